import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimloom.llm.fim import _chunks, fim_documents, gather, restore, scatter


def plain(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by slices of the text."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def same(docs):
    rows = restore(fim_documents(docs)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text)
        assert r.restored == (r.text or "")
    return rows


def test_same_as_slices(small):
    rows = same(small)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert set(small.columns) <= set(rows[0].asDict())


def test_edge_rows(edge, nothing):
    rows = same(edge.drop("output"))
    assert {r.form for r in rows if not r.text} == {"plain"}
    assert fim_documents(nothing).count() == 0 and restore(fim_documents(nothing)).count() == 0


def test_replaced_columns(small):
    again = restore(fim_documents(small.withColumn("output", F.lit(1)).withColumn("n", F.lit("x")).withColumn("restored", F.lit(2))))
    assert again.columns == [*small.columns, "n", "form", "prefix_chars", "middle_chars", "output", "restored"]


def test_parts_of_marks_at_the_cuts(spark):
    bits = ["<", "<S", "<P", "<M", "S>", "P>", "M>", ">", "<S<P", "é<", "\U0001f600", "<S>", "a<P>b", " "]
    rows = [(i, bits[i % len(bits)] + bits[i * 7 % len(bits)] + bits[i * 5 % 13]) for i in range(600)]
    same(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1))


@pytest.mark.parametrize("seed", range(5))
def test_scatter_and_gather_are_inverse(seed):
    rng = np.random.default_rng(seed)
    texts = ["".join(rng.choice(list("ab<>SPM é\U0001f600"), rng.integers(0, 9))) for _ in range(300)]
    texts = [t for t in texts if not any(m in t for m in ("<P>", "<S>", "<M>"))]
    column = pa.array(texts[3:])
    for at, end, data, offsets in _chunks(column):
        form = rng.integers(0, 3, end - at)
        x = offsets[:-1] + (rng.random(end - at) * (np.diff(offsets) + 1)).astype(int)
        y = offsets[:-1] + (rng.random(end - at) * (np.diff(offsets) + 1)).astype(int)
        out, out_offsets = scatter(data, offsets, np.minimum(x, y), np.maximum(x, y), form)
        back, back_offsets = gather(out, out_offsets, form)
        assert (back == data).all() and (back_offsets == offsets).all()


def test_chunks_are_bounded(monkeypatch):
    monkeypatch.setattr("claimloom.llm.fim._CHUNK_BYTES", 10)
    column = pa.array(["a" * 25, None, "", "bcd", "e" * 9, "f", "g"])
    found = [(at, end, bytes(data)) for at, end, data, _ in _chunks(column)]
    assert b"".join(f[2] for f in found) == b"a" * 25 + b"bcd" + b"e" * 9 + b"fg"
    assert [f[0] for f in found][1:] == [f[1] for f in found][:-1] and found[-1][1] == 7
    assert all(len(f[2]) <= 10 for f in found[1:])
