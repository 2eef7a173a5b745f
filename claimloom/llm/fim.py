"""Fill-in-middle documents by displacement scatter.

A batch of texts is one buffer of bytes. The cuts of its documents make
segments; each byte of a segment moves by the same distance. The distances are
written as differences at the segments' starts, a cumulative sum spreads them,
and one scatter builds all outputs. Restoring finds the marks in the outputs and
gathers the bytes back the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = 3  # bytes of a mark
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100: rows that are transformed, and of these the rows in suffix-prefix-middle order.
FIM_PERCENT, SPM_PERCENT = 90, 20
SEED = "1:"
_CHUNK_BYTES = 2 << 20  # bytes scattered at a time; a longer text goes alone

_ADDED = ["n", "form", "prefix_chars", "middle_chars", "output"]


def id_numbers(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of a row's id (null: no digits)."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def _chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with a bounded number of bytes; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _CHUNK_BYTES, side="right")) - 1)
        end = min(end, len(column))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def moves(starts: np.ndarray, targets: np.ndarray, total: int) -> np.ndarray:
    """For every byte where it goes: segments, in order, begin at ``starts`` and are moved to ``targets``."""
    difference = np.zeros(total + 1, dtype=np.int64)
    shifts = targets - starts
    np.add.at(difference, starts, np.diff(shifts, prepend=0))  # empty segments share a start: their differences add up
    place = np.cumsum(difference[:total])
    place += np.arange(total)
    return place


def scatter(data: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of one chunk (bytes, offsets). ``a`` and ``b``: byte cuts from the chunk's start; ``form``: 0 plain, 1 psm, 2 spm."""
    begin, end = offsets[:-1], offsets[1:]
    grown = np.where(form > 0, 3 * MARK, 0)
    out_offsets = np.concatenate([[0], np.cumsum(end - begin + grown)])
    o = out_offsets[:-1]
    spm = form == 2
    first, last = a - begin, end - b
    to_prefix = np.where(spm, o + 2 * MARK + last, np.where(form > 0, o + MARK, o))
    to_suffix = np.where(spm, o + MARK, np.where(form > 0, o + 2 * MARK + first, o + (b - begin)))
    to_middle = np.where(form > 0, o + 3 * MARK + first + last, o + first)
    starts = np.stack([begin, a, b], axis=1).ravel()
    place = moves(starts, np.stack([to_prefix, to_middle, to_suffix], axis=1).ravel(), len(data))
    out = np.empty(out_offsets[-1], dtype=np.uint8)
    out[place] = data
    cut = form > 0
    for mark, at in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        for k, byte in enumerate(mark.encode()):
            out[at[cut] - MARK + k] = byte
    return out, out_offsets


def gather(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of one chunk of outputs (bytes, offsets): the inverse of ``scatter`` from output and form alone."""
    begin, end = offsets[:-1], offsets[1:]
    cut = form > 0
    marks = {}
    for mark in (PREFIX, SUFFIX, MIDDLE):
        low, mid, high = mark.encode()
        at = np.flatnonzero((data[:-2] == low) & (data[1:-1] == mid) & (data[2:] == high))
        row = np.searchsorted(offsets, at, side="right") - 1
        at = at[cut[row] & (at + MARK <= end[row])]
        marks[mark] = begin.copy()
        marks[mark][cut] = at  # a transformed text held no mark, so each output has one of each
    spm = form == 2
    p, s, m = marks[PREFIX] + MARK, marks[SUFFIX] + MARK, marks[MIDDLE] + MARK
    prefix_end = np.where(spm, m - MARK, s - MARK)
    suffix_end = np.where(spm, p - MARK, m - MARK)
    p, prefix_end = np.where(cut, p, begin), np.where(cut, prefix_end, end)
    m, middle_end = np.where(cut, m, end), end
    s, suffix_end = np.where(cut, s, end), np.where(cut, suffix_end, end)
    text_offsets = np.concatenate([[0], np.cumsum(end - begin - np.where(cut, 3 * MARK, 0))])
    t = text_offsets[:-1]
    starts = np.stack([t, t + prefix_end - p, t + prefix_end - p + middle_end - m], axis=1).ravel()
    source = moves(starts, np.stack([p, m, s], axis=1).ravel(), int(text_offsets[-1]))
    return data[source], text_offsets


def _texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _forms(column: pa.Array) -> np.ndarray:
    return np.array([{PSM: 1, SPM: 2}.get(f, 0) for f in column.to_pylist()], dtype=np.int64)


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns of the input, then _text, _form, _h1, _h2, which are replaced by what is added; a chunk is a batch."""
    for batch in batches:
        k = batch.num_columns - 4
        forms = _forms(batch.column(k + 1))
        h1, h2 = (batch.column(k + j).to_numpy(zero_copy_only=False) for j in (2, 3))
        for at, end, data, offsets in _chunks(batch.column(k)):
            form = forms[at:end]
            points = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of the code points
            bounds = np.searchsorted(points, offsets)
            points = np.append(points, len(data))
            n = np.diff(bounds)
            x, y = h1[at:end] % (n + 1), h2[at:end] % (n + 1)
            low, high = np.minimum(x, y), np.maximum(x, y)
            out = scatter(data, offsets, points[bounds[:-1] + low], points[bounds[:-1] + high], form)
            part = batch.slice(at, end - at)
            added = [pa.array(n), part.column(k + 1), pa.array(low, mask=form == 0), pa.array(high - low, mask=form == 0), _texts(*out)]
            yield pa.RecordBatch.from_arrays(part.columns[:k] + added, names=batch.schema.names[:k] + _ADDED)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns of the input, then _output and _form, which are replaced by the text."""
    for batch in batches:
        k = batch.num_columns - 2
        forms = _forms(batch.column(k + 1))
        for at, end, data, offsets in _chunks(batch.column(k)):
            columns = batch.slice(at, end - at).columns[:k] + [_texts(*gather(data, offsets, forms[at:end]))]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:k] + ["restored"])


def fim_documents(
    docs: DataFrame, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with n (code points), form, prefix_chars, middle_chars and output, the fill-in-middle text.

    The cuts are two numbers of the id modulo n + 1, in code points. A null text
    is empty. A text that is empty or holds a mark stays as it is (form plain,
    prefix_chars and middle_chars null), as do the rows that ``fim_percent`` leaves
    out. Rows with equal ids and texts are alike; a null id counts as no digits.
    Columns called like an added one are replaced, all others are kept. A batch
    is worked on in runs of 2 MB, so memory is bounded by the longest text; no shuffle.
    """
    docs = docs.drop(*[c for c in _ADDED if c != text_col])
    h1, h2, h3, h4 = id_numbers(F.col(id_col), seed)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(mark))
    plain = (text == "") | marked | (h3 % 100 >= fim_percent)
    form = F.when(plain, PLAIN).when(h4 % 100 < spm_percent, SPM).otherwise(PSM)
    given = docs.select(*docs.columns, text.alias("_text"), form.alias("_form"), h1.alias("_h1"), h2.alias("_h2"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return given.mapInArrow(_transform, f"{schema}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restore(transformed: DataFrame) -> DataFrame:
    """``transformed`` with ``restored``: the text rebuilt from ``output`` and ``form`` alone."""
    rows = transformed.drop("restored")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    given = rows.select("*", F.col("output").alias("_output"), F.col("form").alias("_form"))
    return given.mapInArrow(_restore, f"{schema}, restored string")
