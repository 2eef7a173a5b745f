import sys
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_near_dedup import plain, shingles
from tokenizers import Tokenizer

from claimloom.llm import secrets as S
from claimloom.llm.text import table

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_all_stages_against_plain_versions(spark):
    docs = table(spark, FOLDER, "documents").cache()
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]
    good = steps["quality"](spark, docs, FOLDER).cache()
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert sum(i in kept for i, q in labels.items() if q) > 0.95 * sum(labels.values())
    assert sum(i in kept for i, q in labels.items() if not q) < 0.3 * sum(not q for q in labels.values())
    texts = {r.doc_id: r.text for r in good.collect()}
    texts = {i: texts[i] for i, (_, root) in plain(texts.items(), 80).items() if i == root}
    single = steps["near_duplicates"](spark, good, FOLDER).cache()
    assert {r.doc_id: r.text for r in single.collect()} == texts
    items = [shingles(r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    texts = {i: t for i, t in texts.items() if not any(100 * len(s & shingles(t)) >= 80 * len(s) for s in items)}
    clean = steps["decontamination"](spark, single, FOLDER).cache()
    assert {r.doc_id: r.text for r in clean.collect()} == texts
    limits = S.thresholds(clean)
    texts = {i: S.without(t, S.all_spans(t, limits), "[SECRET]") for i, t in texts.items()}
    public = steps["secrets"](spark, clean, FOLDER).cache()
    assert {r.doc_id: (r.text, r.n_chars) for r in public.collect()} == {i: (t, len(t)) for i, t in texts.items()}
    for stage in (good, single, clean, public):
        assert stage.dtypes == docs.dtypes
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    assert {r.doc_id: r.ids for r in steps["tokens"](spark, public, FOLDER).collect()} == want
    assert {r.doc_id: r.ids for r in corpus_pipeline.run(spark, FOLDER).collect()} == want


@pytest.mark.parametrize("step", range(5))
def test_edges(spark, edge, nothing, step):
    _, stage = corpus_pipeline.STAGES[step]
    for docs in (edge, nothing, edge.select(*nothing.columns)):
        got = stage(spark, docs, FOLDER)
        if step < 4:
            assert got.dtypes == docs.dtypes
        assert got.count() <= docs.count()
    assert stage(spark, edge.where(F.col("text").isNull()), FOLDER).count() in (0, 2)
