import numpy as np
from test_near_dedup import shingles

from claimloom.llm.decontaminate import Index, clean_documents, contained_items, matches
from claimloom.llm.text import WordHashes, lower_words


def test_same_as_all_pairs(spark, small):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = small.union(small.where("doc_id < 40").selectExpr("doc_id + 100000", "concat(repeat('zz yy ', 9000), text, ' tail')", "lang", "source", "n_chars"))
    got = {tuple(r) for r in contained_items(docs, items).collect()}
    sets = {r.item_id: shingles(r.text) for r in items.collect()}
    want = set()
    for r in docs.collect():
        mine = shingles(r.text)
        want |= {(r.doc_id, i, len(s & mine), len(s)) for i, s in sets.items() if 100 * len(s & mine) >= 80 * len(s)}
    assert want and got == want


def test_partial_items_at_the_threshold(spark):
    words = [f"i{k}" for k in range(44)]  # 40 shingles
    items = spark.createDataFrame([(1, " ".join(words)), (2, "tiny item"), (3, ""), (4, None), (None, "a b c d e f")], "item_id bigint, text string")
    at = " ".join(words[:36])  # 32 of 40
    below = " ".join(words[:35])
    docs = [(1, at), (2, below), (3, "x " * 5000 + at.upper() + " y" * 5000), (4, "a Tiny item b"), (5, None), (6, ""), (None, at), (1, at), (7, "tiny")]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id, r.shared) for r in contained_items(docs, items).collect()}
    assert got == {(1, 1, 32), (3, 1, 32), (4, 2, 1), (None, 1, 32)}
    assert sorted(str(r.doc_id) for r in clean_documents(docs, items).collect()) == ["2", "5", "6", "7"]
    more = docs.union(spark.createDataFrame([(1, "another text"), (None, "and one")], docs.schema))
    assert sorted(str(r.doc_id) for r in clean_documents(more, items).collect()) == ["1", "2", "5", "6", "7", "None"]


def test_nothing(spark, edge, nothing):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert contained_items(edge, items).count() == 0
    assert contained_items(nothing, spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")).count() == 0
    kept = clean_documents(edge, items)
    assert kept.columns == edge.columns and kept.count() == edge.count()


def test_small_items_anywhere_in_a_line_of_documents(spark):
    """Items of one to four shingles that open, close or fill a document are never missed."""
    rng = np.random.default_rng(3)
    words = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 9)))) for i in range(2000)]
    index = Index()
    for i, text in items:
        index.add(i, WordHashes().of(lower_words(text.encode())))
    index.close()
    hashes = WordHashes()
    for i, text in items:
        found = matches(index, [hashes.of(lower_words(f"{text} tail t1 t2 t3".encode())), hashes.of(lower_words(f"t4 t5 {text}".encode()))])
        assert {(0, i), (1, i)} <= {m[:2] for m in found}
