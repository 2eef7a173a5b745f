from collections import Counter, defaultdict

from pyspark.sql import functions as F

from claimloom.llm.sharding import histogram_shards, with_keys


def check(rows, shards, total, slack):
    sizes, slots, texts = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        texts[r.text].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(abs(sizes[i] - total / shards) <= slack for i in range(shards))
    return texts


def test_bytes_are_near_equal_and_equal_texts_together(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = histogram_shards(docs, 8).collect()
    assert len(rows) == docs.count()
    total = sum(r["size"] for r in rows)
    assert all(r["size"] == len((r.text or "").encode()) + 16 for r in rows)
    largest = max(r["size"] for r in rows)
    texts = check(rows, 8, total, 0.01 * total / 8 + largest)
    assert max(map(len, texts.values())) == 1


def test_a_text_with_a_third_of_the_rows_is_split(spark):
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text again")).otherwise(F.concat(F.lit("t"), "id")).alias("text")
    )
    rows = histogram_shards(docs, 10).collect()
    total = sum(r["size"] for r in rows)
    texts = check(rows, 10, total, 0.02 * total / 10)
    assert len(texts["same text again"]) > 3
    again = {r.doc_id: (r.shard, r.slot) for r in histogram_shards(docs.repartition(13), 10).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in rows}


def test_edge_rows(edge, nothing):
    rows = histogram_shards(edge).collect()
    assert len(rows) == edge.count() and set(edge.columns) <= set(rows[0].asDict())
    assert all(0 <= r.shard < 40 for r in rows)
    assert {r["size"] for r in rows if r.text is None} == {16}
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert histogram_shards(nothing).count() == 0


def test_same_as_a_plain_cut_of_the_sorted_rows(spark):
    """Rows in key order, cut where their bytes come within the tolerance of each share; slots count on within a shard."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    shards, tolerance = 13, 0.05
    rows = sorted(with_keys(histogram_shards(docs, shards, tolerance)).collect(), key=lambda r: (r._k1, r._k2))
    assert [r.shard for r in rows] == sorted(r.shard for r in rows) and {r.shard for r in rows} == set(range(shards))
    total = sum(r._size for r in rows)
    for i in range(1, shards):
        below = sum(r._size for r in rows if r.shard < i)
        largest = max(r._size for r in rows if r.shard in (i - 1, i))
        assert abs(below - total * i / shards) <= max(tolerance * total / shards, largest)
        # slots follow the first digit of the key, then part of its second number, then the key
        inside = sorted((r for r in rows if r.shard == i), key=lambda r: (r._k1 >> 48, r._k2 >> 52, r._k1, r._k2))
        assert [r.slot for r in inside] == list(range(len(inside)))
