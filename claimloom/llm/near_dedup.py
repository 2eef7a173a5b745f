"""Near-duplicate documents by min-max hashing.

Each multiplication of the shingle hashes is read twice, for its minimum and
for its maximum, so a signature of 2K values takes K hash evaluations. Bands
of the signature name the candidates; links are confirmed on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.components import components, join_heavy
from claimloom.llm.text import WordHashes, in_steps, lower_words, mix, odd_multipliers, shingle_set, signed, utf8
from claimloom.operators.ordinals import ORD, stage_in_order
from claimloom.session import stage

SIGNATURE_VALUES = 420  # at most
BAND_MISS = 1e-6  # chance that a link exactly at the threshold shares no band
BLOCK_ROWS, BLOCK_BYTES = 256, 8 << 20  # documents compared in one group at a time
SKETCH_MARGIN = 0.17  # over 6 standard deviations of the estimate from 350 values
_STEP = 512  # shingles hashed at a time: the products stay in a core's cache


def banding(percent: int) -> tuple[int, int]:
    """(values per band, bands): the longest bands that miss a link at the threshold once in a million."""
    t = percent / 100
    if t >= 1:
        return 8, 2
    found = (1, math.ceil(math.log(BAND_MISS) / math.log1p(-t)))
    for r in range(2, 33):
        b = math.ceil(math.log(BAND_MISS) / math.log1p(-(t**r)))
        b += (r * b) % 2  # an even number of values
        if r * b <= SIGNATURE_VALUES:
            found = (r, b)
    return found


def min_max(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """All minima, then all maxima, of the shingles under each multiplication."""
    low = np.full(len(multipliers), np.uint64(0xFFFFFFFFFFFFFFFF))
    high = np.zeros(len(multipliers), dtype=np.uint64)
    for at in range(0, len(shingles), _STEP):
        values = shingles[at : at + _STEP, None] * multipliers[None, :]
        np.minimum(low, values.min(axis=0), out=low)
        np.maximum(high, values.max(axis=0), out=high)
    return np.concatenate([low, high])


def _signatures(words: int, r: int, bands: int):
    multipliers = odd_multipliers(r * bands // 2, 9)
    places, salts = odd_multipliers(r, 17), mix(np.arange(1, bands + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in in_steps(batches):
            sizes, high, low, keys, sketches = [], [], [], [], []
            for text in utf8(batch.column(1)):
                s = shingle_set(hashes.of(lower_words(text)), words)
                digest = xxhash.xxh3_128_intdigest(s.tobytes())
                sizes.append(len(s))
                high.append((digest >> 64) - (1 << 63))
                low.append((digest & ((1 << 64) - 1)) - (1 << 63))
                if len(s):
                    values = min_max(s, multipliers)
                    keys.append(signed(mix((values.reshape(bands, r) * places).sum(axis=1, dtype=np.uint64) + salts)))
                    sketches.append((values >> np.uint64(32)).astype(np.uint8).tobytes())
                else:
                    keys.append(np.empty(0, dtype=np.int64))
                    sketches.append(b"")
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(high, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_high", "set_low", "keys", "sketch"],
            )

    return run


_FEATURES = "doc_id bigint, n_shingles bigint, set_high bigint, set_low bigint, keys array<bigint>, sketch binary"


def _sets(words: int):
    """Full shingle sets of candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in in_steps(batches):
            sets = [shingle_set(hashes.of(lower_words(t)), words).tobytes() for t in utf8(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(sets, pa.binary())],
                names=["root", "doc_id", "sketch", "shingles"],
            )

    return run


def _forest(percent: int):
    """Confirmed links of one pair of blocks: as many as join what is linked, at most one per document."""

    def run(key, group):
        left, right = key[1].as_py(), key[2].as_py()
        ids = group.column("doc_id").to_pylist()
        block = np.array(group.column("block").to_pylist())
        sets = [np.frombuffer(s, dtype=np.uint64) for s in group.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
        parent = list(range(len(ids)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        found, first = [], np.nonzero(block == left)[0]
        second = first if left == right else np.nonzero(block == right)[0]
        for a in first:
            others = second[second > a] if left == right else second
            n = sizes[others]
            others = others[100 * np.minimum(n, sizes[a]) >= percent * np.maximum(n, sizes[a])]
            likely = (sketch[others] == sketch[a]).mean(axis=1)
            order = np.argsort(-likely, kind="stable")
            for b in others[order][likely[order] >= percent / 100 - SKETCH_MARGIN]:
                x, y = root(int(a)), root(int(b))
                if x == y:
                    continue
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if 100 * both >= percent * (sizes[a] + sizes[b] - both):
                    parent[max(x, y)] = min(x, y)
                    found.append((ids[a], ids[b]))
        return pa.table({"u": pa.array([f[0] for f in found], pa.int64()), "v": pa.array([f[1] for f in found], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of at least ``percent`` / 100 of their shingle sets.

    Returns one row per input row: doc_id, n_shingles, component_id (the
    smallest doc_id it can reach by links), kept (it is that document).

    1. One pass computes signatures. Equal sets are one class, represented by its smallest id.
    2. Per band, every member is tied to the smallest member of its bucket (two
       columns of ids are shuffled, no pairs). The components of these ties hold
       every pair of documents that share a band.
    3. Inside a component, blocks of at most about 256 documents or 8 MB meet each
       other block; a pair of blocks is one group. Sketches pick pairs, full sets
       confirm them, and a group returns only a spanning forest of its links.
    4. The components of the confirmed links are the result.

    Null, empty and white-space-only texts have the empty set and are linked with
    nothing; fewer words than a shingle are one shingle. Rows with the same
    doc_id are one document and share its component. A row without doc_id takes
    part in no link: component_id null, kept true. Other columns are ignored.
    """
    r, bands = banding(percent)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    features = stage(docs.mapInArrow(_signatures(words, r, bands), _FEATURES), "signatures")
    usable = features.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("set_high", "set_low").agg(F.min("doc_id").alias("rep"))
    classes = stage(classes, "classes")
    ones = features.join(classes.select(F.col("rep").alias("doc_id"), "set_high", "set_low"), ["doc_id", "set_high", "set_low"], "leftsemi")
    keys = stage(ones.select("doc_id", F.explode("keys").alias("key")), "bands")
    firsts = keys.groupBy("key").agg(F.min("doc_id").alias("v"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    ties = join_heavy(keys, firsts.where("v <> last").drop("last"), "key", keys.count()).select(F.col("doc_id").alias("u"), "v")
    groups = stage(components(ties).select(F.col("node").alias("doc_id"), "root"), "candidates")

    member = groups.join(features.select("doc_id", "sketch", "set_high", "set_low").join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "set_high", "set_low"], "leftsemi"), "doc_id")
    member = member.dropDuplicates(["doc_id", "set_high", "set_low"]).select("doc_id", "root", "sketch")
    sets = docs.join(member, "doc_id").select("root", "doc_id", "text", "sketch").mapInArrow(
        _sets(words), "root bigint, doc_id bigint, sketch binary, shingles binary"
    )
    sets = stage(sets, "sets")
    size = sets.groupBy("root").agg(F.count("*").alias("n"), F.sum(F.octet_length("shingles")).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    dealt = join_heavy(sets, size.select("root", blocks.alias("blocks"), "n"), "root", sets.count()).withColumn(
        "block", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = dealt.select("root", "doc_id", "sketch", "shingles", "block", other).select(
        "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "doc_id", "block", "sketch", "shingles"
    )
    met = met.repartition("root", "i", "j")  # else the join's order by root would do, with all pairs of a component in one task
    links = met.groupBy("root", "i", "j").applyInArrow(_forest(percent), "u bigint, v bigint")
    roots = components(links).withColumnRenamed("node", "rep")
    labels = classes.join(roots, "rep", "left").select("set_high", "set_low", F.coalesce("root", "rep").alias("label"))
    alone = F.col("n_shingles") == 0
    result = features.select("doc_id", "n_shingles", "set_high", "set_low").join(labels, ["set_high", "set_low"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(alone, F.col("doc_id")).otherwise(F.col("label")))
    return result.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _with_nodes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_node``: a number per different (doc_id, text), which is the doc_id where that names one text.

    Rows without a doc_id, and rows whose doc_id has several texts, get numbers
    after the largest doc_id, in the order of id (null last) and text hash.
    """
    docs = docs.withColumn("_text", F.xxhash64(F.coalesce("text", F.lit(""))))
    ids = docs.groupBy("doc_id").agg(F.min("_text").alias("low"), F.max("_text").alias("high"))
    several = stage(ids.where("doc_id is null or low <> high").select("doc_id"), "several_texts")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    odd = docs.select("doc_id", "_text").join(several.withColumnRenamed("doc_id", "_several"), same("doc_id", "_several"), "leftsemi").distinct()
    last = ids.agg(F.coalesce(F.max("doc_id"), F.lit(0))).first()[0]
    odd = odd.withColumn("_unknown", F.col("doc_id").isNull())
    odd = stage_in_order(odd, ["_unknown", "doc_id", "_text"], "odd_rows").select(
        F.col("doc_id").alias("_odd"), F.col("_text").alias("_odd_text"), (F.col(ORD) + last + 1).alias("_number")
    )
    joined = docs.join(odd, (F.col("_text") == F.col("_odd_text")) & same("doc_id", "_odd"), "left")
    return joined.withColumn("_node", F.coalesce("_number", "doc_id")).drop("_text", "_odd", "_odd_text", "_number")


def one_of_each(docs: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the one with the smallest doc_id.

    All columns are kept. Every different text is judged for itself: rows that
    share a doc_id but not their text are documents of their own, and so are rows
    without a doc_id; both give way to documents with an id of their own. Of rows
    that agree in doc_id and text one stays. Texts without words are in no group.
    """
    numbered = _with_nodes(docs)
    gone = near_duplicates(numbered, percent, words, id_col="_node").where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    stays = numbered.join(stage(gone, "gone"), F.col("_node") == F.col("_gone"), "leftanti")
    return stays.dropDuplicates(["_node"]).drop("_node")
