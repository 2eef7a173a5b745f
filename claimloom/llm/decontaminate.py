"""Benchmark items inside documents: containment search by MinHash, by size of the items."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.text import WordHashes, in_steps, lower_words, odd_multipliers, shingle_set, utf8, window_hashes
from claimloom.session import stage

WORDS = 5
CONTAINED_PERCENT = 80
#: Items are dealt with in blocks of at most so many; every block meets every document.
BLOCK_ITEMS, BLOCK_SHINGLES = 20_000, 2_000_000
#: A window that holds an item of five shingles or more has at most twice its shingles, so one hash
#: finds 80 % of an item with a chance above 0.36, and all of them miss with a chance under 4e-6.
#: Smaller items are looked up by their shingles and never missed.
HASHES = 28
#: Minima are taken over 32 bits of the shingle hashes, which is quick and enough to name candidates.
_MULTIPLIERS = (odd_multipliers(HASHES, 23) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_TOGETHER = 50_000  # shingles of documents that are searched at once


def strides() -> Iterator[int]:
    """Size classes: items of up to four strides. A class is about a quarter larger than the one before."""
    s = 1
    while True:
        yield s
        s = max(s + 1, s * 5 // 4)


@dataclass
class Table:
    """The minima of one class of items; a bitmap and the sorted minima answer almost all questions at once."""

    items: list[dict[int, list[int]]] = field(default_factory=lambda: [defaultdict(list) for _ in range(HASHES)])
    bitmap: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=bool))
    minima: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.uint32))

    def close(self) -> None:
        self.minima = np.unique(np.array([v for t in self.items for v in t], dtype=np.uint32))
        self.bitmap = np.zeros(1 << max(10, (64 * len(self.minima)).bit_length()), dtype=bool)
        self.bitmap[self._places(self.minima)] = True

    def _places(self, minima: np.ndarray) -> np.ndarray:
        return minima & np.uint32(len(self.bitmap) - 1)

    def hits(self, windows: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """(window, items) where a window has the minimum of items under the same hash."""
        w, j = np.nonzero(self.bitmap[self._places(windows)])
        values = windows[w, j]
        same = self.minima[np.minimum(np.searchsorted(self.minima, values), len(self.minima) - 1)] == values
        for w, j, value in zip(w[same].tolist(), j[same].tolist(), values[same].tolist()):
            items = self.items[j].get(value)
            if items:
                yield w, items


@dataclass
class Lookup:
    """Items of at most four shingles, by shingles of which a document with enough of the item has at least one."""

    items: dict[int, list[int]] = field(default_factory=lambda: defaultdict(list))
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.uint64))
    bitmap: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=bool))

    def add(self, item: int, shingles: np.ndarray, percent: int) -> None:
        needed = -(-percent * len(shingles) // 100)
        for s in shingles[: len(shingles) - max(needed, 1) + 1].tolist():
            self.items[s].append(item)

    def close(self) -> None:
        self.keys = np.unique(np.array(list(self.items), dtype=np.uint64))
        self.bitmap = np.zeros(1 << max(10, (64 * len(self.keys)).bit_length()), dtype=bool)
        self.bitmap[self._places(self.keys)] = True

    def _places(self, shingles: np.ndarray) -> np.ndarray:
        return (shingles & np.uint64(len(self.bitmap) - 1)).astype(np.int64)

    def hits(self, line: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """(place, items) where a shingle of the line is one of an item's."""
        at = np.flatnonzero(self.bitmap[self._places(line)])
        for place, shingle in zip(at.tolist(), line[at].tolist()):
            items = self.items.get(shingle)
            if items:
                yield place, items


@dataclass
class Index:
    """One block of items: shingle sets, and a table per size class."""

    percent: int = CONTAINED_PERCENT
    sets: list[tuple[int, int, np.ndarray]] = field(default_factory=list)  # item, words per shingle, shingles
    #: (words per shingle, stride) -> minima
    classes: dict[tuple[int, int], Table] = field(default_factory=dict)
    small: dict[int, Lookup] = field(default_factory=dict)  # words per shingle -> items of the first class

    def add(self, item_id: int, hashes: np.ndarray) -> None:
        if not len(hashes):
            return
        size = min(WORDS, len(hashes))  # an item of fewer words is one shingle of that many words
        shingles = shingle_set(hashes, WORDS)
        stride = next(s for s in strides() if 4 * s >= len(shingles))
        if stride == 1:
            self.small.setdefault(size, Lookup()).add(len(self.sets), shingles, self.percent)
            self.sets.append((item_id, size, shingles))
            return
        table = self.classes.setdefault((size, stride), Table())
        for items, minimum in zip(table.items, _products(shingles).min(axis=0).tolist()):
            items[minimum].append(len(self.sets))
        self.sets.append((item_id, size, shingles))

    def close(self) -> Index:
        for table in [*self.classes.values(), *self.small.values()]:
            table.close()
        return self


def _products(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(32)).astype(np.uint32)[:, None] * _MULTIPLIERS[None, :]


def _windows(shingles: np.ndarray, stride: int) -> np.ndarray:
    """Minima under every hash of the windows of five strides that start at every stride."""
    runs = np.empty(((len(shingles) + stride - 1) // stride, HASHES), dtype=np.uint32)
    full, step = len(shingles) // stride, max(1, 4096 // stride)
    for at in range(0, full, step):
        part = _products(shingles[at * stride : min(at + step, full) * stride])
        part.reshape(-1, stride, HASHES).min(axis=1, out=runs[at : min(at + step, full)])
    if full < len(runs):
        runs[full] = _products(shingles[full * stride :]).min(axis=0)
    if len(runs) <= 5:
        return runs.min(axis=0, keepdims=True)
    two = np.minimum(runs[:-1], runs[1:])
    four = np.minimum(two[:-2], two[2:])
    return np.minimum(four[:-1], runs[4:])


def matches(index: Index, documents: list[np.ndarray], percent: int = CONTAINED_PERCENT) -> list[tuple[int, int, int, int]]:
    """(document, item, shared shingles, item's shingles) where a document has ``percent`` % of an item's shingles.

    The shingles of the documents are laid end to end. Items of up to four
    shingles are looked up among them. For larger ones, windows are as long as
    the items of a class, and overlap so that one of them holds any item,
    however long its document. Candidates are checked on all shingles of each
    document that the window touches.
    """
    found: set[tuple[int, int]] = set()
    for size in {size for size, _ in index.classes} | set(index.small):
        parts = [window_hashes(d, size) for d in documents]
        starts = np.cumsum([0, *map(len, parts)])
        line = np.concatenate(parts)
        if size in index.small:
            for place, items in index.small[size].hits(line):
                d = int(np.searchsorted(starts, place, side="right")) - 1
                found.update((d, i) for i in items)
        for (other, stride), table in index.classes.items():
            if other != size or not len(line):
                continue
            for w, items in table.hits(_windows(line, stride)):
                first, last = np.searchsorted(starts, [w * stride, min((w + 5) * stride, len(line)) - 1], side="right") - 1
                found.update((d, i) for d in range(first, last + 1) for i in items)
    out, sets = [], {}
    for d, i in sorted(found):
        item, size, shingles = index.sets[i]
        if (d, size) not in sets:
            sets = {k: v for k, v in sets.items() if k[0] == d}
            sets[d, size] = np.unique(window_hashes(documents[d], size))
        shared = len(np.intersect1d(shingles, sets[d, size], assume_unique=True))
        if 100 * shared >= percent * len(shingles):
            out.append((d, item, shared, len(shingles)))
    return out


def _blocks(benchmark: DataFrame, percent: int) -> Iterator[Index]:
    """Items in blocks of bounded size, streamed through the driver one block at a time."""
    hashes, index, shingles = WordHashes(), Index(percent), 0
    for row in benchmark.where("item_id is not null").select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).toLocalIterator():
        words = hashes.of(lower_words((row[1] or "").encode()))
        if index.sets and (len(index.sets) >= BLOCK_ITEMS or shingles + len(words) > BLOCK_SHINGLES):
            yield index.close()
            index, shingles = Index(percent), 0
        index.add(row[0], words)
        shingles += len(words)
    if index.sets:
        yield index.close()


_MATCH = "doc_id bigint, text_hash bigint, item_id bigint, shared bigint, item_shingles bigint"


def contained_items(docs: DataFrame, benchmark: DataFrame, percent: int = CONTAINED_PERCENT) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles): the items of which a document has at least ``percent`` % of the shingles.

    ``benchmark`` (item_id, text) is the stated query set: blocks of at most
    20,000 items or 2 million words are broadcast, each against all documents.
    Shingles are five words, A-Z in lower case; an item of fewer words is one
    shingle and found where a document has these words in a row. Items without
    words or id, and documents without words, match nothing; a null doc_id comes
    back null; a repeated row or item id gives its matches once. Other columns
    are ignored. Without items or documents there are no rows.
    """
    found = _matched(docs, benchmark, percent).drop("text_hash")
    return found.groupBy("doc_id", "item_id").agg(F.max("shared").alias("shared"), F.max_by("item_shingles", "shared").alias("item_shingles"))


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _matched(docs: DataFrame, benchmark: DataFrame, percent: int) -> DataFrame:
    """``contained_items`` row by row, each match with the hash of its row's text."""
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), _text_hash().alias("text_hash"))
    context, found = docs.sparkSession.sparkContext, None
    for block in _blocks(benchmark, percent):
        shared = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in in_steps(batches):
                texts, rows, at = utf8(batch.column(1)), [], 0
                ids = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
                while at < len(texts):
                    together, size = [], 0
                    while at + len(together) < len(texts) and size < _TOGETHER:
                        together.append(hashes.of(lower_words(texts[at + len(together)])))
                        size += len(together[-1])
                    rows += [(*ids[at + d], *match) for d, *match in matches(shared.value, together, percent)]
                    at += len(together)
                columns = zip(*rows) if rows else ((), (), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "text_hash", "item_id", "shared", "item_shingles"]
                )

        part = docs.mapInArrow(run, _MATCH)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], _MATCH) if found is None else found


def clean_documents(docs: DataFrame, benchmark: DataFrame, percent: int = CONTAINED_PERCENT) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text has no item; each text is judged for itself, whatever its doc_id."""
    hit = _matched(docs, benchmark, percent).select(F.col("doc_id").alias("_hit"), F.col("text_hash").alias("_hit_text")).distinct()
    hit = stage(hit, "contaminated")
    rows = docs.withColumn("_text", _text_hash())
    return rows.join(hit, (F.col("_text") == F.col("_hit_text")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("_hit")), "leftanti").drop("_text")
