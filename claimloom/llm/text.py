"""Words and word shingles of texts, as numpy arrays inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Everything but space and the five ASCII control spaces belongs to a word.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
_MASK = (1 << 64) - 1
_CACHED_WORDS = 200_000
STEP_ROWS = 500


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes | None]:
    """A text column as bytes, without decoding it."""
    return column.cast(pa.large_binary()).to_pylist()


def in_steps(batches: Iterator[pa.RecordBatch], rows: int = STEP_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task holds besides its batch stays small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def lower_words(text: bytes | None) -> list[bytes]:
    """Words with A-Z in lower case; ``bytes`` methods touch ASCII only, which is what is wanted."""
    return (text or b"").lower().split()


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise a 64-bit hash so that every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of words, remembered for the words that a task sees again."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < _CACHED_WORDS:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_PLACES = odd_multipliers(64, 5)


def window_hashes(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in order (none if there are fewer)."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.full(n, np.uint64(size * 0x9E3779B97F4A7C15 & _MASK), dtype=np.uint64)
    for k in range(size):
        h += word_hashes[k : k + n] * _PLACES[k]
    return mix(h)


def shingle_set(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles, sorted; a shorter text is one shingle, a text without words none."""
    if not len(word_hashes):
        return np.empty(0, dtype=np.uint64)
    return np.unique(window_hashes(word_hashes, min(size, len(word_hashes))))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
