"""Secrets in texts: fixed forms, and strings that a battery of randomness tests finds."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
_LONG_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")

#: A candidate is judged against natural text of the longest of these lengths that it reaches.
LENGTHS = (20, 28, 40, 64)
_CUTS = np.concatenate([[0], np.cumsum(LENGTHS)])
FALSE_DISCOVERIES = 0.01
#: Statistics are counted in steps of 0.05 up to 20.
STEP, STEPS = 0.05, 400

#: Alphabets by the characters that are used, the smallest first.
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("any", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)
_SETS = [frozenset(a) for _, a in ALPHABETS]
_INDEX = np.full((len(ALPHABETS), 128), -1, dtype=np.int64)
for _i, (_, _letters) in enumerate(ALPHABETS):
    _INDEX[_i, [ord(c) for c in _letters]] = np.arange(len(_letters))


def battery(symbols: np.ndarray, k: int) -> np.ndarray:
    """How far each row of symbols (0 to k - 1) is from a random string: the largest of three scores.

    Chi-squared of the symbol counts (as a normal score), number of runs above
    and below the middle of the alphabet, and correlation of neighbours. Each is
    about standard normal for random rows, whatever their length and alphabet.
    """
    m, n = symbols.shape
    flat = (symbols + np.arange(m)[:, None] * k).ravel()
    counts = np.bincount(flat, minlength=m * k).reshape(m, k)
    chi = (counts.astype(np.float64) ** 2).sum(axis=1) * k / n - n
    df = k - 1
    uniform = (np.cbrt(chi / df) - (1 - 2 / (9 * df))) / np.sqrt(2 / (9 * df))
    high = symbols >= k // 2
    share = (k - k // 2) / k
    change = 2 * share * (1 - share)
    mean = (n - 1) * change
    spread = np.sqrt(max((n - 1) * change * (1 - change), 1e-9))
    runs = np.abs((high[:, 1:] != high[:, :-1]).sum(axis=1) - mean) / spread
    centred = symbols - symbols.mean(axis=1, keepdims=True)
    power = (centred**2).sum(axis=1)
    serial = np.abs((centred[:, 1:] * centred[:, :-1]).sum(axis=1)) / np.maximum(power, 1e-9) * np.sqrt(n)
    return np.maximum(np.maximum(uniform, runs), np.where(power > 0, serial, 99.0))


def _bin(scores: np.ndarray) -> np.ndarray:
    return np.clip(np.ceil(scores / STEP), 0, STEPS - 1).astype(np.int64)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    # runs are maximal, so asking for the length at once gives the same matches as dropping short ones
    found += [(m.start(), 1, m.end()) for m in _LONG_ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


def _free(start: int, end: int, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Parts of a run that no fixed form covers."""
    for a, _, b in base:
        if a < end and start < b:
            if start < a:
                yield start, a
            start = max(start, b)
    if start < end:
        yield start, end


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, length class, binned score) of long strings, and of what fixed forms leave of them."""
    found = []
    for m in _RUN.finditer(text):
        for start, end in _free(m.start(), m.end(), base):
            run = text[start:end].rstrip("=")
            if len(run) < LENGTHS[0]:
                continue
            used = set(run)
            i = next(i for i, s in enumerate(_SETS) if used <= s)
            symbols = _INDEX[i, np.frombuffer(run.encode(), dtype=np.uint8)]
            score = battery(symbols[None, :], len(ALPHABETS[i][1]))
            found.append((start, end, sum(len(run) >= n for n in LENGTHS) - 1, int(_bin(score)[0])))
    return found


_LONG = re.compile(rb"[A-Za-z0-9+/_-]{20,}")
_NO_LETTERS = bytes(b for b in range(256) if not chr(b).isascii() or not chr(b).isalpha())


def natural_scores(texts: list[str | None]) -> np.ndarray:
    """counts[length, binned score] of ordinary words: those of a text, run together and cut into pieces of each length in turn.

    What a text has left under 152 letters is not used, so counts do not depend
    on which texts a task reads. Candidates take no part.
    """
    counts = np.zeros((len(LENGTHS), STEPS), dtype=np.int64)
    size = int(_CUTS[-1])
    words = [_LONG.sub(b"", t.encode("ascii", "ignore")).translate(None, _NO_LETTERS) for t in texts if t]
    letters = np.frombuffer(b"".join([w[: len(w) // size * size] for w in words]), dtype=np.uint8)
    m = len(letters) // size
    for at in range(0, m, 10_000):
        pieces = letters[at * size : min(at + 10_000, m) * size].reshape(-1, size)
        for j in range(len(LENGTHS)):
            part = pieces[:, _CUTS[j] : _CUTS[j + 1]]
            lower = (part >= 97).all(axis=1)
            for i, rows in ((3, part[lower]), (6, part[~lower])):
                if len(rows):
                    counts[j] += np.bincount(_bin(battery(_INDEX[i, rows], len(ALPHABETS[i][1]))), minlength=STEPS)
    return counts


def thresholds(docs: DataFrame, rate: float = FALSE_DISCOVERIES) -> list[int]:
    """Per length, the highest binned score that counts as random; -1: none.

    Over all texts, natural pieces and candidates are counted by length and
    score; 3,200 sums reach the driver. A candidate's p-value is the share of
    natural pieces of its length that look as random as it does, and the
    Benjamini-Hochberg rule over the candidates of that length keeps the
    expected share of false ones under ``rate``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        natural, seen = np.zeros((len(LENGTHS), STEPS), dtype=np.int64), np.zeros((len(LENGTHS), STEPS), dtype=np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            natural += natural_scores(texts)
            for text in texts:
                if text:
                    for _, _, j, b in candidates(text, base_spans(text)):
                        seen[j, b] += 1
        j, b = np.nonzero(natural + seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(j, pa.int32()), pa.array(b, pa.int32()), pa.array(natural[j, b]), pa.array(seen[j, b])],
            names=["length", "bin", "natural", "seen"],
        )

    sums = docs.select(F.col("text").cast("string")).mapInArrow(run, "length int, bin int, natural bigint, seen bigint")
    natural, seen = np.zeros((len(LENGTHS), STEPS)), np.zeros((len(LENGTHS), STEPS))
    for j, b, n, s in sums.groupBy("length", "bin").agg(F.sum("natural"), F.sum("seen")).collect():
        natural[j, b], seen[j, b] = n, s
    limits = []
    for j in range(len(LENGTHS)):
        p = (1 + np.cumsum(natural[j])) / (1 + natural[j].sum())
        ranks = np.cumsum(seen[j])
        passing = np.nonzero((ranks > 0) & (p * max(ranks[-1], 1) <= rate * ranks))[0]
        limits.append(int(passing[-1]) if len(passing) else -1)
    return limits


def all_spans(text: str, limits: list[int]) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    return sorted(base + [(a, 3, b) for a, b, j, score in candidates(text, base) if score <= limits[j]])


def find_secrets(docs: DataFrame, limits: list[int] | None = None) -> DataFrame:
    """Every row of ``docs`` with ``secrets``: an array of (kind, start, end), code points, end exclusive, by start, then kind.

    kinds: assign, access and hex are fixed forms; random is what the tests
    find besides. Null and empty texts have none. Rows are scanned one by one
    against limits from all rows, so repeats and ties change nothing; all other
    columns pass through, but one called ``secrets`` is replaced.
    """
    limits = thresholds(docs) if limits is None else limits

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in all_spans(t or "", limits)])

    return docs.withColumn("secrets", spans(F.col("text").cast("string")))


def redact(docs: DataFrame, mark: str = "[SECRET]", limits: list[int] | None = None) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark`` (overlapping spans by one); null stays null."""
    limits = thresholds(docs) if limits is None else limits

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: t if not t else without(t, all_spans(t, limits), mark))

    return docs.withColumn("text", clean(F.col("text").cast("string")))


def without(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if spans else text
