"""Byte-pair encoding without merging: longest matches, checked pair by pair, with backtracking."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD_END = "\0"  # stands for the end-of-word suffix; no byte is written as this character
_CACHED = 200_000  # words, pairs and pieces that a worker remembers
_PIECE = 40  # letters of a piece that is remembered
_STEP_BYTES = 1 << 20  # of texts that are encoded and decoded at a time; a longer text goes alone
#: White space as the vocabulary's own pattern means it. It parts words and is in none, so it need not be made one space first.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The parts of a tokenizer file that this encoder follows; others are refused.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PRETOKENIZERS = ["Split", "ByteLevel"]


def _byte_letters() -> str:
    """The letter for each byte: printable Latin-1 bytes as they are, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(other)) for b in range(256))


_LETTERS = _byte_letters()


class _Pieces(dict):
    """Tokens of what stands between spaces, as bytes, remembered for what a worker sees again."""

    def __init__(self, codec: Codec) -> None:
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        found = np.array(self.codec.encode(piece), dtype="<u4").tobytes()
        if len(self) < _CACHED and len(piece) <= _PIECE:
            self[piece] = found
        return found


class Codec:
    """Exact encoder and decoder of one vocabulary file with word ends."""

    def __init__(self, raw: bytes) -> None:
        spec = json.loads(raw)
        model, suffix = spec["model"], spec["model"].get("end_of_word_suffix")
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", ())]
        cuts = [p["type"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", ())]
        if model["type"] != "BPE" or not suffix or steps != _NORMALIZERS or cuts != _PRETOKENIZERS or spec["decoder"] is not None:
            raise ValueError("the vocabulary file has parts that this encoder does not follow")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self._words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", _WHITE))
        # the decoder's table: all tokens in one buffer, a space after each
        vocab = model["vocab"]
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        pieces = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self.table = np.frombuffer(b"".join([p + b" " for p in pieces]), dtype=np.uint8)
        self.sizes = np.array([len(p) + 1 for p in pieces])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self._parts = (vocab, model["merges"], suffix)
        self._matches = None

    def _prepare(self) -> None:
        """The encoder's tables, made when a first text is encoded."""
        vocab, merges, suffix = self._parts
        ids = {t.removesuffix(suffix) + _WORD_END if t.endswith(suffix) else t: i for t, i in vocab.items()}
        self._merges: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> (rank, merged)
        self._halves: dict[int, tuple[int, int, int]] = {}  # token -> (rank, left, right)
        for rank, (left, right) in enumerate(merges):
            pair, merged = (vocab[left], vocab[right]), vocab[left + right]
            self._merges[pair] = (rank, merged)
            self._halves.setdefault(merged, (rank, *pair))
        self._matches = ahocorasick.Automaton()
        for text, i in ids.items():
            self._matches.add_word(text, (i, len(text)))
        self._matches.make_automaton()
        self._size = {i: len(text) for text, i in ids.items()}
        self._joins: dict[tuple[int, int], bool] = {}
        self._known: dict[str, tuple[int, ...]] = {}
        self._pieces = _Pieces(self)

    def _edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """Tokens that stood at one edge while ``token`` was merged, each with the rank of the merge that took it in."""
        chain, taken = [], 1 << 60
        while True:
            chain.append((token, taken))
            if token not in self._halves:
                return chain
            taken, left, last = self._halves[token]
            token = last if right else left

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the text of ``a`` and ``b`` gives just these two again: no merge across the border comes first.

        Of merges of one rank the leftmost comes first: one inside ``a`` before
        one across the border, and that before one inside ``b``.
        """
        known = self._joins.get((a, b))
        if known is None:
            known = True
            right = self._edge(b, False)
            for x, x_taken in self._edge(a, True):
                for y, y_taken in right:
                    found = self._merges.get((x, y))
                    if found and found[0] < x_taken and found[0] <= y_taken:
                        known = False
            if len(self._joins) < _CACHED:
                self._joins[a, b] = known
        return known

    def _encode_word(self, word: str) -> tuple[int, ...]:
        text = "".join([_LETTERS[b] for b in word.encode()]) + _WORD_END
        n = len(text)
        # the longest matches one after the other, if their borders hold, are the answer
        greedy, place = [], 0
        for end, (token, size) in self._matches.iter_long(text):
            if end + 1 - size != place or (greedy and not self.compatible(greedy[-1], token)):
                break
            greedy.append(token)
            place = end + 1
        if place == n:
            return tuple(greedy)
        at: list[list[int]] = [[] for _ in range(n)]  # tokens from each place, longest last
        for end, (token, size) in self._matches.iter(text):
            at[end + 1 - size].append(token)
        dead = bytearray(n + 1)
        tokens: list[int] = []
        place, left = 0, [len(at[0])]  # matches not yet tried, for each place on the way
        while place < n:
            last = tokens[-1] if tokens else -1
            choice = left[-1]
            while choice:
                choice -= 1
                token = at[place][choice]
                end = place + self._size[token]
                if not dead[end] and (last < 0 or self.compatible(last, token)):
                    left[-1] = choice
                    tokens.append(token)
                    place = end
                    left.append(len(at[end]) if end < n else 0)
                    break
            else:
                # nothing goes on from here: as compatibility looks at two tokens only, this place need not be tried again
                dead[place] = 1
                left.pop()
                place -= self._size[tokens.pop()]
        return tuple(tokens)

    def _normal(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()  # letter by letter: no final sigma

    def _plain(self, text: str, out: list[int]) -> None:
        known = self._known
        for word in self._words.findall(self._normal(text)):
            ids = known.get(word)
            if ids is None:
                ids = self._encode_word(word)
                if len(known) < _CACHED:
                    known[word] = ids
            out += ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text; strings of special tokens in it are those tokens."""
        if self._matches is None:
            self._prepare()
        out: list[int] = []
        at = 0
        for m in self._special.finditer(text):
            self._plain(text[at : m.start()], out)
            out.append(self.special[m[0]])
            at = m.end()
        self._plain(text[at:], out)
        return out

    def encode_bytes(self, text: str) -> bytes:
        """``encode`` as little-endian unsigned 32-bit integers, joined from what the worker remembers of the text's pieces.

        Spaces and line ends part words, special tokens and letters that would be
        composed, so what stands between them is encoded alike wherever it stands.
        """
        if self._matches is None:
            self._prepare()
        return b"".join(map(self._pieces.__getitem__, text.replace("\n", " ").split(" ")))

    def decode(self, ids: list[int]) -> bytes:
        """The tokens' texts with a space between, as UTF-8 (the file names no decoder, so word ends stay)."""
        data, _ = self.decode_all(np.array(ids, dtype=np.int64), np.array([0, len(ids)]))
        return data[:-1].tobytes()

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts of many rows, ``bounds`` of their tokens given: all bytes, a space after each token, and each row's bounds.

        One gather over the table of all tokens: where a token starts there, moved by where its text starts here.
        """
        starts, sizes = self.starts[ids], self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        place = np.repeat(starts - ends[:-1], sizes)
        place += np.arange(ends[-1])
        return self.table[place], ends[bounds]


@lru_cache(maxsize=1)
def codec(raw: bytes) -> Codec:
    """One codec a worker process: its tasks share the words that it remembers."""
    return Codec(raw)


def _raw(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _steps(column: pa.Array, limit: int = _STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows with about ``limit`` bytes."""
    sizes = np.nan_to_num(pc.binary_length(column).to_numpy(zero_copy_only=False)).astype(np.int64)
    at, ends = 0, np.cumsum(sizes)
    while at < len(column):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield at, stop
        at = stop


def _encoded(codec: Codec, texts: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """Tokens of each text as bytes, and the bounds of the texts' tokens laid end to end."""
    found = [codec.encode_bytes(t) if t else b"" for t in texts.to_pylist()]
    return found, np.concatenate([[0], np.cumsum([len(f) >> 2 for f in found])]).astype(np.int64)


def _ids(found: list[bytes], bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.frombuffer(b"".join(found), dtype="<i4"), pa.int32()))


def _decoded(codec: Codec, ids: np.ndarray, bounds: np.ndarray) -> list[memoryview]:
    """Texts of rows of tokens, as UTF-8."""
    data, ends = codec.decode_all(ids, bounds)
    view = memoryview(data)
    return [view[a : max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _sha(parts) -> pa.Array:
    return pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())


def _given(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), docs.schema[id_col].dataType.simpleString()


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of every row's whole text.

    Null and empty texts have no tokens. Repeated rows are encoded alike, null
    ids pass through, other columns are ignored, and an empty table gives no
    rows. The vocabulary file (a few MB, the same for any corpus) is read by the
    driver and broadcast, so executors need not have it.
    """
    raw = docs.sparkSession.sparkContext.broadcast(_raw(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_file = codec(raw.value)
        for batch in batches:
            for at, stop in _steps(batch.column(1)):
                part = batch.slice(at, stop - at)
                found, bounds = _encoded(with_file, part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(bounds), pa.int64()), _ids(found, bounds)], names=["doc_id", "n_tokens", "ids"]
                )

    given, kind = _given(docs, id_col, text_col)
    return given.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids array<int>")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): ``encode_documents`` and ``decode_documents`` in one pass.

    Each task decodes what it has encoded from the tokens alone, and sends
    digests of both; ``keep_ids=False`` leaves out ``ids``. Nulls, repeated
    rows and empty tables as in ``encode_documents``.
    """
    raw = docs.sparkSession.sparkContext.broadcast(_raw(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_file = codec(raw.value)
        for batch in batches:
            for at, stop in _steps(batch.column(1)):
                part = batch.slice(at, stop - at)
                found, bounds = _encoded(with_file, part.column(1))
                texts = _decoded(with_file, np.frombuffer(b"".join(found), dtype="<u4"), bounds)
                columns = {"doc_id": part.column(0), "n_tokens": pa.array(np.diff(bounds), pa.int64())}
                columns |= {"ids": _ids(found, bounds)} if keep_ids else {}
                columns |= {"ids_sha256": _sha(found), "decoded_sha256": _sha(texts)}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    given, kind = _given(docs, id_col, text_col)
    ids = "ids array<int>, " if keep_ids else ""
    return given.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, {ids}ids_sha256 string, decoded_sha256 string")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the decoded text, and digests of ids and text."""
    raw = encoded.sparkSession.sparkContext.broadcast(_raw(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_file = codec(raw.value)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                column = part.column(2).fill_null([])
                ids, bounds = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(np.diff(column.offsets.to_numpy()))])
                texts = _decoded(with_file, ids, bounds)
                rows = [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                decoded = pa.array([bytes(t).decode() for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), decoded, _sha(rows), _sha(texts)],
                    names=["doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"],
                )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids array<int>, decoded string, ids_sha256 string, decoded_sha256 string"
    )
