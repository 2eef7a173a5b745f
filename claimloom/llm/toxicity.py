"""Toxicity of texts after undoing disguises: the likeliest plain spelling under a character model of the corpus."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.quality_gam import training_rows
from claimloom.llm.text import utf8
from claimloom.session import stage

#: The lexicon is learned from at most so many labelled rows, the first by a hash of their id.
MAX_TRAINING_ROWS = 40_000
#: Default of ``max_words``: the lexicon keeps the words with the surest evidence; later ones would be rare words of a few texts.
MAX_LEXICON = 2_000
MIN_TEXTS = 3  # toxic texts with a word, told apart by its neighbours there, so that copies count once
ACCEPT = 0.3

#: Characters that stand for letters, and the letters that they may stand for (fixed values).
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "{": "c", "[": "c", "<": "c", "€": "e", "£": "l", "¥": "y",
    "¢": "c", "*": "aeiou", "#": "h", "%": "o",
}
#: Letters of other scripts that look like Latin ones (fixed values).
LOOKS_LIKE = str.maketrans(
    "авекмнорстухіјѕԁԛԝɑοαερτυικνϲıł", "abekmhopctyxijsdqwaoaeptuiknc" + "il"
)
_INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])

LETTERS = "abcdefghijklmnopqrstuvwxyz"
_K = 27  # letters and the word border
_CODE = {c: i for i, c in enumerate(LETTERS)} | {" ": 26}
_TO_CODE = bytes(b - 97 if 97 <= b <= 122 else 26 for b in range(256))
#: Costs of the channel, as log probabilities.
KEEP, SWAP, DROP_MARK, DROP_STAND, SQUEEZE, SQUEEZE_PAIR, DOUBLE, BORDER = 0.0, -1.0, -0.5, -4.0, -0.5, -5.0, -1.5, -3.0
STAND_PAIR, DROP_PAIR, DROP_EDGE = -2.5, -8.0, -1.5  # two of a stand-in for one letter, or for none; three and more at an edge for none
_PLAIN = re.compile(r"[a-z]+")
_LONG_RUN = re.compile(r"([a-z])\1\1")
#: Marks at a token's edges that stand for nothing; what may stand for a letter is left to the lattice.
_HEAD = re.compile(r"""^[^\w\s@$!|+({\[<€£¥¢*#%]+""")
_TAIL = re.compile(r"""[^\w\s@$!|+({\[<€£¥¢*#%]+$""")
#: The same marks among ASCII characters.
_EDGES = "\"&'),-./:;=>?\\]^`}~"
_SINGLE = re.compile(r"(?:([a-z])(?!\1))+")  # letters, none followed by itself
_NUMBER = re.compile(r"[-+$€£¥¢#(\[{<|]*\d[\d.,:/-]*[%€£¥¢+)\]}|*!]*")
_APART = "-.,_~·•/\\:;'\"–—"  # what may stand between letters one by one
_CACHED = 200_000  # tokens, and words, that a task remembers
_KINDS = 500_000  # tokens whose kind a worker remembers, under 100 MB
_STEP = 1 << 19  # letters counted at a time
_TEXTS = 64  # toxic texts whose words are counted before they leave a task


def _folded(lower: str) -> str:
    text = unicodedata.normalize("NFKD", lower.translate(_INVISIBLE)).translate(LOOKS_LIKE)
    return "".join(c for c in text if not unicodedata.combining(c))


#: Letters up to here fold one by one: none of them joins with another.
_LATIN = "\u024f"
_FOLDED = {c: _folded(chr(c)) for c in range(0x80, ord(_LATIN) + 1)}


def fold(text: str) -> str:
    """Lower-case letters without accents; look-alikes as Latin letters."""
    text = text.lower()
    if text.isascii():
        return text
    return text.translate(_FOLDED) if max(text) <= _LATIN else _folded(text)


def letter_counts(texts: list[bytes | None]) -> np.ndarray:
    """Counts of the four-letter sequences of texts (borders included), indexed in base 27."""
    plain = [unicodedata.normalize("NFKD", t.decode()).encode("ascii", "ignore") if not t.isascii() else t for t in texts if t]
    codes = np.frombuffer(b"   ".join([b"", *plain, b""]).lower().translate(_TO_CODE), dtype=np.uint8)
    border = codes == 26
    keep = np.ones(len(codes), dtype=bool)
    keep[3:] = ~(border[3:] & border[2:-1] & border[1:-2] & border[:-3])
    codes = codes[keep]
    total = np.zeros(_K**4, dtype=np.int64)
    for at in range(0, len(codes) - 3, _STEP):  # a step's numbers take a few MB
        c = codes[at : at + _STEP + 3].astype(np.int32)
        grams, n = np.unique(((c[:-3] * _K + c[1:-2]) * _K + c[2:-1]) * _K + c[3:], return_counts=True)
        total[grams] += n
    return total


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(letter | three before), from the counts of all documents, smoothed by shorter contexts.

    A task sends its sums only; at most 27 to the fourth, 531,441, sums reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_K**4, dtype=np.int64)
        for batch in batches:
            total += letter_counts(utf8(batch.column(0)))
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["gram", "n"])

    sums = docs.select(F.col("text").cast("string")).mapInArrow(run, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(_K**4)
    counts[sums.column("gram").to_numpy()] = sums.column("n").to_numpy()
    return log_model(counts)


def log_model(counts: np.ndarray) -> np.ndarray:
    four = counts.reshape((_K,) * 4)
    p = np.full(_K, 1 / _K)
    for depth in (1, 2, 3, 4):
        c = four.sum(axis=tuple(range(4 - depth)))
        p = (c + 5.0 * p) / (c.sum(axis=-1, keepdims=True) + 5.0)
    return np.log(p).astype(np.float32)


def lattice(token: str, spaced: bool = False) -> list[list[tuple[str, float]]]:
    """What each run of one character in a folded token may have been, with the channel's cost."""
    steps = []
    at = 0
    while at < len(token):
        if not spaced and (same := _SINGLE.match(token, at)) and (at == 0 or token[at - 1] != token[at]):
            steps.append([(same[0], KEEP)])
            at = same.end()
            continue
        c, end = token[at], at + 1
        while end < len(token) and token[end] == c and not spaced:
            end += 1
        n, at = end - at, end
        if c in _CODE:
            options = [(c * n, KEEP)] if n <= 2 else []
            if n > 1:
                options.append((c, SQUEEZE if n > 2 else SQUEEZE_PAIR))
            if n > 2:
                options.append((c * 2, DOUBLE))
        elif c in STANDS_FOR:
            drop = DROP_STAND
            if c == "!" and at == len(token):
                drop = DROP_MARK
            elif n == 2:
                drop = DROP_PAIR
            elif n > 2 and not c.isdigit() and (at == n or at == len(token)):
                drop = DROP_EDGE
            options = [(x, STAND_PAIR if n == 2 else SWAP) for x in STANDS_FOR[c]] + [("", drop)]
            if n > 1:
                options += [(x * 2, SWAP if n == 2 else SWAP + DOUBLE) for x in STANDS_FOR[c]]
        else:
            options = [("", DROP_MARK)]
        if spaced:
            options += [(x + " ", cost + BORDER) for x, cost in options if x]
        steps.append(options)
    return steps


def viterbi(steps: list[list[tuple[str, float]]], model: np.ndarray) -> str:
    """The likeliest string through a lattice; states are the last three letters."""
    first = next((i for i, options in enumerate(steps) if len(options) > 1), len(steps))
    plain = "".join([options[0][0] for options in steps[:first]])  # all paths begin with it
    if first == len(steps):
        return plain.strip()
    log = memoryview(np.ascontiguousarray(model).reshape(-1))
    start = _K**3 - 1
    for letter in plain[-3:]:
        start = (start * _K + _CODE[letter]) % _K**3
    states: dict[int, tuple[float, str]] = {start: (0.0, plain)}
    for options in [*steps[first:], [(" ", 0.0)]]:
        coded = [(letters, [_CODE[x] for x in letters], cost) for letters, cost in options]
        following: dict[int, tuple[float, str]] = {}
        for state, (score, text) in states.items():
            for letters, codes, cost in coded:
                to, s = state, score + cost
                for code in codes:
                    if code == 26 and to % _K == 26:
                        continue
                    to = to * _K + code
                    s += log[to]
                    to %= _K**3
                found = following.get(to)
                if found is None or s > found[0]:
                    following[to] = (s, text + letters)
        states = following
    return max(states.values())[1].strip()


def word_score(word: str, model: np.ndarray) -> float:
    a = b = c = 26
    s = 0.0
    for letter in word + " ":
        code = _CODE.get(letter, 26)
        s += float(model[a, b, c, code])
        a, b, c = b, c, code
    return s


class _Tokens(dict):
    """Plain words of tokens ("": none; None: one letter, which its neighbours decide), remembered for what a task sees again."""

    def __init__(self, model: np.ndarray) -> None:
        self.model = model

    def __missing__(self, token: str) -> str | None:
        found = self.plain(token)
        if len(self) < _CACHED:
            self[token] = found
        return found

    def plain(self, token: str) -> str | None:
        if len(token) == 1 and (token.isalpha() or token in STANDS_FOR):
            return None
        plain = fold(token)
        core = plain.strip(_EDGES)
        if core.isascii() and core.isalpha():
            return viterbi(lattice(core), self.model) if _LONG_RUN.search(core) else core
        core = _TAIL.sub("", _HEAD.sub("", plain))
        if _PLAIN.fullmatch(core):
            return viterbi(lattice(core), self.model) if _LONG_RUN.search(core) else core
        if _NUMBER.fullmatch(core) or not any(c in _CODE or c in STANDS_FOR for c in core):
            return ""
        return viterbi(lattice(core), self.model)


class Restorer:
    """Plain words of texts."""

    def __init__(self, model: np.ndarray) -> None:
        self.model = model
        self.known = _Tokens(model)

    def words(self, text: str) -> list[str]:
        """The words of a text as they were probably meant, without marks."""
        return self.of_tokens(text.split())

    def of_tokens(self, tokens: list[str]) -> list[str]:
        plain = list(map(self.known.__getitem__, tokens))
        if None not in plain:
            return [w for w in plain if w]
        out: list[str] = []
        at = 0
        while True:
            try:
                first = plain.index(None, at)
            except ValueError:
                out += filter(None, plain[at:])
                return out
            out += filter(None, plain[at:first])
            single, at = [tokens[first]], first + 1
            while at < len(tokens):  # letters one by one, marks between them left out
                if plain[at] is None:
                    single.append(tokens[at])
                elif tokens[at].strip(_APART):
                    break
                at += 1
            self._close(single, out)

    def _close(self, single: list[str], out: list[str]) -> None:
        """Letters one by one: from three on they may be words spelled out."""
        if len(single) >= 3:
            spelled = [fold(c) for c in single]
            spelled = "".join(c for c in spelled if c in _CODE or c in STANDS_FOR)
            if any(c in _CODE for c in spelled) or (len(set(spelled)) > 1 and not spelled.isdigit()):
                out.extend(viterbi(lattice(spelled, spaced=True), self.model).split())
        else:
            out.extend(w for c in single if (w := fold(c)) in _CODE)


def restore(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """``docs`` with ``restored``: the plain words of each text (null: none), for readers of the decoded text."""

    @F.pandas_udf("string")
    def words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restorer = Restorer(model)
        for batch in batches:
            yield batch.map(lambda t: " ".join(restorer.words(t or "")))

    return docs.withColumn("restored", words(F.col("text").cast("string")))


def units(word: str) -> list[str]:
    """What a word may be known by: itself (with a border) and its beginnings of four to eight letters."""
    return [word + " ", *(word[:n] for n in range(4, min(len(word), 8) + 1))]


N_EVIDENCE = 5
#: What a token can do in a text: nothing, not even as a neighbour; be no word; weigh something, or be one
#: letter; begin a word of the lexicon, end one, or both, without any weight of its own.
_IDLE, _NONE, _TELLS, _BEGINS, _ENDS, _BOTH = range(6)
_TELLING = re.compile(rb"\x02|[\x03\x05]\x01*[\x04\x05]")


class _Kinds(dict):
    """Kinds of tokens under a lexicon, remembered for what a task sees again."""

    def __init__(self, scorer: Scorer, restorer: Restorer) -> None:
        self.scorer, self.restorer = scorer, restorer
        self.begins = {u[:n] for u in scorer.lexicon if u.endswith(" ") for n in range(1, len(u) - 1)}
        self.ends = {u[n:-1] for u in scorer.lexicon if u.endswith(" ") for n in range(1, len(u) - 1)}
        self.weights: dict[str, float] = {}

    def __missing__(self, token: str) -> int:
        word = self.restorer.known.plain(token)
        if word is None or (word and self.weight(word)):
            found = _TELLS
        elif word:
            found = (_IDLE, _BEGINS, _ENDS, _BOTH)[(word in self.begins) + 2 * (word in self.ends)]
        else:
            found = _NONE
        if len(self) < _KINDS:
            self[token] = found
        return found

    def weight(self, word: str) -> float:
        found = self.weights.get(word)
        if found is None:
            found = self.scorer.weight(word)
            if len(self.weights) < _CACHED:
                self.weights[word] = found
        return found


@dataclass
class Scorer:
    """Weights of words and beginnings of words, and a logistic curve over what they say of a text."""

    model: np.ndarray
    lexicon: dict[str, float]
    curve: np.ndarray
    squeezed: dict[str, float] = field(init=False)
    starts: set[str] = field(init=False)

    def __post_init__(self) -> None:
        whole = {u[:-1]: w for u, w in self.lexicon.items() if u.endswith(" ")}
        self.squeezed = {_squeeze(u): w for u, w in sorted(whole.items(), key=lambda x: x[1]) if len(u) > 3}
        self.starts = {u[:3] for u in self.lexicon} | {u[:2] for u in self.squeezed}

    def weight(self, word: str) -> float:
        if word[:3] not in self.starts and word[:2] not in self.starts and word + " " not in self.lexicon and word[:1] != word[1:2]:
            return 0.0
        found = max((self.lexicon.get(u, 0.0) for u in units(word)), default=0.0)
        return found or (self.squeezed.get(_squeeze(word), 0.0) if len(word) > 3 else 0.0)

    def _joined(self, last: str, word: str) -> float:
        """Weight of two words that the character model rather takes for one."""
        w = self.lexicon.get(last + word + " ", 0.0)
        apart = word_score(last, self.model) + word_score(word, self.model) + BORDER if w else 0.0
        return w if w and word_score(last + word, self.model) > apart else 0.0

    def kinds(self) -> _Kinds:
        """Kinds of tokens under this lexicon; one table a worker, which its tasks share."""
        if not hasattr(self, "_kinds"):
            self._kinds = _Kinds(self, Restorer(self.model))
        return self._kinds

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_kinds"}

    def evidence(self, text: str) -> list[float]:
        """[1, strongest weight, what it has over 3, the next two, log of the rest], over different words.

        Most tokens neither weigh anything nor begin or end a word that does, and
        part their neighbours; only what stands between them is looked at, and only
        where something weighs or two neighbours may be one word.
        """
        tokens, kinds = text.split(), self.kinds()
        restorer = kinds.restorer
        found: dict[str, float] = {}
        of, end = bytes(map(kinds.__getitem__, tokens)), 0
        while run := _TELLING.search(of, end):
            start, end = of.rfind(b"\0", end, run.start()) + 1 or end, of.find(b"\0", run.end())
            if end < 0:
                end = len(of)
            last = ""
            for word in restorer.of_tokens(tokens[start:end]):
                w = kinds.weight(word)
                if not w and last and len(last) + len(word) > 4:
                    w = self._joined(last, word)
                if w:
                    found[word] = max(w, found.get(word, 0.0))
                last = word
        top = sorted(found.values(), reverse=True)
        most = top[0] if top else 0.0
        return [1.0, most, max(0.0, most - 3), sum(top[1:3]), float(np.log1p(sum(top[3:])))]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(x @ self.curve))) if len(x) else np.empty(0)


_SAME = re.compile(r"(.)\1+", re.DOTALL)


def _squeeze(word: str) -> str:
    return _SAME.sub(r"\1", word)


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps; the evidence never counts against toxicity."""
    base = (y.sum() + 1) / (len(y) + 2)
    w = np.zeros(N_EVIDENCE)
    w[0] = np.log(base / (1 - base))
    if len(y) == 0 or y.min() == y.max():
        return w
    for _ in range(30):
        p = 1 / (1 + np.exp(-(x @ w)))
        ridge = np.array([1e-3, *[0.1] * (N_EVIDENCE - 1)])
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return np.array([w[0], *np.maximum(w[1:], 0.0)])


def _half(text: bytes | None) -> int:
    return xxhash.xxh3_64_intdigest(text or b"") & 1


def _best(counted: DataFrame, max_words: int = MAX_LEXICON) -> dict[str, float]:
    """Weights of the units with the surest evidence: a lower bound of their share of toxic uses, as log odds."""
    uses = F.col("toxic") + F.col("harmless") + 1.0
    share = (F.col("toxic") + 0.5) / uses
    found = counted.withColumn("sure", share - F.sqrt(share * (1 - share) / uses))
    found = found.where((F.col("texts") >= MIN_TEXTS) & (F.col("sure") > 0.6))
    rows = found.orderBy(F.desc("sure"), F.desc("toxic"), "unit").limit(max_words).collect()
    return {r.unit: float(np.log(r.sure / (1 - min(r.sure, 0.999)))) for r in rows}


def _places(said: list[str], at: list[int]) -> set[tuple[str, int]]:
    """Different neighbourhoods of the words at some places of a text."""
    return {(said[i], xxhash.xxh3_64_intdigest(" ".join(said[max(0, i - 1) : i + 2])) >> 1) for i in at}


def _toxic_units(model: np.ndarray):
    """Uses of every unit of toxic texts, text by text: half, unit, least place (it stands for the text), places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in (b.slice(at, _TEXTS) for b in batches for at in range(0, len(b), _TEXTS)):
            rows: list[tuple[int, str, int, int]] = []
            for text in utf8(batch.column(0)):
                half, said = _half(text), restorer.words((text or b"").decode())
                uses: dict[str, list[int]] = {}
                for word, place in _places(said, range(len(said))):
                    for unit in units(word):
                        uses.setdefault(unit, []).append(place)
                rows += [(half, unit, min(places), len(places)) for unit, places in uses.items()]
            columns = zip(*rows) if rows else ((), (), (), ())
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["half", "unit", "text", "uses"])

    return run


class _Asked(dict):
    """The units of a word that are among those asked for, remembered for what a task sees again."""

    def __init__(self, asked: frozenset[str]) -> None:
        self.asked = asked

    def __missing__(self, word: str) -> tuple[str, ...]:
        found = tuple(u for u in units(word) if u in self.asked)
        if len(self) < _CACHED:
            self[word] = found
        return found


def _harmless_units(model: np.ndarray, asked):
    """Uses of the units asked for in harmless texts, summed by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, of_word = Restorer(model), _Asked(asked.value)
        uses: dict[tuple[int, str], int] = {}
        for batch in batches:
            for text in utf8(batch.column(0)):
                half, said = _half(text), restorer.words((text or b"").decode())
                found = list(map(of_word.__getitem__, said))
                for word, _ in _places(said, [i for i, f in enumerate(found) if f]):
                    for unit in of_word[word]:
                        uses[half, unit] = uses.get((half, unit), 0) + 1
        halves, names = zip(*uses) if uses else ((), ())
        columns = [pa.array(halves, pa.int32()), pa.array(names, pa.string()), pa.array(list(uses.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["half", "unit", "uses"])

    return run


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray, max_rows: int = MAX_TRAINING_ROWS, max_words: int = MAX_LEXICON) -> Scorer:
    """Lexicon and curve from ``labels`` (doc_id, toxic).

    The evidence of a word or a beginning of words is the number of different
    neighbourhoods that it has in toxic texts against those in harmless texts,
    text by text. The curve is fitted on evidence by words learned from the other
    half of the texts (copies of a text fall into one half); the lexicon is then
    learned from all. Toxic texts are counted first; harmless ones are asked only
    for the units that ``MIN_TEXTS`` toxic texts have, of which there are as many
    as the bounded rows give. At most ``max_words`` words and ``max_rows`` rows of five
    numbers reach the driver.
    """
    rows = stage(training_rows(docs, labels, "toxic", max_rows), "toxic_texts")
    label, text = rows.columns[:2]
    counted = rows.where(F.col(label) != 0).select(text).mapInArrow(_toxic_units(model), "half int, unit string, text bigint, uses bigint")
    # copies of a text have one least place, and count once
    counted = counted.groupBy("half", "unit", "text").agg(F.max("uses").alias("most"))
    counted = stage(counted.groupBy("half", "unit").agg(F.sum("most").alias("toxic"), F.count("text").alias("texts")), "toxic_units")
    asked = counted.groupBy("unit").agg(F.sum("texts").alias("texts")).where(F.col("texts") >= MIN_TEXTS).select("unit").toArrow()
    asked = docs.sparkSession.sparkContext.broadcast(frozenset(asked.column("unit").to_pylist()))
    harmless = rows.where(F.col(label) == 0).select(text).mapInArrow(_harmless_units(model, asked), "half int, unit string, uses bigint")
    harmless = harmless.groupBy("half", "unit").agg(F.sum("uses").alias("harmless"))
    counted = counted.join(harmless, ["half", "unit"], "full").na.fill(0, ["toxic", "texts", "harmless"])
    counted = stage(counted, "unit_counts")
    judges = [Scorer(model, _best(counted.where(F.col("half") != h), max_words), np.zeros(N_EVIDENCE)) for h in (0, 1)]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = [(_half(t), (t or b"").decode()) for t in utf8(batch.column(1))]
            x = [judges[h].evidence(t) for h, t in halves]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    other = rows.mapInArrow(weigh, "label int, x array<double>").toArrow()
    y = other.column("label").to_numpy().astype(np.float64)
    x = np.array(other.column("x").to_pylist(), dtype=np.float64).reshape(len(y), N_EVIDENCE)
    order = np.lexsort((*x.T, y))
    whole = counted.groupBy("unit").agg(*(F.sum(c).alias(c) for c in ("toxic", "texts", "harmless")))
    return Scorer(model, _best(whole, max_words), _fit_curve(x[order], y[order]))


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, max_rows: int = MAX_TRAINING_ROWS, max_words: int = MAX_LEXICON) -> DataFrame:
    """doc_id, score (higher: likelier toxic), predicted (score >= 0.3) of every row of ``docs``.

    The character model is counted over all of ``docs``, without labels.
    ``held_out`` is a condition on ``labels``: rows for which it holds teach
    nothing, nor do null labels or labels without a document. Null and empty
    texts have no evidence and the score of such texts. Rows are scored one by
    one, so repeats, ties and other columns do not matter; an empty table gives no rows.
    """
    teach = labels if held_out is None else labels.where(~held_out)
    scorer = learn(docs, teach, character_model(docs), max_rows, max_words)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # 2 MB of letters, at most 2,000 words

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array([shared.value.evidence(t or "") for t in batch], dtype=np.float64).reshape(len(batch), N_EVIDENCE)
            yield pd.Series(shared.value.score(x))

    scored = docs.select("doc_id", score(F.col("text").cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
