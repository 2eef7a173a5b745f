"""Anti joins behind a key filter of bounded size: fact rows are probed where they are, before any shuffle.

A filter is a table of 64-bit words, (word, bits), made from a dimension's keys.

* Whole-number keys that lie close together give an exact filter, one bit per
  key: a fact row is an orphan or it is not, and no fact row is shuffled.
* Other keys give a Bloom filter, whose bits of a key are in one word: a row
  whose bits are missing is an orphan for certain; the rest, and only the rest,
  is counted per key and joined exactly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.session import stage

#: Most words of a filter: 16 MB as (word, bits). Nothing larger is broadcast.
MAX_WORDS = 1 << 20
#: Class numbers of a key are a byte; 0 is no key.
MAX_CLASSES = 255
ERROR_RATE = 0.01
_SEED_WORD, _SEED_BITS = 11, 12
_WORD_BITS = 64


def _number(df: DataFrame, key: str) -> Column | None:
    """A whole number or a date as BIGINT; None for other types."""
    kind = dict(df.dtypes)[key]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(key).cast("bigint")
    return F.unix_date(key).cast("bigint") if kind == "date" else None


@dataclass(frozen=True)
class KeyFilter:
    """``words``: (word, bits), at most ``MAX_WORDS`` rows, stored; ``hashes`` is 0 if the filter is exact."""

    words: DataFrame
    total: int
    hashes: int = 0

    def place(self, df: DataFrame, key: str) -> tuple[Column, Column]:
        """Word and bits of a key."""
        if not self.hashes:
            number = _number(df, key)
            return F.shiftright(number, 6), _bit(number.bitwiseAND(_WORD_BITS - 1))
        return _bloom_place(df, key, self.total, self.hashes)

    def probe(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """``df`` with the boolean ``name``: the key is in the filter (a null key is not). Rows stay where they are."""
        word, bits = self.place(df, key)
        found = self.words.select(F.col("word").alias(f"_w_{name}"), F.col("bits").alias(f"_b_{name}"))
        joined = df.withColumn(f"_p_{name}", bits).join(F.broadcast(found), word == F.col(f"_w_{name}"), "left")
        hit = F.col(f"_b_{name}").bitwiseAND(F.col(f"_p_{name}")) == F.col(f"_p_{name}")
        return joined.withColumn(name, F.coalesce(hit, F.lit(False))).drop(f"_w_{name}", f"_b_{name}", f"_p_{name}")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def _bloom_place(df: DataFrame, key: str, words: int, hashes: int) -> tuple[Column, Column]:
    """The word of a hashed key and its ``hashes`` bits, six bits of a second hash each."""
    text = F.col(key).cast("string")
    word = F.pmod(F.xxhash64(F.lit(_SEED_WORD), text), F.lit(words))
    source, bits = F.xxhash64(F.lit(_SEED_BITS), text), F.lit(0).cast("bigint")
    for k in range(hashes):
        bits = bits.bitwiseOR(_bit(F.shiftright(source, 6 * k).bitwiseAND(_WORD_BITS - 1)))
    return word, F.when(F.col(key).isNotNull(), bits)


def _exact(dim: DataFrame, key: str) -> KeyFilter | None:
    number = _number(dim, key)
    if number is None:
        return None
    rows = dim.where(F.col(key).isNotNull())
    near = rows.agg(F.approx_count_distinct(F.shiftright(number, 6)).alias("words")).first()["words"]
    if near > MAX_WORDS:
        return None
    words = rows.groupBy(F.shiftright(number, 6).alias("word")).agg(F.bit_or(_bit(number.bitwiseAND(_WORD_BITS - 1))).alias("bits"))
    words = stage(words, "key_words")
    total = words.count()
    return KeyFilter(words, total) if total <= MAX_WORDS else None


def _bloom(dim: DataFrame, key: str, error_rate: float) -> KeyFilter:
    """Sized for the error rate, as far as ``MAX_WORDS`` allows; a fuller filter only leaves more rows to the join."""
    keys = max(dim.select(key).agg(F.approx_count_distinct(key)).first()[0], 1)
    bits = max(1.0, -math.log(error_rate) / math.log(2) ** 2) * 1.5  # words fill unevenly: half as many bits more
    words = min(max(1, math.ceil(keys * bits / _WORD_BITS)), MAX_WORDS)
    hashes = min(max(1, round(min(bits, words * _WORD_BITS / keys) * math.log(2))), 10)
    word, mask = _bloom_place(dim, key, words, hashes)
    table = dim.where(F.col(key).isNotNull()).groupBy(word.alias("word")).agg(F.bit_or(mask).alias("bits"))
    return KeyFilter(stage(table, "bloom_words"), words, hashes)


def key_filter(dim: DataFrame, key: str, error_rate: float = ERROR_RATE, exact: bool = True) -> KeyFilter:
    """A filter of a dimension's keys (nulls left out): exact where the keys are dense whole numbers, else a Bloom filter.

    Its table is aggregated by word in the dimension's tasks and stored, and its
    number of rows is checked before it is ever broadcast.
    """
    found = _exact(dim, key) if exact else None
    return found or _bloom(dim, key, error_rate)


def orphan_counts(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, error_rate: float = ERROR_RATE, exact: bool = True) -> DataFrame:
    """Per fact key without a dimension row its number of fact rows (null keys included): ``key``, ``rows``.

    ``fact`` may hold other columns; they are not read. Keys of both sides are of one type.
    """
    dim_key = dim_key or key
    members = key_filter(dim, dim_key, error_rate, exact)
    probed = members.probe(fact.select(key), key, "_known")
    certain = probed.where(~F.col("_known")).groupBy(key).agg(F.count("*").alias("rows"))
    if not members.hashes:
        return certain
    suspects = probed.where(F.col("_known")).groupBy(key).agg(F.count("*").alias("rows"))
    rest = suspects.join(dim.select(F.col(dim_key).alias(key)), key, "left_anti")
    return certain.unionByName(rest)


def known_rows(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key the dimension has: by an exact filter where there is one, else by a semi join."""
    members = _exact(dim, key) if _number(fact, key) is not None else None
    if members is None:
        return fact.join(dim.select(key), key, "left_semi")
    return members.probe(fact, key, "_known").where("_known").drop("_known")


def all_known(fact: DataFrame, dim: DataFrame, key: str) -> bool:
    """Whether every non-null key of ``fact`` is one of ``dim``, by an exact filter: no fact row is shuffled.

    False as well where there is no exact filter of bounded size, which is not looked at further.
    """
    members = _exact(dim, key) if _number(fact, key) is not None else None
    if members is None:
        return False
    probed = members.probe(fact.select(key).where(F.col(key).isNotNull()), key, "_known")
    return probed.where(~F.col("_known")).isEmpty()


def classed_rows(fact: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame | None:
    """``fact`` inner joined to the ``columns`` of a dimension, without moving a fact row.

    Whole-number keys that lie close together, and columns of at most 255 value
    pairs in all: a 64-bit word holds the class numbers of eight keys, 0 for none.
    None where that is not so, where the words would be more than ``MAX_WORDS``,
    or where a key occurs twice, whose rows a join repeats.
    """
    number = _number(dim, key)
    if number is None or _number(fact, key) is None:
        return None
    rows = dim.where(F.col(key).isNotNull()).select(key, *columns)
    word, slot = F.shiftright(number, 3), number.bitwiseAND(7).cast("int")
    if rows.agg(F.approx_count_distinct(word)).first()[0] > MAX_WORDS:
        return None
    values = rows.select(*columns).distinct().limit(MAX_CLASSES + 1).collect()
    if len(values) > MAX_CLASSES:
        return None
    kinds = ", ".join(f"`{c}` {kind}" for c, kind in rows.select(*columns).dtypes)
    classes = dim.sparkSession.createDataFrame([(i + 1, *v) for i, v in enumerate(values)], f"_class bigint, {kinds}")
    named = classes.select("_class", *[F.col(c).alias(f"_of_{c}") for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    shift = lambda value, by: F.call_function("shiftleft", value, by)
    numbered = rows.join(F.broadcast(named), same).select(word.alias("_word"), slot.alias("slot"), "_class")
    words = numbered.groupBy("_word").agg(
        F.bit_or(shift(F.col("_class"), F.col("slot") * 8)).alias("_classes"), F.bit_count(F.bit_or(shift(F.lit(1), F.col("slot")))).alias("keys"), F.count("*").alias("rows")
    )
    words = stage(words, "key_classes")
    total = words.agg(F.count("*").alias("words"), F.coalesce(F.sum(F.col("rows") - F.col("keys")), F.lit(0)).alias("surplus")).first()
    if total["words"] > MAX_WORDS or total["surplus"]:
        return None
    number = _number(fact, key)
    found = fact.join(F.broadcast(words.select("_word", "_classes")), F.shiftright(number, 3) == F.col("_word"))
    placed = F.call_function("shiftright", F.col("_classes"), (number.bitwiseAND(7) * 8).cast("int")).bitwiseAND(MAX_CLASSES)
    return found.withColumn("_place", placed).join(F.broadcast(classes), F.col("_place") == F.col("_class")).drop("_word", "_classes", "_place", "_class")


def missing_counts(fact: DataFrame, dims: dict[str, tuple[DataFrame, str, str]]) -> DataFrame | None:
    """One row: fact rows without a dimension row per name, all in one pass over the fact and without moving it.

    ``dims`` maps a name to (dimension, dimension key, fact key). None if a dimension
    has no exact filter of bounded size, or keys of another type than the fact's.
    """
    filters = {}
    for name, (dim, dim_key, fact_key) in dims.items():
        if _number(fact, fact_key) is None or (dict(fact.dtypes)[fact_key] == "date") != (dict(dim.dtypes)[dim_key] == "date"):
            return None
        found = _exact(dim, dim_key)
        if found is None:
            return None
        filters[name] = found
    rows = fact.select(*{fact_key for _, _, fact_key in dims.values()})
    for name, members in filters.items():
        rows = members.probe(rows, dims[name][2], f"_in_{name}")
    return rows.agg(*[F.count_if(~F.col(f"_in_{name}")).alias(name) for name in dims])
