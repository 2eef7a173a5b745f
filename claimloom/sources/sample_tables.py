"""The claims model as a view over the TPC-H-style sample tables.

A claim is one ``lineitem`` row, so the joins to orders and part are left
joins that are only added when one of their columns is asked for: a report
that needs no diagnosis never reads ``part``.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(2002, 1, 1)
CALENDAR_START = dt.date(1995, 1, 1)

CLAIM_COLUMNS = [
    "claim_id",
    "member_id",
    "provider_id",
    "service_date",
    "diagnosis_code",
    "procedure_code",
    "billed_amount",
    "allowed_amount",
    "paid_amount",
    "place_of_service",
]

# Declared, so that opening a table starts no schema job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}

_FROM_ORDERS = {"member_id", "place_of_service"}
_FROM_PART = {"diagnosis_code", "procedure_code"}

ORDER_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _hundredths(name: str) -> Column:
    """A two-decimal amount stored as DOUBLE, as whole hundredths."""
    return F.floor(F.col(name) * 100 + 0.5)


def _over(amount: Column, divisor: int) -> Column:
    """Whole-number division, half up (amounts are not negative)."""
    return F.call_function("div", amount + divisor // 2, F.lit(divisor))


def _money(hundredths: Column) -> Column:
    """DECIMAL from whole hundredths; products stay in BIGINT until here, which is exact and cheap."""
    return (hundredths * F.lit(Decimal("0.01"))).cast("decimal(12,2)")


class SampleTables:
    """Lazy access to one folder of sample Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def _nation_name(self, key: str, name: str) -> Column:
        """Nation or region name by nation key.

        The nation table has 25 rows at every scale factor, so it is looked up as
        one map value. A join would multiply the size estimates of both sides and
        hide from the optimizer whether a dimension is small enough to broadcast.
        """
        nations = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        entries = F.collect_list(F.struct("n_nationkey", name))
        return F.try_element_at(nations.select(F.map_from_entries(entries)).scalar(), F.col(key))

    def members(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("member_id"),
            key.alias("person_id"),
            F.when(
                key % 50 != 0,
                F.date_add(F.lit(dt.date(1930, 1, 1)), (key * 7919 % 27000).cast("int")),
            ).alias("dob"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            F.when(key % 97 != 0, self._nation_name("c_nationkey", "r_name")).alias("region"),
            F.lit(dt.date(1995, 1, 1)).alias("effective_date"),
            F.lit(None).cast("date").alias("termination_date"),
        )

    def providers(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            key.alias("provider_id"),
            self._nation_name("s_nationkey", "n_name").alias("specialty"),
            F.when(key % 25 != 24, key % 10 < 7).alias("in_network"),
            self._nation_name("s_nationkey", "r_name").alias("region"),
        )

    def claims(self, columns: Sequence[str] = tuple(CLAIM_COLUMNS), keep: Sequence[str] = ()) -> DataFrame:
        """Claim rows with the asked columns; ``keep`` adds raw ``lineitem`` columns."""
        rows = self.table("lineitem")
        wanted = set(columns)
        if wanted & _FROM_ORDERS:
            orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
            rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        if wanted & _FROM_PART:
            part = self.table("part").select("p_partkey", "p_brand", "p_type")
            rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        billed = _hundredths("l_extendedprice")
        kept = 100 - _hundredths("l_discount")
        untaxed = 100 - _hundredths("l_tax")
        exprs = {
            "claim_id": F.concat_ws("-", *ORDER_KEYS),
            "member_id": F.col("o_custkey") if wanted & _FROM_ORDERS else None,
            "provider_id": F.col("l_suppkey"),
            "service_date": F.col("l_shipdate").cast("date"),
            "diagnosis_code": F.col("p_brand") if wanted & _FROM_PART else None,
            "procedure_code": F.col("p_type") if wanted & _FROM_PART else None,
            "billed_amount": _money(billed),
            "allowed_amount": _money(_over(billed * kept, 100)),
            "paid_amount": _money(_over(billed * kept * untaxed, 10_000)),
            "place_of_service": F.col("o_orderpriority") if wanted & _FROM_ORDERS else None,
        }
        return rows.select(*[exprs[c].alias(c) for c in columns], *keep)
