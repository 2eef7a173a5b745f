"""Queries over refreshes: observed counts, bitmaps and filters, shared and catalog tables, quarantined lines, ordered files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.operators import distinct, filters
from claimloom.operators.ordinals import ORD
from claimloom.plans import adhoc, export, ingest, job, quality, reports, warehouse
from claimloom.queries import CLIENT_MAP, client_feed, query
from claimloom.session import new_path, stage
from claimloom.sources import catalog, clients, store
from claimloom.sources.config import FeedConfig
from claimloom.sources.feeds import read_quarantine
from claimloom.sources.sample_tables import AS_OF, ORDER_KEYS, SampleTables
from claimloom.stored_queries import _star


# ---- bitmaps and filters ------------------------------------------------------------
def _order_claims(spark: SparkSession, folder: str) -> DataFrame:
    """A claim per order line whose id is the order's number: given out as often as the order has lines; urgent ones have none."""
    lines = SampleTables(spark, folder).table("lineitem")
    return lines.select(F.when(F.col("l_linenumber") != 6, F.col("l_orderkey").cast("bigint")).alias("claim_id"), F.year("l_shipdate").alias("year"))


@query
def id_surplus(spark: SparkSession, folder: str) -> DataFrame:
    """Claims beyond the first of their id, per year and in all; the whole is merged from the years' bitmaps."""
    claims = _order_claims(spark, folder)
    bitmaps = stage(distinct.id_bitmaps(claims, "claim_id", ["year"]), "bitmaps")
    count = [F.sum(F.bitmap_count("bits")).alias("distinct_ids"), F.sum("rows").alias("rows")]
    per_year = bitmaps.groupBy("year").agg(*count)
    whole = distinct.merge_bitmaps(bitmaps).agg(*count).select(F.lit(None).cast("int").alias("year"), "distinct_ids", "rows")
    return per_year.unionByName(whole).withColumn("surplus", F.col("rows") - F.col("distinct_ids"))


@query
def repeated_claim_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every claim id that occurs more than once; only rows of buckets with such an id are grouped."""
    return distinct.repeated_ids(_order_claims(spark, folder), "claim_id")


@query
def gate_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The gate's count of surplus claims over numeric ids, nulls included."""
    claims = _order_claims(spark, folder)
    rows, surplus = distinct.surplus_of(claims, "claim_id")
    return rows.agg(surplus.alias("surplus"))


def _in_credit(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Claims whose key is a text, some of them null, and the customers that are not in debt."""
    t = SampleTables(spark, folder)
    named = lambda c: F.concat(F.lit("M"), F.col(c))
    fact = t.claims(["member_id", "provider_id"]).select(F.when(F.col("provider_id") % 50 != 0, named("member_id")).alias("member_id"))
    return fact, t.table("customer").where("c_acctbal >= 0").select(named("c_custkey").alias("member_id"))


@query
def filtered_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Claims per key that no member has, behind Bloom filters of three error rates; all give the same."""
    fact, listed = _in_credit(spark, folder)
    out = None
    for percent in (30, 5, 1):
        found = filters.orphan_counts(fact, listed, "member_id", error_rate=percent / 100)
        found = found.select(F.lit(percent).alias("error_percent"), "member_id", "rows")
        out = found if out is None else out.unionByName(found)
    return out


@query
def numeric_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Claims per numeric key that no member has, by an exact filter: no claim is moved before it is known to be one."""
    t = SampleTables(spark, folder)
    listed = t.table("customer").where("c_acctbal >= 0").select(F.col("c_custkey").cast("bigint").alias("member_id"))
    return filters.orphan_counts(t.claims(["member_id"]), listed, "member_id")


# ---- observed writes ----------------------------------------------------------------
@query
def observed_writes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, nulls per column and money totals of stored tables, as their writes counted them; no table is read for it."""
    t = SampleTables(spark, folder)
    root = new_path(spark, "observed")
    claims = t.claims(["member_id", "provider_id", "service_date", "billed_amount", "allowed_amount", "paid_amount"])
    faulty = claims.withColumn("provider_id", F.when(F.col("provider_id") % 10 != 3, F.col("provider_id")))
    members = t.members().drop("effective_date", "termination_date")
    tables = {"member": members, "provider": t.providers(), "claim": faulty, "no_claim": claims.where("member_id < 0")}
    store.publish(spark, root, tables)
    return store.table_stats(spark, root)


# ---- shared, partitioned and named tables ---------------------------------------------
@query
def client_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Two clients in one table before and after one of them is replaced; the other keeps its very files."""
    t = SampleTables(spark, folder)
    claims = t.claims(["claim_id", "member_id", "paid_amount"], keep=["l_linestatus", "l_quantity"])
    of = lambda status: claims.where(F.col("l_linestatus") == status).drop("l_linestatus")
    path = new_path(spark, "shared_claims")
    for client, status in (("open", "O"), ("finished", "F")):
        clients.refresh_client(spark, path, client, of(status))
    table = lambda: clients.read_clients(spark, path, of("O"))
    totals = [F.count("*").alias("claims"), F.sum("paid_amount").cast("double").alias("paid_total")]
    before = stage(table().groupBy("client_id").agg(*totals), "before")
    files = stage(clients.client_files(table()), "files")
    clients.refresh_client(spark, path, "open", of("O").where("l_quantity >= 20"))
    kept = clients.client_files(table()).join(files.withColumn("old", F.lit(True)), ["client_id", "file"], "left")
    kept = kept.groupBy("client_id").agg(F.bool_and(F.coalesce("old", F.lit(False))).alias("same_files"))
    after = table().groupBy("client_id").agg(*totals).join(kept, "client_id")
    before = before.withColumn("same_files", F.lit(None).cast("boolean"))
    return before.withColumn("phase", F.lit("before")).unionByName(after.withColumn("phase", F.lit("after")))


@query
def quarter_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Months and whole of a quarter from the stored fact: one reads three partitions, the other those its calendar names."""
    stored = _star(spark, folder)
    fact = adhoc.exact_money(stored["fact_claims"])
    sums = [F.count("claim_id").alias("claims"), F.sum("paid").cast("double").alias("total_paid"), F.sum("billed").cast("double").alias("total_billed")]
    months = warehouse.in_months(fact, 1996, range(7, 10)).groupBy("year", F.col("month").alias("month_num")).agg(*sums)
    quarter = stored["dim_date"].where("year = 1996 and quarter = 3")
    whole = warehouse.with_calendar(fact, quarter).groupBy("year").agg(*sums).withColumn("month_num", F.lit(None).cast("int"))
    return months.unionByName(whole)


@query
def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Names, columns and rows of the tables in the catalog after a refresh, and after one that failed."""
    t = SampleTables(spark, folder)
    root, database = new_path(spark, "named"), "claimloom_sample"
    members = t.members().drop("effective_date", "termination_date")
    first = {"member": members, "provider": t.providers(), "old_claim": t.claims(["claim_id"])}
    second = {"member": members.where("region is not null"), "provider": t.providers(), "claim": t.claims(["claim_id", "member_id"])}

    def refuse(*_) -> None:
        raise RuntimeError("refused")

    store.publish(spark, root, first)
    catalog.register(spark, root, database)
    store.publish(spark, root, second)
    catalog.register(spark, root, database)
    out = catalog.described(spark, database).withColumn("phase", F.lit("refreshed"))
    try:
        store.publish(spark, root, {"member": members.where("member_id < 0")}, check=refuse)
    except RuntimeError:
        catalog.register(spark, root, database)
    failed = catalog.described(spark, database).withColumn("phase", F.lit("failed refresh"))
    shown = catalog.preview(spark, database, "provider").agg(F.count("*").alias("rows")).select(
        F.lit("provider").alias("table_name"), F.lit(None).cast("int").alias("columns"), "rows", F.lit("preview").alias("phase")
    )
    return out.unionByName(failed).unionByName(shown)


# ---- feeds with bad lines ---------------------------------------------------------------
@query
def quarantined_feed(spark: SparkSession, folder: str) -> DataFrame:
    """A claims file with short, long and wrongly quoted lines: how many of each, and what of the rest was loaded."""
    feed = client_feed(SampleTables(spark, folder)).select(*ORDER_KEYS, "insured", "treated_on", "finding", "settled", "area")
    kind = F.col("l_linenumber")
    fields = [F.col(c).cast("string") for c in ("insured", "treated_on", "finding", "settled", "area")]
    line = (
        F.when(kind == 7, F.concat_ws(",", *fields[:3]))
        .when(kind == 6, F.concat_ws(",", *fields, F.lit("more")))
        .when((kind == 5) & (F.col("l_partkey") % 2 == 0), F.concat_ws(",", fields[0], fields[1], F.concat(F.lit('"'), fields[2]), *fields[3:]))
        .otherwise(F.concat_ws(",", *fields))
    )
    path = new_path(spark, "bad_lines")
    header = "insured,treated_on,finding,settled,area"
    feed.select(line.alias(header)).write.option("header", True).option("sep", "\x01").option("quote", "\x02").csv(path)
    quarantine = new_path(spark, "quarantine")
    config = FeedConfig("lines", "Client with bad lines", {"claims": path}, {"claims": CLIENT_MAP})
    tables = ingest.ingest(spark, config, new_path(spark, "operational"), AS_OF, quarantine)
    loaded = tables["claim"].agg(
        F.count("*").alias("lines"), F.sum("paid_amount").cast("double").alias("paid_total"), F.max("claim_id").alias("last_claim")
    )
    bad = read_quarantine(spark, quarantine).groupBy("kind").agg(F.count("*").alias("lines"))
    none = {"paid_total": F.lit(None).cast("double"), "last_claim": F.lit(None).cast("bigint")}
    return bad.withColumns(none).unionByName(loaded.withColumn("kind", F.lit("good")))


# ---- reports ---------------------------------------------------------------------------
@query
def reports_at_once(spark: SparkSession, folder: str) -> DataFrame:
    """All five reports of a batch from one roll-up with grouping sets, as (report, keys, claims, paid_total)."""
    t = SampleTables(spark, folder)
    found = job.report_frames({"member": t.members(), "provider": t.providers(), "claim": t.claims()}, AS_OF)
    out = None
    for name, df in found.items():
        keys = [F.col(c) if c in df.columns else F.lit(None) for c in reports.CUBE_KEYS]
        kinds = ["string", "string", "boolean", "date", "string"]
        keys = [k.cast(kind).alias(c) for k, kind, c in zip(keys, kinds, reports.CUBE_KEYS)]
        part = df.select(F.lit(name).alias("report"), *keys, "claims", "paid_total")
        out = part if out is None else out.unionByName(part)
    return out


@query
def ordered_report(spark: SparkSession, folder: str) -> DataFrame:
    """Paid totals by provider and month as report files of at most 500 rows each, read back in their order."""
    t = SampleTables(spark, folder)
    claims = t.claims(["provider_id", "service_date", "paid_amount"])
    totals = claims.groupBy("provider_id", F.trunc("service_date", "MM").alias("month")).agg(F.sum("paid_amount").cast("double").alias("paid_total"))
    path = new_path(spark, "ordered")
    export.write_csv(totals.orderBy(F.col("paid_total").desc(), "provider_id", "month"), path, file_rows=500)
    back = export.read_csv_in_order(spark, path)
    return back.select(
        F.col(ORD).alias("place"), F.col("provider_id").cast("bigint"), F.col("month").cast("date"), F.col("paid_total").cast("double")
    )


@query
def observed_gate(spark: SparkSession, folder: str) -> DataFrame:
    """The gate's values over stored tables, dimensions and rows as the writes counted them."""
    t = SampleTables(spark, folder)
    fact = t.claims(["claim_id", "member_id", "provider_id", "service_date"]).withColumnRenamed("service_date", "date_key")
    fact = fact.withColumn("claim_id", F.split("claim_id", "-")[0].cast("bigint"))  # the order's number: not unique
    dates = warehouse.dim_date_covering(fact, "date_key")
    found = []

    def gate(written, observed) -> None:
        star = [written[n] for n in ("dim_member", "dim_provider", "dim_date", "fact_claims")]
        found.append(stage(quality.run_checks(*star, observed=observed), "gate"))

    tables = {"dim_member": warehouse.dim_member(t.members(), AS_OF), "dim_provider": warehouse.dim_provider(t.providers()), "dim_date": dates, "fact_claims": fact}
    store.publish(spark, new_path(spark, "gated"), tables, check=gate)
    return found[0]
