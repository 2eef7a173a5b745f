"""Named queries over the sample tables; the same registry feeds tests and bench.

Each function takes (spark, folder) and returns a lazy frame over the whole
tables of that folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.exprs import (
    age_band,
    age_years,
    bin_column,
    days_after,
    either,
    long_date,
    month_start,
    network_label,
    redact_password,
    round_even,
    to_key,
)
from claimloom.model import ROLE_DEFAULTS
from claimloom.operators import keys, lookup, mapping, summaries, validate
from claimloom.operators.joins import orphan_rows
from claimloom.operators.ordinals import ORD, stage_in_order
from claimloom.plans import adhoc, classifier, ingest, marts, quality, reports, warehouse
from claimloom.session import new_path, stage
from claimloom.sources import synthetic
from claimloom.sources.config import FeedConfig
from claimloom.sources.sample_tables import AS_OF, CALENDAR_START, ORDER_KEYS, SampleTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _measures(t: SampleTables, *columns: str, claims: DataFrame | None = None) -> DataFrame:
    """Report measures over the claim columns a report needs."""
    if claims is None:
        claims = t.claims(["claim_id", "member_id", "provider_id", "paid_amount", *columns])
    return reports.member_measures(claims, t.members(), t.providers(), AS_OF)


# ---- reports -------------------------------------------------------------------
@query
def kpis(spark: SparkSession, folder: str) -> DataFrame:
    return reports.kpis(_measures(SampleTables(spark, folder)))


@query
def monthly(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    claims = t.claims(["claim_id", "member_id", "provider_id", "paid_amount", "service_date"])
    return reports.monthly(reports.claim_rows(claims, t.members(), t.providers(), AS_OF))


@query
def loss_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return reports.loss_ratio(_measures(SampleTables(spark, folder), "billed_amount", "allowed_amount"))


@query
def loss_ratio_zero_billed(spark: SparkSession, folder: str) -> DataFrame:
    """The same report for a feed without billed and allowed amounts."""
    t = SampleTables(spark, folder)
    zero = F.lit(0).cast("decimal(12,2)")
    claims = t.claims(["claim_id", "member_id", "provider_id", "paid_amount"])
    claims = claims.withColumns({"billed_amount": zero, "allowed_amount": zero})
    return reports.loss_ratio(_measures(t, claims=claims))


@query
def network_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.network_summary(_measures(SampleTables(spark, folder)))


@query
def diagnosis_summary(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    claims = t.claims(["claim_id", "member_id", "provider_id", "paid_amount", "billed_amount", "diagnosis_code"])
    return reports.diagnosis_summary(reports.known_claims(claims, t.members(), t.providers()))


# ---- warehouse -----------------------------------------------------------------
@query
def dim_member(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.dim_member(SampleTables(spark, folder).members(), AS_OF)


@query
def dim_provider(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.dim_provider(SampleTables(spark, folder).providers())


@query
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.dim_date_covering(SampleTables(spark, folder).claims(["service_date"]), "service_date")


@query
def service_days(spark: SparkSession, folder: str) -> DataFrame:
    """The days of the warehouse calendar on which the claims have a service."""
    days = SampleTables(spark, folder).claims(["service_date"]).select(F.col("service_date").alias("date_key"))
    return warehouse.dim_date(spark, AS_OF, CALENDAR_START).join(days, "date_key", "left_semi")


@query
def fact_claims(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.fact_claims(SampleTables(spark, folder).claims())


# ---- quality -------------------------------------------------------------------
CHECKED = ["claim_id", "member_id", "provider_id", "service_date"]


def _star(t: SampleTables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Members, providers, calendar and the fact's checked columns."""
    return (
        warehouse.dim_member(t.members(), AS_OF),
        warehouse.dim_provider(t.providers()),
        warehouse.dim_date(t.spark, AS_OF, CALENDAR_START),
        t.claims(CHECKED).withColumnRenamed("service_date", "date_key"),
    )


@query
def quality_checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_checks(*_star(SampleTables(spark, folder)))


@query
def missing_refs(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan counts against incomplete dimensions: indebted members and providers are not listed."""
    t = SampleTables(spark, folder)
    _, _, dates, fact = _star(t)
    listed_members = t.table("customer").filter("c_acctbal >= 0")
    listed_providers = t.table("supplier").filter("s_acctbal >= 0")
    return quality.missing_refs(
        fact,
        {
            "missing_member_refs": (listed_members, "c_custkey", "member_id"),
            "missing_provider_refs": (listed_providers, "s_suppkey", "provider_id"),
            "missing_date_refs": (dates.filter("year < 2001"), "date_key", "date_key"),
        },
    )


@query
def duplicate_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Claim numbers given out more than once (order and line number alone are not unique)."""
    lines = SampleTables(spark, folder).table("lineitem")
    return validate.duplicate_keys(lines.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("claim_no")), "claim_no")


# ---- SQL over the warehouse ----------------------------------------------------
def _sql(t: SampleTables, sql: str, claim_columns: list[str], **dims: DataFrame) -> DataFrame:
    claims = t.claims(claim_columns)
    fact = claims.withColumnsRenamed({"service_date": "date_key"})
    for column, short in (("paid_amount", "paid"), ("billed_amount", "billed")):
        if column in claim_columns:
            fact = fact.withColumn(short, F.col(column))
    return adhoc.run_sql(t.spark, sql, fact=fact, **dims)


@query
def q1_age_region(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    member = warehouse.dim_member(t.members(), AS_OF)
    return _sql(t, adhoc.AGE_REGION, ["claim_id", "member_id", "paid_amount"], member=member)


@query
def q2_month_trend(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    date = warehouse.dim_date(spark, AS_OF, CALENDAR_START)
    return _sql(t, adhoc.MONTH_TREND, ["claim_id", "service_date", "paid_amount"], date=date)


@query
def q3_loss_rank(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.run_sql(spark, adhoc.LOSS_RANK, summary=loss_ratio(spark, folder))


@query
def q4_network_share(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    provider = warehouse.dim_provider(t.providers())
    return _sql(t, adhoc.NETWORK_SHARE, ["claim_id", "provider_id", "paid_amount"], provider=provider)


@query
def q5_top_diagnosis(spark: SparkSession, folder: str) -> DataFrame:
    return _sql(SampleTables(spark, folder), adhoc.TOP_DIAGNOSIS, ["diagnosis_code", "paid_amount"])


@query
def q6_quarter(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    date = warehouse.dim_date(spark, AS_OF, CALENDAR_START)
    return _sql(t, adhoc.QUARTERS, ["claim_id", "service_date", "paid_amount", "billed_amount"], date=date)


@query
def top20_diagnosis(spark: SparkSession, folder: str) -> DataFrame:
    return _sql(SampleTables(spark, folder), adhoc.TOP20_DIAGNOSIS, ["diagnosis_code", "paid_amount"])


# ---- marts ---------------------------------------------------------------------
def _stored(report: Query, spark: SparkSession, folder: str) -> DataFrame:
    """A report as the marts see it: stored, because a mart reads it more than once."""
    return stage(report(spark, folder), report.__name__)


@query
def kpi_cards(spark: SparkSession, folder: str) -> DataFrame:
    return marts.kpi_cards(kpis(spark, folder))


@query
def region_top10(spark: SparkSession, folder: str) -> DataFrame:
    return marts.top_regions(marts.region_totals(kpis(spark, folder)))


@query
def region_network_paid(spark: SparkSession, folder: str) -> DataFrame:
    return marts.region_network_paid(_stored(kpis, spark, folder))


@query
def monthly_region(spark: SparkSession, folder: str) -> DataFrame:
    return marts.monthly_region(_stored(monthly, spark, folder))


@query
def region_loss_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return marts.region_loss_ratio(_stored(loss_ratio, spark, folder))


@query
def chart_flags(spark: SparkSession, folder: str) -> DataFrame:
    return marts.chart_flags(region_loss_ratio(spark, folder))


@query
def network_mart(spark: SparkSession, folder: str) -> DataFrame:
    return marts.network_mart(network_summary(spark, folder))


@query
def diagnosis_top10(spark: SparkSession, folder: str) -> DataFrame:
    return marts.diagnosis_top10(diagnosis_summary(spark, folder))


# ---- ingest --------------------------------------------------------------------
# Invented column names of a sample client's claims file, as its config maps them.
CLIENT_MAP = {
    "ref": "claim_id",
    "insured": "member_id",
    "doctor": "provider_id",
    "treated_on": "service_date",
    "finding": "diagnosis_code",
    "treatment": "procedure_code",
    "settled": "paid_amount",
    "f_or_m": "gender",
    "area": "region",
}


def client_feed(t: SampleTables, codes: bool = True) -> DataFrame:
    """Every claim as a client would send it: own column names, text keys, ages with unreadable values."""
    code = ["diagnosis_code"] if codes else []
    claims = t.claims(
        ["claim_id", "member_id", "provider_id", "service_date", "paid_amount", "place_of_service", *code],
        keep=[*ORDER_KEYS, "l_linestatus", "l_quantity"],
    )
    return claims.select(
        *ORDER_KEYS,
        F.col("claim_id").alias("ref"),
        F.col("member_id").alias("insured"),
        F.concat(F.lit("P"), F.col("provider_id")).alias("doctor"),
        F.col("service_date").cast("string").alias("treated_on"),
        *[F.col(c).alias("finding") for c in code],
        F.col("paid_amount").alias("settled"),
        F.when(F.col("l_linestatus") == "F", "F").otherwise("M").alias("f_or_m"),
        F.col("place_of_service").alias("area"),
        F.when(F.col("l_quantity") < 3, "unknown")
        .otherwise((F.col("l_quantity") + 17).cast("int").cast("string"))
        .alias("age"),
    )


def _mapped_feed(t: SampleTables, codes: bool = True) -> DataFrame:
    return mapping.apply_mapping(client_feed(t, codes), CLIENT_MAP, ROLE_DEFAULTS["claims"])


@query
def map_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The mapped feed by every mapped or defaulted attribute (treatment is absent and takes its default)."""
    attributes = [
        "diagnosis_code",
        "procedure_code",
        "gender",
        "region",
        "place_of_service",
        "billed_amount",
        "allowed_amount",
    ]
    return (
        _mapped_feed(SampleTables(spark, folder))
        .groupBy(*attributes)
        .agg(
            F.count("claim_id").alias("claims"),
            F.sum("paid_amount").cast("double").alias("paid_total"),
            F.min(F.col("service_date").cast("date")).alias("first_service"),
        )
    )


@query
def derive_members(spark: SparkSession, folder: str) -> DataFrame:
    """One member per id from its first claim; claims are ordered by their four key columns."""
    feed = _mapped_feed(SampleTables(spark, folder), codes=False)
    return keys.derive_members(feed, AS_OF, F.struct(*ORDER_KEYS)).drop(ORD)


@query
def derive_providers(spark: SparkSession, folder: str) -> DataFrame:
    feed = _mapped_feed(SampleTables(spark, folder), codes=False)
    return keys.derive_providers(feed, F.struct(*ORDER_KEYS)).drop(ORD)


def _provider_claims_in_order(t: SampleTables) -> DataFrame:
    """Provider code and amount of every claim with its ordinal in key order."""
    lines = t.claims(["provider_id", "paid_amount"], keep=ORDER_KEYS)
    lines = lines.withColumn("provider_id", F.concat(F.lit("P"), F.col("provider_id")))
    return stage_in_order(lines, ORDER_KEYS, "ordered_claims").drop(*ORDER_KEYS)


@query
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Text provider codes numbered by first appearance, and the claims rewritten to the numbers."""
    claims = _provider_claims_in_order(SampleTables(spark, folder))
    dim = stage(keys.derive_providers(claims), "providers").withColumn("provider_code", F.col("provider_id"))
    dim, claims = keys.map_surrogates(dim, claims, "provider_id", known=True)
    totals = claims.groupBy("provider_id").agg(
        F.count("*").alias("claims"), F.sum("paid_amount").cast("double").alias("paid_total")
    )
    return dim.select("provider_id", "provider_code").join(totals, "provider_id")


@query
def serial_claim_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Claims numbered 1..n in key order, checked per provider."""
    claims = ingest.serial_claim_ids(_provider_claims_in_order(SampleTables(spark, folder)))
    return claims.groupBy("provider_id").agg(
        F.min("claim_id").alias("first_id"),
        F.max("claim_id").alias("last_id"),
        F.sum("claim_id").alias("id_sum"),
        F.count_distinct("claim_id").alias("ids"),
    )


@query
def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Provider ids of claims that a provider file of suppliers in credit does not list."""
    t = SampleTables(spark, folder)
    listed = t.table("supplier").filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("provider_id"))
    return orphan_rows(t.claims(["provider_id"]), listed, "provider_id").withColumnRenamed("rows", "claims")


@query
def overlong_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Part names used as codes break the width limit; part types keep it."""
    t = SampleTables(spark, folder)
    lines = t.table("lineitem").join(t.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    codes = lines.select(F.col("p_name").alias("diagnosis_code"), F.col("p_type").alias("procedure_code"))
    return validate.overlong_codes(codes)


@query
def ingest_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The client's CSV loaded from end to end; the stored tables joined and grouped.

    The feed is written in key order, so file order, serial ids and first
    appearances are known.
    """
    path = new_path(spark, "claims_csv")
    feed = client_feed(SampleTables(spark, folder)).orderBy(*ORDER_KEYS).drop(*ORDER_KEYS)
    feed.write.option("header", True).csv(path)
    config = FeedConfig("sample", "Sample client", {"claims": path}, {"claims": CLIENT_MAP})
    tables = ingest.ingest(spark, config, new_path(spark, "operational"), AS_OF)
    joined = tables["claim"].join(tables["provider"].select("provider_id", "in_network"), "provider_id")
    joined = joined.join(tables["member"].select("member_id", "gender", "dob"), "member_id")
    return joined.groupBy("provider_id", "in_network", "gender").agg(
        F.count("*").alias("claims"),
        F.sum("paid_amount").cast("double").alias("paid_total"),
        F.min("claim_id").alias("first_claim"),
        F.max("claim_id").alias("last_claim"),
        F.min("dob").alias("oldest"),
        F.max("service_date").alias("last_service"),
        F.min("procedure_code").alias("procedure_code"),
        F.max(F.col("billed_amount").cast("double")).alias("billed"),
    )


@query
def missing_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Texts made from a flag, one of which (NA) reads as missing."""
    lines = SampleTables(spark, folder).table("lineitem").select("l_returnflag", F.concat("l_returnflag", F.lit("A")).alias("code"))
    clean = lines.select(*mapping.missing_to_null(lines.columns))
    return clean.groupBy("l_returnflag").agg(F.count("*").alias("rows"), F.count("code").alias("codes"))


@query
def numeric_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Key texts in three spellings (7, 7.0, 7x) as numbers; the last one is none."""
    ending = F.when(F.col("l_returnflag") == "A", "").when(F.col("l_returnflag") == "N", ".0").otherwise("x")
    lines = SampleTables(spark, folder).table("lineitem")
    number = lines.select("l_returnflag", to_key(F.concat("l_suppkey", ending)).alias("number"))
    return number.groupBy("l_returnflag").agg(F.count("number").alias("numbers"), F.sum("number").alias("total"))


@query
def network_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of five spellings of the network flag."""
    spellings = F.array(*map(F.lit, [" TRUE ", "1", "yes", "0", "n/a"]))
    lines = SampleTables(spark, folder).table("lineitem")
    text = F.element_at(spellings, (F.col("l_suppkey") % 5 + 1).cast("int")).alias("spelling")
    return lines.select(text).groupBy("spelling", network_label(F.col("spelling")).alias("network")).agg(
        F.count("*").alias("rows")
    )


# ---- classifier ----------------------------------------------------------------
def _costs(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    claims = t.claims(["member_id", "provider_id", "paid_amount"])
    return classifier.member_cost(claims, t.members(), t.providers())


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    costs = stage(_costs(spark, folder), "member_cost")
    return classifier.label_costs(costs, classifier.cost_threshold(costs))


@query
def member_cost(spark: SparkSession, folder: str) -> DataFrame:
    return _costs(spark, folder).withColumn("paid_total", F.col("paid_total").cast("double"))


@query
def high_cost_threshold(spark: SparkSession, folder: str) -> DataFrame:
    costs = stage(_costs(spark, folder), "member_cost")
    threshold = F.lit(classifier.cost_threshold(costs)).cast("double")
    return costs.agg(
        F.round(threshold, 4).alias("threshold"),
        F.count("*").alias("members"),
        F.count_if(F.col("paid_total").cast("double") > threshold).alias("above"),
    )


@query
def high_cost_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(spark, folder).select("member_id", "in_network", "high_cost")


@query
def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.class_balance(_labelled(spark, folder))


@query
def split_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per class and side of the stratified split."""
    rows = classifier.features(_labelled(spark, folder), AS_OF)
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    train, test = classifier.stratified_split(rows, "label", ["member_id", "in_network"], counts)
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides.groupBy("side", F.col("label").cast("int").alias("high_cost")).agg(F.count("*").alias("members"))


@query
def classifier_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    rows = classifier.features(_labelled(spark, folder), AS_OF)
    return classifier.score_frame(spark, classifier.evaluate(rows, ["member_id", "in_network"]))


# ---- summaries and worked examples ---------------------------------------------
@query
def profile(spark: SparkSession, folder: str) -> DataFrame:
    """Column profile of the claim table."""
    claims = SampleTables(spark, folder).claims()
    out = summaries.profile(stage(claims, "claims"))
    rounded = {c: F.round(c, 4) for c in ("mean", "std", "p25", "p50", "p75")}
    return out.withColumns(rounded).drop("data_type")


# Places that count as hospital or office care (the rest stay unlabelled)
URGENCY = {"1-URGENT": "hospital", "2-HIGH": "hospital", "5-LOW": "office"}


@query
def lookup_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Claims by place and by the label a dictionary gives it, empty where it gives none."""
    claims = SampleTables(spark, folder).claims(["place_of_service", "paid_amount"])
    filled = lookup.lookup_fill(claims, "place_of_service", "care", URGENCY)
    return filled.groupBy("place_of_service", "care").agg(F.count("*").alias("claims"))


@query
def class_means(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of the paid amount per seniority class of the member."""
    t = SampleTables(spark, folder)
    senior = either(age_years(F.col("dob"), AS_OF) >= 40, "Senior", "Junior")
    members = t.members().select("member_id", senior.alias("age_group"))
    sums = summaries.moments(t.claims(["member_id", "paid_amount"]), "member_id", "paid_amount")
    out = summaries.means_of_moments(sums.join(members, "member_id"), "age_group")
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std")})


@query
def group_mean(spark: SparkSession, folder: str) -> DataFrame:
    claims = SampleTables(spark, folder).claims(["diagnosis_code", "billed_amount"])
    out = summaries.group_mean(claims, "diagnosis_code", "billed_amount", "mean_billed")
    return out.withColumn("mean_billed", F.round("mean_billed", 4))


@query
def frequency(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.frequency(SampleTables(spark, folder).claims(["place_of_service"]), "place_of_service")


@query
def bin_members(spark: SparkSession, folder: str) -> DataFrame:
    """Members per age class of a three-bin scale and per report band."""
    age = age_years(F.col("dob"), AS_OF)
    members = SampleTables(spark, folder).members().select(
        bin_column(age, [0, 30, 40, 100], ["Young", "Middle", "Old"]).alias("age_category"),
        age_band(age).alias("age_band"),
        age.alias("age"),
    )
    return members.groupBy("age_category", "age_band").agg(
        F.count("*").alias("members"), F.min("age").alias("youngest"), F.max("age").alias("oldest")
    )


@query
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Service days written out, moved by 30 days and cut to the month."""
    day = F.col("service_date")
    return (
        SampleTables(spark, folder)
        .claims(["service_date"])
        .groupBy(day)
        .agg(F.count("*").alias("claims"))
        .select(
            day,
            long_date(day).alias("written"),
            days_after(day, 30).alias("due"),
            month_start(day).alias("month"),
            "claims",
        )
    )


@query
def rounding_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Half-even against half-up rounding of eighths of every quantity (ties occur)."""
    eighths = SampleTables(spark, folder).table("lineitem").select((F.col("l_quantity") / 8).alias("x"))
    return eighths.groupBy("x").agg(F.count("*").alias("rows")).select(
        "x", round_even(F.col("x"), 2).alias("half_even"), F.round("x", 2).alias("half_up"), "rows"
    )


@query
def redacted_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Connection texts made from supplier names, with the password part hidden."""
    suppliers = SampleTables(spark, folder).table("supplier")
    url = F.concat(F.lit("db://"), F.lower("s_name"), F.lit(":"), F.col("s_suppkey"), F.lit("@host/claims"))
    return suppliers.select("s_suppkey", redact_password(url).alias("url"))


@query
def synthetic_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Synthetic claims, as many as the tables hold rows: counts and broken invariants (all zero)."""
    t = SampleTables(spark, folder)
    n_claims, n_members, n_providers = (t.table(n).count() for n in ("lineitem", "customer", "supplier"))
    claims = synthetic.claims(spark, n_claims, n_members, n_providers)
    return claims.agg(
        F.count("*").alias("claims"),
        F.count_distinct("claim_id").alias("ids"),
        F.count_if(~F.col("member_id").between(1, n_members)).alias("bad_members"),
        F.count_if(~F.col("provider_id").between(1, n_providers)).alias("bad_providers"),
        F.count_if((F.col("allowed_amount") > F.col("billed_amount")) | (F.col("paid_amount") > F.col("allowed_amount"))).alias(
            "bad_amounts"
        ),
        F.count_if(~F.year("service_date").between(2020, 2024)).alias("bad_dates"),
        F.count_distinct("diagnosis_code").alias("diagnoses"),
    )


from claimloom import config_queries, refresh_queries, stored_queries  # noqa: E402, F401  (register their queries)
