"""Queries that go through files and stored tables: feeds with files per role, the stored warehouse, reports, the model run."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.model import PROVIDER
from claimloom.operators import distinct, keys, mapping, validate
from claimloom.operators.ordinals import ORD
from claimloom.plans import adhoc, classifier, export, ingest, job, marts, quality, reports, warehouse
from claimloom.queries import CLIENT_MAP, _labelled, client_feed, query
from claimloom.session import new_path, stage
from claimloom.sources.config import FeedConfig
from claimloom.sources.feeds import scan_csv
from claimloom.sources.sample_tables import AS_OF, CALENDAR_START, ORDER_KEYS, SampleTables


def _csv(df: DataFrame, name: str) -> str:
    path = new_path(df.sparkSession, name)
    df.write.option("header", True).csv(path)
    return path


# ---- feeds ---------------------------------------------------------------------
@query
def ingest_files(spark: SparkSession, folder: str) -> DataFrame:
    """A feed with a file per role and text keys, loaded from end to end; the stored tables joined and grouped."""
    t = SampleTables(spark, folder)
    claims = client_feed(t).drop(*ORDER_KEYS).withColumn("insured", F.concat(F.lit("M"), "insured"))
    members = t.members().select(
        F.concat(F.lit("M"), "member_id").alias("insured"), F.col("dob").alias("born"), F.col("gender").alias("f_or_m"), F.col("region").alias("area")
    )
    providers = t.providers().select(
        F.concat(F.lit("P"), "provider_id").alias("doctor"), F.col("specialty").alias("field"), F.col("in_network").alias("listed"), F.col("region").alias("area")
    )
    files = {"claims": _csv(claims, "claims"), "members": _csv(members, "members"), "providers": _csv(providers, "providers")}
    maps = {
        "claims": CLIENT_MAP,
        "members": {"insured": "member_id", "born": "dob", "f_or_m": "gender", "area": "region"},
        "providers": {"doctor": "provider_id", "field": "specialty", "listed": "in_network", "area": "region"},
    }
    tables = ingest.ingest(spark, FeedConfig("files", "Client with files", files, maps), new_path(spark, "operational"), AS_OF)
    claim, member = tables["claim"], tables["member"].select("member_id", "gender", "dob", F.col("region").alias("member_region"))
    joined = claim.join(tables["provider"].select("provider_id", "specialty", "in_network"), "provider_id").join(member, "member_id")
    by = ["specialty", "in_network", "gender", "member_region"]
    sums = [
        F.count("*").alias("claims"),
        F.sum("paid_amount").cast("double").alias("paid_total"),
        F.max("service_date").alias("last_service"),
        F.min("dob").alias("oldest"),
    ]
    # the load has checked that members and providers are unique, so the joins repeat no claim
    out = distinct.distinct_by(joined, "claim_id", by, "ids", sums, ids=claim)
    return out.select(*by, "claims", "ids", "paid_total", "last_service", "oldest")


@query
def ingest_without_ids(spark: SparkSession, folder: str) -> DataFrame:
    """A claims file without any id: a member per claim, one provider."""
    feed = client_feed(SampleTables(spark, folder)).select("treated_on", "finding", "settled", "age")
    config = FeedConfig("bare", "Client without ids", {"claims": _csv(feed, "claims")}, {"claims": CLIENT_MAP})
    tables = ingest.ingest(spark, config, new_path(spark, "operational"), AS_OF)
    members = tables["member"].agg(F.count("*").alias("members"), F.count("dob").alias("with_dob"))
    claim = tables["claim"]
    sums = [
        F.count("*").alias("claims"),
        F.min("member_id").alias("first_member"),
        F.max("member_id").alias("last_member"),
        F.max("provider_id").alias("provider"),
        F.count_if(F.col("claim_id") != F.col("member_id")).alias("moved"),
        F.sum("paid_amount").cast("double").alias("paid_total"),
    ]
    # the claims' numbers are serial, so their members are counted by bitmaps and not shuffled
    claims = distinct.distinct_by(claim, "member_id", [], "claim_members", sums, ids=claim)
    claims = claims.select("claims", "first_member", "last_member", "claim_members", "provider", "moved", "paid_total")
    # one row each
    return claims.withColumn("_one", F.lit(1)).join(members.withColumn("_one", F.lit(1)), "_one").drop("_one")


@query
def reference_errors(spark: SparkSession, folder: str) -> DataFrame:
    """What a load says of claims whose provider a file of suppliers in credit does not list."""
    t = SampleTables(spark, folder)
    listed = t.table("supplier").filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("provider_id"))
    said = []
    for dim in (listed, listed.withColumnRenamed("provider_id", "number"), t.providers()):
        try:
            validate.require_references(t.claims(["provider_id"]), dim, "provider_id", "providers")
            said.append("")
        except ValueError as error:
            said.append(str(error))
    return spark.createDataFrame(list(enumerate(said)), "file int, error string")


@query
def cut_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Provider descriptions that are longer than the table's width, as stored."""
    wide = SampleTables(spark, folder).providers().withColumns(
        {"specialty": F.repeat("specialty", F.lit(15)), "region": F.repeat("region", F.lit(9)), ORD: F.lit(0)}
    )
    return mapping.conform(mapping.trim_to_schema(wide, PROVIDER), PROVIDER)


@query
def csv_with_column(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV of suppliers, written again with a column more, and read back."""
    source = _csv(SampleTables(spark, folder).table("supplier").select("s_suppkey", "s_name"), "suppliers")
    target = new_path(spark, "suppliers_named")
    export.append_column_csv(spark, source, target, "label", F.concat_ws("/", "s_name", "s_suppkey"))
    return scan_csv(spark, target)


# ---- stored warehouse -----------------------------------------------------------
def _numbered(claims: DataFrame) -> DataFrame:
    """Stored claims with distinct numbers for ids; the sample's own keys occur twice."""
    return stage(claims.withColumn("claim_id", F.monotonically_increasing_id()), "claims")


def _star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The star schema and summaries of all claims, built, checked and committed."""
    t = SampleTables(spark, folder)
    tables = {"member": t.members(), "provider": t.providers(), "claim": _numbered(t.claims())}
    frames = job.run_reports(tables, new_path(spark, "reports"), AS_OF)
    return job.build_warehouse(
        spark, tables, frames, new_path(spark, "warehouse"), new_path(spark, "quality"), AS_OF, CALENDAR_START
    )


@query
def warehouse_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every stored table, of the fact by year and month with its paid total."""
    stored = _star(spark, folder)
    out = adhoc.exact_money(stored["fact_claims"]).groupBy("year", "month").agg(
        F.count("*").alias("rows"), F.sum("paid").cast("double").alias("paid_total")
    )
    out = out.select(F.lit("fact_claims").alias("table_name"), "year", "month", "rows", "paid_total")
    nothing = [F.lit(None).cast("int").alias("year"), F.lit(None).cast("int").alias("month")]
    for name, df in stored.items():
        if name != "fact_claims":
            rows = df.agg(F.count("*").alias("rows"))
            out = out.unionByName(rows.select(F.lit(name).alias("table_name"), *nothing, "rows", F.lit(None).cast("double").alias("paid_total")))
    return out


@query
def q1_stored(spark: SparkSession, folder: str) -> DataFrame:
    stored = _star(spark, folder)
    return adhoc.run_sql(spark, adhoc.AGE_REGION, fact=adhoc.exact_money(stored["fact_claims"]), member=stored["dim_member"])


@query
def q3_stored(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.run_sql(spark, adhoc.LOSS_RANK, summary=_star(spark, folder)["summary_loss_ratio"])


def _faulty_star(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Members with a null key and without those in debt, a short calendar, and first lines that occur twice."""
    t = SampleTables(spark, folder)
    members = warehouse.dim_member(t.members(), AS_OF)
    listed = members.join(t.table("customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("member_id")), "member_id", "left_semi")
    faulty = listed.unionByName(listed.limit(1).withColumn("member_id", F.lit(None).cast("bigint")))
    dates = warehouse.dim_date(spark, AS_OF, CALENDAR_START).filter("year < 2001")
    fact = t.claims(["claim_id", "member_id", "provider_id", "service_date"], keep=["l_linenumber"]).withColumnRenamed("service_date", "date_key")
    fact = fact.unionByName(fact.filter("l_linenumber = 1")).drop("l_linenumber")
    return faulty, warehouse.dim_provider(t.providers()), dates, fact


@query
def gate_failures(spark: SparkSession, folder: str) -> DataFrame:
    """All check values and texts of a star with planted faults, and whether the gate stops it."""
    checks = stage(quality.run_checks(*_faulty_star(spark, folder)), "checks")
    try:
        quality.enforce(checks)
        stopped = ""
    except RuntimeError as error:
        stopped = str(error)
    return checks.withColumn("stopped", F.lit(stopped))


@query
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON report of a star that passed, read back."""
    t = SampleTables(spark, folder)
    fact = _numbered(t.claims(["claim_id", "member_id", "provider_id", "service_date"])).withColumnRenamed("service_date", "date_key")
    star = (warehouse.dim_member(t.members(), AS_OF), warehouse.dim_provider(t.providers()), warehouse.dim_date(spark, AS_OF, CALENDAR_START), fact)
    path = new_path(spark, "quality_json")
    quality.write_quality_report(spark, quality.enforce(quality.run_checks(*star)), path)
    return quality.read_quality_report(spark, path).drop("generated_at")


# ---- report files ---------------------------------------------------------------
@query
def report_files(spark: SparkSession, folder: str) -> DataFrame:
    """The exported sheets, read back: rows and claims of each, and of the status sheet of an empty folder."""
    t = SampleTables(spark, folder)
    home = new_path(spark, "reports")
    job.run_reports({"member": t.members(), "provider": t.providers(), "claim": t.claims()}, home, AS_OF)
    classifier.write_metrics(spark, classifier.Score(classifier.LABEL_SINGLE, 1.0), f"{home}/model_metrics.txt")
    out = None
    for source in (home, new_path(spark, "nothing")):
        target = new_path(spark, "export")
        for name in export.export_reports(spark, source, target):
            sheet = scan_csv(spark, f"{target}/{name}")
            claims = F.sum(F.col("claims").cast("bigint")) if "claims" in sheet.columns else F.lit(None).cast("bigint")
            row = sheet.agg(F.count("*").alias("rows"), claims.alias("claims")).select(F.lit(name).alias("sheet"), "rows", "claims")
            out = row if out is None else out.unionByName(row)
    return out


# ---- classifier -----------------------------------------------------------------
KEYS = ["member_id", "in_network"]


@query
def classifier_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per class and side, and whether the fitted coefficients are an optimum of the penalised weighted loss."""
    rows = stage(classifier.features(_labelled(spark, folder), AS_OF), "features")
    usable = rows.filter("age is not null")
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    train, test = (stage(side, "side") for side in classifier.stratified_split(usable, "label", KEYS, counts))
    model = classifier.fit(train)
    n = train.count()
    positives = train.filter("label = 1").count()
    weight = F.when(F.col("label") == 1, n / (2 * positives)).otherwise(n / (2 * (n - positives)))
    scored = model.transform(train).select(
        (weight * (vector_to_array("probability")[1] - F.col("label"))).alias("pull"), vector_to_array("features").alias("x")
    )
    coefficients = model.stages[-1].coefficients.toArray()
    pulls = scored.agg(*[F.sum(F.col("pull") * F.col("x")[j]).alias(f"g{j}") for j in range(len(coefficients))]).first()
    optimal = all(abs(g + b) < 1e-4 * n for g, b in zip(pulls, coefficients))  # the gradient of the loss and of |b|^2 / 2
    sides = [
        F.count_if((F.col("side") == side) & (F.col("label") == label)).alias(f"{side}_{label}") for side in ("train", "test") for label in (0, 1)
    ]
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.agg(*sides).withColumns({"without_age": F.lit(rows.count() - n - test.count()).cast("bigint"), "optimal": F.lit(optimal)})


@query
def classifier_fallbacks(spark: SparkSession, folder: str) -> DataFrame:
    """The metric of one class, of a class with one row, and of an unstratified split."""
    rows = stage(classifier.features(_labelled(spark, folder), AS_OF), "features")
    costly = rows.filter("label = 1 and age is not null")
    first = costly.agg(F.min("member_id")).first()[0]
    tiny = rows.filter(F.col("label") == 0).unionByName(costly.filter(F.col("member_id") == first).limit(1))
    scores = {
        "one class": classifier.evaluate(rows.filter("label = 0"), KEYS),
        "one row": classifier.evaluate(stage(tiny, "tiny"), KEYS),
        "unstratified": classifier.evaluate(rows, KEYS, stratify=False),
    }
    found = [(name, s.label, s.rows_without_age, 0.0 <= s.accuracy <= 1.0) for name, s in scores.items()]
    return spark.createDataFrame(found, "case_name string, label string, without_age bigint, in_range boolean")


@query
def cube_reports(spark: SparkSession, folder: str) -> DataFrame:
    """The KPI report rolled up from the stored cube that the batch makes once for all reports."""
    t = SampleTables(spark, folder)
    measures = reports.member_measures(t.claims(), t.members(), t.providers(), AS_OF)
    return reports.kpis(stage(reports.claim_cube(measures), "cube"))


# ---- variants that the plain sample does not reach --------------------------------
@query
def nation_top10(spark: SparkSession, folder: str) -> DataFrame:
    """Paid totals by network for the ten nations with the largest, of the 25 that there are."""
    t = SampleTables(spark, folder)
    nation = t.table("nation").select("n_nationkey", F.col("n_name").alias("region"))
    members = t.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    members = members.select(F.col("c_custkey").alias("member_id"), F.lit(None).cast("date").alias("dob"), "region")
    claims = t.claims(["claim_id", "member_id", "provider_id", "paid_amount"])
    measures = reports.member_measures(claims, members, t.providers(), AS_OF)
    return marts.region_network_paid(stage(reports.kpis(measures), "kpis"))


@query
def kept_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Provider keys that are numbers in the dimension stay so; a claim key that is none becomes null."""
    t = SampleTables(spark, folder)
    dim = t.table("supplier").select(F.concat("s_suppkey", F.lit(".0")).alias("provider_id"), F.col("s_suppkey").alias(ORD))
    key = F.when(F.col("l_linenumber") != 7, F.col("l_suppkey").cast("string")).otherwise("none")
    fact = t.table("lineitem").select(key.alias("provider_id"))
    dim, fact = keys.map_surrogates(dim, fact, "provider_id")
    rows = fact.groupBy("provider_id").agg(F.count("*").alias("claims"))
    return rows.join(dim.select("provider_id", F.lit(True).alias("listed")), "provider_id", "left")
