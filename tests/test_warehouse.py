"""Calendar, star schema, quality gate, refresh, and the whole batch for several clients."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from claimloom.plans import adhoc, job, quality, warehouse
from claimloom.sources import store, synthetic
from claimloom.sources.config import FeedConfig

AS_OF = dt.date(2024, 2, 29)


def test_calendar_bounds_and_parts(spark, rows):
    days = warehouse.dim_date(spark, AS_OF).cache()
    bounds = days.agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()
    last = dt.date(2025, 2, 28)
    assert tuple(bounds) == (dt.date(2010, 1, 1), last, (last - dt.date(2010, 1, 1)).days + 1)
    assert rows(days.filter("date_key = '2024-02-29'")) == [(AS_OF, 2024, 2, "February", 1, "Thursday")]


def test_calendar_covers_a_fact(spark):
    days = spark.createDataFrame([(dt.date(2020, 5, 1),), (None,), (dt.date(2020, 5, 3),)], "d date")
    out = warehouse.dim_date_covering(days, "d").agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()
    assert tuple(out) == (dt.date(2020, 5, 1), dt.date(2021, 5, 3), 368)


@pytest.fixture
def star(spark):
    members = spark.createDataFrame([(1,), (2,)], "member_id bigint")
    providers = spark.createDataFrame([(10,)], "provider_id bigint")
    dates = spark.createDataFrame([(dt.date(2023, 1, 1),)], "date_key date")
    fact = spark.createDataFrame([(1, 1, 10, dt.date(2023, 1, 1)), (2, 2, 10, dt.date(2023, 1, 1))],
                                 "claim_id bigint, member_id bigint, provider_id bigint, date_key date")
    return members, providers, dates, fact


def test_gate_passes(star):
    results = quality.enforce(quality.run_checks(*star))
    assert results["status"] == "ok"
    assert [results[c] for c in quality.CHECKS] == [2, 1, 1, 2, 0, 0, 0, 0, 0, 0, 0]


def test_gate_collects_every_failure(spark, star):
    members, providers, dates, _ = star
    bad_members = members.unionByName(spark.createDataFrame([(None,)], "member_id bigint"))
    fact = spark.createDataFrame(
        [(1, 7, 99, dt.date(2020, 1, 1)), (1, None, 10, None), (None, 1, 10, dt.date(2023, 1, 1))],
        "claim_id bigint, member_id bigint, provider_id bigint, date_key date",
    )
    row = quality.run_checks(bad_members, providers, dates, fact).first()
    assert (row["fact_claims_dup_claim_id"], row["missing_member_refs"], row["missing_provider_refs"], row["missing_date_refs"], row["null_member_pk"]) == (2, 2, 1, 2, 1)
    with pytest.raises(RuntimeError) as error:
        quality.enforce(quality.run_checks(bad_members, providers, dates, fact))
    for text in ("duplicate claim_id", "NULL primary keys found in dimensions", "member_id values not", "provider_id values not", "date_key values not"):
        assert text in str(error.value)


def test_empty_tables(star):
    members, providers, dates, fact = star
    with pytest.raises(RuntimeError, match="dim_member is empty; dim_date is empty; fact_claims is empty$"):
        quality.enforce(quality.run_checks(members.limit(0), providers, dates.limit(0), fact.limit(0)))
    # An empty provider table alone is no failure: only the dangling references are.
    with pytest.raises(RuntimeError, match="failed: fact_claims contains provider_id values not present in dim_provider$"):
        quality.enforce(quality.run_checks(members, providers.limit(0), dates, fact))


def test_quality_report_round_trip(spark, star, rows, tmp_path):
    path = str(tmp_path / "qa")
    results = quality.enforce(quality.run_checks(*star))
    quality.write_quality_report(spark, results, path, dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc))
    text = "".join(p.read_text() for p in (tmp_path / "qa").glob("*.json"))
    payload = json.loads(text)
    assert payload["generated_at"] == "2024-01-02T03:04:05Z"
    assert payload["checks"]["fact_claims_count"] == 2 and payload["checks"]["status"] == "ok"
    back = {r["check"]: r["value"] for r in quality.read_quality_report(spark, path).collect()}
    assert back["dim_member_count"] == "2" and back["status"] == "ok" and len(back) == 12


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "s")
    assert store.open_tables(spark, root) == {}
    store.publish(spark, root, {"a": spark.range(3), "b": spark.range(2)})
    with pytest.raises(RuntimeError, match="no"):
        store.publish(spark, root, {"a": spark.range(9)}, check=lambda written, observed: (_ for _ in ()).throw(RuntimeError("no")))
    tables = store.open_tables(spark, root)
    assert {n: t.count() for n, t in tables.items()} == {"a": 3, "b": 2}
    store.publish(spark, root, {"a": spark.range(5)})
    assert store.open_tables(spark, root)["a"].count() == 5
    assert store.vacuum(spark, str(tmp_path / "none")) == []
    store.publish(spark, root, {"a": spark.range(6)})
    assert len(store.vacuum(spark, root)) == 2  # the first commit and the failed one
    assert store.open_tables(spark, root)["a"].count() == 6 and store.vacuum(spark, root) == []


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    """The whole batch on synthetic feeds of two clients."""
    base = tmp_path_factory.mktemp("batch")
    out = {}
    for client, seed in (("north", 1), ("south", 2)):
        folder = str(base / f"in_{client}")
        synthetic.write_sample(spark, folder, AS_OF, n_claims=3000, n_members=200, n_providers=20, seed=seed)
        files = {role: f"{folder}/sample_{role}.csv" for role in ("members", "providers", "claims")}
        out[client] = job.run_feed(spark, FeedConfig(client, client.title(), files), str(base / "out"), AS_OF)
    return base / "out", out


def test_batch_writes_every_table(spark, batch):
    home, tables = batch
    for client, stored in tables.items():
        counts = {n: df.count() for n, df in stored.items()}
        assert counts["fact_claims"] == 3000 and counts["dim_member"] == 200 and counts["dim_provider"] == 20
        assert set(counts) == {"dim_member", "dim_provider", "dim_date", "fact_claims", "summary_kpis", "summary_monthly", "summary_loss_ratio", "summary_network"}
        ids = stored["fact_claims"].agg(F.min("claim_id"), F.max("claim_id"), F.count_distinct("claim_id")).first()
        assert tuple(ids) == (1, 3000, 3000)
        assert stored["summary_kpis"].agg(F.sum("claims")).first()[0] == 3000
        line = (home / client / "reports" / "model_metrics.txt").glob("part-*")
        assert "LogisticRegression accuracy: 0." in "".join(p.read_text() for p in line)
        assert {p.name for p in (home / client / "export").iterdir()} == {
            "KPIs", "Monthly", "LossRatio", "NetworkUtilization", "DiagnosisSummary", "Model_Metrics",
        }


def test_clients_do_not_share_output(batch):
    _, tables = batch
    north, south = (tables[c]["fact_claims"].agg(F.sum("paid_amount")).first()[0] for c in ("north", "south"))
    assert north != south


def test_fact_prunes_by_month(spark, batch):
    _, tables = batch
    fact = tables["north"]["fact_claims"]
    one = fact.filter("year = 2021 and month = 3")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert one.filter("date_key not between '2021-03-01' and '2021-03-31'").count() == 0


def test_sql_over_the_stored_warehouse(spark, batch):
    _, tables = batch
    stored = tables["north"]
    fact = adhoc.exact_money(stored["fact_claims"])
    total = round(stored["fact_claims"].agg(F.sum("paid_amount")).first()[0], 2)
    for sql, dims in [
        (adhoc.AGE_REGION, {"member": stored["dim_member"]}),
        (adhoc.MONTH_TREND, {"date": stored["dim_date"]}),
        (adhoc.NETWORK_SHARE, {"provider": stored["dim_provider"]}),
        (adhoc.QUARTERS, {"date": stored["dim_date"]}),
        (adhoc.TOP20_DIAGNOSIS, {}),
    ]:
        out = adhoc.run_sql(spark, sql, fact=fact, **dims)
        column = "paid_total" if "paid_total" in out.columns else "total_paid"
        assert out.agg(F.round(F.sum(column), 2)).first()[0] == pytest.approx(total)
    top = adhoc.run_sql(spark, adhoc.TOP_DIAGNOSIS, fact=fact).collect()
    assert len(top) == 10 and [r["total_paid"] for r in top] == sorted((r["total_paid"] for r in top), reverse=True)
    rank = [r["loss_ratio_pct"] for r in adhoc.run_sql(spark, adhoc.LOSS_RANK, summary=stored["summary_loss_ratio"]).collect()]
    assert rank == sorted(rank, reverse=True)
    store.register_views(stored)
    assert "fact_claims" in store.list_tables(spark)


def test_synthetic_rows_do_not_depend_on_partitions(spark, rows):
    few, many = (
        synthetic.claims(spark, 500, 50, 5).repartition(n) for n in (1, 7)
    )
    assert few.exceptAll(many).count() == 0
    order = (F.col("paid_amount") <= F.col("allowed_amount")) & (F.col("allowed_amount") <= F.col("billed_amount"))
    stats = few.agg(F.min("member_id"), F.max("member_id"), F.count_if(~order))
    low, high, bad = stats.first()
    assert 1 <= low and high <= 50 and bad == 0
    log_mean = synthetic.claims(spark, 20000, 50, 5).agg(F.avg(F.log("billed_amount")), F.stddev(F.log("billed_amount"))).first()
    assert log_mean[0] == pytest.approx(5.5, abs=0.05) and log_mean[1] == pytest.approx(1.2, abs=0.05)
    share = synthetic.providers(spark, 20000).agg(F.avg(F.col("in_network").cast("int"))).first()[0]
    assert share == pytest.approx(0.7, abs=0.02)
    people = synthetic.people(spark, 5000, ["Alice", "Bob"]).agg(F.min("age"), F.max("age"), F.min("score"), F.max("score")).first()
    assert people[0] == 18 and people[1] <= 80 and (people[2], people[3]) == (50, 99)
    ages = synthetic.members(spark, 5000, AS_OF).agg(F.min("dob"), F.max("dob")).first()
    assert ages[0] >= dt.date(1944, 2, 28) and ages[1] < dt.date(2006, 3, 1)


def test_batch_looks_members_up_where_the_claims_are(spark, rows):
    """The same measures as by sums per member, with null attributes, unknown and null members; no claim is shuffled for them."""
    from claimloom.operators.filters import classed_rows
    from claimloom.plans import reports
    from claimloom.sources.sample_tables import AS_OF, SampleTables

    t = SampleTables(spark, "/root/testdata/sf0.001")
    member = F.when(F.crc32("claim_id") % 9 == 0, F.lit(None)).when(F.crc32("claim_id") % 9 == 1, F.col("member_id") - 10_000_000).otherwise(F.col("member_id"))
    claims = t.claims().withColumn("member_id", member)
    expected = reports.claim_cube(reports.member_measures(claims, t.members(), t.providers(), AS_OF))
    found = reports.batch_measures(claims, t.members(), t.providers(), AS_OF)
    assert "Exchange hashpartitioning(member_id" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(reports.claim_cube(found)) == rows(expected) and expected.count() > 100

    twice = t.members().unionByName(t.members().limit(1))
    assert classed_rows(claims, twice, "member_id", ["gender"]) is None
    assert rows(reports.claim_cube(reports.batch_measures(claims, twice, t.providers(), AS_OF))) == rows(reports.claim_cube(reports.member_measures(claims, twice, t.providers(), AS_OF)))
    odd = spark.createDataFrame([(i, i % 255 if i % 3 else None) for i in range(-300, 300)], "k bigint, v bigint")
    fact = spark.range(-400, 400).select(F.col("id").alias("k"))
    assert rows(classed_rows(fact, odd, "k", ["v"])) == rows(fact.join(odd, "k"))
    assert classed_rows(fact, odd.withColumn("v", F.col("k")), "k", ["v"]) is None


def test_stored_tables_are_written_small(spark, tmp_path):
    """Work files and tables are compressed with zstd, which takes a third less of a claim than Spark's default."""
    import glob

    from claimloom.session import stage

    store.publish(spark, str(tmp_path), {"t": spark.range(10)})
    assert all(".zstd." in f for f in glob.glob(f"{tmp_path}/versions/*/t/part-*"))
    assert all(".zstd." in f for f in stage(spark.range(10), "t").inputFiles())
