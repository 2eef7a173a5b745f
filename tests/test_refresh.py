"""Refreshes: observed counts, shared and named tables, bad lines, ordered files, pruned reads, one roll-up."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimloom.plans import export, reports, warehouse
from claimloom.sources import catalog, clients, feeds, store
from claimloom.sources.config import FeedConfig


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_come_from_the_write(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 7).select("id", F.when(F.col("id") % 4 != 0, F.col("id").cast("decimal(12,2)")).alias("paid_amount"), F.lit(None).cast("string").alias("t"))
    seen = {}
    root = str(tmp_path)
    store.publish(spark, root, {"a": rows, "none": rows.where("id < 0")}, check=lambda written, stats: seen.update(stats))
    assert seen["a"].rows == 1000 and seen["a"].nulls == {"id": 0, "paid_amount": 250, "t": 1000}
    assert float(seen["a"].totals["paid_amount"]) == sum(i for i in range(1000) if i % 4)
    assert seen["none"].rows == 0 and seen["none"].totals == {"paid_amount": None}
    kept = {(r.table_name, r.column_name): (r["rows"], r.nulls, r.total) for r in store.table_stats(spark, root).collect()}
    assert kept["a", "paid_amount"] == (1000, 250, float(sum(i for i in range(1000) if i % 4)))
    assert kept["a", "t"] == (1000, 1000, None) and kept["none", "id"] == (0, 0, None)


def test_commits_without_counts_stay_readable(spark, tmp_path):
    """A table that was committed before writes were counted."""
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/versions/v0/t")
    old = "version string, tables array<struct<name: string, rows: bigint, fields: string>>"
    spark.createDataFrame([("v0", [("t", 3, spark.range(1).schema.json())])], old).write.json(f"{root}/commits")
    assert store.open_tables(spark, root)["t"].count() == 3
    assert store.table_stats(spark, root).count() == 0


def test_one_client_is_replaced(spark, tmp_path):
    path = f"{tmp_path}/shared"
    for name, n in (("a", 10), ("b", 20)):
        assert clients.refresh_client(spark, path, name, spark.range(n)).rows == n
    table = lambda: clients.read_clients(spark, path, spark.range(1))
    before = {r.client_id: r.file for r in clients.client_files(table().where("client_id = 'b'")).collect()}
    clients.refresh_client(spark, path, "a", spark.range(3))
    assert {r.client_id: r["count"] for r in table().groupBy("client_id").count().collect()} == {"a": 3, "b": 20}
    assert {r.client_id: r.file for r in clients.client_files(table().where("client_id = 'b'")).collect()} == before
    with pytest.raises(Exception):
        clients.refresh_client(spark, path, "b", spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")))
    assert table().where("client_id = 'b'").count() == 20
    assert clients.refresh_client(spark, path, "b", spark.range(0)).rows == 0
    assert {r.client_id for r in table().collect()} == {"a"}


def test_failed_refresh_leaves_the_names(spark, tmp_path):
    root = str(tmp_path)
    store.publish(spark, root, {"t": spark.range(4), "gone": spark.range(1)})
    assert catalog.register(spark, root, "named_test") == ["gone", "t"]
    with pytest.raises(RuntimeError):
        store.publish(spark, root, {"t": spark.range(9)}, check=lambda *_: (_ for _ in ()).throw(RuntimeError("no")))
    catalog.register(spark, root, "named_test")
    assert spark.table("named_test.t").count() == 4
    store.publish(spark, root, {"t": spark.range(9).withColumn("more", F.lit(1))})
    assert catalog.register(spark, root, "named_test") == ["t"] == catalog.list_names(spark, "named_test")
    assert spark.table("named_test.t").columns == ["id", "more"]
    assert catalog.preview(spark, "named_test", "t", 5).count() == 5
    assert catalog.register(spark, f"{root}/nothing", "named_test") == []


BAD = """key,name,amount
1,"a, b",2
2,short
3,x,1,more
4,"open,5
5,a, b,6

6,last,7
"""


def test_bad_lines_are_quarantined(spark, tmp_path):
    (tmp_path / "f.csv").write_text(BAD)
    (tmp_path / "g.csv").write_text("key,name,amount\n7,z,1\n8\n9,y,3\n")
    config = FeedConfig("q", "q", {"members": str(tmp_path / "[fg].csv")}, {})
    found = feeds.load_roles(spark, config, f"{tmp_path}/quarantine")["members"]
    rows = {r.key: (r.name, r._ord) for r in found.collect()}
    assert {k: v[0] for k, v in rows.items()} == {"1": "a, b", "6": "last", "7": "z", "9": "y"}
    assert sorted(v[1] for v in rows.values()) == [0, 1, 2, 3] and rows["1"][1] < rows["6"][1] and rows["7"][1] < rows["9"][1]
    bad = {(r.file, r.kind, r.line) for r in feeds.read_quarantine(spark, f"{tmp_path}/quarantine").collect()}
    assert bad == {
        ("f.csv", "short", "2,short"), ("f.csv", "long", "3,x,1,more"), ("f.csv", "quote", '4,"open,5'), ("f.csv", "long", "5,a, b,6"), ("g.csv", "short", "8")
    }


def test_bad_lines_are_found_where_not_all_columns_are_read(spark, tmp_path):
    """Good rows are numbered without gaps, block by block, as they are read: no window, and stored once."""
    lines = [f"{i}" if i % 10 == 3 else f"{i},n,1,more" if i % 10 == 7 else f"{i},n,1" for i in range(3000)]
    (tmp_path / "f.csv").write_text("key,name,amount\n" + "\n".join(lines) + "\n")
    config = FeedConfig("q", "q", {"members": str(tmp_path / "f.csv")}, {})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        found = feeds.load_roles(spark, config, f"{tmp_path}/quarantine", {"members": {"key"}})["members"]
        got = [(int(r.key), r._ord) for r in found.orderBy("_ord").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [(k, i) for i, k in enumerate(k for k in range(3000) if k % 10 not in (3, 7))]
    bad = feeds.read_quarantine(spark, f"{tmp_path}/quarantine").orderBy("position").collect()
    assert [(r.kind, int(r.line.split(",")[0])) for r in bad] == [("short" if k % 10 == 3 else "long", k) for k in range(3000) if k % 10 in (3, 7)]


def test_files_keep_the_order(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 4).select(((F.col("id") * 7919) % 5000).alias("k"), F.lit('a "b", c').alias("t"))
    path = f"{tmp_path}/sorted"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export.write_csv(rows.orderBy(F.col("k").desc()), path, file_rows=300)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "sorted").glob("part-*.csv"))) >= 17
    back = export.read_csv_in_order(spark, path).collect()
    assert [int(r.k) for r in sorted(back, key=lambda r: r._ord)] == list(range(4999, -1, -1))
    assert {r.t for r in back} == {'a "b", c'}


@pytest.fixture(scope="module")
def stored_fact(spark, tmp_path_factory):
    fact = spark.range(0, 4000).select(F.col("id").alias("claim_id"), F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 700).cast("int")).alias("date_key"))
    root = str(tmp_path_factory.mktemp("fact"))
    tables = {"fact_claims": warehouse.partitioned_fact(fact), "dim_date": warehouse.dim_date(spark, dt.date(2021, 1, 1), dt.date(2020, 1, 1))}
    store.publish(spark, root, tables, partition_by={"fact_claims": ["year", "month"]})
    return store.open_tables(spark, root)


def test_a_quarter_reads_three_partitions(stored_fact):
    frame = warehouse.in_months(stored_fact["fact_claims"], 2020, range(4, 7))
    assert frame.count() == sum(1 for i in range(4000) if 91 <= i % 700 < 182)
    assert "PartitionFilters: [isnotnull(year" in frame._jdf.queryExecution().toString()
    assert len({tuple(f.split("/")[-3:-1]) for f in (r[0] for r in frame.select("_metadata.file_path").distinct().collect())}) == 3


def test_the_calendar_prunes_while_it_runs(spark, stored_fact):
    quarter = stored_fact["dim_date"].where("year = 2020 and quarter = 2")
    frame = warehouse.with_calendar(stored_fact["fact_claims"], quarter)
    assert "dynamicpruning" in plan(frame)
    assert frame.count() == sum(1 for i in range(4000) if 91 <= i % 700 < 182)


@pytest.fixture(scope="module")
def measures(spark):
    rows = []
    for i in range(400):
        day = None if i % 17 == 0 else dt.date(2020, 1 + i % 12, 1)
        rows.append((None if i % 7 == 0 else "19-30", ["A", "B", None][i % 3], [True, False, None][i % 5 % 3], day, ["x", None][i % 2], 1, 1, i, 2 * i, None))
    money = "decimal(12,2)"
    return spark.createDataFrame(
        [(*r[:7], *[None if v is None else v for v in r[7:]]) for r in rows],
        "age_band string, member_region string, in_network boolean, month date, diagnosis_code string, claims bigint, paid_claims bigint, paid int, billed int, allowed int",
    ).withColumns({c: F.col(c).cast(money) for c in ("paid", "billed", "allowed")})


def test_all_reports_from_one_scan(measures, rows):
    cube = reports.claim_cube(measures).cache()
    rolled = reports.rollups(cube)
    assert plan(rolled).count("Expand") == 1 and plan(rolled).count("InMemoryTableScan") == 1
    rolled = rolled.cache()
    wanted = reports.all_reports(cube)
    for name, found in reports.reports_of(rolled).items():
        assert rows(found) == rows(wanted[name]), name


def test_reports_by_claim_do_not_sum_per_member(spark):
    claims = spark.range(2000).select(
        F.col("id").alias("claim_id"), (F.col("id") % 60).alias("member_id"), (F.col("id") % 9).alias("provider_id"), F.lit(1).cast("decimal(12,2)").alias("paid_amount"),
        F.concat(F.lit("d"), F.col("id") % 3).alias("diagnosis_code"), F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 2).cast("int")).alias("service_date"),
    )
    members = spark.range(50).select(F.col("id").alias("member_id"), F.lit(dt.date(1990, 1, 1)).alias("dob"), F.lit("r").alias("region"))
    providers = spark.range(8).select(F.col("id").alias("provider_id"), F.lit(True).alias("in_network"))
    frame = reports.diagnosis_summary(reports.known_claims(claims, members, providers))
    text = plan(frame)
    assert text.count("Exchange hashpartitioning") == 1 and "hashpartitioning(diagnosis_code" in text
    known = sum(1 for i in range(2000) if i % 60 < 50 and i % 9 < 8)
    assert frame.agg(F.sum("claims")).first()[0] == known
    assert reports.monthly(reports.claim_rows(claims, members, providers, dt.date(2020, 1, 1))).first().claims == known
