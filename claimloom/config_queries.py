"""Queries over configs, contracts and the model: what a load says and does from a YAML file on, and what a fit predicts."""

from __future__ import annotations

import os
import tempfile

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.operators import summaries, validate
from claimloom.plans import classifier, ingest, job
from claimloom.queries import CLIENT_MAP, _labelled, client_feed, query
from claimloom.session import new_path, stage
from claimloom.sources.config import FeedConfig, read_client_config, read_dataset_config
from claimloom.sources.feeds import load_feed
from claimloom.sources.sample_tables import AS_OF, ORDER_KEYS, SampleTables
from claimloom.stored_queries import _csv


def _yaml(folder: str, name: str, content) -> str:
    """A config file; configs are read by the driver, so its own disk will do."""
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as handle:
        yaml.safe_dump(content, handle)
    return path


def _said(action) -> str:
    try:
        action()
    except (ValueError, KeyError, FileNotFoundError) as error:
        return f"{type(error).__name__}: {error.args[0]}"
    return ""


@query
def configured_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """Two feeds loaded from their YAML files: a client's, with paths as written, and the active one of several datasets, relative to its folder."""
    feed = client_feed(SampleTables(spark, folder)).drop(*ORDER_KEYS)
    path = _csv(feed, "configured").rstrip("/")
    home, name = os.path.split(path)
    with tempfile.TemporaryDirectory() as configs:
        client = {"client_id": "acme", "files": {"claims": path}, "column_map": {"claims": CLIENT_MAP}, "defaults": {"claims": {"procedure_code": "00000"}}}
        datasets = {
            "active_dataset": "second",
            "datasets": {"first": {"dest_dir": "nowhere", "files": {"claims": "none.csv"}}, "second": {"dest_dir": home, "files": {"claims": name}, "column_map": {"claims": {**CLIENT_MAP, "finding": "procedure_code"}}}},
        }
        found = [read_client_config(_yaml(configs, "acme.yaml", client)), read_dataset_config(_yaml(configs, "sets.yaml", datasets))]
    out = None
    for config in found:
        claim = ingest.ingest(spark, config, new_path(spark, "operational"), AS_OF)["claim"]
        row = claim.groupBy("procedure_code", "diagnosis_code").agg(F.count("*").alias("claims"), F.sum("paid_amount").cast("double").alias("paid_total"))
        row = row.withColumn("feed", F.lit(config.feed_id))
        out = row if out is None else out.unionByName(row)
    return out


@query
def contract_errors(spark: SparkSession, folder: str) -> DataFrame:
    """What is said of configs and reports that break their contracts; the good case of each says nothing."""
    t = SampleTables(spark, folder)
    found = job.report_frames({"member": t.members(), "provider": t.providers(), "claim": t.claims()}, AS_OF)
    cases = {}
    for name, df in found.items():
        first, *_, last = sorted(df.columns)
        cases[f"{name}: whole"] = lambda name=name, df=df: validate.require_report_columns(name, df)
        cases[f"{name}: two less"] = lambda name=name, df=df, gone=(last, first): validate.require_report_columns(name, df.drop(*gone))
        cases[f"{name}: one more"] = lambda name=name, df=df: validate.require_report_columns(name, df.withColumn("more", F.lit(1)))
    path = _csv(t.providers().select("provider_id"), "providers")
    cases["no claims role"] = lambda: load_feed(spark, FeedConfig("x", "x", {"providers": path}, {}), AS_OF)
    cases["no key column"] = lambda: validate.require_references(t.claims(["provider_id"]), t.providers().drop("provider_id"), "provider_id", "providers")
    return spark.createDataFrame([(case, _said(action)) for case, action in cases.items()], "case_name string, said string")


@query
def table_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, columns and previewed rows of the tables that claims are made of."""
    t = SampleTables(spark, folder)
    rows = []
    for name in ("lineitem", "orders", "customer", "supplier", "part"):
        table = t.table(name)
        n, columns = summaries.shape(table)
        rows.append((name, n, columns, summaries.preview(table, 7).count()))
    return spark.createDataFrame(rows, "table_name string, rows bigint, columns int, previewed bigint")


@query
def network_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of a fit to a label that is the network status, turned over for every seventh member: the fit learns the rule, not the turns."""
    turned = (F.col("member_id") % 7 == 0).cast("int")
    labelled = _labelled(spark, folder).withColumn("high_cost", F.coalesce(F.col("in_network").cast("int"), F.lit(0)).bitwiseXOR(turned))
    rows = stage(classifier.features(labelled, AS_OF).where("age is not null"), "network_features")
    share = classifier.accuracy(classifier.fit(rows), rows)
    return rows.agg(F.count("*").alias("members")).withColumn("right", F.round(F.lit(share) * F.col("members")).cast("bigint"))


@query
def plain_split_sides(spark: SparkSession, folder: str) -> DataFrame:
    """The unstratified split: all rows on one side each, a fifth of them for the test give or take five standard deviations, the same again."""
    rows = stage(classifier.features(_labelled(spark, folder), AS_OF), "features")
    keys = ["member_id", "in_network"]
    train, test = classifier.plain_split(rows, keys)
    again = classifier.plain_split(rows.repartition(5), keys)[1]
    n, tests = rows.count(), test.count()
    both = train.select(*keys).join(test.select(*keys), keys, "left_semi").count()
    lost = test.select(*keys).exceptAll(again.select(*keys)).count() + again.count() - tests
    near = abs(tests - 0.2 * n) <= 5 * (n * 0.2 * 0.8) ** 0.5
    return spark.createDataFrame([(train.count() + tests, both, lost, near)], "rows bigint, on_both_sides bigint, changed bigint, a_fifth boolean")
