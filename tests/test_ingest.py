"""Feeds from CSV to operational tables: mapping, keys, derivation, validation."""

import datetime as dt

import pytest
import yaml
from pyspark.sql import functions as F

from claimloom.operators import keys, mapping, validate
from claimloom.operators.ordinals import ORD
from claimloom.plans import ingest
from claimloom.sources import feeds
from claimloom.sources.config import FeedConfig, jdbc_options, read_client_config, read_dataset_config, read_db_config

AS_OF = dt.date(2024, 1, 1)

CLIENT_MAP = {
    "claim_no": "claim_id",
    "patient_id": "member_id",
    "physician_id": "provider_id",
    "service_dt": "service_date",
    "icd_code": "diagnosis_code",
    "cpt_code": "procedure_code",
    "charge_amt": "paid_amount",
    "sex": "gender",
    "patient_state": "region",
}
CLIENT_CSV = """claim_no,patient_id,physician_id,service_dt,icd_code,cpt_code,charge_amt,sex,age,patient_state
C1,101,P01,2023-01-10,E11.9,99213,1200,M,45,Northeast
C2,102,P02,2023-01-15,I10,93000,2500,F,52,Southeast
C3,103,P01,2023-02-01,M54.5,27447,980,M,38,West
"""


@pytest.fixture
def client(tmp_path):
    """Write CSVs and build a config for them."""

    def build(column_map=None, defaults=None, **files):
        paths = {}
        for role, text in files.items():
            path = tmp_path / f"{role}.csv"
            path.write_text(text)
            paths[role] = str(path)
        return FeedConfig("acme", "Acme", paths, {"claims": column_map or {}}, defaults or {})

    return build


def test_client_feed_end_to_end(spark, client, rows, tmp_path):
    config = client(CLIENT_MAP, {"claims": {"billed_amount": 0.0, "allowed_amount": 0.0}}, claims=CLIENT_CSV)
    tables = ingest.ingest(spark, config, str(tmp_path / "op"), AS_OF)
    assert rows(tables["claim"], "claim_id", "member_id", "provider_id", "diagnosis_code", "procedure_code", F.col("paid_amount").cast("double"), "place_of_service") == [
        (1, 101, 1, "E11.9", "99213", 1200.0, "Office"),
        (2, 102, 2, "I10", "93000", 2500.0, "Office"),
        (3, 103, 1, "M54.5", "27447", 980.0, "Office"),
    ]
    assert rows(tables["provider"]) == [(1, "Unknown", True, "Unknown"), (2, "Unknown", True, "Unknown")]
    day = dt.date
    assert rows(tables["member"], "member_id", "dob", "gender", "region", "effective_date", "termination_date") == [
        (101, day(1978, 12, 31), "M", "Northeast", day(2023, 1, 1), None),
        (102, day(1972, 1, 1), "F", "Southeast", day(2023, 1, 1), None),
        (103, day(1985, 12, 31), "M", "West", day(2023, 1, 1), None),
    ]
    assert tables["claim"].schema["billed_amount"].dataType.simpleString() == "decimal(12,2)"


def test_feed_without_ids(spark, client, rows):
    config = client({"charges": "paid_amount", "sex": "gender"}, claims="charges,sex,age,region\n100,M,30,East\n200,F,45,West\n")
    out = feeds.load_feed(spark, config, AS_OF)
    assert rows(out["claims"], "member_id", "provider_id", "paid_amount", "diagnosis_code", "service_date") == [
        (1, 1, "100", "Z00", "2023-01-01"),
        (2, 1, "200", "Z00", "2023-01-01"),
    ]
    assert rows(out["members"], "member_id", "gender", "region") == [(1, "M", "East"), (2, "F", "West")]
    assert out["providers"].count() == 1


def test_loading_twice_gives_the_same(spark, client, rows):
    config = client(CLIENT_MAP, claims=CLIENT_CSV)
    first, second = (feeds.load_feed(spark, config, AS_OF) for _ in range(2))
    for role in first:
        assert rows(first[role]) == rows(second[role])


def test_missing_texts_and_leading_zeros(spark, client, rows):
    config = client(claims='member_id,provider_id,procedure_code,region\n007,1,00123,NA\n8,2,N/A,"New\nYork"\n')
    config = FeedConfig("acme", "Acme", config.files, csv_options={"multiLine": True})
    out = feeds.load_feed(spark, config, AS_OF)
    assert rows(out["claims"], "member_id", "procedure_code", "region") == [("007", "00123", None), ("8", None, "New\nYork")]


def test_missing_file_is_named(spark):
    config = FeedConfig("x", "x", {"claims": "/nowhere/claims.csv"})
    with pytest.raises(FileNotFoundError, match="/nowhere/claims.csv"):
        feeds.load_feed(spark, config, AS_OF)
    assert feeds.read_optional(spark, "/nowhere/kpis.csv") is None


def test_claims_role_is_required(spark):
    with pytest.raises(ValueError, match="claims"):
        feeds.load_feed(spark, FeedConfig("x", "x", {"members": "m.csv"}), AS_OF)


CLAIMS = "member_id,provider_id,paid_amount\n1,10,5\n2,20,6\n,10,7\n"


def test_unknown_members_are_reported(spark, client):
    config = client(claims=CLAIMS, members="member_id\n1\n")
    with pytest.raises(ValueError, match="1 member_id.*not among the members: 2$"):
        feeds.load_feed(spark, config, AS_OF)


def test_unknown_providers_are_reported(spark, client):
    config = client(claims=CLAIMS, providers="provider_id\n10\n")
    with pytest.raises(ValueError, match="1 provider_id.*not among the providers: 20$"):
        feeds.load_feed(spark, config, AS_OF)


@pytest.mark.parametrize("role, key", [("members", "member_id"), ("providers", "provider_id")])
def test_dimension_file_needs_its_key(spark, client, role, key):
    config = client(claims=CLAIMS, **{role: "other\n1\n"})
    with pytest.raises(ValueError, match=f"no '{key}' column"):
        feeds.load_feed(spark, config, AS_OF)


def test_missing_ids_sort_as_numbers(spark):
    claims = spark.createDataFrame([(str(i),) for i in range(20, 0, -1)], "member_id string")
    members = spark.createDataFrame([("1",)], "member_id string")
    with pytest.raises(ValueError, match="^19 member_id.*: 2, 3, 4, 5, 6, 7, 8, 9, 10, 11$"):
        validate.require_references(claims, members, "member_id", "members")


# ---- mapping -------------------------------------------------------------------
def test_rename_ignores_absent_and_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert mapping.rename_columns(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]
    with pytest.raises(ValueError, match="x"):
        mapping.rename_columns(df, {"a": "x", "b": "x"})


def test_defaults_only_for_absent_columns(spark, rows):
    df = spark.createDataFrame([("ER",), (None,)], "place string")
    out = mapping.add_defaults(df, {"place": "Office", "code": "Z00", "n": None, "r": lambda: F.lit(3) + 1})
    assert rows(out) == [("ER", "Z00", None, 4), (None, "Z00", None, 4)]


def test_conform_cuts_descriptions(spark):
    from claimloom.model import PROVIDER

    df = spark.createDataFrame([("7", "s" * 100, "False", None)], "provider_id string, specialty string, in_network string, region string")
    row = mapping.conform(df, PROVIDER).first()
    assert row == (7, "s" * 80, False, None)


# ---- derived dimensions --------------------------------------------------------
def claims_frame(spark, ids, providers=("10", "10", "20", "20")):
    data = [(m, p, str(30 + i), "MFMF"[i % 4], f"R{i}", i) for i, (m, p) in enumerate(zip(ids, providers))]
    return spark.createDataFrame(data, f"member_id string, provider_id string, age string, gender string, region string, {ORD} bigint").repartition(3)


def test_first_claim_of_a_member_wins(spark, rows):
    out = keys.derive_members(claims_frame(spark, ["1", "2", None, "1"]), AS_OF)
    assert rows(out, "member_id", "gender", "region", ORD) == [("1", "M", "R0", 0), ("2", "F", "R1", 1), (None, "M", "R2", 2)]
    bare = keys.derive_members(claims_frame(spark, ["1", "2"]).drop("age", "gender", "region"), AS_OF)
    assert rows(bare, "member_id", "dob", "gender", "region") == [("1", None, "U", "Unknown"), ("2", None, "U", "Unknown")]


def test_derived_providers_skip_null(spark, rows):
    out = keys.derive_providers(claims_frame(spark, ["1"] * 4, ("10", None, "20", "10")))
    assert rows(out, "provider_id", "specialty", "in_network") == [("10", "Unknown", True), ("20", "Unknown", True)]


# ---- surrogate keys ------------------------------------------------------------
def dim_and_fact(spark, dim, fact, kind="string"):
    return (
        spark.createDataFrame([(k, i) for i, k in enumerate(dim)], f"k {kind}, {ORD} bigint").repartition(3),
        spark.createDataFrame([(k, i) for i, k in enumerate(fact)], f"k {kind}, id int").repartition(2),
    )


def test_integer_keys_stay(spark):
    dim, fact = dim_and_fact(spark, [5, 7], [7, 5], "bigint")
    assert keys.map_surrogates(dim, fact, "k") == (dim, fact)


def test_numeric_texts_keep_their_value(spark, rows):
    dim, fact = keys.map_surrogates(*dim_and_fact(spark, ["1001", "7", None], ["7", "x", None, "1001"]), "k")
    assert rows(dim, "k") == [(1001,), (7,), (None,)]
    assert rows(fact, "id", "k") == [(0, 7), (1, None), (2, None), (3, 1001)]


def test_text_keys_are_numbered_by_first_appearance(spark, rows):
    dim, fact = keys.map_surrogates(*dim_and_fact(spark, ["P9", None, "P1", "P9", "5"], ["5", "P9", None, "P1"]), "k")
    assert rows(dim, ORD, "k") == [(0, 1), (1, None), (2, 2), (3, 1), (4, 3)]
    assert rows(fact, "id", "k") == [(0, 3), (1, 1), (2, None), (3, 2)]


def test_unmapped_text_keys_raise(spark):
    with pytest.raises(ValueError, match="^k values.*and 2 more"):
        keys.map_surrogates(*dim_and_fact(spark, ["P1"], [f"Q{i}" for i in range(7)]), "k")


def test_fractional_keys_raise(spark):
    with pytest.raises(ValueError, match="not whole"):
        keys.map_surrogates(*dim_and_fact(spark, ["1.5"], ["1.5"]), "k")


# ---- width and uniqueness ------------------------------------------------------
def test_long_codes_stop_the_load(spark):
    df = spark.createDataFrame([("A1", 0), ("too-long-1", 2), ("too-long-0", 3), (None, 4)], f"diagnosis_code string, {ORD} bigint")
    with pytest.raises(ValueError, match="^claims: a diagnosis_code.*'too-long-1'"):
        validate.require_code_widths(df, "claims", F.col(ORD))
    validate.require_code_widths(df.filter("length(diagnosis_code) < 9"), "claims", F.col(ORD))
    assert validate.overlong_codes(df).first() == ("diagnosis_code", 2, "too-long-0")


def test_unique_keys(spark):
    good = spark.createDataFrame([(1,), (2,)], "member_id int")
    validate.require_unique(good, "member_id", "member")
    for bad in ([(1,), (1,)], [(None,), (1,)]):
        with pytest.raises(ValueError, match="breaks its key"):
            validate.require_unique(spark.createDataFrame(bad, "member_id int"), "member_id", "member")


def test_failed_load_keeps_the_last_version(spark, client, tmp_path):
    from claimloom.sources import store

    root = str(tmp_path / "op")
    good = client(claims="member_id,provider_id,paid_amount\n1,10,5\n")
    ingest.ingest(spark, good, root, AS_OF)
    bad = client(claims="member_id,provider_id,paid_amount\n1,10,5\n1,10,9\n", members="member_id\n1\n1\n")
    with pytest.raises(ValueError, match="repeated"):
        ingest.ingest(spark, bad, root, AS_OF)
    assert store.open_tables(spark, root)["claim"].count() == 1


# ---- configs -------------------------------------------------------------------
def write_yaml(tmp_path, content):
    path = tmp_path / "config.yaml"
    path.write_text(content if isinstance(content, str) else yaml.safe_dump(content))
    return str(path)


def test_client_config(tmp_path):
    config = read_client_config(write_yaml(tmp_path, {"client_id": "c", "files": {"claims": "a.csv"}}))
    assert (config.feed_id, config.name, config.files["claims"]) == ("c", "c", "a.csv")
    for content, message in [("", "found empty file"), ("- 1", "found list"), ({"files": {"claims": "a"}}, "client_id"), ({"client_id": "c"}, "no files")]:
        with pytest.raises(ValueError, match=message):
            read_client_config(write_yaml(tmp_path, content))


def test_dataset_config(tmp_path):
    content = {
        "active_dataset": "one",
        "datasets": {"one": {"dest_dir": "/d/", "files": {"claims": "a.csv"}}, "two": {"files": {"claims": "b.csv"}}},
    }
    path = write_yaml(tmp_path, content)
    assert read_dataset_config(path).files["claims"] == "/d/a.csv"
    assert read_dataset_config(path, "two").feed_id == "two"
    with pytest.raises(KeyError, match="three"):
        read_dataset_config(path, "three")
    with pytest.raises(ValueError):
        read_dataset_config(write_yaml(tmp_path, {"datasets": {}}))


def test_jdbc_options(tmp_path):
    url = jdbc_options({}, {"DATABASE_URL": "postgresql+psycopg2://me:p%40ss@db:5433/claims"})
    assert url == {"url": "jdbc:postgresql://db:5433/claims", "user": "me", "password": "p@ss", "driver": "org.postgresql.Driver"}
    path = write_yaml(tmp_path, {"engine_url": "${DATABASE_URL}", "host": "h", "port": 1})
    assert read_db_config(path, {}) == {"engine_url": None, "host": "h", "port": 1}
    parts = jdbc_options(read_db_config(path, {}), {"DB_NAME": "d", "DB_USER": "me", "DB_PASS": "x"})
    assert (parts["url"], parts["user"]) == ("jdbc:postgresql://h:1/d", "me")
    with pytest.raises(ValueError, match="password"):  # nothing is guessed
        jdbc_options({"user": "me"}, {})
    assert jdbc_options({"engine_url": "postgres://x@y/z"}, {})["url"] == "jdbc:postgresql://y/z"
    assert read_db_config(str(tmp_path / "absent.yaml")) == {}


def test_load_stores_only_what_it_reads(spark, client, monkeypatch):
    """The feed's own ids and columns without a place in the model are not stored; those members are derived from are."""
    stored = {}
    plain = feeds.stage
    monkeypatch.setattr(feeds, "stage", lambda df, name: stored.setdefault(name, df) and plain(df, name))
    config = client({"sex": "gender"}, claims="claim_id,member_id,provider_id,paid_amount,sex,age,region,more\nc1,1,10,5,F,30,East,x\n", providers="provider_id,more\n10,y\n")
    tables = feeds.load_feed(spark, config, AS_OF, wanted=ingest.wanted_columns(config))
    own = lambda role: [c for c in stored[role].columns if not c.startswith("_")]
    assert own("claims") == ["member_id", "provider_id", "paid_amount", "sex", "age", "region"] and own("providers") == ["provider_id"]
    assert tables["members"].first()["gender"] == "F"
    config = client({"sex": "gender"}, claims="member_id,sex,gender\n1,F,F\n")
    with pytest.raises(ValueError, match="more than one source column"):
        feeds.load_feed(spark, config, AS_OF, wanted=ingest.wanted_columns(config))


def test_numbered_claims_are_their_members_without_grouping(spark, client, rows):
    config = client({}, claims="paid_amount,age\n1,30\n2,40\n3,x\n")
    members = feeds.load_feed(spark, config, AS_OF)["members"]
    assert "Aggregate" not in members._jdf.queryExecution().optimizedPlan().toString()
    assert rows(members, "member_id", "gender") == [(1, "U"), (2, "U"), (3, "U")]


def test_written_tables_with_many_keys_are_checked(spark):
    """Keys that bitmaps find broken are still named, at one claim a key."""
    from claimloom.sources import store

    member = spark.range(1, 2001).select(F.col("id").alias("member_id"))
    claim = spark.range(1, 2001).select(F.col("id").alias("member_id"), F.lit(1).cast("bigint").alias("provider_id"))
    provider = spark.range(1, 2).select(F.col("id").alias("provider_id"))
    stats = lambda n: store.TableStats(n, {}, {})
    seen = {"member": stats(2000), "provider": stats(1), "claim": stats(2000)}
    ingest.check_operational({"member": member, "provider": provider, "claim": claim}, seen)
    with pytest.raises(ValueError, match="1 member_id.*: 7$"):
        ingest.check_operational({"member": member.where("member_id <> 7"), "provider": provider, "claim": claim}, seen)
    with pytest.raises(ValueError, match="1 repeated keys"):
        ingest.check_operational({"member": member.unionByName(member.where("member_id = 7")), "provider": provider, "claim": claim}, seen)


@pytest.mark.parametrize("text, key", [("7", 7), ("007", 7), ("7.0", 7), (" 7 ", 7), ("-7", -7), ("1e3", 1000), ("999999999999999999", 10**18 - 1), ("7x", None), ("7.5", None), ("", None), (None, None)])
def test_plain_and_other_spellings_of_keys(spark, text, key):
    from claimloom.functions.exprs import to_key

    assert spark.createDataFrame([(text,)], "t string").select(to_key(F.col("t"))).first()[0] == key


def test_first_claims_are_found_without_a_sort(spark, rows, monkeypatch):
    """Numbered value sets give the rows that an aggregate over texts gives, null values and a null key included."""
    claims = claims_frame(spark, ["1", "2", None, "1", None, "3"], ("10",) * 6).withColumn("region", F.when(F.col(ORD) > 0, F.col("region")))
    known = ["age", "gender", "region"]
    out = keys.first_by_class(claims, "member_id", known)
    assert rows(out) == rows(keys.first_per_key(claims, "member_id", ORD, known).select(out.columns))
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(keys, "MAX_CLASSES", 2)
    assert keys.first_by_class(claims, "member_id", known) is None
    assert rows(keys.derive_members(claims, AS_OF, stored=True)) == rows(keys.derive_members(claims, AS_OF))


def test_references_are_checked_where_the_claims_are(spark, monkeypatch):
    """Many claims a key: no claim is counted per key unless one has no member."""
    from claimloom.sources import store

    member = spark.range(1, 101).select(F.col("id").alias("member_id"))
    provider = spark.range(1, 3).select(F.col("id").alias("provider_id"))
    claim = spark.range(0, 2000).select((F.col("id") % 100 + 1).alias("member_id"), F.when(F.col("id") > 0, F.col("id") % 2 + 1).alias("provider_id"))
    stats = lambda n: store.TableStats(n, {}, {})
    seen = {"member": stats(100), "provider": stats(2), "claim": stats(2000)}
    with pytest.raises(ValueError, match="1 member_id.*: 7$"):
        ingest.check_operational({"member": member.where("member_id <> 7"), "provider": provider, "claim": claim}, seen)

    def refuse(*_):
        raise AssertionError("claims were counted per key")

    monkeypatch.setattr(ingest, "require_references", refuse)
    ingest.check_operational({"member": member, "provider": provider, "claim": claim}, seen)


def test_members_of_claims_without_ids_are_counted_without_a_shuffle_of_them(spark):
    from claimloom.queries import QUERIES

    out = QUERIES["ingest_without_ids"](spark, "/root/testdata/sf0.001")
    assert "distinct" not in out._jdf.queryExecution().optimizedPlan().toString()
    row = out.first()
    assert row.claim_members == row.claims == row.members == row.last_member
