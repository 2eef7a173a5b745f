"""CSV feeds: scan per role, map, assign keys, derive missing dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimloom.model import ROLE_DEFAULTS
from claimloom.operators.keys import derive_members, derive_providers, ensure_claim_keys
from claimloom.operators.mapping import apply_mapping, missing_to_null, rename_columns
from claimloom.operators.ordinals import ORD, add_file_ordinal, tag_by_file
from claimloom.operators.validate import require_references
from claimloom.session import stage
from claimloom.sources.config import FeedConfig


def scan_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """All columns as text (codes keep their leading zeros), one file or a folder.

    Quotes are doubled as in RFC 4180. Files are split across tasks; a feed with
    line breaks inside quotes must say ``multiLine: true``, which reads each
    file in one task.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    try:
        return reader.options(**options).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no file or folder at '{path}'") from error
        raise


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored report, or None where it was never written."""
    try:
        return scan_csv(spark, path)
    except FileNotFoundError:
        return None


#: Text of a line that does not fit the header, in a scan that looks for them.
BAD_LINE = "_bad_line"
QUARANTINE = "role string, file string, position bigint, kind string, line string"


def scan_with_bad_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """``scan_csv`` with ``_bad_line``: the whole line where it has fewer or more fields than the header, else null.

    A value with an unquoted separator makes its line too long, a quote that is
    never closed too short. Without this column Spark fills such lines up or cuts them.
    Lines are parsed whole whatever columns are read: Spark would otherwise count
    the fields of those columns only, and find no line bad.
    """
    header = scan_csv(spark, path, **options).columns
    fields = StructType([StructField(c, StringType()) for c in [*header, BAD_LINE]])
    checks = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE, "enforceSchema": True, "columnPruning": False, **options}
    return spark.read.schema(fields).option("header", True).option("quote", '"').option("escape", '"').options(**checks).csv(path)


def _line_kind(line: Column, fields: int, sep: str) -> Column:
    """Why a line is bad, by what a reader of it would look at first."""
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    found = F.length(line) - F.length(F.replace(line, F.lit(sep), F.lit(""))) + 1
    return F.when(quotes % 2 == 1, "quote").when(found < fields, "short").otherwise("long")


def bad_lines(scan: DataFrame, role: str, sep: str = ",") -> DataFrame:
    """Quarantined lines of a scan with bad lines, by file, position in the scan, and kind.

    A second pass over the text: numbering the good rows as they are read needs
    neither a sort nor a second copy of them, which cost more than the pass.
    Positions are only stable once written.
    """
    first, *_ = header = scan.drop(BAD_LINE).columns
    tagged = scan.select(
        F.col(BAD_LINE),
        F.coalesce(BAD_LINE, F.col(f"`{first}`")).alias("line"),  # Spark refuses a scan of nothing but bad lines
        F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"),
        F.monotonically_increasing_id().alias("position"),
    )
    kind = _line_kind(F.col("line"), len(header), sep).alias("kind")
    return tagged.where(F.col(BAD_LINE).isNotNull()).select(F.lit(role).alias("role"), "file", "position", kind, "line")


def line_counts(good: DataFrame, bad: DataFrame, role: str) -> DataFrame:
    """(role, kind, lines): good lines and the bad ones of each kind."""
    counts = bad.groupBy("role", "kind").agg(F.count("*").alias("lines"))
    return good.agg(F.count(F.lit(1)).alias("lines")).select(F.lit(role).alias("role"), F.lit("good").alias("kind"), "lines").unionByName(counts)


def load_roles(
    spark: SparkSession, config: FeedConfig, quarantine: str | None = None, wanted: Mapping[str, Collection[str]] | None = None
) -> dict[str, DataFrame]:
    """One mapped frame per configured role, each with its ``_ord`` file order.

    Every role is written once to the shared folder: the order of a text scan is
    only reproducible when stored, and later steps read columns instead of text.

    With a ``quarantine`` folder, lines that do not fit the header are left out of
    the feed and written there (role, file, position, kind, line), a partition a
    role; without one they are read as Spark reads them, filled up or cut.

    ``wanted`` names, per role, the model columns that the caller reads; other
    columns of that role's file are not stored. Without it all are.
    """
    out = {}
    for role, path in config.files.items():
        mapped = config.column_map.get(role, {})
        if quarantine is None:
            scan = scan_csv(spark, path, **config.csv_options)
            kept = _kept(scan, mapped, wanted, role)
        else:
            scan = scan_with_bad_lines(spark, path, **config.csv_options)
            kept = _kept(scan.drop(BAD_LINE), mapped, wanted, role)
            bad = bad_lines(scan, role, config.csv_options.get("sep", ","))
            bad.drop("role").write.mode("overwrite").parquet(f"{quarantine}/role={role}")
            scan = scan.where(F.col(BAD_LINE).isNull())
        rows, paths = tag_by_file(scan, missing_to_null(kept))
        ordered = add_file_ordinal(stage(rows, role), paths)
        defaults = {**ROLE_DEFAULTS.get(role, {}), **config.defaults.get(role, {})}
        out[role] = apply_mapping(ordered, mapped, defaults)
    return out


def _kept(scan: DataFrame, column_map: Mapping[str, str], wanted: Mapping[str, Collection[str]] | None, role: str) -> list[str]:
    """Columns of a file whose model names are wanted; names that clash are an error for all columns."""
    names = rename_columns(scan, column_map).columns
    if wanted is None or role not in wanted:
        return scan.columns
    return [c for c, name in zip(scan.columns, names) if name in wanted[role]]


def read_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """All quarantined lines of a feed."""
    return spark.read.schema(QUARANTINE).parquet(folder)


def load_feed(
    spark: SparkSession, config: FeedConfig, as_of: dt.date, quarantine: str | None = None, wanted: Mapping[str, Collection[str]] | None = None
) -> dict[str, DataFrame]:
    """Members, providers and claims of a feed, still in the feed's own key space.

    Derived dimensions are stored: several later steps read them, and each would
    otherwise aggregate all claims again. Members of claims that came without ids
    are the claims themselves; they are neither grouped nor stored.
    """
    if "claims" not in config.files:
        raise ValueError("a feed needs a file for the 'claims' role")
    tables = load_roles(spark, config, quarantine, wanted)
    numbered = "member_id" not in tables["claims"].columns
    claims = tables["claims"] = ensure_claim_keys(tables["claims"])
    if "members" in config.files:
        require_references(claims, tables["members"], "member_id", "members")
    elif numbered:
        tables["members"] = derive_members(claims, as_of, ORD, numbered=True)
    else:
        tables["members"] = stage(derive_members(claims, as_of, stored=True), "derived_members")
    if "providers" in config.files:
        require_references(claims, tables["providers"], "provider_id", "providers")
    else:
        tables["providers"] = stage(derive_providers(claims, ORD), "derived_providers")
    return tables
