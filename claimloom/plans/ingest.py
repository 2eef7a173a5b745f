"""From a mapped feed to the three operational tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.model import CLAIM, MEMBER, PROVIDER, ROLE_TABLE
from claimloom.operators import distinct, filters
from claimloom.operators.keys import map_surrogates
from claimloom.operators.mapping import conform, trim_to_schema
from claimloom.operators.ordinals import ORD
from claimloom.operators.validate import require_code_widths, require_references, require_unique
from claimloom.sources import store
from claimloom.sources.config import FeedConfig
from claimloom.sources.feeds import load_feed


#: Checks of keys use bitmaps where a key has fewer claims than this.
MANY_KEYS = 8


def serial_claim_ids(claims: DataFrame, ordinal: str = ORD) -> DataFrame:
    """Number the claims 1..n in file order; an id the feed carries is not kept."""
    return claims.withColumn("claim_id", F.col(ordinal) + 1)


def wanted_columns(config: FeedConfig) -> dict[str, set[str]]:
    """The columns of each role that a load reads: its table's, and what members are derived from.

    The feed's own claim ids are left out, since claims are numbered anew.
    """
    wanted = {role: set(schema.names) for role, (_, schema) in ROLE_TABLE.items()}
    wanted["claims"] -= {"claim_id"}
    if "members" not in config.files:
        wanted["claims"] |= {"age", "gender", "region"}
    return wanted


def to_operational(
    members: DataFrame, providers: DataFrame, claims: DataFrame, derived: Collection[str] = ()
) -> dict[str, DataFrame]:
    """Numeric keys, serial claim ids, checked codes, cut descriptions, table types.

    ``derived`` names the roles that were made from the claims or already checked
    against them, whose keys need no check here. Codes are checked before any join is added, on a
    scan of the code columns alone.
    """
    members, providers, claims = (
        trim_to_schema(df, schema, extra=(ORD,))
        for df, schema in ((members, MEMBER), (providers, PROVIDER), (claims, CLAIM))
    )
    for role, df in (("claims", claims), ("members", members), ("providers", providers)):
        require_code_widths(df, role, F.col(ORD))
    providers, claims = map_surrogates(providers, claims, "provider_id", known="providers" in derived)
    members, claims = map_surrogates(members, claims, "member_id", known="members" in derived)
    claims = serial_claim_ids(claims)
    tables = {"members": members, "providers": providers, "claims": claims}
    return {ROLE_TABLE[role][0]: conform(df, ROLE_TABLE[role][1]) for role, df in tables.items()}


def check_operational(tables: dict[str, DataFrame], observed: dict[str, store.TableStats] | None = None) -> None:
    """What the operational database would refuse: broken keys and dangling references."""
    for table, key in (("member", "member_id"), ("provider", "provider_id")):
        dim, claim = tables[table], tables["claim"]
        # counting claims per key moves most of them; bitmaps and filters move none and say at least whether all is well
        many = observed is not None and observed[table].rows * MANY_KEYS > observed["claim"].rows
        if not (many and distinct.is_key(dim, key)):
            require_unique(dim, key, table)
        known = distinct.covers(dim, claim, key) if many else filters.all_known(claim, dim, key)
        if not known:
            require_references(claim, dim, key, f"{table}s")


def ingest(spark: SparkSession, config: FeedConfig, root: str, as_of: dt.date, quarantine: str | None = None) -> dict[str, DataFrame]:
    """Load a feed as the new version of the operational tables under ``root``.

    Lines that do not fit their header go to the ``quarantine`` folder if there is one.
    """
    feed = load_feed(spark, config, as_of, quarantine, wanted_columns(config))
    # every role is known here: load_feed has derived it from the claims or checked their references to it
    tables = to_operational(feed["members"], feed["providers"], feed["claims"], list(feed))
    store.publish(spark, root, tables, check=check_operational)
    return store.open_tables(spark, root)
