"""How far a feed has come: newest LSN per table, and whether a table has new changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.functions.lsn import ZERO_LSN, lsn_literal, lsn_number, lsn_of_number
from tidefeed.operators.changes import LSN, changes_since, quoted
from tidefeed.operators.envelope import fan_in


def progress(
    tables: Mapping[str, DataFrame], last_lsns: Mapping[str, bytes] | None = None
) -> DataFrame:
    """One row per table: ``table_name``, ``high_water``, ``changes_found``, ``changes``.

    ``high_water`` is the newest LSN, or the saved one if nothing is newer. Each table is a
    global aggregate over its LSN column alone: the maximum of a binary column under a grouping
    key would be a sort-based aggregate, and without a key it is a plain streaming one.
    """
    saved = last_lsns or {}
    newest, changes_seen = F.max(quoted(LSN)), F.count(F.lit(1))
    return fan_in(
        changes_since(changes, saved.get(name)).agg(
            F.lit(name).alias("table_name"),
            F.coalesce(newest, lsn_literal(saved.get(name))).alias("high_water"),
            (changes_seen > 0).alias("changes_found"),
            changes_seen.alias("changes"),
        )
        for name, changes in tables.items()
    )


def feed_high_water(feed: DataFrame, tables: Sequence[str] = ()) -> DataFrame:
    """Newest LSN per table of a feed that already mixes tables.

    With ``tables``, one maximum for each of them without a grouping key, so nothing is sorted and
    one row per task is shuffled; a table without rows has a null. Without, LSNs are grouped as
    two integers, which a hash aggregate takes.
    """
    if tables:
        newest = [
            F.max(F.when(F.col("table_name") == table, F.col("lsn"))).alias(f"t{i}")
            for i, table in enumerate(tables)
        ]
        pairs = F.array(
            *[
                F.struct(F.lit(table).alias("table_name"), F.col(f"t{i}").alias("high_water"))
                for i, table in enumerate(tables)
            ]
        )
        return feed.agg(*newest).select(F.inline(pairs))
    return (
        feed.where("lsn IS NOT NULL")
        .groupBy("table_name")
        .agg(F.max(lsn_number("lsn")).alias("number"))
        .select("table_name", lsn_of_number("number").alias("high_water"))
    )


def live_progress(feed: DataFrame, last_lsns: Mapping[str, bytes] | None = None) -> DataFrame:
    """One row per table of a feed, also of one that streams: ``table_name``, ``high_water``,
    ``changes``, ``behind``.

    A streaming query over it, in update mode, keeps a number and a count for each table as state,
    and after each batch gives the rows of the tables that the batch had changes of. ``behind`` is
    how many LSNs the newest change is past the table's position in ``last_lsns``.
    """
    saved = F.lit(ZERO_LSN)
    for name, lsn in (last_lsns or {}).items():
        saved = F.when(F.col("table_name") == name, F.lit(bytes(lsn))).otherwise(saved)
    newest = (
        feed.where("lsn IS NOT NULL")
        .groupBy("table_name")
        .agg(F.max(lsn_number("lsn")).alias("number"), F.count(F.lit(1)).alias("changes"))
    )
    return newest.select(
        "table_name",
        lsn_of_number("number").alias("high_water"),
        "changes",
        (F.col("number") - lsn_number(saved)).alias("behind"),
    )
