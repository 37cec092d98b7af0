"""Saved positions: one LSN per table.

The store is a folder with two leaves per query, ``query_id=.../slot=0`` and ``slot=1``. A save
writes all positions of its query, under the next number, to the leaf that does not hold the
newest save; so a failure while writing leaves the newest save whole, however many batches saved
nothing in between, and the store does not grow with the number of batches.

A position says either that everything up to it has been published (``complete``), or only that a
row of that LSN was (``seen``): files of a stream need not come in log order, so a stream has seen
more than it has completed. Feeds start from complete positions alone. The position of a table is
the newest one over all leaves, so no batch can move it back; only ``reset_offset`` can.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.functions.lsn import ZERO_LSN, lsn_literal
from tidefeed.workspace import path_exists

OFFSETS_SCHEMA = "table_name STRING, last_lsn BINARY, updated_at TIMESTAMP"
STORE_SCHEMA = OFFSETS_SCHEMA + ", complete BOOLEAN, era LONG, save LONG"

SLOTS = 2


def empty_offsets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], OFFSETS_SCHEMA)


def offsets_frame(spark: SparkSession, positions: Mapping[str, bytes]) -> DataFrame:
    """Positions held in a Python mapping, as offset rows stamped with the present time."""
    rows = [(name, bytes(lsn)) for name, lsn in positions.items()]
    frame = spark.createDataFrame(rows, "table_name STRING, last_lsn BINARY")
    return frame.withColumn("updated_at", F.current_timestamp())


def merge_offsets(*offsets: DataFrame) -> DataFrame:
    """One row per table: the newest LSN, with the time it was saved. An upsert that never
    lowers a position."""
    columns = ["table_name", "last_lsn", "updated_at"]
    rows = reduce(DataFrame.unionByName, [frame.select(*columns) for frame in offsets])
    newest = F.max(F.struct("last_lsn", "updated_at")).alias("newest")
    return rows.groupBy("table_name").agg(newest).select("table_name", "newest.*")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of a store's leaves, or None if nothing was saved yet."""
    if not path_exists(spark, path):
        return None
    # Another query may replace a leaf of its own meanwhile.
    return spark.read.schema(STORE_SCHEMA).option("ignoreMissingFiles", True).parquet(path)


def read_offsets(spark: SparkSession, path: str, complete: bool = True) -> DataFrame:
    """The saved positions; no rows if nothing was saved yet.

    With ``complete=False`` they are the newest that were seen, which a stream of files may have
    reached before older rows: for reports, not to read on from.
    """
    saved = _stored(spark, path)
    if saved is None:
        return empty_offsets(spark)
    if complete:
        saved = saved.where(F.coalesce("complete", F.lit(True)))
    # An era begins when a table's position is set back; what was saved before it is void.
    era = F.coalesce("era", F.lit(0)).alias("era")
    newest = F.max(F.struct(era, "last_lsn", "updated_at")).alias("newest")
    return (
        saved.groupBy("table_name")
        .agg(newest)
        .select("table_name", "newest.last_lsn", "newest.updated_at")
    )


def save_offsets(
    spark: SparkSession,
    positions: Mapping[str, bytes],
    path: str,
    query_id: str,
    complete: bool = True,
    new_era: bool = False,
) -> None:
    """Record the positions one batch reached. Saving them again changes nothing."""
    rows: dict[tuple[str, bool], tuple] = {}
    eras: dict[str, int] = {}
    newest_save, newest_slot = 0, SLOTS - 1
    stored = _stored(spark, path)
    if stored is not None and {"query_id", "slot"} <= set(stored.columns):
        own = (F.col("query_id") == query_id).alias("own")
        for row in stored.select("*", own).collect():  # a few per table and query
            era = row.era or 0
            eras[row.table_name] = max(eras.get(row.table_name, 0), era)
            if row.own:
                if row.save > newest_save:
                    newest_save, newest_slot = row.save, int(row.slot)
                kind, here = (row.table_name, row.complete), (era, row.last_lsn, row.updated_at)
                rows[kind] = max(rows.get(kind, here), here)
    now = datetime.now()
    for name, lsn in positions.items():
        here = (eras.get(name, 0) + new_era, bytes(lsn), now)
        rows[name, complete] = max(rows.get((name, complete), here), here)
    frame = spark.createDataFrame(
        [
            (name, bytes(lsn), at, kind, era, newest_save + 1)
            for (name, kind), (era, lsn, at) in rows.items()
        ],
        STORE_SCHEMA,
    )
    leaf = f"{path}/query_id={query_id}/slot={(newest_slot + 1) % SLOTS}"
    frame.coalesce(1).write.mode("overwrite").parquet(leaf)


def complete_offsets(spark: SparkSession, path: str, query_id: str) -> None:
    """Declare that a query has published everything up to what it has seen.

    For a stream of files that has run to the end of its input and into whose folders no older
    changes come any more.
    """
    own = f"{path}/query_id={query_id}"
    seen = read_offsets(spark, own, complete=False).collect()  # one row per table
    save_offsets(spark, {r.table_name: bytes(r.last_lsn) for r in seen}, path, query_id)


def reset_offset(spark: SparkSession, path: str, table: str, lsn: bytes = ZERO_LSN) -> None:
    """Set one table's position, also back: the next feed reads from there again."""
    save_offsets(spark, {table: lsn}, path, "reset", new_era=True)


def compact_offsets(spark: SparkSession, path: str, target: str) -> None:
    """Write the present positions as a new store with a single leaf, and leave the old one: for
    a store that holds leaves of many past queries."""
    if path_exists(spark, target):
        raise ValueError(f"{target} is there already")
    for complete in (False, True):
        saved = read_offsets(spark, path, complete).collect()  # one row per table
        positions = {r.table_name: bytes(r.last_lsn) for r in saved}
        if positions:
            save_offsets(spark, positions, target, "compacted", complete)


def create_offsets_table(spark: SparkSession, table: str, using: str = "parquet") -> None:
    """The offsets as a catalog table, created if absent."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({OFFSETS_SCHEMA}) USING {using}")


def compact_offsets_table(spark: SparkSession, table: str) -> None:
    """One row per table in a catalog table to which saves have added rows. No feed may save
    meanwhile."""
    columns = [f.split()[0] for f in OFFSETS_SCHEMA.split(", ")]
    rows = merge_offsets(spark.table(table)).select(*columns).collect()  # one per table
    frame = spark.createDataFrame([tuple(row) for row in rows], OFFSETS_SCHEMA)
    frame.coalesce(1).write.insertInto(table, overwrite=True)


def merge_offsets_into(spark: SparkSession, table: str, positions: Mapping[str, bytes]) -> None:
    """Upsert into a catalog table whose format supports row-level operations."""
    spark.sql(
        f"MERGE INTO {table} AS saved USING {{new}} AS new ON saved.table_name = new.table_name "
        "WHEN MATCHED AND (saved.last_lsn IS NULL OR new.last_lsn > saved.last_lsn) THEN "
        "UPDATE SET last_lsn = new.last_lsn, updated_at = new.updated_at "
        "WHEN NOT MATCHED THEN INSERT (table_name, last_lsn, updated_at) "
        "VALUES (new.table_name, new.last_lsn, new.updated_at)",
        new=offsets_frame(spark, positions),
    )


def last_lsns(offsets: DataFrame | None, tables: Iterable[str]) -> dict[str, bytes]:
    """The saved LSN of each of ``tables``, zero where none is saved.

    The only rows a feed reads into the driver: at most one per name in ``tables``.
    """
    names = list(tables)
    positions = dict.fromkeys(names, ZERO_LSN)
    if offsets is None:
        return positions
    watched = offsets.filter(F.col("table_name").isin(names) & F.col("last_lsn").isNotNull())
    newest = watched.groupBy("table_name").agg(F.max("last_lsn").alias("last_lsn"))
    positions.update((row.table_name, bytes(row.last_lsn)) for row in newest.collect())
    return positions


def with_last_lsn(feed: DataFrame, offsets: DataFrame) -> DataFrame:
    """A feed that mixes tables, with the saved ``last_lsn`` of each row's table, or zero.

    For a few known tables, ``last_lsns`` and a literal filter per table are better, because a
    literal reaches the scan. Here the offsets are reduced to one row per table and joined. How,
    Spark decides by their size in bytes; if it shuffles, adaptive execution splits a table that
    is too large for one task.
    """
    saved = merge_offsets(offsets).select("table_name", "last_lsn")
    joined = feed.join(saved, "table_name", "left")
    return joined.withColumn("last_lsn", F.coalesce("last_lsn", lsn_literal(ZERO_LSN)))
