"""How far a stream of files is complete: up to the smallest LSN of any file it has not read.

Files of a folder need not be read in log order, so the newest LSN that a stream has published
says nothing about older ones. What does is the frontier: the smallest wanted LSN of every file
that is there and has not been read. Below it everything has been published.

Beside the checkpoint, each batch leaves the files it has read with their newest LSN, and the
smallest LSN of each file that it found unread, so a file's LSN column is scanned once for it. A
repeated batch writes its own part again.

A file that comes late, with changes older than the position, takes the position back until it has
been read: a feed that starts from the store then reads it. A file that the stream never reads
(one that is older than its ``maxFileAge``) holds the position where it is.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidefeed.functions.lsn import ZERO_LSN, lsn_number, lsn_of_number
from tidefeed.plans.feed import change_feed
from tidefeed.sources.files import read_changes
from tidefeed.workspace import path_exists

READ = "table_name STRING, source_file STRING, newest BINARY"
FIRST = "table_name STRING, source_file STRING, first BINARY"
REACHED = "table_name STRING, last_lsn BINARY"


def lsn_before(lsn: bytes) -> bytes:
    """The greatest LSN that is smaller."""
    return max(0, int.from_bytes(lsn) - 1).to_bytes(len(lsn))


class Frontier:
    """The files of a query's folders, by table, in a ledger at ``path``."""

    def __init__(
        self,
        path: str,
        folders: Mapping[str, str],
        schemas: Mapping[str, StructType],
        after: Mapping[str, bytes],
        file_format: str = "parquet",
        **envelope_options,
    ):
        missing = set(schemas) - set(folders)
        if missing:
            raise ValueError(f"no folder is given for {sorted(missing)}")
        self.path, self.folders, self.schemas = path, dict(folders), dict(schemas)
        self.after, self.file_format = dict(after), file_format
        self.envelope_options = envelope_options

    def positions(self, feed: DataFrame, batch_id: int) -> dict[str, bytes]:
        """Up to where each table is complete once the batch ``feed`` has been published."""
        spark = feed.sparkSession
        read = (
            feed.where("lsn IS NOT NULL")
            .groupBy("table_name", "source_file")
            .agg(F.max(lsn_number("lsn")).alias("number"))
            .select("table_name", "source_file", lsn_of_number("number").alias("newest"))
        )
        read.write.mode("overwrite").parquet(f"{self.path}/read/batch={batch_id}")
        read = self._ledger(spark, "read", READ)
        there = self._there(spark)
        unread = there.join(read, ["table_name", "source_file"], "left_anti")
        self._look_at(unread, batch_id)
        first = self._ledger(spark, "first", FIRST)
        ahead = unread.join(first, ["table_name", "source_file"]).where("first IS NOT NULL")
        number = lsn_number("lsn")
        marks = (
            read.select("table_name", F.col("newest").alias("lsn"), F.lit(True).alias("is_read"))
            .unionByName(ahead.select("table_name", F.col("first").alias("lsn"), F.lit(False).alias("is_read")))
            .groupBy("table_name")
            .agg(
                F.max(F.when(F.col("is_read"), number)).alias("newest"),
                F.min(F.when(~F.col("is_read"), number)).alias("frontier"),
            )
            .select(
                "table_name",
                lsn_of_number("newest").alias("newest"),
                lsn_of_number("frontier").alias("frontier"),
            )
        )
        found = {}
        for row in marks.collect():  # one per table
            if row.newest is None:
                continue
            lsn = bytes(row.newest)
            if row.frontier is not None:
                lsn = min(lsn, lsn_before(bytes(row.frontier)))
            found[row.table_name] = max(lsn, self.after.get(row.table_name, ZERO_LSN))
        rows = spark.createDataFrame(list(found.items()), REACHED)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/reached/batch={batch_id}")
        return found

    def before(self, spark: SparkSession, batch_id: int) -> dict[str, bytes]:
        """Up to where each table was complete before this batch."""
        folder = f"{self.path}/reached"
        if not path_exists(spark, folder):
            return {}
        reached = spark.read.schema(REACHED + ", batch LONG").parquet(folder)
        last = reached.where(F.col("batch") < batch_id).groupBy("table_name").agg(
            F.max_by("last_lsn", "batch").alias("last_lsn")
        )
        return {row.table_name: bytes(row.last_lsn) for row in last.collect()}  # one per table

    def _ledger(self, spark: SparkSession, part: str, schema: str) -> DataFrame:
        folder = f"{self.path}/{part}"
        if not path_exists(spark, folder):
            return spark.createDataFrame([], schema)
        names = [name.split()[0] for name in schema.split(", ")]
        return spark.read.schema(schema).parquet(folder).select(*names).distinct()

    def _there(self, spark: SparkSession) -> DataFrame:
        """Every file of every folder, by listing alone."""
        files = [
            spark.read.format("binaryFile")
            .load(folder)
            .select(F.lit(name).alias("table_name"), F.col("_metadata.file_path").alias("source_file"))
            for name, folder in self.folders.items()
        ]
        return reduce(DataFrame.unionByName, files)

    def _look_at(self, unread: DataFrame, batch_id: int) -> None:
        """The smallest wanted LSN of the unread files that were not looked at before. The driver
        holds their names, as the stream itself does for the files it has found."""
        spark = unread.sparkSession
        first = self._ledger(spark, "first", FIRST)
        new: dict[str, list[str]] = {}
        for row in unread.join(first, ["table_name", "source_file"], "left_anti").collect():
            new.setdefault(row.table_name, []).append(row.source_file)
        if not new:
            return
        tables = {
            name: read_changes(spark, files, self.file_format, self.schemas[name], with_file=True)
            for name, files in new.items()
        }
        feed = change_feed(tables, self.after, **self.envelope_options)
        found = feed.groupBy("table_name", "source_file").agg(F.min(lsn_number("lsn")).alias("number"))
        found = found.select("table_name", "source_file", lsn_of_number("number").alias("first"))
        # a file without wanted changes is known too, without an LSN
        named = [(name, file) for name, files in new.items() for file in files]
        named = spark.createDataFrame(named, "table_name STRING, source_file STRING")
        found = named.join(found, ["table_name", "source_file"], "left")
        found.write.mode("overwrite").parquet(f"{self.path}/first/batch={batch_id}")
