"""Following folders of change files whose columns change while the feed runs.

A stream of files has one schema, and a file that comes with another column would lose it, or show
a dropped one as null. So the stream carries only the log position and the file of each change. A
batch then reads its files by what their own footers say: the files of one table and one set of
columns are one change table, with exactly those columns in its records. Nothing is restarted.

What was found is kept as a ledger: each table's sets of columns, and the range of LSNs in which
each was in force. Positions are completed by the frontier of unread files.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidefeed.functions.lsn import lsn_number, lsn_of_number
from tidefeed.operators.changes import LSN, OPERATION, SEQVAL
from tidefeed.operators.envelope import fan_in
from tidefeed.plans.feed import change_feed
from tidefeed.sources.files import read_changes, stream_changes
from tidefeed.streaming.feed import Offsets, deliver, start_of
from tidefeed.streaming.frontier import Frontier
from tidefeed.streaming.sinks import Batch, Sink
from tidefeed.workspace import path_exists

METADATA = T.StructType(
    [
        T.StructField(LSN, T.BinaryType()),
        T.StructField(SEQVAL, T.BinaryType()),
        T.StructField(OPERATION, T.IntegerType()),
    ]
)
FOUND = "table_name STRING, columns ARRAY<STRUCT<name: STRING, type: STRING>>, lsn BINARY"
# Footers that the driver reads at a time.
FOOTERS = 16


def schema_ledger(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``table_name``, ``columns`` (name and type), ``from_lsn``, ``to_lsn``: the sets of columns a
    feed has found, and between which changes of its files each occurred."""
    folder = f"{checkpoint}/tidefeed-schemas"
    if not path_exists(spark, folder):
        found = spark.createDataFrame([], FOUND)
    else:
        found = spark.read.schema(FOUND).parquet(folder).select("table_name", "columns", "lsn")
    number = lsn_number("lsn")
    return (
        found.groupBy("table_name", "columns")
        .agg(F.min(number).alias("first"), F.max(number).alias("last"))
        .select(
            "table_name",
            "columns",
            lsn_of_number("first").alias("from_lsn"),
            lsn_of_number("last").alias("to_lsn"),
        )
    )


class _Files:
    """The files of a batch as change tables of one set of columns each."""

    def __init__(self, checkpoint: str, after: Mapping[str, bytes], file_format: str, options: dict):
        self.ledger, self.after = f"{checkpoint}/tidefeed-schemas", dict(after)
        self.file_format, self.options = file_format, options

    def feed(self, positions: DataFrame, batch_id: int) -> DataFrame | None:
        spark = positions.sparkSession
        number = lsn_number("lsn")
        files = (
            positions.groupBy("table_name", "source_file")
            .agg(F.min(number).alias("first"), F.max(number).alias("last"))
            .select(
                "table_name",
                "source_file",
                lsn_of_number("first").alias("first"),
                lsn_of_number("last").alias("last"),
            )
            .collect()  # the files of one batch, which its trigger bounds
        )
        if not files:
            return None

        def footer(file) -> T.StructType:
            return read_changes(spark, file.source_file, self.file_format).schema

        with ThreadPoolExecutor(FOOTERS) as pool:
            schemas = dict(zip((f.source_file for f in files), pool.map(footer, files), strict=True))

        def kind(file) -> tuple[str, str]:
            return file.table_name, schemas[file.source_file].json()

        feeds, found = [], []
        for (table, _), some in groupby(sorted(files, key=kind), key=kind):
            some = list(some)
            schema = schemas[some[0].source_file]
            changes = read_changes(
                spark, [f.source_file for f in some], self.file_format, schema, with_file=True
            )
            feeds.append(change_feed({table: changes}, self.after, **self.options))
            columns = [(f.name, f.dataType.simpleString()) for f in schema if f.name not in METADATA.names]
            found += [(table, columns, f.first) for f in some] + [(table, columns, f.last) for f in some]
        rows = spark.createDataFrame(found, FOUND).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.ledger}/batch={batch_id}")
        return fan_in(feeds)


def follow(
    spark: SparkSession,
    folders: Mapping[str, str],
    sink: Sink,
    checkpoint: str,
    offsets: str | Offsets | None = None,
    after: Mapping[str, bytes] | None = None,
    query_name: str | None = None,
    trigger: Mapping[str, object] | None = None,
    file_format: str = "parquet",
    max_files: int | None = None,
    max_bytes: str | None = None,
    **envelope_options,
) -> StreamingQuery:
    """Start a feed over folders of change files (one per table), whatever columns they come with.

    Files need the LSN and the operation; sequence values are optional. The rest is as for
    ``start_feed`` with ``folders``: a checkpoint starts at the complete positions of its first
    start, and positions are completed as far as no unread file has an older change.
    """
    eras = None
    if after is None:
        after, eras = start_of(spark, checkpoint, offsets, folders)
    # what tells whether a change is wanted at all
    plain = {k: v for k, v in envelope_options.items() if k == "before_image"}
    frontier = Frontier(
        f"{checkpoint}/tidefeed-files", folders, dict.fromkeys(folders, METADATA), after,
        file_format, **plain,
    )
    files = _Files(checkpoint, after, file_format, envelope_options)
    streams = {
        name: stream_changes(spark, folder, METADATA, file_format, max_files, max_bytes, with_file=True)
        for name, folder in folders.items()
    }
    positions = change_feed(streams, after, **plain)
    positions = positions.select("table_name", "lsn", "source_file")
    inner = deliver(_reads(files, sink), offsets, tuple(folders), frontier, eras, keep_files=True)
    writer = positions.writeStream.foreachBatch(inner).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def _reads(files: _Files, sink: Sink) -> Sink:
    def run(positions: DataFrame, batch: Batch) -> None:
        feed = files.feed(positions, batch.batch_id)
        if feed is not None:
            sink(feed.drop("source_file"), batch)

    return run
