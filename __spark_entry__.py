"""

Every query runs over whole tables. The change tables are derived from the test data by
``fixtures.py``; the saved positions say where each table's feed starts.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyarrow import fs as pa_fs  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.errors import StreamingQueryException  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import fixtures as fx  # noqa: E402
from tidefeed import (  # noqa: E402
    ConsolePrinter,
    Publisher,
    change_feed,
    follow,
    mixed_feed_since,
    poll,
    publish,
    read_once,
    sink,
    start_feed,
)
from tidefeed.functions import console_line, format_lsn, operation_type, payload_json  # noqa: E402
from tidefeed.operators import (  # noqa: E402
    LSN,
    OPERATION,
    OffsetLog,
    changes_since,
    complete_offsets,
    create_offsets_table,
    data_columns,
    envelopes,
    fan_in,
    last_lsns,
    live_progress,
    merge_offsets,
    offsets_frame,
    progress,
    read_offsets,
    retention_gaps,
    save_offsets,
    scan_changes,
    with_position,
    with_record,
)
from tidefeed.operators.changes import quoted  # noqa: E402
from tidefeed.sources import stream_changes  # noqa: E402
from tidefeed.streaming import (  # noqa: E402
    Batch,
    DeadLetters,
    LoggedOffsets,
    committed_positions,
)
from tidefeed.streaming.sinks import kafka_frame  # noqa: E402
from tidefeed.workspace import new_folder  # noqa: E402

ENVELOPE = ("table_name", "event_type", "message", "lsn")


def shown(feed: DataFrame, *columns: str) -> DataFrame:
    """The named columns, LSNs as text."""
    texts = {"lsn", "high_water", "last_lsn"}
    return feed.select(*[format_lsn(c).alias(c) if c in texts else F.col(c) for c in columns])


def saved_positions(spark: SparkSession, tables=fx.FEED_TABLES) -> dict[str, bytes]:
    return last_lsns(fx.saved_offsets(spark), tables)


# Scans, filters, projections


def scan_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = scan_changes(fx.change_table(spark, sf_dir, "events"))
    return changes.select(
        format_lsn(quoted(LSN)).alias("lsn"),
        quoted(OPERATION).alias("operation"),
        operation_type(quoted(OPERATION)).alias("operation_type"),
        "event_id",
    )


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The discovered columns, each with the number of changes that carry a value in it."""
    changes = fx.change_table(spark, sf_dir, "events")
    names = data_columns(changes)
    counted = changes.agg(*[F.count(quoted(name)).alias(name) for name in names])
    return counted.unpivot([], names, "column_name", "changes_with_value")


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = saved_positions(spark)["events"]
    newer = changes_since(fx.change_table(spark, sf_dir, "events"), after)
    return newer.select(format_lsn(quoted(LSN)).alias("lsn"), "event_id")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = with_record(fx.change_table(spark, sf_dir, "events"))
    return records.select("record.event_id", payload_json("record").alias("message"))


def before_image_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = fx.change_table(spark, sf_dir, "events")
    return shown(envelopes(changes, "events", before_image="drop"), *ENVELOPE)


def before_image_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = fx.change_table(spark, sf_dir, "events")
    return shown(envelopes(changes, "events", before_image="label"), *ENVELOPE)


# Envelopes and feeds


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = change_feed({"events": fx.change_table(spark, sf_dir, "events")}, fx.SAVED)
    return shown(feed, *ENVELOPE)


def lsn_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = fx.change_table(spark, sf_dir, "events")
    return changes.select(format_lsn(quoted(LSN)).alias("lsn")).distinct()


def feed_of(spark: SparkSession, sf_dir: str, tables=fx.FEED_TABLES) -> DataFrame:
    return change_feed(fx.change_tables(spark, sf_dir, tables), saved_positions(spark, tables))


def fan_in_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(feed_of(spark, sf_dir), *ENVELOPE)


def fan_in_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of all five derived tables, long texts and the largest table included."""
    return shown(feed_of(spark, sf_dir, tuple(fx.DERIVED)), *ENVELOPE)


def mixed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed from one frame that mixes all tables, and the offsets table."""
    tables = fx.change_tables(spark, sf_dir)
    everything = fan_in(envelopes(changes, name) for name, changes in tables.items())
    offsets = fx.saved_offsets(spark)
    return shown(mixed_feed_since(everything, offsets), *ENVELOPE)


def console_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_of(spark, sf_dir).select(console_line().alias("line"))


def ordered_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = feed_of(spark, sf_dir)
    rows = feed.select(
        "table_name",
        "lsn",
        "seqval",
        "operation",
        operation_type("operation").alias("operation_type"),
    )
    return shown(with_position(rows), "table_name", "position", "lsn", "operation_type")


# Positions


def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = progress(fx.change_tables(spark, sf_dir), saved_positions(spark))
    return shown(marks, "table_name", "high_water")


def changes_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = progress(fx.change_tables(spark, sf_dir), saved_positions(spark))
    return marks.select("table_name", "changes_found")


def offset_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = progress(fx.change_tables(spark, sf_dir), saved_positions(spark))
    reached = marks.select(
        "table_name", F.col("high_water").alias("last_lsn"), F.now().alias("updated_at")
    )
    return shown(merge_offsets(fx.saved_offsets(spark), reached), "table_name", "last_lsn")


# Continuous feeds, run to the end of their input


def middle(spark: SparkSession, sf_dir: str) -> dict[str, bytes]:
    """An LSN in the middle of each table's log."""
    marks = progress(fx.change_tables(spark, sf_dir)).collect()
    return {
        row.table_name: (int.from_bytes(row.high_water) // 2).to_bytes(10)
        for row in marks
    }


def arrives(spark: SparkSession, sf_dir: str, folder: str, newer: bool) -> None:
    """One of the two portions of every table's changes arrives in ``folder``."""
    for table, lsn in middle(spark, sf_dir).items():
        is_newer = quoted(LSN) > F.lit(lsn)
        changes = fx.change_table(spark, sf_dir, table)
        portion = changes.where(is_newer if newer else ~is_newer)
        portion.write.mode("append").parquet(f"{folder}/{table}")


def streamed(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a streaming feed that is stopped and started again on its checkpoint. The
    newer portion of the changes arrives before the first run, the older one before the second."""
    folder = new_folder(spark, "stream")
    for newer in (True, False):
        arrives(spark, sf_dir, f"{folder}/changes", newer)
        tables = {t: stream_changes(spark, f"{folder}/changes/{t}") for t in fx.FEED_TABLES}
        query = start_feed(
            tables,
            sink("parquet", path=f"{folder}/published"),
            f"{folder}/checkpoint",
            f"{folder}/offsets",
            after=fx.SAVED,
            trigger={"availableNow": True},
        )
        query.awaitTermination()
    complete_offsets(spark, f"{folder}/offsets", query.id)
    return folder


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(spark.read.parquet(f"{streamed(spark, sf_dir)}/published"), *ENVELOPE)


def stream_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions that the stream has completed when both portions are through."""
    saved = read_offsets(spark, f"{streamed(spark, sf_dir)}/offsets")
    return shown(saved, "table_name", "last_lsn")


def polled(spark: SparkSession, sf_dir: str, idle: bool = False) -> str:
    """The folder of two looks at the change tables, the second of which finds the newer half of
    each log; with ``idle`` a look that finds nothing new stands between."""
    folder = new_folder(spark, "polled")
    offsets = f"{folder}/offsets"
    save_offsets(spark, fx.SAVED, offsets, "start")
    half = middle(spark, sf_dir)
    looks = [half, half, None] if idle else [half, None]
    for batch_id, newest in enumerate(looks):
        tables = fx.change_tables(spark, sf_dir)
        published = sink("parquet", path=f"{folder}/published")
        poll(spark, tables, published, offsets, "looks", batch_id, newest)
    return folder


def poll_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(spark.read.parquet(f"{polled(spark, sf_dir)}/published"), *ENVELOPE)


def poll_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved = read_offsets(spark, f"{polled(spark, sf_dir)}/offsets")
    return shown(saved, "table_name", "last_lsn")


def offsets_after_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved = read_offsets(spark, f"{polled(spark, sf_dir, idle=True)}/offsets")
    return shown(saved, "table_name", "last_lsn")


def offsets_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table of offsets, created twice, that holds the position each table reached."""
    name = f"cdc_offsets_{uuid.uuid4().hex}"
    for _ in range(2):
        create_offsets_table(spark, name)
    try:
        marks = progress(fx.change_tables(spark, sf_dir), saved_positions(spark))
        reached = marks.select("table_name", F.col("high_water").alias("last_lsn"), F.now().alias("at"))
        reached.write.insertInto(name)
        found = last_lsns(spark.table(name), fx.FEED_TABLES)  # one per table
    finally:
        spark.sql(f"DROP TABLE {name}")
    return shown(offsets_frame(spark, found), "table_name", "last_lsn")


# Sinks


class ToFolder(Publisher):
    """Writes what it is given to a file of its own in a folder that all executors reach."""

    def __init__(self, folder: str):
        self.folder = folder

    def open(self, partition_id: int, epoch_id: int) -> bool:
        system, path = pa_fs.FileSystem.from_uri(self.folder)
        system.create_dir(path)
        self.file = system.open_output_stream(f"{path}/{partition_id}-{uuid.uuid4().hex}.json")
        return True

    def process(self, row) -> None:
        record = {name: getattr(row, name) for name in ENVELOPE[:3]} | {"lsn": row.lsn.hex()}
        record["line"] = ConsolePrinter.line(row)
        self.file.write(json.dumps(record).encode() + b"\n")

    def close(self, error: BaseException | None) -> None:
        self.file.close()


def handed_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "handed-over")
    publish(feed_of(spark, sf_dir), ToFolder(folder if ":" in folder else f"file://{folder}"))
    schema = ", ".join(f"{name} STRING" for name in (*ENVELOPE, "line"))
    return spark.read.schema(schema).json(folder)


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a user's publisher got."""
    got = handed_over(spark, sf_dir)
    return got.withColumn("lsn", F.concat(F.lit("0x"), F.upper("lsn"))).select(*ENVELOPE)


def console_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the console's publisher."""
    return handed_over(spark, sf_dir).select("line")


def bus_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = F.transform("headers", lambda h: F.concat_ws("=", h["key"], F.hex(h["value"])))
    records = kafka_frame(feed_of(spark, sf_dir), "table_name")
    return records.select("key", "value", F.array_join(headers, ";").alias("headers"))


class Stopped(Exception):
    """Ends a run that is to be resumed."""


def stream_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions that a stream of files completes by itself: after its first batch, which holds the
    newer portion of each log while the older one is unread, and when a second run has gone on
    from the store alone."""
    folder = new_folder(spark, "frontier")
    for newer in (True, False):
        arrives(spark, sf_dir, f"{folder}/changes", newer)
    folders = {table: f"{folder}/changes/{table}" for table in fx.FEED_TABLES}
    offsets = f"{folder}/offsets"
    save_offsets(spark, fx.SAVED, offsets, "start")
    publishes = sink("parquet", path=f"{folder}/published")

    def first_batch_only(feed: DataFrame, batch: Batch) -> None:
        if batch.batch_id > 0:
            raise Stopped
        publishes(feed, batch)

    found = []
    for run, (to, limit) in enumerate([(first_batch_only, 1), (publishes, None)]):
        tables = {
            table: stream_changes(spark, path, max_files=limit, with_file=True)
            for table, path in folders.items()
        }
        query = start_feed(
            tables, to, f"{folder}/checkpoint-{run}", offsets,
            trigger={"availableNow": True}, folders=folders,
        )
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if to is publishes:
                raise
        found.append(last_lsns(read_offsets(spark, offsets), folders))
    marks = [offsets_frame(spark, positions) for positions in found]
    first, last = (frame.select("table_name", format_lsn("last_lsn").alias(name))
                   for frame, name in zip(marks, ("after_first_batch", "at_the_end")))
    told = spark.read.parquet(f"{folder}/published")
    told = told.groupBy("table_name").agg(F.countDistinct("lsn", "seqval").alias("published"))
    return first.join(last, "table_name").join(told, "table_name")


def offsets_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one query that save by turns, a reset between, and what the run saves that
    began before it."""
    offsets = LoggedOffsets(new_folder(spark, "log"))
    half, whole = middle(spark, sf_dir), progress(fx.change_tables(spark, sf_dir)).collect()
    newest = {row.table_name: bytes(row.high_water) for row in whole}
    one = other = offsets.eras(spark)
    offsets.save(spark, {t: half[t] for t in ("events", "orders")}, "q", True, one)
    offsets.save(spark, {"customer": newest["customer"], "events": newest["events"]}, "q", True, other)
    offsets.save(spark, {"events": half["events"]}, "q", True, one)
    offsets.log.reset(spark, "orders", fx.SAVED["orders"])
    offsets.save(spark, newest, "q", True, one)
    return shown(offsets.read(spark), "table_name", "last_lsn")


def gap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer half of each log is all that retention has left."""
    tables = {}
    for table, lsn in middle(spark, sf_dir).items():
        changes = fx.change_table(spark, sf_dir, table)
        tables[table] = changes.where(quoted(LSN) > F.lit(lsn))
    gaps = retention_gaps(tables, fx.SAVED)
    return gaps.select(
        "table_name", format_lsn("saved").alias("saved"), format_lsn("oldest").alias("oldest"), "gap"
    )


class RefusesSome(ToFolder):
    """Takes no message whose sequence value ends in a zero."""

    def process(self, row) -> None:
        if row.seqval[-1] == 0:
            raise ValueError("refused")
        super().process(row)


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a publisher got, and what it refused."""
    folder = new_folder(spark, "letters")
    letters = DeadLetters(f"{folder}/dead", tries=2, most=1_000_000, wait=0)
    to = f"{folder}/got"
    publisher = RefusesSome(to if ":" in to else f"file://{to}")
    publish(feed_of(spark, sf_dir), publisher, dead_letters=letters)
    schema = ", ".join(f"{name} STRING" for name in ENVELOPE)
    got = spark.read.schema(schema).json(to)
    got = got.withColumns({"lsn": F.concat(F.lit("0x"), F.upper("lsn")), "error": F.lit("")})
    dead = shown(letters.read(spark), *ENVELOPE, "error")
    return got.unionByName(dead)


#: Columns that the newer half of the events has and the older one has not, and the other way.
ADDED, DROPPED = "props", "value"


def schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose table gains a column and loses another while it runs."""
    folder = new_folder(spark, "follow")
    half = middle(spark, sf_dir)["events"]
    changes = fx.change_table(spark, sf_dir, "events")
    for newer in (False, True):
        portion = changes.where((quoted(LSN) > F.lit(half)) == F.lit(newer))
        portion = portion.drop(DROPPED if newer else ADDED)
        portion.write.mode("append").parquet(f"{folder}/events")
    query = follow(
        spark, {"events": f"{folder}/events"}, sink("parquet", path=f"{folder}/published"),
        f"{folder}/checkpoint", f"{folder}/offsets", after=fx.SAVED,
        trigger={"availableNow": True}, max_files=1,
    )
    query.awaitTermination()
    return shown(spark.read.parquet(f"{folder}/published"), *ENVELOPE)


def replay_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader has of messages that were published once, in part, and then whole again."""
    folder = new_folder(spark, "once")
    feed, half = feed_of(spark, sf_dir), middle(spark, sf_dir)
    log = OffsetLog(f"{folder}/log")
    log.save(spark, fx.SAVED)
    columns = [*ENVELOPE, "seqval", "operation"]

    def read() -> None:
        reader = spark.readStream.schema(feed.select(*columns).schema)
        reader = reader.parquet(f"{folder}/messages")
        query = read_once(reader, committed_positions(spark, log.path), buckets=4).writeStream
        query = query.option("checkpointLocation", f"{folder}/checkpoint")
        query.trigger(availableNow=True).start(f"{folder}/read").awaitTermination()

    part = feed.where((F.col("table_name") != "customer") & (F.col("seqval") < F.lit(half["events"])))
    for messages, reached in ((part, None), (feed, middle(spark, sf_dir)), (part, None)):
        messages.select(*columns).write.mode("append").parquet(f"{folder}/messages")
        read()
        if reached:
            log.save(spark, {"customer": reached["customer"]})
    return shown(spark.read.parquet(f"{folder}/read"), *ENVELOPE)


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a streaming query over the feed says last of each table."""
    folder = new_folder(spark, "live")
    for newer in (True, False):
        arrives(spark, sf_dir, f"{folder}/changes", newer)
    tables = {t: stream_changes(spark, f"{folder}/changes/{t}", max_files=1) for t in fx.FEED_TABLES}
    marks = live_progress(change_feed(tables, fx.SAVED), fx.SAVED)

    def keep(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/marks/batch={batch_id}")

    query = marks.writeStream.outputMode("update").foreachBatch(keep)
    query = query.option("checkpointLocation", f"{folder}/checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()
    said = spark.read.parquet(f"{folder}/marks").groupBy("table_name")
    last = said.agg(F.max_by(F.struct("high_water", "changes", "behind"), "batch").alias("last"))
    last = last.select("table_name", "last.*")
    return last.select(
        "table_name", format_lsn("high_water").alias("high_water"), "changes",
        F.col("behind").cast("long").alias("behind"),
    )


def entry(spark: SparkSession) -> DataFrame:
    """The flagship: every table's new changes as one feed of JSON envelopes."""
    return fan_in_feed(spark, "/root/testdata/sf0.001")


def llm_modules() -> tuple:
    """The modules that add queries for training text; none where they have been left out."""
    try:
        import corpus_pipeline
        from tidefeed.llm import queries as llm
    except ImportError as missing:
        if (missing.name or "") in ("corpus_pipeline", "tidefeed.llm"):
            return ()
        raise
    return (llm, corpus_pipeline)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    added: dict = {}
    for module in llm_modules():
        added |= module.queries()
    return feed_queries() | added


def oracle_sql() -> dict[str, str]:
    added: dict = {}
    for module in llm_modules():
        added |= module.oracle_sql()
    return feed_oracle_sql() | added


def feed_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "cdc_scan_decode": scan_decode,
        "cdc_columns": columns,
        "cdc_incremental": incremental,
        "cdc_payload_json": payloads,
        "cdc_before_image_drop": before_image_drop,
        "cdc_before_image_label": before_image_label,
        "cdc_envelope": envelope,
        "cdc_lsn_format": lsn_format,
        "cdc_fan_in": fan_in_feed,
        "cdc_fan_in_all": fan_in_all,
        "cdc_mixed_feed": mixed_feed,
        "cdc_console_line": console_lines,
        "cdc_ordered_feed": ordered_feed,
        "cdc_high_water": high_water,
        "cdc_changes_found": changes_found,
        "cdc_offset_upsert": offset_upsert,
        "cdc_stream_resume": stream_resume,
        "cdc_poll_resume": poll_resume,
        "cdc_poll_offsets": poll_offsets,
        "cdc_stream_offsets": stream_offsets,
        "cdc_offsets_after_idle": offsets_after_idle,
        "cdc_offsets_create": offsets_create,
        "cdc_publish": published,
        "cdc_console_sink": console_sink,
        "cdc_bus_records": bus_records,
        "cdc_stream_frontier": stream_frontier,
        "cdc_offsets_log": offsets_log,
        "cdc_gap_check": gap_check,
        "cdc_dead_letters": dead_letters,
        "cdc_schema_change": schema_change,
        "cdc_replay_once": replay_once,
        "cdc_live_progress": live,
    }


def feed_oracle_sql() -> dict[str, str]:
    events = fx.changes_sql("events")
    feed = fx.feed_sql()
    envelope_columns = ", ".join(ENVELOPE)
    names = fx.DERIVED["events"].columns
    label = (
        "CASE operation WHEN 2 THEN 'Insert' WHEN 4 THEN 'Update' "
        "WHEN 3 THEN 'UpdateBefore' ELSE 'Delete' END"
    )
    new = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, max(lsn) AS newest, "
        f"'0x{fx.SAVED.get(table, bytes(10)).hex().upper()}' AS saved "
        f"FROM ({fx.changes_sql(table)})"
        for table in fx.FEED_TABLES
    )
    reached = f"SELECT table_name, greatest(coalesce(newest, saved), saved) AS lsn FROM ({new})"
    whole = f"SELECT {envelope_columns} FROM ({feed})"
    saved = "CASE table_name WHEN 'events' THEN '{}' WHEN 'orders' THEN '{}' ELSE '{}' END".format(
        *("0x" + fx.SAVED.get(t, bytes(10)).hex().upper() for t in fx.FEED_TABLES)
    )
    logs = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, lsn FROM ({fx.changes_sql(table)})" for table in fx.FEED_TABLES
    )
    return {
        "cdc_scan_decode": (
            f"SELECT lsn, operation, {fx.OPERATION_TYPE_SQL} AS operation_type, event_id "
            f"FROM ({events})"
        ),
        "cdc_columns": " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, count({name}) AS changes_with_value FROM events"
            for name in names
        ),
        "cdc_incremental": (
            f"SELECT lsn, event_id FROM ({events}) WHERE lsn > '0x00000000000000000064'"
        ),
        "cdc_payload_json": (
            f"SELECT event_id, {fx.message_sql('events')} AS message FROM ({events})"
        ),
        "cdc_before_image_drop": (
            "SELECT 'events' AS table_name, 'ChangeDetected' AS event_type, "
            f"{fx.message_sql('events')} AS message, lsn FROM ({events}) WHERE operation <> 3"
        ),
        "cdc_before_image_label": (
            "SELECT 'events' AS table_name, 'ChangeDetected' AS event_type, "
            f"{fx.message_sql('events', label)} AS message, lsn FROM ({events})"
        ),
        "cdc_envelope": f"SELECT {envelope_columns} FROM ({fx.envelopes_sql('events')})",
        "cdc_lsn_format": f"SELECT DISTINCT lsn FROM ({events})",
        "cdc_fan_in": whole,
        "cdc_fan_in_all": f"SELECT {envelope_columns} FROM ({fx.feed_sql(tuple(fx.DERIVED))})",
        "cdc_mixed_feed": whole,
        "cdc_console_line": (
            f"SELECT '[' || event_type || '] ' || table_name || ': ' || message AS line "
            f"FROM ({feed})"
        ),
        "cdc_ordered_feed": (
            "SELECT table_name, row_number() OVER (PARTITION BY table_name "
            "ORDER BY lsn, seqval, operation) AS position, lsn, "
            f"{fx.OPERATION_TYPE_SQL} AS operation_type FROM ({feed})"
        ),
        "cdc_high_water": f"SELECT table_name, lsn AS high_water FROM ({reached})",
        "cdc_changes_found": (
            f"SELECT table_name, coalesce(newest > saved, false) AS changes_found FROM ({new})"
        ),
        "cdc_offset_upsert": f"SELECT table_name, lsn AS last_lsn FROM ({reached})",
        "cdc_stream_resume": whole,
        "cdc_poll_resume": whole,
        "cdc_poll_offsets": f"SELECT table_name, lsn AS last_lsn FROM ({reached})",
        "cdc_stream_offsets": f"SELECT table_name, newest AS last_lsn FROM ({new})",
        "cdc_offsets_after_idle": f"SELECT table_name, lsn AS last_lsn FROM ({reached})",
        "cdc_offsets_create": f"SELECT table_name, lsn AS last_lsn FROM ({reached})",
        "cdc_publish": whole,
        "cdc_console_sink": (
            "SELECT 'ConsolePublisher: [' || event_type || '] ' || table_name || ': ' || message "
            f"AS line FROM ({feed})"
        ),
        "cdc_bus_records": (
            "SELECT table_name AS key, message AS value, concat_ws(';', "
            "'table_name=' || hex(table_name), 'event_type=' || hex(event_type), "
            "'lsn=' || lsn[3:], 'seqval=' || seqval[3:], "
            f"'operation=' || hex(CAST(operation AS VARCHAR))) AS headers FROM ({feed})"
        ),
        # the unread files begin right after the saved positions: nothing is complete past those
        "cdc_stream_frontier": (
            f"SELECT table_name, {saved} AS after_first_batch, newest AS at_the_end, published "
            f"FROM ({new}) JOIN (SELECT table_name, count(DISTINCT lsn || seqval) AS published "
            f"FROM ({feed}) GROUP BY table_name) USING (table_name)"
        ),
        "cdc_offsets_log": (
            f"SELECT table_name, CASE table_name WHEN 'orders' THEN {saved} ELSE newest END "
            f"AS last_lsn FROM ({new})"
        ),
        "cdc_gap_check": (
            f"SELECT table_name, {saved} AS saved, oldest, "
            f"table_name <> 'customer' AND oldest > {saved} AS gap FROM ("
            "SELECT table_name, min(lsn) AS oldest FROM (SELECT table_name, lsn, "
            "max(lsn) OVER (PARTITION BY table_name) AS newest "
            f"FROM ({logs})) WHERE CAST(lsn AS BIGINT) > CAST(newest AS BIGINT) // 2 "
            "GROUP BY table_name)"
        ),
        "cdc_dead_letters": (
            f"SELECT {envelope_columns}, CASE WHEN seqval LIKE '%00' THEN 'ValueError: refused' ELSE '' END "
            f"AS error FROM ({feed})"
        ),
        "cdc_schema_change": " UNION ALL ".join(
            "SELECT 'events' AS table_name, 'ChangeDetected' AS event_type, "
            f"{fx.message_sql('events', without=without)} AS message, lsn FROM (SELECT *, "
            f"CAST(max(lsn) OVER () AS BIGINT) // 2 AS half FROM ({events})) "
            f"WHERE lsn > '0x00000000000000000064' AND CAST(lsn AS BIGINT) {than} half"
            for without, than in ((ADDED, "<="), (DROPPED, ">"))
        ),
        "cdc_replay_once": whole,
        "cdc_live_progress": (
            "SELECT table_name, max(lsn) AS high_water, count(*) AS changes, "
            f"CAST(max(lsn) AS BIGINT) - CAST({saved} AS BIGINT) AS behind FROM ({feed}) "
            "GROUP BY table_name"
        ),
    }
