"""Running a feed: publish a batch, then save how far it reached.

The positions are saved after the sink has taken the whole batch and before Spark marks the
batch done. A failure at any point repeats the batch, so delivery is at least once, and a
repeated message is recognised by ``(table_name, lsn, seqval, operation)``.

Positions are kept in a store folder, or wherever an ``Offsets`` of the user's keeps them.
"""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Callable, Mapping
from inspect import signature

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidefeed.functions.lsn import ZERO_LSN
from tidefeed.operators.changes import SOURCE_FILE
from tidefeed.operators.gaps import RetentionGap, guard_gaps
from tidefeed.operators.offset_log import OffsetLog
from tidefeed.operators.offsets import (
    last_lsns,
    merge_offsets,
    merge_offsets_into,
    offsets_frame,
    read_offsets,
    save_offsets,
)
from tidefeed.operators.progress import feed_high_water, progress
from tidefeed.plans.feed import change_feed
from tidefeed.streaming.frontier import Frontier
from tidefeed.streaming.sinks import Batch, Sink
from tidefeed.workspace import path_exists

log = logging.getLogger(__name__)

# Set by Spark for the thread that runs a micro-batch; the id outlives restarts.
QUERY_ID = "sql.streaming.queryId"


class Offsets:
    """Where a feed keeps its positions: a store folder, in which each query has its own leaves."""

    def __init__(self, path: str):
        self.path = path

    def read(self, spark: SparkSession) -> DataFrame:
        """Rows of table_name, last_lsn, updated_at that are complete."""
        return read_offsets(spark, self.path)

    def eras(self, spark: SparkSession) -> dict[str, int] | None:
        """The era of each table, for a store that refuses what is saved in one that is over."""
        return None

    def save(
        self,
        spark: SparkSession,
        positions: Mapping[str, bytes],
        query_id: str,
        complete: bool,
        eras: Mapping[str, int] | None = None,
    ) -> None:
        save_offsets(spark, positions, self.path, query_id, complete)

    def take_back(
        self, spark: SparkSession, positions: Mapping[str, bytes], query_id: str
    ) -> None:
        """Positions that are lower than those saved before, because older changes came late."""
        save_offsets(spark, positions, self.path, query_id, True, new_era=True)


class LoggedOffsets(Offsets):
    """A log of numbered commits (``OffsetLog``): for stores that several runs write, also of one
    query. A run that started before a reset does not undo it."""

    def __init__(self, path: str):
        super().__init__(path)
        self.log = OffsetLog(path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.log.read(spark)

    def eras(self, spark: SparkSession) -> dict[str, int]:
        return self.log.eras(spark)

    def save(
        self,
        spark: SparkSession,
        positions: Mapping[str, bytes],
        query_id: str,
        complete: bool,
        eras: Mapping[str, int] | None = None,
    ) -> None:
        self.log.save(spark, positions, complete, eras)

    def take_back(
        self, spark: SparkSession, positions: Mapping[str, bytes], query_id: str
    ) -> None:
        for table, lsn in positions.items():
            self.log.reset(spark, table, lsn)


class CatalogOffsets(Offsets):
    """A catalog table of ``create_offsets_table``. It keeps complete positions; what a stream has
    only seen is not for other feeds to read.

    With ``merge`` its format has row-level operations. Without, as for plain parquet, a save adds
    rows and a table's newest row counts; then one run at a time writes it, positions never go
    back, and ``compact_offsets_table`` takes out the older rows now and then.
    """

    def __init__(self, path: str, merge: bool = True):
        super().__init__(path)
        self.merge = merge

    def read(self, spark: SparkSession) -> DataFrame:
        return merge_offsets(spark.table(self.path))

    def save(
        self,
        spark: SparkSession,
        positions: Mapping[str, bytes],
        query_id: str,
        complete: bool,
        eras: Mapping[str, int] | None = None,
    ) -> None:
        if not complete or not positions:
            return
        if self.merge:
            merge_offsets_into(spark, self.path, positions)
        else:
            offsets_frame(spark, positions).coalesce(1).write.insertInto(self.path)

    def take_back(
        self, spark: SparkSession, positions: Mapping[str, bytes], query_id: str
    ) -> None:
        raise ValueError(f"positions in {self.path} cannot go back; reset {sorted(positions)} there")


def _offsets(offsets: str | Offsets) -> Offsets:
    return Offsets(offsets) if isinstance(offsets, str) else offsets


def _save(
    store: Offsets,
    spark: SparkSession,
    positions: Mapping[str, bytes],
    query_id: str,
    complete: bool,
    eras: Mapping[str, int] | None,
) -> None:
    """A save; only stores that tell eras are given any."""
    told = () if eras is None else (eras,)
    store.save(spark, positions, query_id, complete, *told)


def deliver(
    sink: Sink,
    offsets: str | Offsets | None = None,
    tables: tuple[str, ...] = (),
    frontier: Frontier | None = None,
    eras: Mapping[str, int] | None = None,
    keep_files: bool = False,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the sink, then the positions.

    A stream takes files in the order they come in, so what the batch has seen is not complete.
    With a ``frontier`` of its files, complete positions are saved too. The sink does not see the
    files, unless ``keep_files``.
    """
    known = dict(eras) if eras is not None else None

    def run(feed: DataFrame, batch_id: int) -> None:
        spark = feed.sparkSession
        query_id = spark.sparkContext.getLocalProperty(QUERY_ID)
        if frontier is not None:
            shown = feed if keep_files else feed.drop("source_file")
            sink(shown, Batch(query_id, batch_id))
            reached = frontier.positions(feed, batch_id)
            if offsets is None or not reached:
                return
            store, last = _offsets(offsets), frontier.before(spark, batch_id)
            back = {t: lsn for t, lsn in reached.items() if lsn < last.get(t, lsn)}
            if back:
                store.take_back(spark, back, query_id)
                if known is not None:
                    known.update({table: known.get(table, 0) + 1 for table in back})
            _save(store, spark, reached, query_id, True, known)
            return
        batch = Batch(query_id, batch_id, tables)
        newest = sink(feed.drop("source_file"), batch)
        if offsets is None:
            return
        if newest is None:
            marks = feed_high_water(feed, tables).filter("high_water IS NOT NULL").collect()
            newest = {row.table_name: bytes(row.high_water) for row in marks}
        if newest:
            _save(_offsets(offsets), spark, newest, batch.query_id, False, known)

    return run


# Where a checkpoint started: a row for each table.
START_SCHEMA = "table_name STRING, last_lsn BINARY, updated_at TIMESTAMP, era INT"


def start_of(
    spark: SparkSession, checkpoint: str, offsets: str | Offsets | None, tables: Mapping
) -> tuple[dict[str, bytes], dict[str, int] | None]:
    """Where a checkpoint starts, and the eras it started in: at the complete positions of its
    first start, written beside it, because a later start must filter alike.

    The marker is one file with a row for each table, which is there whole or not at all. One
    without rows was left by a start that failed; no batch can have run on it.
    """
    path = f"{checkpoint}/tidefeed-start"
    there = path_exists(spark, path)
    marks = spark.read.schema(START_SCHEMA).parquet(path).collect() if there else []
    if not marks:
        begun = not there and path_exists(spark, f"{checkpoint}/metadata")
        store = _offsets(offsets) if offsets is not None and not begun else None
        eras = (store.eras(spark) if store else None) or {}
        positions = last_lsns(store.read(spark) if store else None, tables)
        rows = offsets_frame(spark, positions).collect()
        marked = [(*row, eras.get(row.table_name, 0)) for row in rows]
        frame = spark.createDataFrame(marked, START_SCHEMA).coalesce(1)
        frame.write.mode("overwrite").parquet(path)
        marks = frame.collect()
    positions = dict.fromkeys(tables, ZERO_LSN)
    positions |= {m.table_name: bytes(m.last_lsn) for m in marks if m.table_name in positions}
    eras = None
    if offsets is not None and _offsets(offsets).eras(spark) is not None:
        eras = {m.table_name: m.era or 0 for m in marks}
    return positions, eras


def start_feed(
    tables: Mapping[str, DataFrame],
    sink: Sink,
    checkpoint: str,
    offsets: str | Offsets | None = None,
    after: Mapping[str, bytes] | None = None,
    query_name: str | None = None,
    trigger: Mapping[str, object] | None = None,
    folders: Mapping[str, str] | None = None,
    file_format: str = "parquet",
    **envelope_options,
) -> StreamingQuery:
    """Start a streaming feed over streaming change tables.

    The checkpoint is the position. A new checkpoint starts at the complete positions saved in
    ``offsets``, or at ``after`` where that is given, and starts there every time: a moving LSN
    filter would lose rows, because files need not arrive in log order. For the same reason what
    a stream saves is what it has seen; ``complete_offsets`` turns that into positions to read on
    from, once the stream has read all there is.

    With ``folders``, where each table's files are, the stream completes positions by itself, as
    far as no unread file has an older change (``Frontier``). Its tables come from
    ``stream_changes`` with ``with_file``. ``trigger`` holds the arguments of
    ``DataStreamWriter.trigger``, such as ``{"processingTime": "5 seconds"}`` (the default) or
    ``{"availableNow": True}``.
    """
    spark = next(iter(tables.values())).sparkSession
    eras = None
    if after is None:
        after, eras = start_of(spark, checkpoint, offsets, tables)
    frontier = None
    if folders is not None:
        lacking = [name for name, changes in tables.items() if SOURCE_FILE not in changes.columns]
        if lacking:
            raise ValueError(f"the changes of {sorted(lacking)} do not tell their files")
        schemas = {
            name: T.StructType([f for f in changes.schema if f.name != SOURCE_FILE])
            for name, changes in tables.items()
        }
        frontier = Frontier(
            f"{checkpoint}/tidefeed-files", folders, schemas, after, file_format, **envelope_options
        )
    feed = change_feed(tables, after, **envelope_options)
    run = deliver(sink, offsets, tuple(tables), frontier, eras)
    writer = feed.writeStream.foreachBatch(run)
    writer = writer.option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def poll(
    spark: SparkSession,
    tables: Mapping[str, DataFrame] | Callable[[Mapping[str, bytes]], Mapping[str, DataFrame]],
    sink: Sink,
    offsets: str | Offsets,
    query_id: str,
    batch_id: int,
    newest: Mapping[str, bytes | None] | None = None,
    on_gap: str = "ignore",
    oldest: Mapping[str, bytes | None] | None = None,
    **envelope_options,
) -> dict[str, bytes]:
    """One look at batch change tables: publish what is newer than the saved positions, then
    save the new ones. Returns the new positions, of the tables that had changes.

    The newest LSNs are read first, as upper ends, so that rows which arrive meanwhile wait for
    the next look and are not skipped. They come from the LSN columns, or are given as
    ``newest`` where the source can tell, as ``jdbc_newest`` does. Both reads push the LSN range
    into the scan. ``tables`` may be a function of the saved positions (a mapping that gives zero
    for unknown tables), for sources that are cut into slices from there on.

    With ``on_gap="fail"`` a table whose oldest change is past its saved position stops the look
    with ``RetentionGap`` before anything is published, and with ``"warn"`` it is logged; the
    tables must then be whole ones, or ``oldest`` must be given.
    """
    if on_gap not in ("ignore", "warn", "fail"):
        raise ValueError(f"on_gap is ignore, warn or fail, not {on_gap!r}")
    store = _offsets(offsets)
    eras = store.eras(spark)
    if callable(tables):
        known = {row.table_name: bytes(row.last_lsn) for row in store.read(spark).collect()}
        tables = tables(defaultdict(lambda: ZERO_LSN, known))
    saved = last_lsns(store.read(spark), tables)
    if on_gap != "ignore":
        try:
            guard_gaps(tables, saved, oldest)
        except RetentionGap as gap:
            if on_gap == "fail":
                raise
            log.warning("%s", gap)
    if newest is None:
        marks = progress(tables, saved).collect()  # one per table
        newest = {row.table_name: bytes(row.high_water) for row in marks}
    reached = {name: lsn for name, lsn in newest.items() if lsn and lsn > saved[name]}
    if not reached:
        return {}
    fresh = {name: tables[name] for name in reached}
    feed = change_feed(fresh, saved, reached, **envelope_options)
    sink(feed, Batch(query_id, batch_id))
    _save(store, spark, reached, query_id, True, eras)
    return reached


def start_polling(
    spark: SparkSession,
    tables: Callable[..., Mapping[str, DataFrame]],
    sink: Sink,
    offsets: str | Offsets,
    checkpoint: str,
    interval: str = "5 seconds",
    query_name: str | None = None,
    newest: Callable[[], Mapping[str, bytes | None]] | None = None,
    on_gap: str = "ignore",
    oldest: Callable[[], Mapping[str, bytes | None]] | None = None,
    **envelope_options,
) -> StreamingQuery:
    """``poll`` every ``interval``, for sources that Spark reads but does not stream, such as a
    database table. ``tables`` is called for each look, so new files and columns are seen, and
    so are ``newest`` and ``oldest`` if given. If ``tables`` takes an argument, it gets the saved positions.

    A one-row-per-second stream only supplies the beat and the batch ids.
    """

    def look(beat: DataFrame, batch_id: int) -> None:
        query_id = beat.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        reached = None if newest is None else newest()
        found = tables if signature(tables).parameters else tables()
        left = None if oldest is None else oldest()
        poll(
            spark, found, sink, offsets, query_id, batch_id, reached, on_gap, left,
            **envelope_options,
        )

    beat = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    writer = beat.writeStream.foreachBatch(look).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.trigger(processingTime=interval).start()
