"""Where a feed goes: user publishers, the console, files, a message bus.

A sink is a function of a feed and the batch it belongs to. It publishes every row and returns
the newest LSN per table if it learned it on the way; a sink that returns ``None`` costs a
second pass over the feed to find out.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.operators.ordering import LOG_ORDER, cuts_of, with_tie
from tidefeed.workspace import new_folder, path_exists, remove_folder, shared_folder

log = logging.getLogger(__name__)

# Maxima that one observation holds; more tables take a chain of observations.
OBSERVED = 64

# Fixed value: what each line on the console starts with.
CONSOLE_PREFIX = "ConsolePublisher: "

# Orders to ask for. Each table in log order cannot go on in parallel within a table: a table's
# slices are published one after the other. Each row key in log order hardly waits.
PER_TABLE = ("table_name",)
PER_ROW = ("table_name", "row_key")
# Unless told otherwise: per row key where the feed has one, else none. Every message carries its
# log position.
AUTO = ("auto",)


def order_of(feed: DataFrame, order: Sequence[str] | None) -> Sequence[str] | None:
    if order is None or tuple(order) != AUTO:
        return order
    return PER_ROW if "row_key" in feed.columns else None


@dataclass(frozen=True)
class Batch:
    """Which batch a feed is, so that a sink can recognise a replay."""

    query_id: str
    batch_id: int
    tables: tuple[str, ...] = ()


Sink = Callable[[DataFrame, Batch], Mapping[str, bytes] | None]


class Publisher:
    """A user's client. It is sent to the executors, so it connects in ``open``, not before.

    One task calls ``open`` once, ``process`` for each message, one at a time, and ``close``
    once, with the error if there was one. The same object serves ``writeStream.foreach``.
    """

    def open(self, partition_id: int, epoch_id: int) -> bool:
        """Whether this partition wants its rows."""
        return True

    def process(self, row: Row) -> None:
        raise NotImplementedError

    def close(self, error: BaseException | None) -> None:
        pass


class ConsolePrinter(Publisher):
    """Prints each message where its task runs."""

    @staticmethod
    def line(row: Row) -> str:
        return f"{CONSOLE_PREFIX}[{row.event_type}] {row.table_name}: {row.message}"

    def process(self, row: Row) -> None:
        print(self.line(row), flush=True)


_LETTER_ARROW = pa.schema(
    [
        ("table_name", pa.string()), ("event_type", pa.string()), ("message", pa.string()),
        ("lsn", pa.binary()), ("seqval", pa.binary()), ("operation", pa.int32()),
        ("error", pa.string()),
    ]
)


class TooManyFailed(Exception):
    """A task's publisher failed on more messages than single faulty ones explain."""


@dataclass(frozen=True)
class DeadLetters:
    """A message that a publisher fails on ``tries`` times is kept in a table, and the others go on.

    The table's rows are the message's own columns, ``error``, and the query, batch and step. A
    repeated batch writes its rows again. More than ``most`` such messages in one task are taken
    for a destination that is down: the task fails as without dead letters. Between tries the
    task waits ``wait`` seconds, then twice as long, and so on.
    """

    path: str
    tries: int = 3
    most: int = 100
    wait: float = 0.1

    def folder(self, batch: Batch) -> str:
        return f"{self.path}/query_id={batch.query_id}/batch_id={batch.batch_id}"

    def read(self, spark: SparkSession) -> DataFrame:
        """The letters of all batches."""
        kinds = f"{LETTER}, query_id STRING, batch_id LONG, step INT"
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], kinds)
        return spark.read.schema(kinds).parquet(self.path)


LETTER = (
    "table_name STRING, event_type STRING, message STRING, lsn BINARY, seqval BINARY, "
    "operation INT, error STRING"
)


def publish(
    feed: DataFrame,
    publisher: Publisher,
    epoch_id: int = 0,
    order: Sequence[str] | None = AUTO,
    partitions: int | None = None,
    folder: str | None = None,
    dead_letters: DeadLetters | None = None,
    query_id: str = "batch",
) -> dict[str, bytes]:
    """Hand every message of a feed to ``publisher``, and return the newest LSN per table.

    ``order``, ``partitions`` and ``folder`` are those of ``in_steps``. With ``dead_letters`` a
    message that the publisher cannot take does not hold up the others.
    """
    newest: dict[str, bytes] = {}
    spark = feed.sparkSession
    own = None if folder else new_folder(spark, "slices")
    letters = dead_letters and dead_letters.folder(Batch(query_id, epoch_id))
    if letters:
        remove_folder(spark, letters)  # of an attempt before this one
    try:
        for number, (first_id, step) in enumerate(in_steps(feed, order, partitions, folder or own)):
            kept = letters and f"{letters}/step={number}"
            _keep_newest(newest, _publish_step(step, publisher, epoch_id, first_id, dead_letters, kept))
    finally:
        if own:
            remove_folder(spark, own)
    return newest


def _keep_newest(newest: dict[str, bytes], found: Mapping[str, bytes]) -> None:
    for table, lsn in found.items():
        newest[table] = max(lsn, newest.get(table, lsn))


def _values(column: pa.Array) -> list:
    """A column as Python values. Text and bytes take the way through NumPy, which is about
    twenty times as fast as making an Arrow scalar of each value."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def _publish_step(
    feed: DataFrame,
    publisher: Publisher,
    epoch_id: int,
    first_id: int = 0,
    dead_letters: DeadLetters | None = None,
    letters: str | None = None,
) -> dict[str, bytes]:
    """One pass: the tasks publish, and report the newest LSN per table they handled, and the
    messages that failed."""

    def handed_over(row: Row) -> str | None:
        """What went wrong with a message; nothing, as a rule."""
        if dead_letters is None:
            publisher.process(row)
            return None
        for attempt in range(1, dead_letters.tries + 1):
            try:
                publisher.process(row)
                return None
            except Exception as error:
                failure = f"{type(error).__name__}: {error}"
                if attempt < dead_letters.tries:
                    time.sleep(dead_letters.wait * 2 ** (attempt - 1))
        return failure

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        newest: dict[str, bytes] = {}
        failed: list[dict] = []
        failure = None
        try:
            wanted = publisher.open(first_id + TaskContext.get().partitionId(), epoch_id)
            for batch in batches:
                columns = {n: _values(c) for n, c in zip(batch.schema.names, batch.columns)}
                if wanted:
                    message = Row(*columns)
                    for values in zip(*columns.values()):
                        error = handed_over(message(*values))
                        if error is not None:
                            failed.append(dict(zip(columns, values)) | {"error": error})
                            if len(failed) > dead_letters.most:
                                raise TooManyFailed(error)
                for table, lsn in zip(columns["table_name"], columns["lsn"]):
                    if lsn is not None and lsn > newest.get(table, b""):
                        newest[table] = lsn
        except BaseException as error:
            failure = error
            raise
        finally:
            publisher.close(failure)
        rows = [{"table_name": t, "lsn": lsn} for t, lsn in newest.items()]
        reported = pa.Table.from_pylist(rows + failed, _LETTER_ARROW)
        yield from reported.to_batches()

    reports = feed.mapInArrow(run, LETTER)
    newest = F.max("lsn").alias("lsn")
    if letters is None:
        # The aggregate's shuffle stands between publishing and the result, so there is none until
        # every task is done.
        rows = reports.groupBy("table_name").agg(newest).collect()
    else:
        # Publishing happens as the reports are written, once; both kinds are then read from there.
        spark, folder = feed.sparkSession, new_folder(feed.sparkSession, "reports")
        reports.write.parquet(folder)
        reports = spark.read.schema(LETTER).parquet(folder)
        rows = reports.where("error IS NULL").groupBy("table_name").agg(newest).collect()
        failed = reports.where("error IS NOT NULL")
        if not failed.isEmpty():
            failed.write.mode("overwrite").parquet(letters)
        remove_folder(spark, folder)
    return {row.table_name: bytes(row.lsn) for row in rows if row.lsn is not None}


def in_steps(
    feed: DataFrame,
    order: Sequence[str] | None = AUTO,
    partitions: int | None = None,
    folder: str | None = None,
) -> Iterator[tuple[int, DataFrame]]:
    """The feed as frames to be published one after the other, each by tasks side by side.

    ``("table_name",)`` keeps each table in log order, ``("table_name", "row_key")`` each row
    key of it. The log order is cut into slices, each for one task, and a slice that continues
    a group comes in the step after the slice before it: only what must wait waits, and no task
    gets a whole large table. ``partitions`` sets the number of slices, by default the session's
    number of shuffle partitions; ``folder`` is where they are laid out, overwriting what an
    earlier batch left. With ``None`` for ``order`` the feed is one frame as it is, with no
    shuffle.

    With each frame goes a partition number that no earlier frame reaches. Each row is rendered
    once and shuffled once: where no group is larger than a slice there is one step, which is not
    laid out at all, and else the rows are written by step and slice, one file for each, and a
    step's files are read whole, each by one task.
    """
    order = order_of(feed, order)
    if order is None:
        yield 0, feed
        return
    group = list(order)
    spark = feed.sparkSession
    tied = with_tie(feed)
    cuts = cuts_of(tied, group, partitions)
    # A slice's first cut inside a group means that the group goes on from the slice before it;
    # the rows of that group wait for as many steps as there are such slices before.
    steps, places, heads = [0], [0], {}
    members = [0]
    for number, key in enumerate(cuts.keys, 1):
        goes_on = any(value is not None for value in key[len(group) :])
        step = steps[-1] + 1 if goes_on else 0
        steps.append(step)
        if goes_on:
            members += [0] * (step + 1 - len(members))
            heads[number] = key[: len(group)]
            members[step] += 1
        places.append(members[step] - 1 if goes_on else 0)
    in_slices = (*group, *LOG_ORDER, "_tie")
    placed = tied.withColumn("_slice", cuts.range_of())
    if not heads:
        rows = placed.repartitionById(cuts.ranges, "_slice")
        yield 0, rows.sortWithinPartitions(*in_slices).select(*feed.columns)
        return

    firsts = [sum(([cuts.ranges, *members[1:]])[:step]) for step in range(len(members))]
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in ("_slice", "_on", "_at")])
    schema.add("_head", T.StructType([cuts.schema[name] for name in group]))
    waits = [(n, steps[n], firsts[steps[n]] + places[n], head) for n, head in heads.items()]
    # A row for each slice. As a local table its size is known, and Spark chooses the join by it.
    placed = placed.join(spark.createDataFrame(waits, schema), "_slice", "left")
    on = F.col("_on").isNotNull() & F.struct(*group).eqNullSafe(F.col("_head"))
    placed = placed.withColumns(
        {"_step": F.when(on, F.col("_on")).otherwise(0), "_place": F.when(on, F.col("_at")).otherwise(F.col("_slice"))}
    )
    placed = placed.repartitionById(cuts.ranges + len(heads), "_place")
    folder = folder or new_folder(spark, "slices")
    kept = (*feed.columns, "_step", "_place")
    laid = placed.sortWithinPartitions("_step", "_place", *in_slices).select(*kept)
    laid.write.mode("overwrite").partitionBy("_step", "_place").parquet(folder)
    laid = spark.read.schema(laid.schema).parquet(folder)
    with _whole_files(spark):
        for step in range(len(members)):
            yield step * cuts.ranges, laid.where(F.col("_step") == step).select(*feed.columns)


@contextmanager
def _whole_files(spark: SparkSession) -> Iterator[None]:
    """Every file that is scanned meanwhile is one partition."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.set(name, 1 << 40)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _slices_of(feed: DataFrame, batch: Batch) -> str:
    """One folder per query, so that a feed that runs for years keeps one batch of slices."""
    return f"{shared_folder(feed.sparkSession)}/tidefeed/slices-{batch.query_id}"


def publisher_sink(
    publisher: Publisher,
    order: Sequence[str] | None = AUTO,
    partitions: int | None = None,
    dead_letters: DeadLetters | None = None,
) -> Sink:
    def run(feed: DataFrame, batch: Batch) -> Mapping[str, bytes]:
        return publish(
            feed, publisher, batch.batch_id, order, partitions, _slices_of(feed, batch),
            dead_letters, batch.query_id,
        )

    return run


def writer_sink(
    write: Callable[[DataFrame, Batch], None],
    order: Sequence[str] | None = None,
    partitions: int | None = None,
) -> Sink:
    """A sink from a function that writes a whole frame with one DataFrame write."""

    def run(feed: DataFrame, batch: Batch) -> Mapping[str, bytes] | None:
        newest: dict[str, bytes] = {}
        for _, step in in_steps(feed, order, partitions, _slices_of(feed, batch)):
            if batch.tables:
                _keep_newest(newest, _observed_write(write, step, batch))
            else:
                write(step, batch)
        return newest if batch.tables else None

    return run


def _observed_write(
    write: Callable[[DataFrame, Batch], None], feed: DataFrame, batch: Batch
) -> dict[str, bytes]:
    """Write, and learn the newest LSN per table from the rows that go by."""
    seen: list[tuple[Observation, Sequence[str]]] = []
    for first in range(0, len(batch.tables), OBSERVED):
        some = batch.tables[first : first + OBSERVED]
        newest = [
            F.max(F.when(F.col("table_name") == table, F.col("lsn"))).alias(f"t{i}")
            for i, table in enumerate(some)
        ]
        seen.append((Observation(), some))
        feed = feed.observe(seen[-1][0], *newest)
    write(feed, batch)
    found = {t: o.get[f"t{i}"] for o, some in seen for i, t in enumerate(some)}
    return {table: bytes(lsn) for table, lsn in found.items() if lsn is not None}


def parquet_sink(path: str) -> Sink:
    """Files under ``query_id=.../batch_id=.../table_name=...``; a replay overwrites its own."""

    def write(feed: DataFrame, batch: Batch) -> None:
        leaf = f"{path}/query_id={batch.query_id}/batch_id={batch.batch_id}"
        feed.write.mode("overwrite").partitionBy("table_name").parquet(leaf)

    return writer_sink(write)


def kafka_frame(feed: DataFrame, key: str | None = None) -> DataFrame:
    """A feed as Kafka records: the payload is the value, the rest of the envelope headers.

    ``key`` is the column whose messages share a Kafka partition: by default ``row_key`` where the
    feed has one. Without, there is no order to keep and no key, so that a large table spreads over
    all Kafka partitions. Readers recognise a repeated message by the table, LSN, sequence value
    and operation; a table without ``__$seqval`` has no such key.
    """

    def header(name: str) -> Column:
        return F.struct(F.lit(name).alias("key"), F.col(name).cast("binary").alias("value"))

    operation = F.struct(
        F.lit("operation").alias("key"),
        F.col("operation").cast("string").cast("binary").alias("value"),
    )
    names = ("table_name", "event_type", "lsn", "seqval")
    key = key or ("row_key" if "row_key" in feed.columns else None)
    return feed.select(
        (F.col(key) if key else F.lit(None)).cast("string").alias("key"),
        F.col("message").alias("value"),
        F.array(*[header(name) for name in names], operation).alias("headers"),
    )


def kafka_sink(
    options: Mapping[str, str],
    key: str | None = None,
    order: Sequence[str] | None = AUTO,
    partitions: int | None = None,
) -> Sink:
    """A Kafka topic. Messages of one ``key`` share a Kafka partition, see ``kafka_frame``; with
    ``order`` per table, the table is the key."""
    if key is None and order is not None and tuple(order) == PER_TABLE:
        key = "table_name"
    missing = {"kafka.bootstrap.servers", "topic"} - set(options)
    if missing:
        raise ValueError(f"a kafka sink needs the options {sorted(missing)}")

    def write(feed: DataFrame, batch: Batch) -> None:
        kafka_frame(feed, key).write.format("kafka").options(**options).save()

    return writer_sink(write, order, partitions)


def event_hub_options(connection_string: str, topic: str | None = None) -> dict[str, str]:
    """Kafka options for the Kafka endpoint of an Event Hubs connection string."""
    parts = dict(part.partition("=")[::2] for part in connection_string.strip(";").split(";"))
    if not parts.get("Endpoint"):
        raise ValueError("the connection string names no endpoint")
    if not (topic or "EntityPath" in parts):
        raise ValueError("the connection string names no hub; give its topic")
    host = parts["Endpoint"].removeprefix("sb://").strip("/")
    login = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return {
        "kafka.bootstrap.servers": f"{host}:9093",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": (
            f'{login} required username="$ConnectionString" password="{connection_string}";'
        ),
        "topic": topic or parts["EntityPath"],
    }


def sink(
    kind: str | None = None,
    connection_string: str | None = None,
    publisher: Publisher | None = None,
    order: Sequence[str] | None = AUTO,
    partitions: int | None = None,
    key: str | None = None,
    path: str | None = None,
    topic: str | None = None,
    options: Mapping[str, str] | None = None,
    dead_letters: DeadLetters | None = None,
) -> Sink:
    """The sink of that name.

    ``parquet`` needs ``path``; ``kafka`` needs ``options``; ``publisher`` needs ``publisher``.
    ``EventHub`` and ``ServiceBus`` need ``connection_string``: the first is written through its
    Kafka endpoint, the second has no Spark sink and needs a ``publisher`` as well. Any other
    name, or none, is the console. ``order`` and ``partitions`` are those of ``in_steps``; files
    need no order, because their rows carry the log position. ``dead_letters`` is for publishers.
    """
    if kind in ("EventHub", "ServiceBus") and not connection_string:
        raise ValueError(f"{kind} needs a connection string")
    if kind == "publisher" or kind == "ServiceBus":
        if publisher is None:
            raise ValueError(f"{kind} needs a publisher")
        return publisher_sink(publisher, order, partitions, dead_letters)
    if kind == "EventHub":
        hub = event_hub_options(connection_string, topic)
        return kafka_sink({**hub, **(options or {})}, key, order, partitions)
    if kind == "kafka":
        return kafka_sink(options or {}, key, order, partitions)
    if kind == "parquet":
        if not path:
            raise ValueError("parquet needs a path")
        return parquet_sink(path)
    if kind not in (None, "", "Console", "console"):
        log.warning("no sink is called %r; using the console", kind)
    return publisher_sink(ConsolePrinter(), order, partitions, dead_letters)
