"""Publishers and sinks."""

import json
from itertools import groupby
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from rows import FailsOnce, Recorder, change, change_frame, lsn, recorded
from test_ordering import skewed_feed
from tidefeed import change_feed
from tidefeed.operators import envelopes, with_position
from tidefeed.streaming import Batch, ConsolePrinter, DeadLetters, publish, sink
from tidefeed.streaming import sinks
from tidefeed.workspace import shared_folder


def test_console_publisher_prints_the_line(capsys):
    ConsolePrinter().process(Row(table_name="t", event_type="ChangeDetected", message="{}"))
    assert capsys.readouterr().out == "ConsolePublisher: [ChangeDetected] t: {}\n"


def test_publish_hands_over_every_message_and_reports_marks(spark, tmp_path):
    marks = publish(skewed_feed(spark), Recorder(tmp_path), epoch_id=3, order=None)
    assert marks == {"big": lsn(858), "a": lsn(6), "z": lsn(6)}
    messages = recorded(tmp_path)
    assert len(messages) == 6080
    assert {m["event_type"] for m in messages} == {"ChangeDetected"}
    ids = sorted(json.loads(m["message"])["id"] for m in messages if m["table_name"] == "big")
    assert ids == list(range(6000))


@pytest.mark.parametrize("partitions", [1, 5, None])
def test_publishing_in_table_order(spark, tmp_path, partitions):
    feed = skewed_feed(spark)
    marks = publish(feed, Recorder(tmp_path), order=["table_name"], partitions=partitions)
    assert marks == {"big": lsn(858), "a": lsn(6), "z": lsn(6)}
    messages = recorded(tmp_path)
    assert len(messages) == 6080
    for table in ("big", "a", "z"):
        mine = [(m["lsn"], m["seqval"]) for m in messages if m["table_name"] == table]
        assert mine == sorted(mine)
    if partitions == 5:
        by_task = {m["partition"] for m in messages if m["table_name"] == "big"}
        assert len(by_task) >= 4


def test_publishing_in_row_key_order(spark, tmp_path):
    # Key 0 holds most rows, and there is a key that is null.
    frame = change_frame(
        spark,
        [change(i, i, 2, None if i % 50 == 1 else (0 if i % 4 else i % 12)) for i in range(1, 2001)],
    )
    feed = envelopes(frame.orderBy(F.hash("id", "`__$seqval`")), "t", row_key=F.col("record.id"))
    publish(feed, Recorder(tmp_path), order=["table_name", "row_key"], partitions=7)
    messages = recorded(tmp_path)
    assert len(messages) == 2000

    def key(message):
        return str(json.loads(message["message"])["id"])

    for _, mine in groupby(sorted(messages, key=key), key=key):
        lsns = [m["lsn"] for m in mine]
        assert lsns == sorted(lsns)


def test_steps_hold_every_row_once_and_each_group_in_order(spark):
    feed = skewed_feed(spark, big=3000, small=5)
    steps = list(sinks.in_steps(feed, ["table_name"], 6))
    assert len(steps) > 3
    ids = [first_id for first_id, _ in steps]
    assert all(b - a >= 6 for a, b in zip(ids, ids[1:]))
    assert sum(step.count() for _, step in steps) == 3010


def counted_feed(spark, rows, row_key=None):
    """A feed whose messages are counted as they are rendered."""
    rendered = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def render(message):
        rendered.add(1)
        return message

    frame = change_frame(spark, [change(i, i, 2, i % 5) for i in range(1, rows + 1)]).repartition(3)
    frame = read_back(spark, frame)
    feed = envelopes(frame, "t", row_key=row_key)
    return feed.withColumn("message", render("message")), rendered


def read_back(spark, frame):
    folder = f"{shared_folder(spark)}/tidefeed/counted-{id(frame)}"
    frame.write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize("order", [["table_name"], ["table_name", "row_key"]])
def test_each_message_is_rendered_once(spark, tmp_path, order):
    feed, rendered = counted_feed(spark, 850, F.col("record.id"))
    publish(feed, Recorder(tmp_path), order=order, partitions=6)
    assert len(recorded(tmp_path)) == 850
    assert rendered.value == 850


def test_numbering_renders_each_message_once(spark):
    feed, rendered = counted_feed(spark, 850)
    assert with_position(feed, partitions=6).count() == 850
    assert rendered.value == 850


def test_steps_shuffle_whole_rows_once(spark):
    feed = skewed_feed(spark, big=3000, small=5)
    for _, step in sinks.in_steps(feed, ["table_name"], 6):
        plan = step._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan  # the rows were laid out by their one shuffle
    small = in_order_of_keys(spark)
    (_, step), = sinks.in_steps(small, ["table_name", "row_key"], 6)
    plan = step._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY") == 1


def in_order_of_keys(spark):
    frame = change_frame(spark, [change(i, i, 2, i % 97) for i in range(1, 1000)])
    return envelopes(frame, "t", row_key=F.col("record.id"))


class Poisoned(Recorder):
    """Takes no message with an id that ``bad`` divides; one with id 7 only at the second try."""

    def __init__(self, folder, bad):
        super().__init__(folder)
        self.bad, self.seen = bad, set()

    def process(self, row):
        number = json.loads(row.message)["id"]
        if number % self.bad == 0 or (number == 7 and number not in self.seen):
            self.seen.add(number)
            raise ValueError(f"cannot take {number}")
        super().process(row)


@pytest.mark.parametrize("order", [None, ["table_name"]])
def test_a_poison_message_is_kept_and_the_others_are_published(spark, tmp_path, order):
    (tmp_path / "out").mkdir()
    letters = DeadLetters(str(tmp_path / "dead"), tries=2, wait=0)
    to = sink("publisher", publisher=Poisoned(tmp_path / "out", 1000), order=order,
              partitions=4, dead_letters=letters)
    feed = skewed_feed(spark, 3000, 5)
    for _ in range(2):  # a repeated batch keeps them once
        assert to(feed, Batch("q", 3)) == {"big": lsn(429), "a": lsn(1), "z": lsn(1)}
    ids = [json.loads(m["message"])["id"] for m in recorded(tmp_path / "out")]
    assert set(ids) == set(range(3000)) - {0, 1000, 2000}
    dead = letters.read(spark).collect()
    assert sorted((r.table_name, json.loads(r.message)["id"]) for r in dead) == [
        ("a", 0), ("big", 0), ("big", 1000), ("big", 2000), ("z", 0),
    ]
    assert {r.error for r in dead} == {f"ValueError: cannot take {i}" for i in (0, 1000, 2000)}
    assert {(r.query_id, r.batch_id) for r in dead} == {("q", 3)}


def test_a_destination_that_is_down_is_no_poison(spark, tmp_path):
    (tmp_path / "out").mkdir()
    letters = DeadLetters(str(tmp_path / "dead"), tries=1, most=3, wait=0)
    with pytest.raises(Exception, match="cannot take"):
        publish(skewed_feed(spark, 50, 0), Poisoned(tmp_path / "out", 1), order=None, dead_letters=letters)
    assert letters.read(spark).collect() == []


def test_publishing_nothing(spark, tmp_path):
    feed = change_feed({"t": change_frame(spark, [])})
    assert publish(feed, Recorder(tmp_path), order=None) == {}
    assert publish(feed, Recorder(tmp_path)) == {}


def test_a_failing_publisher_is_closed_and_fails_the_job(spark, tmp_path):
    (tmp_path / "out").mkdir()
    publisher = FailsOnce(tmp_path / "out", tmp_path / "marker")
    with pytest.raises(Exception, match="no connection"):
        publish(skewed_feed(spark, 10, 0), publisher)


class Unwilling(Recorder):
    def open(self, partition_id, epoch_id):
        super().open(partition_id, epoch_id)
        return False


def test_a_publisher_may_skip_a_partition(spark, tmp_path):
    publish(skewed_feed(spark, 10, 0), Unwilling(tmp_path))
    assert recorded(tmp_path) == []


def small_feed(spark):
    frame = change_frame(spark, [change(i, i, 2, i) for i in range(1, 6)])
    return change_feed({"a": frame, "b": frame.limit(2), "none": frame.limit(0)})


@pytest.mark.parametrize("tables", [("a", "b", "none"), ()])
def test_parquet_sink_replays_over_its_own_output(spark, tmp_path, tables):
    write = sink("parquet", path=str(tmp_path / "out"))
    for _ in range(2):
        marks = write(small_feed(spark), Batch("q", 4, tables))
    assert marks == ({"a": lsn(5), "b": lsn(2)} if tables else None)
    write(small_feed(spark), Batch("q", 5, tables))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == 14
    assert {(r.batch_id, r.table_name) for r in written.collect()} == {
        (4, "a"), (4, "b"), (5, "a"), (5, "b"),
    }


def test_a_writer_gets_each_table_in_order_step_by_step(spark, tmp_path):
    out = str(tmp_path / "out")
    steps = []

    def write(feed, batch):
        taken = feed.withColumn("step", F.lit(len(steps))).withColumn(
            "place", F.monotonically_increasing_id()
        )
        taken.write.mode("append").parquet(out)
        steps.append(batch)

    batch = Batch("ordered", 0, ("big", "a", "z"))
    write_in_order = sinks.writer_sink(write, ["table_name"], 5)
    marks = write_in_order(skewed_feed(spark), batch)
    assert marks == {"big": lsn(858), "a": lsn(6), "z": lsn(6)}
    assert len(steps) > 3
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 6080
    for table in ("big", "a", "z"):
        mine = sorted((r for r in rows if r.table_name == table), key=lambda r: (r.step, r.place))
        lsns = [(bytes(r.lsn), bytes(r.seqval)) for r in mine]
        assert lsns == sorted(lsns)


def test_kafka_records(spark):
    records = sinks.kafka_frame(small_feed(spark), "table_name").collect()
    assert len(records) == 7
    first = min(records, key=lambda r: (r.key, r.value))
    assert first.key == "a" and json.loads(first.value)["id"] == 1
    headers = {h.key: bytes(h.value) for h in first.headers}
    assert headers == {
        "table_name": b"a",
        "event_type": b"ChangeDetected",
        "lsn": lsn(1),
        "seqval": lsn(1),
        "operation": b"2",
    }


def test_without_a_row_key_records_have_no_key(spark):
    assert {r.key for r in sinks.kafka_frame(small_feed(spark)).collect()} == {None}


def test_order_per_table_makes_the_table_the_key(spark, monkeypatch):
    keys = []
    monkeypatch.setattr(sinks, "writer_sink", lambda write, order, partitions: (write, order))

    class Written:
        def __getattr__(self, name):
            return self

        def __call__(self, *args, **kwargs):
            return self

    def frame(feed, key=None):
        keys.append(key)
        return Written()

    monkeypatch.setattr(sinks, "kafka_frame", frame)
    options = {"kafka.bootstrap.servers": "x", "topic": "t"}
    for order in (sinks.PER_TABLE, sinks.AUTO, None):
        sinks.kafka_sink(options, order=order)[0](None, None)
    assert keys == ["table_name", None, None]


def test_a_large_table_spreads_over_row_keys(spark):
    frame = change_frame(spark, [change(i, i, 2, i % 50) for i in range(1, 301)])
    feed = envelopes(frame, "hot", row_key=F.col("record.id"))
    assert sinks.kafka_frame(feed).select("key").distinct().count() == 50
    assert sinks.kafka_frame(feed, "table_name").select("key").distinct().count() == 1


def test_order_is_per_row_key_where_there_is_one(spark):
    feed = small_feed(spark)
    assert sinks.order_of(feed, sinks.AUTO) is None
    assert sinks.order_of(feed.withColumn("row_key", F.lit("1")), sinks.AUTO) == sinks.PER_ROW
    assert sinks.order_of(feed, sinks.PER_TABLE) == sinks.PER_TABLE


def test_publishing_leaves_no_folder(spark, tmp_path):
    folder = Path(shared_folder(spark).removeprefix("file:")) / "tidefeed"
    before = set(folder.glob("slices-*")) if folder.exists() else set()
    publish(skewed_feed(spark, 50, 5), Recorder(tmp_path), order=sinks.PER_TABLE, partitions=3)
    assert set(folder.glob("slices-*")) == before


def test_a_publisher_that_fails_to_open_is_closed(spark, tmp_path):
    class Unopened(Recorder):
        def open(self, partition_id, epoch_id):
            super().open(partition_id, epoch_id)
            raise RuntimeError("refused")

        def close(self, error):
            super().close(error)
            Path(self.folder, f"closed-{self.partition_id}").touch()

    with pytest.raises(Exception, match="refused"):
        publish(small_feed(spark), Unopened(tmp_path))
    assert list(tmp_path.glob("closed-*"))


def test_a_connection_string_without_an_endpoint():
    with pytest.raises(ValueError, match="endpoint"):
        sinks.event_hub_options("SharedAccessKey=s;EntityPath=hub")


def test_kafka_needs_its_connector(spark):
    options = {"kafka.bootstrap.servers": "nowhere:9092", "topic": "t"}
    with pytest.raises(Exception, match="(?i)kafka"):
        sink("kafka", options=options)(small_feed(spark), Batch("q", 0))


CONNECTION = "Endpoint=sb://space.example.net/;SharedAccessKeyName=k;SharedAccessKey=s=;EntityPath=hub"


def test_event_hub_is_its_kafka_endpoint():
    options = sinks.event_hub_options(CONNECTION)
    assert options["kafka.bootstrap.servers"] == "space.example.net:9093"
    assert options["topic"] == "hub"
    assert f'password="{CONNECTION}"' in options["kafka.sasl.jaas.config"]
    assert callable(sink("EventHub", connection_string=CONNECTION))
    with pytest.raises(ValueError, match="topic"):
        sink("EventHub", connection_string="Endpoint=sb://space.example.net/;SharedAccessKey=s")


@pytest.mark.parametrize("kind", ["EventHub", "ServiceBus"])
def test_bus_names_need_a_connection_string(kind):
    with pytest.raises(ValueError, match="connection string"):
        sink(kind)


def test_service_bus_goes_through_a_publisher(spark, tmp_path):
    with pytest.raises(ValueError, match="publisher"):
        sink("ServiceBus", connection_string="x")
    write = sink("ServiceBus", connection_string="x", publisher=Recorder(tmp_path))
    assert write(small_feed(spark), Batch("q", 0)) == {"a": lsn(5), "b": lsn(2)}
    assert len(recorded(tmp_path)) == 7


@pytest.mark.parametrize("kind", ["Console", None, "", "eventhub", "nothing of the kind"])
def test_other_names_are_the_console(spark, capfd, kind):
    assert sink(kind)(small_feed(spark), Batch("q", 0)) == {"a": lsn(5), "b": lsn(2)}


@pytest.mark.parametrize("kind", ["parquet", "kafka", "publisher"])
def test_sinks_check_their_arguments(kind):
    with pytest.raises(ValueError):
        sink(kind)
