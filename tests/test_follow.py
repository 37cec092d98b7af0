"""Feeds whose tables change their columns; reading once; progress of a running feed."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rows import Recorder, change, change_frame, lsn, recorded
from tidefeed import change_feed, follow, read_once, sink
from tidefeed.operators import OffsetLog, last_lsns, live_progress, progress, read_offsets
from tidefeed.sources import read_changes, stream_changes
from tidefeed.streaming import committed_positions, schema_ledger
from tidefeed.streaming.once import Names

NOW = {"availableNow": True}


def add(spark, folder, first, last, drop=(), **more):
    frame = change_frame(spark, [change(i, i, 2, i) for i in range(first, last + 1)]).drop(*drop)
    for name, value in more.items():
        frame = frame.withColumn(name, F.lit(value))
    frame.coalesce(1).write.mode("append").parquet(str(folder))


def messages(out):
    return {json.loads(m["message"])["id"]: json.loads(m["message"]) for m in recorded(out)}


@pytest.fixture
def out(tmp_path):
    (tmp_path / "out").mkdir()
    return tmp_path / "out"


def run(spark, tmp_path, out, *tables, **options):
    folders = {t: str(tmp_path / t) for t in tables}
    query = follow(
        spark, folders, sink("publisher", publisher=Recorder(out)), str(tmp_path / "checkpoint"),
        str(tmp_path / "offsets"), trigger=NOW, **options,
    )
    query.awaitTermination()


def test_columns_come_and_go_without_a_restart(spark, tmp_path, out):
    add(spark, tmp_path / "a", 1, 3)
    add(spark, tmp_path / "a", 4, 5, extra=7, OperationType="own")
    add(spark, tmp_path / "a", 6, 6, drop=("name", "raw", "__$seqval"), extra="text now")
    add(spark, tmp_path / "b", 1, 1)
    run(spark, tmp_path, out, "a", "b", max_files=1)
    got = {json.loads(m["message"])["id"]: m for m in recorded(out) if m["table_name"] == "a"}
    plain = {"OperationType", "id", "name", "amount", "raw"}
    records = {i: json.loads(m["message"]) for i, m in got.items()}
    assert all(set(records[i]) == plain for i in (1, 2, 3))
    assert all(set(records[i]) == plain | {"extra"} and records[i]["extra"] == 7 for i in (4, 5))
    assert records[4]["OperationType"] == "own"
    assert records[6] == {"OperationType": "Insert", "id": 6, "amount": 1.5, "extra": "text now"}
    assert got[6]["seqval"] is None
    offsets = read_offsets(spark, str(tmp_path / "offsets"))
    assert last_lsns(offsets, ["a", "b"]) == {"a": lsn(6), "b": lsn(1)}

    ledger = schema_ledger(spark, str(tmp_path / "checkpoint")).where("table_name = 'a'").collect()
    found = {
        tuple(c.name for c in row.columns): (bytes(row.from_lsn), bytes(row.to_lsn)) for row in ledger
    }
    assert found == {
        ("id", "name", "amount", "raw"): (lsn(1), lsn(3)),
        ("id", "name", "amount", "raw", "extra", "OperationType"): (lsn(4), lsn(5)),
        ("id", "amount", "extra"): (lsn(6), lsn(6)),
    }


def test_a_batch_may_hold_several_sets_of_columns(spark, tmp_path, out):
    add(spark, tmp_path / "a", 1, 3)
    add(spark, tmp_path / "a", 4, 5, extra=None)
    run(spark, tmp_path, out, "a", after={"a": lsn(1)})
    assert {i: "extra" in m for i, m in messages(out).items()} == {2: False, 3: False, 4: True, 5: True}


def test_it_goes_on_from_the_checkpoint_with_new_columns(spark, tmp_path, out):
    add(spark, tmp_path / "a", 1, 2)
    run(spark, tmp_path, out, "a", row_key=F.col("record.id"))
    add(spark, tmp_path / "a", 3, 4, extra="x")
    run(spark, tmp_path, out, "a", row_key=F.col("record.id"))
    run(spark, tmp_path, out, "a", row_key=F.col("record.id"))
    assert len(recorded(out)) == 4 and messages(out)[4]["extra"] == "x"
    ledger = schema_ledger(spark, str(tmp_path / "checkpoint"))
    assert ledger.count() == 2
    assert schema_ledger(spark, str(tmp_path / "nowhere")).count() == 0


# Reading once


def feed(spark, rows):
    return change_feed({"t": change_frame(spark, rows)})


def numbers(first, last):
    return [change(i, i, 2, i) for i in range(first, last + 1)]


class Reader:
    def __init__(self, spark, tmp_path, with_positions=True):
        self.spark, self.folder = spark, tmp_path
        self.log = OffsetLog(str(tmp_path / "log"))
        self.log.save(spark, {"t": lsn(0)})
        self.with_positions = with_positions

    def publish(self, rows):
        feed(self.spark, rows).coalesce(1).write.mode("append").parquet(str(self.folder / "messages"))

    def read(self):
        path = str(self.folder / "messages")
        stream = self.spark.readStream.schema(self.spark.read.parquet(path).schema).parquet(path)
        marks = committed_positions(self.spark, self.log.path) if self.with_positions else None
        writer = read_once(stream, marks, buckets=2).writeStream
        writer = writer.option("checkpointLocation", str(self.folder / "reader"))
        writer.trigger(availableNow=True).start(str(self.folder / "read")).awaitTermination()
        rows = self.spark.read.parquet(str(self.folder / "read")).collect()
        return sorted((int.from_bytes(r.lsn), int.from_bytes(r.seqval), r.operation) for r in rows)


@pytest.mark.parametrize("with_positions", [True, False])
def test_a_replayed_batch_is_read_once(spark, tmp_path, with_positions):
    reader = Reader(spark, tmp_path, with_positions)
    pair = [change(5, 5, 3, 5), change(5, 5, 4, 5), change(5, 6, 4, 5)]
    reader.publish(numbers(1, 4) + pair[:1])
    first = reader.read()
    assert len(first) == 5
    reader.publish(numbers(1, 4) + pair + pair)  # the replay, whole, and twice in itself
    expected = [(i, i, 2) for i in range(1, 5)] + [(5, 5, 3), (5, 5, 4), (5, 6, 4)]
    assert reader.read() == expected
    reader.log.save(spark, {"t": lsn(5)})
    reader.publish(numbers(6, 8))
    assert reader.read() == expected + [(6, 6, 2), (7, 7, 2), (8, 8, 2)]
    reader.publish(numbers(6, 9))
    assert reader.read() == expected + [(i, i, 2) for i in range(6, 10)]


def test_a_buckets_names_are_many_rows_of_state(spark, tmp_path):
    path = str(tmp_path / "messages")
    feed(spark, numbers(1, 200)).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    writer = read_once(stream, buckets=1).writeStream.trigger(availableNow=True)
    writer = writer.option("checkpointLocation", str(tmp_path / "reader"))
    query = writer.start(str(tmp_path / "read"))
    query.awaitTermination()
    kept = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)
    assert kept >= 8 and spark.read.parquet(str(tmp_path / "read")).count() == 200


def test_names_are_dropped_below_the_position():
    names = Names()

    def columns(*rows):
        return [pd.Series(c) for c in zip(*rows)]

    rows = [(lsn(i), lsn(i), "2") for i in range(1, 1001)]
    assert names.add(columns(*rows)).all()
    assert not names.add(columns(*rows[:10])).any()
    size = len(names.packed())
    names.drop(lsn(990))
    assert len(names) == 10 and len(names.packed()) == size // 100
    again = Names(names.packed())
    new = again.add(columns((lsn(995), lsn(995), "2"), (lsn(995), lsn(995), "4"), (lsn(2000), None, None)))
    assert new.tolist() == [False, True, True]


def test_nested_columns_are_refused(spark):
    rows = feed(spark, numbers(1, 1)).withColumn("x", F.array(F.lit(1)))
    with pytest.raises(ValueError, match="nested"):
        read_once(rows)


# Progress


def test_live_progress_equals_progress_after_every_batch(spark, tmp_path):
    for first, last in ((11, 20), (1, 10), (21, 22)):
        add(spark, tmp_path / "a", first, last)
    add(spark, tmp_path / "b", 1, 3)
    tables = {t: stream_changes(spark, str(tmp_path / t), max_files=1) for t in "ab"}
    saved = {"a": lsn(4)}
    marks = live_progress(change_feed(tables, saved), saved)
    batches = []
    query = marks.writeStream.outputMode("update").foreachBatch(
        lambda rows, _: batches.append({r.table_name: r for r in rows.collect()})
    )
    query = query.option("checkpointLocation", str(tmp_path / "checkpoint"))
    query.trigger(availableNow=True).start().awaitTermination()
    expected = [
        {"a": (20, 10, 16), "b": (3, 3, 3)},
        {"a": (20, 16, 16)},
        {"a": (22, 18, 18)},
    ]
    shown = [
        {t: (int.from_bytes(r.high_water), r.changes, int(r.behind)) for t, r in batch.items()}
        for batch in batches
    ]
    assert [s for s in shown if s] == expected
    whole = progress({t: read_changes(spark, str(tmp_path / t)) for t in "ab"}, saved).collect()
    last = shown[0] | shown[1] | shown[2]
    assert {r.table_name: (int.from_bytes(r.high_water), r.changes) for r in whole} == {
        t: r[:2] for t, r in last.items()
    }
