"""Streaming feeds: resume, replay, order of arrival; polling."""

import json
import time

import pytest
from pyspark.sql import functions as F

from rows import FailsOnce, Recorder, change, change_frame, lsn, recorded
from tidefeed import change_feed, poll, sink, start_feed, start_polling
from tidefeed.operators import (
    complete_offsets,
    empty_offsets,
    last_lsns,
    offsets_frame,
    read_offsets,
    save_offsets,
)
from tidefeed.sources import read_changes, stream_changes
from tidefeed.streaming import Offsets, Sink, deliver

NOW = {"availableNow": True}


class Site:
    """One place for change tables, output, checkpoint and positions."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.out = folder / "out"
        self.out.mkdir()
        self.offsets = str(folder / "offsets")

    def add(self, table, rows):
        path = str(self.folder / table)
        change_frame(self.spark, rows).coalesce(1).write.mode("append").parquet(path)

    def streams(self, *tables, **limits):
        return {t: stream_changes(self.spark, str(self.folder / t), **limits) for t in tables}

    def batches(self, *tables):
        return {t: read_changes(self.spark, str(self.folder / t)) for t in tables}

    def run(self, sink, *tables, checkpoint="checkpoint", after=None, **limits):
        streams = self.streams(*tables, **limits)
        place = str(self.folder / checkpoint)
        query = start_feed(streams, sink, place, self.offsets, after, trigger=NOW)
        query.awaitTermination()
        return query

    def positions(self, *tables):
        return last_lsns(read_offsets(self.spark, self.offsets, complete=False), tables)

    def complete(self, *tables):
        return last_lsns(read_offsets(self.spark, self.offsets), tables)

    def seen(self):
        return [(m["table_name"], json.loads(m["message"])["id"]) for m in recorded(self.out)]


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


def numbers(first, last):
    return [change(i, i, 2, i) for i in range(first, last + 1)]


def test_second_run_reads_only_what_is_new_and_third_nothing(site):
    site.add("a", numbers(1, 20))
    site.add("b", numbers(1, 5))
    publisher = sink("publisher", publisher=Recorder(site.out))
    site.run(publisher, "a", "b")
    assert len(site.seen()) == 25
    assert site.positions("a", "b") == {"a": lsn(20), "b": lsn(5)}

    site.add("a", numbers(21, 30))
    site.run(publisher, "a", "b")
    expected = [("a", i) for i in range(1, 31)] + [("b", i) for i in range(1, 6)]
    assert sorted(site.seen()) == sorted(expected)
    assert site.positions("a", "b") == {"a": lsn(30), "b": lsn(5)}

    site.run(publisher, "a", "b")
    assert sorted(site.seen()) == sorted(expected)


def test_a_failed_batch_saves_nothing_and_is_replayed_whole(site):
    site.add("a", numbers(1, 20))
    publisher = sink("publisher", publisher=FailsOnce(site.out, site.folder / "marker"))
    with pytest.raises(Exception, match="no connection"):
        site.run(publisher, "a")
    assert site.positions("a") == {"a": lsn(0)}
    site.run(publisher, "a")
    assert set(site.seen()) == {("a", i) for i in range(1, 21)}
    assert site.positions("a") == {"a": lsn(20)}


def test_a_replayed_parquet_batch_leaves_no_duplicates(site, monkeypatch):
    site.add("a", numbers(1, 20))
    written = str(site.folder / "written")
    inner = sink("parquet", path=written)
    failures = iter([True])

    def fails_after_writing(feed, batch):
        marks = inner(feed, batch)
        if next(failures, False):
            raise RuntimeError("lost after writing")
        return marks

    with pytest.raises(Exception, match="lost after writing"):
        site.run(fails_after_writing, "a")
    assert site.positions("a") == {"a": lsn(0)}
    site.run(fails_after_writing, "a")
    assert site.spark.read.parquet(written).count() == 20
    assert site.positions("a") == {"a": lsn(20)}


def test_a_fresh_checkpoint_reads_again_without_lowering_positions(site):
    site.add("a", numbers(1, 20))
    publisher = sink("publisher", publisher=Recorder(site.out))
    site.run(publisher, "a")
    site.run(publisher, "a", checkpoint="fresh")
    assert len(site.seen()) == 40
    assert site.positions("a") == {"a": lsn(20)}


def test_a_fresh_checkpoint_starts_at_complete_positions_every_time(site):
    site.add("a", numbers(1, 20))
    publisher = sink("publisher", publisher=Recorder(site.out))
    query = site.run(publisher, "a")
    complete_offsets(site.spark, site.offsets, query.id)
    site.add("a", numbers(21, 25))
    site.run(publisher, "a", checkpoint="fresh")
    assert sorted(site.seen()) == [("a", i) for i in range(1, 26)]
    save_offsets(site.spark, {"a": lsn(99)}, site.offsets, "other")
    site.add("a", numbers(26, 27))
    site.run(publisher, "a", checkpoint="fresh")
    assert sorted(site.seen()) == [("a", i) for i in range(1, 28)]


def test_a_stream_that_failed_between_files_out_of_order_loses_nothing(site):
    site.add("a", numbers(11, 20))
    site.add("a", numbers(1, 10))
    inner = sink("publisher", publisher=Recorder(site.out))

    def fails_in_the_second_batch(feed, batch):
        if batch.batch_id == 1:
            raise RuntimeError("stopped")
        return inner(feed, batch)

    with pytest.raises(Exception, match="stopped"):
        site.run(fails_in_the_second_batch, "a", max_files=1)
    assert site.positions("a") == {"a": lsn(20)}
    rest = change_feed(site.batches("a"), site.complete("a"))
    assert rest.count() == 20
    site.run(inner, "a", checkpoint="fresh")
    assert {i for _, i in site.seen()} == set(range(1, 21))


def test_files_out_of_log_order_lose_nothing(site):
    for first, last in ((11, 20), (1, 10), (5, 15)):
        site.add("a", numbers(first, last))
    batches = []
    inner = sink("publisher", publisher=Recorder(site.out))

    def counting(feed, batch):
        batches.append(batch.batch_id)
        return inner(feed, batch)

    site.run(counting, "a", max_files=1)
    assert batches == [0, 1, 2]
    wanted = [*range(1, 11), *range(5, 16), *range(11, 21)]
    assert sorted(site.seen()) == sorted(("a", i) for i in wanted)
    assert site.positions("a") == {"a": lsn(20)}


def test_starting_position_is_strict(site):
    site.add("a", numbers(1, 20))
    site.run(sink("publisher", publisher=Recorder(site.out)), "a", after={"a": lsn(15)})
    assert sorted(site.seen()) == [("a", i) for i in range(16, 21)]


def test_batch_and_stream_give_the_same_feed(site):
    site.add("a", numbers(1, 20))
    site.add("b", numbers(0x70, 0x90))
    after = {"b": lsn(0x7F)}
    written = str(site.folder / "written")
    site.run(sink("parquet", path=written), "a", "b", after=after)
    columns = ["table_name", "event_type", "message", "lsn", "seqval", "operation"]
    streamed = site.spark.read.parquet(written).select(*columns)
    batch = change_feed(site.batches("a", "b"), after).select(*columns)
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_a_user_function_is_a_sink(site):
    site.add("a", numbers(1, 20))
    written = str(site.folder / "written")

    def user(feed, batch):
        feed.write.mode("overwrite").parquet(written)

    site.run(user, "a")
    assert site.spark.read.parquet(written).count() == 20
    assert site.positions("a") == {"a": lsn(20)}


def test_a_publisher_also_serves_foreach(site):
    site.add("a", numbers(1, 20))
    feed = change_feed(site.streams("a"))
    query = (
        feed.writeStream.foreach(Recorder(site.out))
        .option("checkpointLocation", str(site.folder / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(site.seen()) == [("a", i) for i in range(1, 21)]


@pytest.mark.parametrize("name", ["memory", "console", "noop"])
def test_builtin_formats_take_the_feed(site, name):
    site.add("a", numbers(1, 20))
    feed = change_feed(site.streams("a"))
    writer = feed.writeStream.format(name).queryName(f"seen_{name}")
    query = writer.option("checkpointLocation", str(site.folder / "cp")).trigger(**NOW).start()
    query.awaitTermination()
    assert query.lastProgress.numInputRows == 20
    if name == "memory":
        assert site.spark.table("seen_memory").count() == 20


def test_a_restart_picks_up_new_columns(site):
    site.add("a", numbers(1, 3))
    publisher = sink("publisher", publisher=Recorder(site.out))
    site.run(publisher, "a")
    path = str(site.folder / "a")
    more = change_frame(site.spark, numbers(4, 6)).withColumn("added", F.lit("later"))
    more.coalesce(1).write.mode("append").parquet(path)
    schema = site.spark.read.option("mergeSchema", True).parquet(path).schema
    site.run(publisher, "a", schema=schema)
    messages = [json.loads(m["message"]) for m in recorded(site.out)]
    assert [m["id"] for m in messages] == list(range(1, 7))
    assert ["added" in m for m in messages] == [False] * 3 + [True] * 3


@pytest.mark.parametrize("more", [1, 63, 64, 200])
def test_many_tables_are_read_once(site, more, monkeypatch):
    from tidefeed.streaming import feed as feeds

    def second_pass(*_):
        raise AssertionError("the batch was read again")

    monkeypatch.setattr(feeds, "feed_high_water", second_pass)
    site.add("a", numbers(1, 4))
    names = [f"t{i}" for i in range(more)]
    tables = site.streams("a")
    feed = change_feed(tables)
    written = str(site.folder / "written")
    query = (
        feed.writeStream.foreachBatch(
            deliver(sink("parquet", path=written), site.offsets, ("a", *names))
        )
        .option("checkpointLocation", str(site.folder / "cp"))
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()
    assert site.positions("a") == {"a": lsn(4)}


def test_deliver_without_positions(site):
    site.add("a", numbers(1, 3))
    feed = change_feed(site.streams("a"))
    publisher: Sink = sink("publisher", publisher=Recorder(site.out))
    query = (
        feed.writeStream.foreachBatch(deliver(publisher))
        .option("checkpointLocation", str(site.folder / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert len(site.seen()) == 3


# Polling


def look(site, batch_id, *tables, publisher=None):
    target = publisher or Recorder(site.out)
    chosen = sink("publisher", publisher=target, order=["table_name"])
    return poll(site.spark, site.batches(*tables), chosen, site.offsets, "looks", batch_id)


def test_sources_are_told_the_saved_positions(site):
    site.add("a", numbers(1, 20))
    told = []

    def tables(saved):
        told.append(saved["a"])
        return site.batches("a")

    publisher = sink("publisher", publisher=Recorder(site.out))
    for batch_id in range(2):
        poll(site.spark, tables, publisher, site.offsets, "looks", batch_id)
    assert told == [lsn(0), lsn(20)]
    assert len(site.seen()) == 20


def test_positions_may_be_kept_elsewhere(site):
    class Kept(Offsets):
        positions = {}

        def read(self, spark):
            return offsets_frame(spark, self.positions) if self.positions else empty_offsets(spark)

        def save(self, spark, positions, query_id, complete):
            self.positions.update(positions)

    site.add("a", numbers(1, 20))
    kept = Kept("anywhere")
    publisher = sink("publisher", publisher=Recorder(site.out))
    assert poll(site.spark, site.batches("a"), publisher, kept, "q", 0) == {"a": lsn(20)}
    assert poll(site.spark, site.batches("a"), publisher, kept, "q", 1) == {}


def test_polls_add_up_and_stop_at_the_end(site):
    site.add("a", numbers(1, 20))
    site.add("b", numbers(1, 5))
    assert look(site, 0, "a", "b") == {"a": lsn(20), "b": lsn(5)}
    assert look(site, 1, "a", "b") == {}
    site.add("a", numbers(21, 25))
    assert look(site, 2, "a", "b") == {"a": lsn(25)}
    expected = [("a", i) for i in range(1, 26)] + [("b", i) for i in range(1, 6)]
    assert sorted(site.seen()) == sorted(expected)
    assert [i for t, i in site.seen() if t == "a"] == list(range(1, 26))


def test_a_row_at_or_below_the_position_is_never_polled(site):
    site.add("a", numbers(10, 20))
    look(site, 0, "a")
    site.add("a", [change(20, 99, 2, 99), change(5, 1, 2, 98), change(21, 1, 2, 97)])
    assert look(site, 1, "a") == {"a": lsn(21)}
    assert ("a", 97) in site.seen()
    assert not {("a", 98), ("a", 99)} & set(site.seen())


def test_rows_that_arrive_during_a_poll_wait_for_the_next(site):
    site.add("a", numbers(1, 5))
    arrived = []

    def late(feed, batch):
        if not arrived:
            site.add("a", numbers(6, 8))
            arrived.append(True)
        return sink("publisher", publisher=Recorder(site.out))(feed, batch)

    for batch_id in range(2):
        poll(site.spark, site.batches("a"), late, site.offsets, "looks", batch_id)
    assert sorted(site.seen()) == [("a", i) for i in range(1, 9)]


def test_a_source_may_tell_how_far_it_goes(site):
    site.add("a", numbers(1, 20))
    site.add("b", numbers(1, 5))
    publisher = sink("publisher", publisher=Recorder(site.out))
    tables = site.batches("a", "b")
    told = {"a": lsn(12), "b": None}
    assert poll(site.spark, tables, publisher, site.offsets, "q", 0, told) == {"a": lsn(12)}
    assert poll(site.spark, tables, publisher, site.offsets, "q", 1, told) == {}
    assert sorted(site.seen()) == [("a", i) for i in range(1, 13)]


def test_a_failed_poll_saves_nothing(site):
    site.add("a", numbers(1, 20))
    with pytest.raises(Exception, match="no connection"):
        look(site, 0, "a", publisher=FailsOnce(site.out, site.folder / "marker"))
    assert site.positions("a") == {"a": lsn(0)}
    assert look(site, 0, "a") == {"a": lsn(20)}
    assert set(site.seen()) == {("a", i) for i in range(1, 21)}


def test_polling_on_a_beat_sees_new_files_and_columns(site):
    site.add("a", numbers(1, 5))
    query = start_polling(
        site.spark,
        lambda: {"a": site.spark.read.option("mergeSchema", True).parquet(str(site.folder / "a"))},
        sink("publisher", publisher=Recorder(site.out)),
        site.offsets,
        str(site.folder / "checkpoint"),
        interval="1 second",
    )
    try:
        wait_for(query, lambda: site.positions("a") == {"a": lsn(5)})
        more = change_frame(site.spark, numbers(6, 8)).withColumn("added", F.lit("later"))
        more.coalesce(1).write.mode("append").parquet(str(site.folder / "a"))
        wait_for(query, lambda: site.positions("a") == {"a": lsn(8)})
    finally:
        query.stop()
    assert sorted(site.seen()) == [("a", i) for i in range(1, 9)]
    last = json.loads(recorded(site.out)[-1]["message"])
    assert last["added"] == "later"


def wait_for(query, condition, seconds=90):
    end = time.time() + seconds
    while not condition():
        assert query.isActive, query.exception()
        assert time.time() < end, "waited too long"
        time.sleep(0.3)
