"""Positions as a log of commits; gaps that retention leaves; positions in a plain table."""

import threading
import uuid

import pytest

from rows import Recorder, change, change_frame, lsn, recorded
from tidefeed import poll, sink, start_feed
from tidefeed.operators import (
    CommitConflict,
    OffsetLog,
    RetentionGap,
    compact_offsets_table,
    create_offsets_table,
    last_lsns,
    offset_log,
    retention_gaps,
)
from tidefeed.sources import stream_changes
from tidefeed.streaming import CatalogOffsets, LoggedOffsets
from tidefeed.workspace import create_file, read_file


def positions(log, spark, complete=True):
    return {r.table_name: bytes(r.last_lsn) for r in log.read(spark, complete).collect()}


def numbers(first, last):
    return [change(i, i, 2, i) for i in range(first, last + 1)]


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "one" / "file")
    assert read_file(spark, path) is None
    assert create_file(spark, path, "first é")
    assert not create_file(spark, path, "second")
    assert read_file(spark, path) == "first é"
    assert [p.name for p in (tmp_path / "one").iterdir()] == ["file"]


def test_interleaved_saves_lose_nothing(spark, tmp_path):
    log = OffsetLog(str(tmp_path / "log"))
    log.save(spark, {"a": lsn(5), "b": lsn(5)})
    log.save(spark, {"c": lsn(1), "a": lsn(3)})
    log.save(spark, {"b": lsn(9)}, complete=False)
    assert positions(log, spark) == {"a": lsn(5), "b": lsn(5), "c": lsn(1)}
    assert positions(log, spark, complete=False) == {"a": lsn(5), "b": lsn(9), "c": lsn(1)}


def test_a_commit_that_comes_second_is_merged_again(spark, tmp_path, monkeypatch):
    log, other = (OffsetLog(str(tmp_path / "log")) for _ in range(2))
    create, raced = offset_log.create_file, []

    def between(spark, path, text):
        if not raced:
            raced.append(path)
            other.save(spark, {"b": lsn(2)})
        return create(spark, path, text)

    monkeypatch.setattr(offset_log, "create_file", between)
    log.save(spark, {"a": lsn(1)})
    assert positions(log, spark) == {"a": lsn(1), "b": lsn(2)}
    assert log.history(spark) == [1, 2]


def test_many_writers_at_once(spark, tmp_path):
    path, failed = str(tmp_path / "log"), []

    def run(number):
        try:
            for i in range(1, 6):
                OffsetLog(path).save(spark, {f"t{number}": lsn(i), "all": lsn(10 * i + number)})
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=run, args=(n,)) for n in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failed
    assert positions(OffsetLog(path), spark) == {f"t{n}": lsn(5) for n in range(4)} | {"all": lsn(53)}


def test_taken_numbers_end_in_a_conflict(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(offset_log, "create_file", lambda *_: False)
    monkeypatch.setattr(offset_log, "TRIES", 3)
    with pytest.raises(CommitConflict):
        OffsetLog(str(tmp_path / "log")).save(spark, {"a": lsn(1)})


def test_old_commits_go_and_idle_saves_make_none(spark, tmp_path):
    log = OffsetLog(str(tmp_path / "log"))
    for i in range(1, 31):
        log.save(spark, {"a": lsn(i)})
        log.save(spark, {"a": lsn(i)})
    assert log.history(spark) == list(range(31 - offset_log.KEPT, 31))
    assert positions(log, spark) == {"a": lsn(30)}


def test_a_reset_is_not_undone_by_a_run_that_began_before(spark, tmp_path):
    log = OffsetLog(str(tmp_path / "log"))
    log.save(spark, {"a": lsn(50), "b": lsn(5)})
    eras = log.eras(spark)
    log.reset(spark, "a", lsn(10))
    log.save(spark, {"a": lsn(60), "b": lsn(6)}, eras=eras)
    assert positions(log, spark) == {"a": lsn(10), "b": lsn(6)}
    log.save(spark, {"a": lsn(20)}, eras=log.eras(spark))
    assert positions(log, spark) == {"a": lsn(20), "b": lsn(6)}


def test_polling_over_a_log_while_it_is_reset(spark, tmp_path):
    store = LoggedOffsets(str(tmp_path / "log"))
    tables = {"a": change_frame(spark, numbers(1, 20))}
    (tmp_path / "out").mkdir()
    inner = sink("publisher", publisher=Recorder(tmp_path / "out"))

    def reset_meanwhile(feed, batch):
        inner(feed, batch)
        store.log.reset(spark, "a", lsn(3))

    poll(spark, tables, reset_meanwhile, store, "q", 0)
    assert positions(store.log, spark) == {"a": lsn(3)}
    poll(spark, tables, inner, store, "q", 1)
    assert positions(store.log, spark) == {"a": lsn(20)}
    assert len(recorded(tmp_path / "out")) == 37


def test_a_stream_keeps_to_the_era_of_its_checkpoint(spark, tmp_path):
    store = LoggedOffsets(str(tmp_path / "log"))
    folder = str(tmp_path / "a")

    def run():
        change_frame(spark, numbers(1, 9)).coalesce(1).write.mode("append").parquet(folder)
        tables = {"a": stream_changes(spark, folder, with_file=True)}
        start_feed(
            tables, sink("parquet", path=str(tmp_path / "out")), str(tmp_path / "checkpoint"),
            store, trigger={"availableNow": True}, folders={"a": folder},
        ).awaitTermination()

    run()
    assert positions(store.log, spark) == {"a": lsn(9)}
    store.log.reset(spark, "a", lsn(2))
    run()
    assert positions(store.log, spark) == {"a": lsn(2)}


def test_a_plain_table_keeps_positions(spark, tmp_path):
    name = f"offsets_{uuid.uuid4().hex}"
    create_offsets_table(spark, name)
    try:
        store = CatalogOffsets(name, merge=False)
        tables = {"a": change_frame(spark, numbers(1, 20)), "b": change_frame(spark, numbers(1, 2))}
        (tmp_path / "out").mkdir()
        publisher = sink("publisher", publisher=Recorder(tmp_path / "out"))
        for i, newest in enumerate(({"a": lsn(5)}, {"a": lsn(5)}, None)):
            poll(spark, tables, publisher, store, "q", i, newest)
        assert len(recorded(tmp_path / "out")) == 22
        assert last_lsns(store.read(spark), tables) == {"a": lsn(20), "b": lsn(2)}
        compact_offsets_table(spark, name)
        assert spark.table(name).count() == 2
        assert last_lsns(store.read(spark), tables) == {"a": lsn(20), "b": lsn(2)}
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_gaps_are_rows(spark):
    tables = {
        "passed": change_frame(spark, numbers(8, 9)),
        "next": change_frame(spark, numbers(5, 9)),
        "there": change_frame(spark, numbers(4, 9)),
        "new": change_frame(spark, numbers(8, 9)),
        "empty": change_frame(spark, []),
    }
    saved = {"passed": lsn(4), "next": lsn(4), "there": lsn(4), "empty": lsn(4)}
    found = {r.table_name: r for r in retention_gaps(tables, saved).collect()}
    # whether 5 is the first change after 4 cannot be known
    assert {t for t, r in found.items() if r.gap} == {"passed", "next"}
    assert bytes(found["passed"].oldest) == lsn(8) and found["empty"].oldest is None
    told = retention_gaps(tables, saved, {"passed": lsn(4), "next": None}).collect()
    assert not any(r.gap for r in told)


def test_retention_that_passed_the_position_stops_the_look(spark, tmp_path, caplog):
    store = LoggedOffsets(str(tmp_path / "log"))
    (tmp_path / "out").mkdir()
    publisher = sink("publisher", publisher=Recorder(tmp_path / "out"))
    whole, rest = change_frame(spark, numbers(1, 20)), change_frame(spark, numbers(15, 20))
    poll(spark, {"a": whole}, publisher, store, "q", 0, {"a": lsn(10)}, on_gap="fail")
    with pytest.raises(RetentionGap, match="a: saved 0x0000000000000000000A"):
        poll(spark, {"a": rest}, publisher, store, "q", 1, on_gap="fail")
    assert len(recorded(tmp_path / "out")) == 10
    assert positions(store.log, spark) == {"a": lsn(10)}
    poll(spark, {"a": rest}, publisher, store, "q", 1, on_gap="warn")
    assert "may be missing" in caplog.text
    assert len(recorded(tmp_path / "out")) == 16
    with pytest.raises(ValueError):
        poll(spark, {"a": rest}, publisher, store, "q", 2, on_gap="stop")
