"""Streams of files that complete their positions by themselves."""

import os

import pytest

from rows import Recorder, change, change_frame, lsn, recorded
from test_streaming import NOW, Site, numbers
from tidefeed import sink, start_feed
from tidefeed.sources import stream_changes
from tidefeed.streaming.frontier import lsn_before


class Followed(Site):
    def run(self, sink, *tables, checkpoint="checkpoint", after=None, max_files=None, **options):
        folders = {t: str(self.folder / t) for t in tables}
        streams = {
            t: stream_changes(self.spark, path, max_files=max_files, with_file=True)
            for t, path in folders.items()
        }
        place = str(self.folder / checkpoint)
        query = start_feed(
            streams, sink, place, self.offsets, after, trigger=NOW, folders=folders, **options
        )
        query.awaitTermination()
        return query


@pytest.fixture
def site(spark, tmp_path):
    return Followed(spark, tmp_path)


def stops_at(batch_id, inner):
    def run(feed, batch):
        assert "source_file" not in feed.columns
        if batch.batch_id == batch_id:
            raise RuntimeError("stopped")
        return inner(feed, batch)

    return run


def test_files_out_of_order_with_a_failure_between(site):
    """Files 11 to 20, then 1 to 10: the position waits for the older files."""
    for i in [*range(11, 21), *range(1, 11)]:
        site.add("a", [change(i, i, 2, i)])
    publisher = sink("publisher", publisher=Recorder(site.out))
    with pytest.raises(Exception, match="stopped"):
        site.run(stops_at(12, publisher), "a", max_files=1)
    assert {i for _, i in site.seen()} == {*range(11, 21), 1, 2}
    assert site.complete("a") == {"a": lsn(2)}
    # from the store alone
    site.run(publisher, "a", checkpoint="fresh")
    assert {i for _, i in site.seen()} == set(range(1, 21))
    assert site.complete("a") == {"a": lsn(20)}
    before = len(site.seen())
    site.run(publisher, "a", checkpoint="third")
    assert len(site.seen()) == before


def test_a_run_goes_on_from_its_checkpoint(site):
    for rows in (numbers(11, 20), numbers(1, 10), numbers(5, 25)):
        site.add("a", rows)
    publisher = sink("publisher", publisher=Recorder(site.out))
    with pytest.raises(Exception, match="stopped"):
        site.run(stops_at(1, publisher), "a", max_files=1)
    assert site.complete("a") == {"a": lsn(0)}
    site.run(publisher, "a", max_files=1)
    assert len(site.seen()) == 41
    assert site.complete("a") == {"a": lsn(25)}


def test_a_late_file_takes_the_position_back_until_it_is_read(site):
    site.add("a", numbers(11, 20))
    publisher = sink("publisher", publisher=Recorder(site.out))
    site.run(publisher, "a")
    assert site.complete("a") == {"a": lsn(20)}
    site.add("a", numbers(21, 22))
    site.add("a", numbers(6, 8))
    with pytest.raises(Exception, match="stopped"):
        site.run(stops_at(2, publisher), "a", max_files=1)
    assert site.complete("a") == {"a": lsn(5)}
    site.run(publisher, "a", checkpoint="fresh")
    assert {i for _, i in site.seen()} == {6, 7, 8, *range(11, 23)}
    assert site.complete("a") == {"a": lsn(22)}


def test_files_without_wanted_changes_hold_nothing_up(site):
    """Older than the start, without an LSN, empty, or of before-images alone."""
    site.add("a", numbers(11, 20))
    site.add("a", numbers(1, 5))
    site.add("a", [change(None, 1, 2, 1)])
    site.add("a", [])
    site.add("a", [change(12, 12, 3, 12)])
    site.add("b", numbers(1, 2))
    publisher = sink("publisher", publisher=Recorder(site.out))
    with pytest.raises(Exception, match="stopped"):
        site.run(
            stops_at(1, publisher), "a", "b", after={"a": lsn(10)}, max_files=1, before_image="drop"
        )
    assert site.complete("a", "b") == {"a": lsn(20), "b": lsn(2)}


def test_tables_wait_for_their_own_files_alone(site):
    for table, parts in (("a", ((1, 5), (6, 9))), ("b", ((6, 9), (1, 5)))):
        for first, last in parts:
            site.add(table, numbers(first, last))
    publisher = sink("publisher", publisher=Recorder(site.out))
    with pytest.raises(Exception, match="stopped"):
        site.run(stops_at(1, publisher), "a", "b", max_files=1)
    assert site.complete("a", "b") == {"a": lsn(5), "b": lsn(0)}


def test_a_file_is_looked_at_once(site, spark):
    for i in range(4, 0, -1):
        site.add("a", numbers(i, i))
    site.run(sink("publisher", publisher=Recorder(site.out)), "a", max_files=1)
    ledger = spark.read.parquet(str(site.folder / "checkpoint" / "tidefeed-files" / "first"))
    assert ledger.count() == 3 and ledger.select("source_file").distinct().count() == 3


def test_it_needs_to_know_the_files(site):
    site.add("a", numbers(1, 2))
    streams = {"a": stream_changes(site.spark, str(site.folder / "a"))}
    with pytest.raises(ValueError, match="do not tell their files"):
        start_feed(streams, print, str(site.folder / "c"), folders={"a": str(site.folder / "a")})


def test_lsn_before():
    assert lsn_before(lsn(256)) == lsn(255) and lsn_before(lsn(0)) == lsn(0)


@pytest.mark.parametrize("damage", ["no files", "no folder"])
def test_a_start_marker_that_was_half_written_is_written_again(site, damage):
    site.add("a", numbers(1, 20))
    marker = site.folder / "checkpoint" / "tidefeed-start"
    if damage == "no files":
        (marker / "_temporary" / "0").mkdir(parents=True)
    publisher = sink("publisher", publisher=Recorder(site.out))
    Site.run(site, publisher, "a")
    assert len(recorded(site.out)) == 20
    assert any(name.endswith(".parquet") for name in os.listdir(marker))
    Site.run(site, publisher, "a")
    assert len(recorded(site.out)) == 20
