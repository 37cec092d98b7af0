"""Saved positions: lookup, upsert, high-water marks."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from rows import change, change_frame, lsn
from tidefeed import change_feed, mixed_feed_since
from tidefeed.functions import ZERO_LSN, lsn_number, lsn_of_number
from tidefeed.operators import (
    compact_offsets,
    complete_offsets,
    create_offsets_table,
    empty_offsets,
    envelopes,
    fan_in,
    feed_high_water,
    last_lsns,
    merge_offsets,
    merge_offsets_into,
    offsets_frame,
    progress,
    read_offsets,
    reset_offset,
    save_offsets,
    with_last_lsn,
)


def saved(frame):
    return {row.table_name: bytes(row.last_lsn) for row in frame.collect()}


def test_missing_store_is_empty(spark, tmp_path):
    store = read_offsets(spark, str(tmp_path / "none"))
    assert store.columns == empty_offsets(spark).columns == ["table_name", "last_lsn", "updated_at"]
    assert store.count() == 0


def test_an_unreadable_store_is_not_taken_for_an_empty_one(spark):
    with pytest.raises(Py4JJavaError, match="nosuchscheme"):
        read_offsets(spark, "nosuchscheme://x/y").count()


def test_positions_default_to_zero(spark):
    offsets = offsets_frame(spark, {"a": lsn(5), "other": lsn(9)})
    assert last_lsns(offsets, ["a", "b"]) == {"a": lsn(5), "b": ZERO_LSN}
    assert last_lsns(None, ["a"]) == {"a": ZERO_LSN}
    nulls = offsets.withColumn("last_lsn", F.lit(None).cast("binary"))
    assert last_lsns(nulls, ["a"]) == {"a": ZERO_LSN}


def test_save_is_an_upsert_that_replays_and_never_goes_back(spark, tmp_path):
    path = str(tmp_path / "offsets")
    save_offsets(spark, {"a": lsn(5), "b": lsn(7)}, path, "q")
    save_offsets(spark, {"a": lsn(9)}, path, "q")
    assert saved(read_offsets(spark, path)) == {"a": lsn(9), "b": lsn(7)}
    save_offsets(spark, {"a": lsn(9)}, path, "q")
    assert spark.read.parquet(path).count() == 4
    save_offsets(spark, {"a": lsn(2)}, path, "fresh checkpoint")
    save_offsets(spark, {"c": lsn(0x80)}, path, "fresh checkpoint")
    assert saved(read_offsets(spark, path)) == {"a": lsn(9), "b": lsn(7), "c": lsn(0x80)}


def test_the_store_does_not_grow_with_batches(spark, tmp_path):
    path = tmp_path / "offsets"
    for batch in range(7):
        save_offsets(spark, {f"t{batch}": lsn(batch + 1)}, str(path), "q")
    assert sorted(leaf.name for leaf in (path / "query_id=q").iterdir()) == ["slot=0", "slot=1"]
    assert saved(read_offsets(spark, str(path))) == {f"t{i}": lsn(i + 1) for i in range(7)}


def older_leaf(spark, path):
    leaves = spark.read.parquet(str(path)).groupBy("slot").agg(F.max("save").alias("save"))
    return leaves.orderBy("save").first().slot


def test_batches_that_save_nothing_between_do_not_endanger_the_newest_save(spark, tmp_path):
    path = tmp_path / "offsets"
    # Batches 0 and 2 save, batch 1 has no changes and saves nothing.
    save_offsets(spark, {"a": lsn(1)}, str(path), "q")
    save_offsets(spark, {"a": lsn(2)}, str(path), "q")
    assert len(list((path / "query_id=q").iterdir())) == 2
    for file in (path / "query_id=q" / f"slot={older_leaf(spark, path)}").iterdir():
        file.unlink()
    assert saved(read_offsets(spark, str(path))) == {"a": lsn(2)}


def test_what_was_seen_is_not_where_to_read_on(spark, tmp_path):
    path = str(tmp_path / "offsets")
    save_offsets(spark, {"a": lsn(5)}, path, "q")
    save_offsets(spark, {"a": lsn(9)}, path, "q", complete=False)
    assert saved(read_offsets(spark, path)) == {"a": lsn(5)}
    assert saved(read_offsets(spark, path, complete=False)) == {"a": lsn(9)}
    complete_offsets(spark, path, "q")
    assert saved(read_offsets(spark, path)) == {"a": lsn(9)}


def test_a_position_goes_back_only_when_it_is_reset(spark, tmp_path):
    path = str(tmp_path / "offsets")
    save_offsets(spark, {"a": lsn(50), "b": lsn(7)}, path, "q")
    reset_offset(spark, path, "a", lsn(3))
    assert saved(read_offsets(spark, path)) == {"a": lsn(3), "b": lsn(7)}
    save_offsets(spark, {"a": lsn(8)}, path, "q")
    assert saved(read_offsets(spark, path)) == {"a": lsn(8), "b": lsn(7)}
    reset_offset(spark, path, "b")
    assert saved(read_offsets(spark, path)) == {"a": lsn(8), "b": ZERO_LSN}


def test_a_batch_that_died_while_saving_leaves_the_positions_before_it(spark, tmp_path):
    path = tmp_path / "offsets"
    for batch in range(3):
        save_offsets(spark, {"a": lsn(batch + 1), "b": lsn(9)}, str(path), "q")
    # The next save goes to the leaf that does not hold the newest, and dies when it has emptied it.
    for file in (path / "query_id=q" / f"slot={older_leaf(spark, path)}").iterdir():
        file.unlink()
    assert saved(read_offsets(spark, str(path))) == {"a": lsn(3), "b": lsn(9)}
    save_offsets(spark, {"a": lsn(4)}, str(path), "q")
    assert saved(read_offsets(spark, str(path))) == {"a": lsn(4), "b": lsn(9)}


def test_time_goes_with_the_newest_position(spark):
    rows = "VALUES ('a', X'02', TIMESTAMP '2024-01-01'), ('a', X'03', TIMESTAMP '2023-01-01')"
    frame = spark.sql(f"SELECT * FROM {rows} AS t(table_name, last_lsn, updated_at)")
    row = merge_offsets(frame).first()
    assert (bytes(row.last_lsn), row.updated_at.year) == (b"\x03", 2023)


def test_compaction_keeps_positions_and_the_old_store(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    for batch in range(4):
        save_offsets(spark, {"a": lsn(batch), "b": lsn(9 - batch)}, old, "q")
    compact_offsets(spark, old, new)
    assert saved(read_offsets(spark, new)) == saved(read_offsets(spark, old))
    assert spark.read.parquet(new).select("query_id").distinct().count() == 1
    save_offsets(spark, {"a": lsn(70)}, new, "q")
    assert saved(read_offsets(spark, new))["a"] == lsn(70)
    with pytest.raises(ValueError, match="already"):
        compact_offsets(spark, old, new)


def test_offsets_as_a_catalog_table(spark):
    create_offsets_table(spark, "cdc_offsets_test")
    create_offsets_table(spark, "cdc_offsets_test")
    try:
        assert spark.table("cdc_offsets_test").count() == 0
        offsets_frame(spark, {"a": lsn(1)}).write.insertInto("cdc_offsets_test")
        offsets_frame(spark, {"a": lsn(3)}).write.insertInto("cdc_offsets_test")
        assert last_lsns(spark.table("cdc_offsets_test"), ["a"]) == {"a": lsn(3)}
        # Plain parquet tables have no row-level operations; formats that do accept this.
        with pytest.raises(UnsupportedOperationException) as refused:
            merge_offsets_into(spark, "cdc_offsets_test", {"a": lsn(4)})
        assert refused.value.getCondition() == "UNSUPPORTED_FEATURE.TABLE_OPERATION"
    finally:
        spark.sql("DROP TABLE cdc_offsets_test")


def test_progress_of_new_old_and_empty_tables(spark):
    tables = {
        "new": change_frame(spark, [change(3, 1, 2, 1), change(9, 2, 2, 2), change(None, 3, 2, 3)]),
        "old": change_frame(spark, [change(3, 1, 2, 1)]),
        "empty": change_frame(spark, []),
        "untouched": change_frame(spark, []),
    }
    marks = progress(tables, {"new": lsn(3), "old": lsn(3), "empty": lsn(4)})
    found = {r.table_name: (bytes(r.high_water), r.changes_found, r.changes) for r in marks.collect()}
    assert found == {
        "new": (lsn(9), True, 1),
        "old": (lsn(3), False, 0),
        "empty": (lsn(4), False, 0),
        "untouched": (ZERO_LSN, False, 0),
    }


def test_progress_needs_no_sort_and_reads_only_the_lsn(spark, tmp_path):
    path = str(tmp_path / "changes")
    change_frame(spark, [change(1, 1, 2, 1)]).write.parquet(path)
    marks = progress({"t": spark.read.parquet(path)}, {"t": lsn(1)})
    plan = marks._jdf.queryExecution().executedPlan().toString()
    assert "Sort [" not in plan
    assert "ReadSchema: struct<__$start_lsn:binary>" in plan


def test_high_water_of_a_mixed_feed(spark):
    feed = fan_in(
        envelopes(change_frame(spark, [change(i, i, 2, i) for i in range(1, top + 1)]), name)
        for name, top in (("a", 5), ("b", 0x80))
    )
    marks = {row.table_name: bytes(row.high_water) for row in feed_high_water(feed).collect()}
    assert marks == {"a": lsn(5), "b": lsn(0x80)}


def mixed(spark):
    frame = change_frame(spark, [change(i, i, 2, i) for i in range(1, 11)])
    return {name: frame for name in ("a", "b", "c")}


def test_high_water_is_never_sorted_for(spark):
    feed = fan_in(envelopes(changes, name) for name, changes in mixed(spark).items())
    for marks in (feed_high_water(feed), feed_high_water(feed, ["a", "b", "none"])):
        assert "Sort [" not in marks._jdf.queryExecution().executedPlan().toString()
    marks = {r.table_name: r.high_water for r in feed_high_water(feed, ["a", "none"]).collect()}
    assert marks == {"a": lsn(10), "none": None}


def test_lsn_numbers_round_trip(spark):
    lsns = [lsn(0), lsn(0x80), lsn((1 << 40) - 1), lsn(1 << 40), bytes([0xFF] * 10)]
    frame = spark.createDataFrame([(x,) for x in lsns], "lsn BINARY")
    back = frame.select("lsn", lsn_of_number(lsn_number("lsn")).alias("back")).collect()
    assert [bytes(r.back) for r in back] == [bytes(r.lsn) for r in back]


def test_lookup_by_join_equals_lookup_by_literal(spark):
    tables = mixed(spark)
    offsets = offsets_frame(spark, {"a": lsn(4), "b": lsn(10), "unwatched": lsn(1)})
    feed = fan_in(envelopes(changes, name) for name, changes in tables.items())
    joined = with_last_lsn(feed, offsets)
    assert joined.count() == 30

    by_join = mixed_feed_since(feed, offsets)
    by_literal = change_feed(tables, last_lsns(offsets, tables))
    assert sorted(by_join.collect()) == sorted(by_literal.collect())
    assert by_join.count() == 6 + 0 + 10


def test_lookup_tolerates_repeated_offset_rows(spark):
    offsets = offsets_frame(spark, {"a": lsn(4)}).union(offsets_frame(spark, {"a": lsn(8)}))
    feed = envelopes(mixed(spark)["a"], "a")
    assert mixed_feed_since(feed, offsets).count() == 2
