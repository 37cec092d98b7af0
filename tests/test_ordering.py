"""Order and positions, also where one table or one set of copies holds most rows."""

import pytest
from pyspark.sql import functions as F

from rows import change, change_frame, lsn
from tidefeed import change_feed
from tidefeed.operators import envelopes, fan_in, in_order, with_position
from tidefeed.operators.ordering import by_range


def skewed_feed(spark, big=6000, small=40):
    """One table far larger than the others, in shuffled order, with tied LSNs."""

    def table(rows):
        numbers = spark.range(0, rows, 1, 4)
        return numbers.select(
            F.unhex(F.lpad(F.hex(F.expr("id DIV 7 + 1")), 20, "0")).alias("__$start_lsn"),
            F.unhex(F.lpad(F.hex("id"), 20, "0")).alias("__$seqval"),
            F.lit(2).alias("__$operation"),
            "id",
        ).orderBy(F.hash("id"))

    return change_feed({"big": table(big), "a": table(small), "z": table(small)})


def keys(rows):
    return [(r.table_name, bytes(r.lsn), bytes(r.seqval), r.operation) for r in rows]


def test_order_holds_across_partitions(spark):
    feed = skewed_feed(spark)
    rows = in_order(feed, partitions=6).collect()
    assert len(rows) == 6080
    assert keys(rows) == sorted(keys(rows))


def test_update_pair_of_one_position_is_ordered_by_operation(spark):
    frame = change_frame(spark, [change(5, 9, 4, 1), change(5, 9, 3, 1), change(5, 8, 2, 1)])
    rows = in_order(envelopes(frame, "t")).collect()
    assert [row.operation for row in rows] == [2, 3, 4]


def largest_share(frame):
    sizes = frame.groupBy(F.spark_partition_id()).count().select(F.max("count"), F.sum("count"))
    largest, total = sizes.first()
    return largest / total


def test_a_large_table_spreads_over_partitions(spark):
    assert largest_share(by_range(skewed_feed(spark), partitions=6)) < 0.3


def test_copies_of_one_row_spread_over_partitions(spark):
    copies = spark.range(0, 6000, 1, 4).select(
        F.lit(lsn(1)).alias("__$start_lsn"),
        F.lit(lsn(1)).alias("__$seqval"),
        F.lit(2).alias("__$operation"),
        F.lit("same").alias("name"),
    )
    feed = change_feed({"t": copies})
    assert largest_share(by_range(feed, partitions=6)) < 0.3
    positions = [row.position for row in with_position(feed, partitions=6).collect()]
    assert sorted(positions) == list(range(1, 6001))


@pytest.mark.parametrize("partitions", [1, 5, None])
def test_positions_count_each_table_in_log_order(spark, partitions):
    rows = with_position(skewed_feed(spark), partitions).collect()
    assert len(rows) == 6080
    for table, size in (("big", 6000), ("a", 40), ("z", 40)):
        mine = sorted((r for r in rows if r.table_name == table), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(1, size + 1))
        assert keys(mine) == sorted(keys(mine))


def test_positions_use_no_window_over_the_rows(spark):
    plan = with_position(skewed_feed(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "BroadcastHashJoin" in plan


def test_positions_of_nothing(spark):
    feed = change_feed({"t": change_frame(spark, [])})
    assert with_position(feed).count() == 0


def test_row_keys_can_be_the_order(spark):
    frame = change_frame(spark, [change(i, i, 2, i % 3) for i in range(1, 31)])
    feed = fan_in([envelopes(frame, "t", row_key=F.col("record.id"))])
    rows = in_order(feed, ["table_name", "row_key"], 4).collect()
    assert [(r.row_key, bytes(r.lsn)) for r in rows] == sorted((r.row_key, bytes(r.lsn)) for r in rows)
