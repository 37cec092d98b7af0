"""Order within each table of a feed, without putting a table into one task.

Rows are cut into ranges of table and log position, so a table that holds a third of all rows
spans a third of the ranges, and read in the order of ranges each table is in log order. The cuts
come from a sketch of the keys alone; rows then go to their ranges in one shuffle, by comparison
with the cuts. So a message is rendered once, in the task that sends it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.workspace import new_folder

# Position in the log; __$seqval and then the operation order the rows of one transaction.
LOG_ORDER = ("lsn", "seqval", "operation")

# monotonically_increasing_id puts the partition above this bit and the row number below it.
ROW_BITS = 33

# Keys that a sketch holds for each range; a range's size is then within about a quarter.
SKETCHED = 64
# Unless told otherwise, a range holds at least so many rows.
LEAST_ROWS = 10_000


def with_tie(feed: DataFrame) -> DataFrame:
    """The feed with ``_tie``, the row's place in its input partition: it spreads rows that tie in
    everything else, however many copies there are. In which range a copy ends is of no account,
    so the place may be another when a lost task is repeated."""
    return feed.withColumn("_tie", F.monotonically_increasing_id())


@dataclass(frozen=True)
class Cuts:
    """Where ranges of rows begin, but for the first: keys of ``names`` in ascending order."""

    schema: T.StructType
    keys: tuple[tuple, ...]

    @property
    def ranges(self) -> int:
        return len(self.keys) + 1

    def range_of(self) -> Column:
        """The number of a row's range, by a binary search over the cuts."""
        if not self.keys:
            return F.lit(0)
        cuts = F.array(*[_literal(key, self.schema) for key in self.keys])
        steps = [1 << i for i in reversed(range(len(self.keys).bit_length()))]
        key = F.struct(*self.schema.names)
        return F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda at, step: F.when(F.get(cuts, at + step - 1) <= key, at + step).otherwise(at),
        )


def _literal(key: Sequence, schema: T.StructType) -> Column:
    values = [bytes(v) if isinstance(v, bytearray) else v for v in key]
    return F.struct(
        *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, schema.fields)]
    )


def _sortable(key: Sequence) -> tuple:
    """A key as Python sorts it like Spark: null first, bytes unsigned, text as UTF-8."""
    return tuple(
        (v is not None, v.encode() if isinstance(v, str) else bytes(v) if isinstance(v, bytearray) else v)
        for v in key
    )


def cuts_of(tied: DataFrame, group: Sequence[str], partitions: int | None = None) -> Cuts:
    """Cuts that give at most ``partitions`` ranges of about the same number of rows.

    ``tied`` comes from ``with_tie``. Its keys are counted, and as many of them as the number of
    ranges calls for are picked by their hash: two passes over the keys' columns, which render no
    message. A cut that is the only one inside its ``group`` moves to where that group begins, so
    only groups larger than a range are cut.
    """
    names = [*group, *LOG_ORDER, "_tie"]
    keys = tied.select(*names)
    n = keys.count()
    if partitions is None:
        session = int(tied.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = min(session, -(-n // LEAST_ROWS))
    schema = keys.schema
    if partitions <= 1 or not n:
        return Cuts(schema, ())
    share = min(1.0, SKETCHED * partitions / n)
    picked = F.pmod(F.xxhash64(*names), F.lit(1 << 30)) < F.lit(round(share * (1 << 30)))
    sketch = sorted((tuple(row) for row in keys.where(picked).collect()), key=_sortable)
    marks = [sketch[i * len(sketch) // partitions] for i in range(1, partitions) if sketch]
    owners = [None, *[mark[: len(group)] for mark in marks], None]
    found: list[tuple] = []
    for before, own, after, mark in zip(owners, owners[1:], owners[2:], marks):
        alone = own not in (before, after)
        cut = (*own, *[None] * (len(names) - len(group))) if alone else mark
        if not found or _sortable(cut) > _sortable(found[-1]):
            found.append(cut)
    return Cuts(schema, tuple(found))


def by_range(
    feed: DataFrame, group: Sequence[str] = ("table_name",), partitions: int | None = None
) -> DataFrame:
    """The feed cut into contiguous ranges of ``group`` and log position, one per partition.

    Rows that tie in all of these are in no particular order, and ``_tie`` spreads them: however
    many copies a row has. One shuffle of the whole rows.
    """
    tied = with_tie(feed)
    cuts = cuts_of(tied, group, partitions)
    placed = tied.withColumn("_range", cuts.range_of())
    return placed.repartitionById(cuts.ranges, "_range").drop("_range")


def in_order(
    feed: DataFrame, group: Sequence[str] = ("table_name",), partitions: int | None = None
) -> DataFrame:
    """The feed with each ``group`` in log order, across partitions and within them."""
    ranges = by_range(feed, group, partitions)
    return ranges.sortWithinPartitions(*group, *LOG_ORDER, "_tie").drop("_tie")


def with_position(
    feed: DataFrame, partitions: int | None = None, folder: str | None = None
) -> DataFrame:
    """The feed with ``position``: 1, 2, 3, ... within each table, in log order.

    ``row_number`` over a window per table would collect a table into one task. Instead the
    ordered rows are numbered where they are and written once, which also fixes them against
    a lost executor; a small aggregate then tells how many rows of a table lie in earlier
    partitions. The result reads what was written: who gives ``folder`` deletes it afterwards,
    without it a new one is made under the shared folder.
    """
    spark = feed.sparkSession
    folder = folder or new_folder(spark, "ordered")
    ordered = in_order(feed, partitions=partitions)
    numbered = ordered.withColumn("_slot", F.monotonically_increasing_id())
    numbered.write.parquet(folder)
    rows = spark.read.schema(numbered.schema).parquet(folder)
    rows = rows.withColumn("_range", F.shiftright("_slot", ROW_BITS))

    ranges = rows.groupBy("table_name", "_range").agg(
        F.min("_slot").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # Ranges are contiguous, so there are at most as many of these rows as partitions and tables
    # together, and a table's window holds at most one per partition.
    earlier = Window.partitionBy("table_name").orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = ranges.select(
        "table_name",
        "_range",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    # A row per range and table. As a local table its size is known, and Spark broadcasts it or
    # not by its bytes; a join with an unknown side would shuffle the wide rows again.
    starts = spark.createDataFrame(starts.collect(), starts.schema)
    joined = rows.join(starts, ["table_name", "_range"])
    position = F.col("_slot") + F.col("_shift")
    return joined.select(*feed.columns, position.alias("position"))
