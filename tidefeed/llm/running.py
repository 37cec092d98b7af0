"""Running sums within groups that may be larger than a task: ranges, and what each carries on.

Rows are sorted by group and order into ranges, each of which sums up what it holds and is
written. Only the first group of a range can have begun before it, so one row for each range is
enough to tell what every range has to add.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.llm.shared import staged

Values = Callable[[pa.RecordBatch], Sequence[np.ndarray]]


def running(
    frame: DataFrame, group: str, order: Sequence[str], values: Values, sums: Sequence[str]
) -> DataFrame:
    """``frame`` with ``sums``: of a row's ``values`` and those before it in its ``group``.

    ``group`` is a long without nulls, and the first of ``sums`` is ``_n``, of ones. Sums are of 64 bits and wrap around. Rows that tie in
    ``order`` come in the order of their input and spread over ranges too.
    """
    columns, names = list(frame.columns), list(sums)
    tied = frame.withColumn("_tie", F.monotonically_increasing_id())
    keys = [group, *order, "_tie"]
    ranges = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    fields = [*frame.schema.fields, *[T.StructField(n, T.LongType()) for n in names]]
    summed = T.StructType([*fields, T.StructField("_range", T.IntegerType())])
    within = staged(ranges.mapInArrow(_within(group, values, names), summed), "ranges")
    ends = within.groupBy("_range").agg(
        F.min(group).alias("head"),
        F.max(group).alias("tail"),
        F.max_by(F.struct(*names), F.struct(group, "_n")).alias("last"),
    )
    carried, before = {}, None
    for end in ends.orderBy("_range").collect():  # one row for each range
        if before is not None and before.tail == end.head:
            add = np.array(before.last, np.int64)
            if before.head == before.tail:
                add = add + carried.get(before["_range"], (0, 0))[1]
            carried[end["_range"]] = (end.head, add)
        before = end

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column(group).to_numpy()
            at = batch.column("_range").to_numpy()
            total = [batch.column(n).to_numpy().copy() for n in names]
            for number in np.unique(at).tolist():
                if number in carried:
                    head, more = carried[number]
                    here = (at == number) & (of == head)
                    for sums_of, x in zip(total, more, strict=True):
                        sums_of[here] += x
            arrays = [batch.column(c) for c in columns] + [pa.array(t) for t in total]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, *names])

    return within.mapInArrow(add, T.StructType(fields))


def _within(group: str, values: Values, names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, last, held = TaskContext.get().partitionId(), None, [0] * len(names)
        for batch in batches:
            if not len(batch):
                continue
            of = batch.column(group).to_numpy()
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            run_of = np.cumsum(np.append(True, of[1:] != of[:-1])) - 1
            arrays = []
            for i, value in enumerate(values(batch)):
                sums = np.cumsum(value, dtype=np.int64)
                base = sums[starts] - value[starts]
                if of[0] == last:
                    base[0] -= held[i]
                sums = sums - base[run_of]
                held[i] = sums[-1]
                arrays.append(pa.array(sums))
            last = of[-1]
            arrays.append(pa.array(np.full(len(of), number, np.int32)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], [*batch.schema.names, *names, "_range"]
            )

    return run
