"""Reading a feed that was delivered at least once, so that each message counts once.

A message is known by its table, LSN, sequence value and operation. A stateful operator keeps the
names of those that it has let through, and lets no second one pass. What bounds its state are the
positions that the feed's writer completes: past changes are never published again, so their names
go. As a position is committed after what it covers, a reader may see it first; it takes effect a
batch later, when all messages before it have been read. So the reader takes all there is in each
batch: it has no ``maxFilesPerTrigger``.

A table's messages are dealt out to buckets by a hash, so that one large table is many groups, and
a bucket's to ``PAGES`` groups by another part of it. Spark sends a group's state along with every
10,000 of its rows and sorts all rows of a group in one task, so neither may grow with few buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

NAME = ("lsn", "seqval", "operation")
# Bytes of an LSN, and of the digest of the rest of a name.
LSN_BYTES, DIGEST = 10, 8
# Groups of a bucket. A checkpoint knows its names by group; Spark refuses one from before pages.
PAGES = 16
STATE = "names BINARY, position BINARY, coming BINARY"


def committed_positions(spark: SparkSession, path: str) -> DataFrame:
    """The complete positions of an ``OffsetLog`` as a stream of (table_name, last_lsn)."""
    row = "MAP<STRING, STRUCT<complete: STRING>>"
    reader = spark.readStream.schema("value STRING").option("ignoreMissingFiles", True)
    commits = reader.text(f"{path}/*.json", wholetext=True)
    rows = commits.select(F.explode(F.from_json("value", row)).alias("table_name", "row"))
    return rows.where("row.complete IS NOT NULL").select(
        "table_name", F.unhex("row.complete").alias("last_lsn")
    )


def read_once(
    messages: DataFrame, positions: DataFrame | None = None, buckets: int = 64
) -> DataFrame:
    """The rows of a streaming feed without those that were there before.

    ``messages`` has (table_name, lsn, seqval, operation) and other columns of plain types; of rows
    of one name any one passes. ``positions`` is a stream of (table_name, last_lsn), such as
    ``committed_positions``; without it names are kept for good.
    """
    columns = messages.columns
    deep = (T.ArrayType, T.MapType, T.StructType)
    nested = [f.name for f in messages.schema.fields if isinstance(f.dataType, deep)]
    if nested:
        raise ValueError(f"columns of nested types: {nested}")
    hashed = F.xxhash64(*NAME)
    group = [
        F.pmod(hashed, F.lit(buckets)).cast("int").alias("bucket"),
        F.pmod(F.shiftright(hashed, 32), F.lit(PAGES)).cast("int").alias("page"),
    ]
    whole = T.StructType(messages.schema.fields)
    rows = messages.select("table_name", *group, F.struct(*columns).alias("row"))
    rows = rows.withColumn("last_lsn", F.lit(None).cast("binary"))
    if positions is not None:
        every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")
        pages = F.explode(F.sequence(F.lit(0), F.lit(PAGES - 1))).alias("page")
        marks = positions.select("table_name", every, "last_lsn")
        marks = marks.select("table_name", "bucket", pages, "last_lsn")
        rows = rows.unionByName(marks.withColumn("row", F.lit(None).cast(whole)))
    # as text and bytes, which pandas leaves as they are where others are null
    names = [f"m_{i}" for i in range(len(columns))]
    kinds = [f.dataType if f.dataType == T.BinaryType() else T.StringType() for f in whole.fields]
    carried = [F.col(f"row.`{c}`").cast(k).alias(n) for c, k, n in zip(columns, kinds, names)]
    flat = rows.select(
        "table_name", "bucket", "page", "last_lsn", F.col("row").isNotNull().alias("is_row"), *carried
    )
    at = {name: f"m_{columns.index(name)}" for name in NAME}
    out_schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, position, coming = state.get if state.exists else (b"", b"", b"")
        seen, position = Names(bytes(seen)), max(bytes(position), bytes(coming))
        coming = bytes(coming)
        for frame in frames:
            marks = [bytes(x) for x in frame["last_lsn"] if x is not None]
            coming = max([coming, *marks])
            fresh = frame[frame["is_row"]]
            if len(fresh):
                new = seen.add([fresh[at[n]] for n in NAME])
                if new.any():
                    yield fresh.loc[new, names]
        seen.drop(position)
        state.update((seen.packed(), position, coming))

    once = flat.groupBy("table_name", "bucket", "page").applyInPandasWithState(
        run, out_schema, STATE, "append", GroupStateTimeout.NoTimeout
    )
    return once.select(*[F.col(n).cast(f.dataType).alias(f.name) for n, f in zip(names, whole.fields)])


class Names:
    """A set of message names, sorted, in a row of bytes each: the LSN, then a digest."""

    def __init__(self, packed: bytes = b""):
        self.rows = np.frombuffer(packed, f"V{LSN_BYTES + DIGEST}")

    def __len__(self) -> int:
        return len(self.rows)

    def packed(self) -> bytes:
        return self.rows.tobytes()

    def add(self, columns: list) -> np.ndarray:
        """Which of these names are new: the first of each that was not there."""
        made = []
        for lsn, seqval, operation in zip(*columns, strict=True):
            lsn = b"" if lsn is None else bytes(lsn)
            rest = repr((len(lsn), None if seqval is None else bytes(seqval), str(operation)))
            digest = hashlib.blake2b(rest.encode(), digest_size=DIGEST).digest()
            made.append(lsn.rjust(LSN_BYTES, b"\0")[-LSN_BYTES:] + digest)
        names, first = np.unique(
            np.frombuffer(b"".join(made), f"V{LSN_BYTES + DIGEST}"), return_index=True
        )
        at = np.searchsorted(self.rows, names)
        fresh = np.append(self.rows, names[:1])[at] != names if len(names) else np.zeros(0, bool)
        fresh |= at == len(self.rows)
        self.rows = np.insert(self.rows, at[fresh], names[fresh])
        new = np.zeros(len(made), bool)
        new[first[fresh]] = True
        return new

    def drop(self, position: bytes) -> None:
        """Forget what is not past a position."""
        if position and len(self.rows):
            last = position.rjust(LSN_BYTES, b"\0")[-LSN_BYTES:] + b"\xff" * DIGEST
            last = np.frombuffer(last, self.rows.dtype)
            self.rows = self.rows[int(np.searchsorted(self.rows, last, "right")[0]) :]
