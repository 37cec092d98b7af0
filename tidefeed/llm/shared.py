"""What the operators share: written tables, keys of rows, text as bytes, rolling hashes."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.workspace import new_folder, remove_folder

#: Bytes of text that a task works on at a time: what fits a core's cache.
CHUNK = 1 << 20
#: Stands for a null id: it comes after every other one.
LAST_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files of finished steps now, not at some later collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Folders written so far in each open ``scratch``, innermost last.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what ``staged`` wrote meanwhile, but for what it was told to keep."""
    folders: list[str] = []
    token = _open.set((*_open.get(), folders))
    try:
        yield
    finally:
        _open.reset(token)
        for folder in folders:
            remove_folder(spark, folder)


def staged(
    frame: DataFrame, purpose: str, keep: bool = False, by: str | None = None
) -> DataFrame:
    """``frame``, written to the shared folder and read again.

    What follows survives lost executors, because it starts from files. The shuffle files of what
    came before are released (before the step too: listeners may have held the last step's plan
    until now), so that a job of many steps needs the disk of its largest step. In a ``scratch``
    the files are deleted at its end; ``keep`` leaves them to the scratch around it, if any. With
    ``by``, a column of few values, later filters on it read only those values' files.
    """
    spark = frame.sparkSession
    folder = new_folder(spark, purpose)
    scratches = _open.get()[: -1 if keep else None]
    if scratches:
        scratches[-1].append(folder)
    release(spark)
    frame.write.parquet(folder, partitionBy=by)
    release(spark)
    return spark.read.schema(frame.schema).parquet(folder)


def row_id(column: str = "doc_id") -> Column:
    """The id as a long; a null id counts as larger than all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def real_id(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != LAST_ID, column)


def same_row(docs: DataFrame, other: DataFrame, text: str = "text") -> Column:
    """Joins ``docs`` to a table with doc_id and version, null ids and null texts too."""
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    mine = F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID))
    return (mine == F.coalesce(other["doc_id"], F.lit(LAST_ID))) & (
        F.xxhash64(body) == other["version"]
    )


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(id, version, text) of each distinct row: rows of one id and one text are one document."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(row_id().alias("id"), body.alias("text")).select(
        "id", F.xxhash64("text").alias("version"), "text"
    )


# Text in Arrow batches


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one more offset than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = ends.astype(np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about ``size`` bytes; a longer row stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


# Hashes modulo 2**64


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit value scattered over all 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers 0 to n - 1 of the rolling hash's base, or of its inverse."""
    name = "inverse" if inverse else "base"
    have = _powers.get(name)
    if have is None or len(have) < n:
        step = np.full(max(n, 2 * CHUNK), _INVERSE if inverse else _BASE, np.uint64)
        step[0] = 1
        have = _powers[name] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


class Rolling:
    """Hashes of any byte range of ``data``, each in constant time."""

    def __init__(self, data: np.ndarray):
        terms = _BYTES[data] * powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:], dtype=np.uint64)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        unshift = powers(len(self.sums), inverse=True)
        return (self.sums[end] - self.sums[start]) * unshift[start]

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of data[start:end]; the length is part of the hash."""
        length = (end - start).astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7)
        return mixed(self.raw(start, end) ^ length)

    def windows(self, width: int) -> np.ndarray:
        """Of all ranges of ``width`` bytes, by start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[width:] - self.sums[:n]) * powers(n, inverse=True))


# Lists in Arrow columns


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and the length of each list."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), counts.astype(np.int64)
