"""Sum-of-squares packing of tokenised documents into sequences of a fixed length.

A document is its token ids and one end id. Only longer ones are cut: their last pieces are full,
and the first one takes what is left. Pieces are dealt at random into groups of bounded size, and
a task packs a group. It keeps how many open sequences have each residual gap, and puts a piece
where the sum of the squared counts becomes smallest. Ties go to the smallest gap, pieces come
longest first, and a new sequence is opened only where no open one has room: opening one to even
out the counts serves an endless stream of pieces, not a table to be packed into few sequences.

Groups are independent, so the number of sequences is that of one packing plus at most the last,
unfilled ones of each group (``GROUP`` pieces make some ten thousand sequences).

Null texts are empty; an empty document is its end id. Rows of one id are packed one by one, and
identical rows too. A null id stays null. An empty table gives no rows. Further
columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.byte_bpe import default_file, encoder
from tidefeed.llm.shared import chunks, staged, utf8

LENGTH = 2048
END = 0
#: Pieces that a task packs together, on average.
GROUP = 40_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(file: str, length: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(file).ids
        end = np.array([END], np.uint32)
        for batch in batches:
            _, offsets = utf8(batch.column("text"))
            for a, b in chunks(offsets):
                texts = batch.column("text").slice(a, b - a).fill_null("").to_pylist()
                row, piece, start, size, crc, ids = [], [], [], [], [], []
                for i, text in enumerate(texts):
                    raw = np.concatenate([ids_of(text), end]).tobytes()
                    n, at, k = len(raw) // 4, 0, 0
                    step = n % length or min(n, length)
                    while at < n:
                        body = raw[4 * at : 4 * (at + step)]
                        row.append(a + i)
                        piece.append(k)
                        start.append(at)
                        size.append(step)
                        crc.append(zlib.crc32(body))
                        if with_ids:
                            ids.append(body)
                        at, k, step = at + step, k + 1, length
                columns = [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return cut


def token_pieces(
    docs: DataFrame, file: str | None = None, length: int = LENGTH, with_ids: bool = False
) -> DataFrame:
    """The pieces of each document, and with ``with_ids`` their ids (32 bits, little-endian)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = PIECES + ", ids binary" * with_ids
    return rows.mapInArrow(_pieces(file or default_file(), length, with_ids), schema)


def sum_of_squares(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each piece, longest first, its sequence and its place there."""
    bins, places = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    count = np.zeros(length + 1, np.int64)  # of open sequences, by gap
    by_gap: list[list[int]] = [[] for _ in range(length + 1)]
    made = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        before = count[size:length]
        gap = length
        if before.any():
            # a gap g with n sequences becomes n - 1, and g - size with m becomes m + 1
            change = 2 * (count[: length - size] - before) + 2
            change[0] = 1 - 2 * before[0]  # it fills up, and no gap is left to count
            change[before == 0] = np.iinfo(np.int64).max
            gap = size + int(np.argmin(change))
        if gap == length:
            at, made = made, made + 1
        else:
            at = by_gap[gap].pop()
            count[gap] -= 1
        bins[i], places[i] = at, length - gap
        if gap > size:
            by_gap[gap - size].append(at)
            count[gap - size] += 1
    return bins, places


def packed(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` with sequence_id and offset. They are read twice, so give a written table."""
    n = pieces.count()
    groups = max(1, -(-n // GROUP))
    names = [c for c in pieces.columns]

    def pack(got: pa.Table) -> pa.Table:
        bins, places = sum_of_squares(got.column("length").to_numpy(), length)
        number = got.column("part")[0].as_py() << 32
        out = got.select(names)
        return out.append_column("sequence_id", pa.array(number + bins)).append_column(
            "offset", pa.array(places)
        )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    place = F.monotonically_increasing_id()
    dealt = F.pmod(F.xxhash64("doc_id", "piece", place), F.lit(groups))
    return (
        pieces.withColumn("part", dealt)
        .groupBy("part")
        .applyInArrow(pack, f"{kinds}, sequence_id long, offset long")
    )


def pack_documents(
    docs: DataFrame, file: str | None = None, length: int = LENGTH, with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of each piece."""
    return packed(staged(token_pieces(docs, file, length, with_ids), "pieces"), length)
