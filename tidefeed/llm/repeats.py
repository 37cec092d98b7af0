"""Which documents are made of shingles that other documents have too.

Only such a document can have a near copy, and telling needs a count of every shingle of the
corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.exchange import Entries, Outbox, answered, texts
from tidefeed.llm.shingles import shingles

#: Shingles that a bucket holds on average.
IN_BUCKET = 3 << 20


def _send(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Outbox(buckets)
        for batch in batches:
            for _, _, ids, versions, data, offsets in texts(batch):
                values, sizes = shingles(data, offsets)
                row = np.repeat(np.arange(len(sizes)), sizes)
                tokens = (values >> np.uint64(32)).astype(np.uint32)
                low = values & np.uint64(0xFFFFFFFF)
                yield from out.add(ids, versions, row, low, tokens=tokens)
        yield from out.send()

    return send


def _count(entries: Entries) -> pa.Table:
    tokens = entries.values("tokens").view(np.uint32).astype(np.uint64)
    both = (tokens << np.uint64(32)) | entries.row.astype(np.uint64)
    both.sort()
    token = both >> np.uint64(32)
    same = np.zeros(len(token) + 1, bool)
    same[1:-1] = token[1:] == token[:-1]
    again = both[same[1:] | same[:-1]] & np.uint64(0xFFFFFFFF)
    repeated = np.bincount(again.astype(np.int64), minlength=len(entries.counts))
    return entries.answer(repeated, np.zeros(0, np.int32))


def shingle_repeats(docs: DataFrame) -> DataFrame:
    """(id, version, n, repeated, rows): shingles of each document, and those that others have too.

    ``docs`` comes from ``keyed``. 32 bits of hash within a bucket decide, so ``repeated`` may be
    too large by a very few, never too small. ``rows`` counts rows of the same id and text.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // (6 * IN_BUCKET)))
    found = answered(docs, _send(buckets), _count, buckets)
    return found.groupBy("id", "version").agg(
        F.max("n").alias("n"), F.max("count").alias("repeated"), F.count("*").alias("rows")
    )
