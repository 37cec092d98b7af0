"""Entries of documents, sent to buckets by a hash, as arrays; and answers sent back.

Corpus-wide counts of what is in a text need every text's entries (shingles, blocks) sorted by
name. A row for each entry would be costly. So a task gathers the entries of many documents, a
parcel, and sends one row for each bucket. A bucket's task answers with one row for each parcel,
and a parcel's answers meet with the ids of its documents, which travel once. An entry of a
document is sent once, so no frequent name makes a bucket large beyond one entry for a document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidefeed.llm.shared import chunks, flat, lists, utf8

#: Entries of a parcel, more or less.
GATHERED = 3 << 19

SENT = (
    "bucket long, parcel long, ids array<long>, versions array<long>, sizes array<int>, "
    "docs array<int>, owners array<long>, counts array<int>, names array<long>, wholes array<long>, "
    "places array<int>, tokens array<int>, sides array<int>"
)
ANSWER = (
    "parcel long, ids array<long>, versions array<long>, sizes array<int>, docs array<int>, "
    "counts array<int>, marks array<int>"
)
FOUND = "id long, version long, n long, count long, marks array<int>"

_KINDS = {
    "names": pa.int64(),
    "wholes": pa.int64(),
    "places": pa.int32(),
    "tokens": pa.int32(),
    "sides": pa.int32(),
}


class Outbox:
    """Gathers documents with their entries and sends parcels."""

    def __init__(self, buckets: int, with_owners: bool = False):
        """``with_owners``: buckets get the ids of documents too, to compare them."""
        self.with_owners = with_owners
        self.buckets, self.sent = buckets, TaskContext.get().partitionId() << 32
        self.held: list = []
        self.n = self.documents = 0

    def add(self, ids, versions, row, bucket, **entries) -> Iterator[pa.RecordBatch]:
        """``row``: the document of each entry, in order; ``bucket``: hashes of the entries."""
        bucket = (bucket % np.uint64(self.buckets)).astype(np.int32)
        sizes = np.bincount(row, minlength=len(ids)).astype(np.int32)
        row = (row + self.documents).astype(np.int32)
        self.held.append((ids, versions, sizes, row, bucket, *entries.values()))
        self.kinds = list(entries)
        self.n, self.documents = self.n + len(row), self.documents + len(ids)
        if self.n + self.documents >= GATHERED:
            yield from self.send()

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.documents:
            return
        ids, versions, sizes, row, bucket, *entries = map(
            np.concatenate, zip(*self.held, strict=True)
        )
        order = np.argsort(bucket, kind="stable")
        bucket, row = bucket[order], row[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (bucket[1:] != bucket[:-1])
        runs = np.flatnonzero(new)
        lengths = np.diff(np.append(runs, len(row))).astype(np.int32)
        numbers, documents = np.unique(bucket[runs], return_counts=True)
        of_bucket = np.unique(bucket, return_counts=True)[1]
        # the last row has the documents themselves, and goes to a bucket without entries
        alone = self.buckets + (self.sent >> 32) % self.buckets
        rows = len(numbers)
        last = np.append(np.zeros(rows, np.int64), len(ids))
        columns = {
            "bucket": pa.array(np.append(numbers.astype(np.int64), alone)),
            "parcel": pa.array(np.full(rows + 1, self.sent)),
            "ids": lists(ids, last),
            "versions": lists(versions, last),
            "sizes": lists(sizes, last),
            "docs": lists(row[runs], np.append(documents, 0)),
            "owners": lists(ids[row[runs]], np.append(documents, 0))
            if self.with_owners
            else pa.nulls(rows + 1, pa.list_(pa.int64())),
            "counts": lists(lengths, np.append(documents, 0)),
        }
        got = dict(zip(self.kinds, entries, strict=True))
        for name, kind in _KINDS.items():
            if name in got:
                values = got[name][order].view(kind.to_pandas_dtype())
                columns[name] = lists(values, np.append(of_bucket, 0))
            else:
                columns[name] = pa.nulls(rows + 1, pa.list_(kind))
        yield pa.RecordBatch.from_pydict(columns)
        self.sent, self.held, self.n, self.documents = self.sent + 1, [], 0, 0


def texts(batch: pa.RecordBatch):
    """(first row, last row, ids, versions, bytes, offsets) of the chunks of a batch of texts."""
    data, offsets = utf8(batch.column("text"))
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    versions = batch.column("version").to_numpy(zero_copy_only=False)
    for a, b in chunks(offsets):
        part = data[offsets[a] : offsets[b]]
        yield a, b, ids[a:b], versions[a:b], part, offsets[a : b + 1] - offsets[a]


class Entries:
    """What a bucket has got: for each entry its run (one document of one parcel)."""

    def __init__(self, got: pa.Table):
        self.counts, self.runs = flat(got.column("counts"))
        self.docs, _ = flat(got.column("docs"))
        self.parcels = got.column("parcel").to_numpy()
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        self.got = got

    def values(self, name: str) -> np.ndarray:
        return flat(self.got.column(name))[0]

    def answer(self, counts: np.ndarray, marks: np.ndarray) -> pa.Table:
        """A row for each parcel: runs with a count that is not zero, and their marks, by run."""
        some = counts > 0
        source = np.repeat(np.arange(len(self.runs)), self.runs)
        runs = np.bincount(source[some], minlength=len(self.runs))
        n_marks = np.zeros(len(self.runs), np.int64)
        if len(marks):
            np.add.at(n_marks, source, counts)
        rows = len(self.parcels)
        none = np.zeros(rows, np.int64)
        return pa.table(
            {
                "parcel": self.parcels,
                "ids": lists(np.zeros(0, np.int64), none),
                "versions": lists(np.zeros(0, np.int64), none),
                "sizes": lists(np.zeros(0, np.int32), none),
                "docs": lists(self.docs[some], runs),
                "counts": lists(counts[some].astype(np.int32), runs),
                "marks": lists(marks.astype(np.int32), n_marks),
            }
        )


def _joined(got: pa.Table) -> pa.Table:
    ids, _ = flat(got.column("ids"))
    versions, _ = flat(got.column("versions"))
    sizes, _ = flat(got.column("sizes"))
    docs, _ = flat(got.column("docs"))
    counts, _ = flat(got.column("counts"))
    marks, _ = flat(got.column("marks"))
    total = np.bincount(docs, counts, len(ids)).astype(np.int64)
    lengths = np.zeros(len(ids), np.int64)
    if len(marks):
        lengths = total
        marks = marks[np.argsort(np.repeat(docs, counts), kind="stable")]
    return pa.table(
        {
            "id": ids,
            "version": versions,
            "n": sizes.astype(np.int64),
            "count": total,
            "marks": lists(marks, lengths),
        }
    )


def answered(
    docs: DataFrame,
    send: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    decide: Callable[[Entries], pa.Table],
    buckets: int,
) -> DataFrame:
    """(id, version, n, count, marks) of every document: its entries, and what ``decide`` said."""

    def one_bucket(got: pa.Table) -> pa.Table:
        if got.column("bucket")[0].as_py() >= buckets:
            return got.select(
                ["parcel", "ids", "versions", "sizes", "docs", "counts"]
            ).append_column("marks", got.column("counts"))
        return decide(Entries(got))

    answers = docs.mapInArrow(send, SENT).groupBy("bucket").applyInArrow(one_bucket, ANSWER)
    return answers.groupBy("parcel").applyInArrow(_joined, FOUND)
