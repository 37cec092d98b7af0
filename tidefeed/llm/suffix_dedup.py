"""Removal of byte strings that an earlier document has, by bucket-pointer refinement.

Suffixes are sorted into buckets by their first ``Q`` bytes, and a bucket's number stands for
those bytes. Buckets that still hold suffixes of several documents are refined by the buckets at
later offsets; a bucket of one document is done. Sorting every suffix of a corpus costs several
times its size in shuffles, so only every string's own anchor goes into the first buckets:

1. Of the ``Q``-byte strings in a string of ``LENGTH`` bytes, the one with the least hash is its
   anchor. Equal strings have equal anchors at equal places. The strings of a document that share
   an anchor form a block of consecutive starts; there are about 18 starts to a block.
2. Tasks send each block's anchor and the number of all its bytes, as arrays for many documents.
   An anchor's bucket is refined by the bytes at later and at earlier offsets: a string goes on for
   half of its other bytes on one side of the anchor at least. A block whose bytes an earlier
   document has too is decided as a whole. Other blocks whose refined bucket has an earlier document
   are open, and with them what they may equal.
3. Only open blocks are refined to single strings: the numbers of the ``Q``-byte strings at
   offsets 0, Q, 2 Q and LENGTH - Q number the string, and the earliest document of each number keeps
   it. So long copies cost one number a block, and single strings are sent at ends of copies only.

Numbers are 64-bit hashes. Buckets are sized by the corpus and hold a few bytes for each block, so
a passage of a third of all documents spreads over as many buckets as it has anchors, and the
largest possible bucket has one entry for each document.

Null texts are empty. A null id is later than all others. Rows of one id are not earlier than each
other, so nothing is removed for a repeated row; every row gives a result row. Texts shorter than
``LENGTH`` bytes keep everything. Further columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.exchange import Entries, Outbox, answered, texts
from tidefeed.llm.shared import Rolling, flat, keyed, lists, mixed, real_id, scratch, staged

LENGTH, Q = 50, 16
#: Of a string's bytes besides its anchor at least so many are on one side of it.
SIDE = (LENGTH - Q) // 2
#: Blocks, or strings, that a bucket holds on average.
IN_BUCKET = 3 << 19


class Strings:
    """Anchors and blocks of the texts of a chunk."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.offsets = offsets
        self.rolling = Rolling(data)
        self.short = self.rolling.windows(Q)
        n = len(data) - LENGTH + 1
        starts = np.arange(max(n, 0))
        row = np.searchsorted(offsets, starts, side="right") - 1
        inside = starts + LENGTH <= offsets[row + 1]
        self.starts, self.row = starts[inside], row[inside]
        if not len(self.starts):
            self.anchor = self.first = self.last = self.of = np.zeros(0, np.int64)
            self.ordinal = np.zeros(0, np.int64)
            return
        place = np.arange(len(self.short), dtype=np.uint64)
        least = (self.short & np.uint64(0xFFFFFFFF00000000)) | place
        width = 1
        while 2 * width <= LENGTH - Q + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = LENGTH - Q + 1 - width
        least = np.minimum(least[: len(least) - rest], least[rest:])
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)[inside]
        new = np.ones(len(anchor), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        at = np.flatnonzero(new)
        self.anchor = anchor[at]
        self.first = self.starts[at]
        self.last = self.starts[np.append(at[1:], len(anchor)) - 1]
        self.of = self.row[at]
        blocks_before = np.searchsorted(self.of, np.arange(len(offsets) - 1))
        self.ordinal = np.arange(len(at)) - blocks_before[self.of]

    def names(self) -> np.ndarray:
        return self.short[self.anchor]

    def wholes(self) -> np.ndarray:
        body = self.rolling.ranges(self.first, self.last + LENGTH)
        return mixed(body + (self.anchor - self.first).astype(np.uint64))

    def sides(self) -> np.ndarray:
        """16 bits of hash of the anchor with ``SIDE`` bytes on its left, and on its right."""
        n = self.offsets[-1]
        left = self.rolling.ranges(np.maximum(self.anchor - SIDE, 0), self.anchor + Q)
        right = self.rolling.ranges(self.anchor, np.minimum(self.anchor + Q + SIDE, n))
        high, low = left >> np.uint64(48), right >> np.uint64(48)
        return ((high << np.uint64(16)) | low).astype(np.uint32)

    def strings(self, starts: np.ndarray) -> np.ndarray:
        """The numbers of the strings that start at ``starts``, from those at later offsets."""
        number = self.short[starts]
        for offset in (*range(Q, LENGTH - Q, Q), LENGTH - Q):
            number = mixed(number ^ (self.short[starts + offset] * np.uint64(0x2545F4914F6CDD1D)))
        return number

    def starts_of(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all strings of some blocks, and the text of each."""
        size = self.last[blocks] - self.first[blocks] + 1
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        within = np.arange(total) - np.repeat(ends - size, size)
        return np.repeat(self.first[blocks], size) + within, np.repeat(self.of[blocks], size)


def _send_blocks(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Outbox(buckets, with_owners=True)
        for batch in batches:
            for _, _, ids, versions, data, offsets in texts(batch):
                s = Strings(data, offsets)
                names = s.names()
                yield from out.add(
                    ids,
                    versions,
                    s.of,
                    names & np.uint64(0xFFFFFFFF),
                    tokens=(names >> np.uint64(32)).astype(np.uint32),
                    wholes=s.wholes(),
                    sides=s.sides(),
                    places=s.ordinal.astype(np.int32),
                )
        yield from out.send()

    return send


def _send_strings(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Outbox(buckets, with_owners=True)
        for batch in batches:
            marks = batch.column("open")
            for a, b, ids, versions, data, offsets in texts(batch):
                s = Strings(data, offsets)
                starts, row = s.starts_of(_blocks(s, marks.slice(a, b - a)))
                names, places = s.strings(starts), (starts - offsets[row]).astype(np.int32)
                yield from out.add(ids, versions, row, names, names=names, places=places)
        yield from out.send()

    return send


def _blocks(s: Strings, marks: pa.ListArray) -> np.ndarray:
    """The blocks that the lists of ordinals, one for each text, name."""
    ordinals, counts = flat(marks)
    if not len(ordinals):
        return np.zeros(0, np.int64)
    blocks_before = np.searchsorted(s.of, np.arange(len(counts)))
    return np.unique(np.repeat(blocks_before, counts) + ordinals)


def _least(names: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each entry the least id of its name, and (order, first) of the sorted names."""
    order = np.argsort(names)
    ranked = names[order]
    new = np.ones(len(names), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first = np.flatnonzero(new)
    least = np.empty(len(names), np.int64)
    group = np.cumsum(new) - 1
    least[order] = np.minimum.reduceat(ids[order], first)[group] if len(first) else ids[order]
    return least, order, first


def _own(entries: Entries) -> np.ndarray:
    """The id of each entry's document."""
    return np.repeat(entries.values("owners"), entries.counts)


def _marked(entries: Entries, keep: np.ndarray, marks: np.ndarray) -> pa.Table:
    """``keep``: entries in any order, ``marks``: theirs."""
    row = entries.row[keep]
    counts = np.bincount(row, minlength=len(entries.counts))
    return entries.answer(counts, marks[np.argsort(row, kind="stable")])


def _shared(names: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Entries whose name an earlier document has, and those that have it for a later one."""
    least, order, first = _least(names, own)
    if not len(names):
        return np.zeros(0, bool)
    ranked = own[order]
    several = np.maximum.reduceat(ranked, first) > np.minimum.reduceat(ranked, first)
    out = np.empty(len(names), bool)
    out[order] = np.repeat(several, np.diff(np.append(first, len(names))))
    return out


def _decide_blocks(entries: Entries) -> pa.Table:
    """Marks 2 * ordinal of blocks that an earlier document has, 2 * ordinal + 1 of open ones."""
    own = _own(entries)
    anchor = entries.values("tokens").view(np.uint32).astype(np.uint64) << np.uint64(32)
    some = np.flatnonzero(_shared(anchor, own))
    # a string goes on for half of its other bytes on one side of its anchor at least
    sides = entries.values("sides")[some].view(np.uint32).astype(np.uint64)
    anchor, own = anchor[some], own[some]
    left = anchor | (sides >> np.uint64(16)) | np.uint64(1 << 31)
    right = anchor | (sides & np.uint64(0xFFFF))
    further = _shared(left, own) | _shared(right, own)
    some, own, left, right = some[further], own[further], left[further], right[further]
    decided = own > _least(entries.values("wholes")[some], own)[0]
    # what is undecided and has something earlier beside it, and all that may be equal to that
    wanting = ~decided & ((own > _least(left, own)[0]) | (own > _least(right, own)[0]))
    open_ = ~decided & (np.isin(left, left[wanting]) | np.isin(right, right[wanting]))
    keep = decided | open_
    return _marked(entries, some[keep], 2 * entries.values("places")[some[keep]] + open_[keep])


def _decide_strings(entries: Entries) -> pa.Table:
    """Starts of the strings that an earlier document has."""
    own = _own(entries)
    later = np.flatnonzero(own > _least(entries.values("names"), own)[0])
    return _marked(entries, later, entries.values("places")[later])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, _, _, data, offsets in texts(batch):
            size = b - a
            step = np.zeros(len(data) + 1, np.int32)
            blocks = batch.column("decided").slice(a, size)
            if len(flat(blocks)[0]):
                s = Strings(data, offsets)
                at = _blocks(s, blocks)
                np.add.at(step, s.first[at], 1)
                np.add.at(step, s.last[at] + LENGTH, -1)
            starts, counts = flat(batch.column("starts").slice(a, size))
            if len(starts):
                starts = np.repeat(offsets[:-1], counts) + starts
                np.add.at(step, starts, 1)
                np.add.at(step, starts + LENGTH, -1)
            gone = np.zeros(len(data) + 2, bool)
            gone[1:-1] = np.cumsum(step[:-1]) > 0
            # runs end where a text ends
            begins = np.zeros(len(data) + 1, bool)
            begins[offsets[:-1]] = True
            opens = np.flatnonzero(gone[1:-1] & (~gone[:-2] | begins[:-1]))
            begins[offsets[1:]] = True
            closes = np.flatnonzero(gone[1:-1] & (~gone[2:] | begins[1:])) + 1
            of = np.searchsorted(offsets, opens, side="right") - 1
            spans = np.bincount(of, minlength=size)
            kept_mask = ~gone[1:-1]
            kept = data[kept_mask]
            ends = np.concatenate([[0], np.cumsum(kept_mask)])[offsets].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(a, size),
                    batch.column("version").slice(a, size),
                    pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), size, [None, pa.py_buffer(ends), pa.py_buffer(kept)]
                    ).cast(pa.binary()),
                    pa.array(np.diff(offsets)),
                    lists((opens - offsets[of]).astype(np.int32), spans),
                    lists((closes - offsets[of]).astype(np.int32), spans),
                ],
                ["id", "version", "kept", "n_bytes", "starts", "ends"],
            )


CUT = (
    "id long, version long, kept binary, n_bytes long, starts array<int>, ends array<int>"
)


def _marks(found: DataFrame) -> DataFrame:
    """Repeated rows of one id and text have the same marks."""
    marks = F.first("marks").alias("marks")
    return found.where("size(marks) > 0").groupBy("id", "version").agg(marks)


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, version, kept, n_bytes, starts, ends): remaining bytes and removed runs.

    ``version`` is ``xxhash64`` of the text; with the id it finds the row of ``docs`` again.
    """
    whole = keyed(docs, text)
    with scratch(docs.sparkSession):
        found = staged(_found(whole), "found", keep=True)
    none = F.array().cast("array<int>")
    rows = whole.join(found, ["id", "version"], "left").select(
        "id",
        "version",
        "text",
        F.coalesce("decided", none).alias("decided"),
        F.coalesce("starts", none).alias("starts"),
    )
    return rows.mapInArrow(_cut, CUT).select(
        real_id("id").alias("doc_id"), "version", "kept", "n_bytes", "starts", "ends"
    )


def _found(whole: DataFrame) -> DataFrame:
    """(id, version, decided, starts): blocks and strings that an earlier document has."""
    size = whole.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // (18 * IN_BUCKET)))
    blocks = _marks(answered(whole, _send_blocks(buckets), _decide_blocks, buckets))
    blocks = staged(
        blocks.select(
            "id",
            "version",
            F.expr("transform(filter(marks, m -> m % 2 = 0), m -> m div 2)")
            .cast("array<int>")
            .alias("decided"),
            F.expr("transform(filter(marks, m -> m % 2 = 1), m -> m div 2)")
            .cast("array<int>")
            .alias("open"),
        ),
        "blocks",
    )
    n_open = blocks.agg(F.sum(F.size("open"))).first()[0] or 0
    buckets = max(1, -(-n_open * 18 // IN_BUCKET))
    open_ = blocks.where("size(open) > 0").select("id", "version", "open")
    wanted = whole.join(open_, ["id", "version"])
    strings = _marks(answered(wanted, _send_strings(buckets), _decide_strings, buckets))
    strings = staged(strings.withColumnRenamed("marks", "starts"), "strings")
    none = F.array().cast("array<int>")
    return (
        blocks.select("id", "version", "decided")
        .join(strings, ["id", "version"], "full")
        .select(
            "id",
            "version",
            F.coalesce("decided", none).alias("decided"),
            F.coalesce("starts", none).alias("starts"),
        )
    )
