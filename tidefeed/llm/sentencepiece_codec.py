"""SentencePiece encoding and decoding by suffix-array matching.

The new words of a batch are laid out one after another and their suffixes sorted: by their first
8 bytes, then by pairs of ranks 8, 16 and 32 bytes on, as far as pieces and words reach. Every piece
of the vocabulary is looked up in the sorted suffixes by binary search, its first bytes by rank and
its last ones by a range of ranks. Its range of suffixes are its occurrences, and each is an edge
from its first to its last byte. Edges are sorted by position, and words fall apart where no edge
crosses. The characters of a stretch are relaxed along its edges: of all edges that span exactly two
neighbouring parts the best one merges them, again and again, until no edge does. The vocabulary is
a byte-pair one, whose scores are ranks of merges; so this, and not the path of the best sum, gives
the ids of its own encoder. All stretches go on at once; one of very many characters has a heap of
its edges instead, whose best is always at hand.

No piece goes on past a space mark that follows another character, so texts are cut there, and a
word is encoded once for all its copies in a batch, and kept for later batches of the same worker:
words of ``WORD`` characters at most, and ``KEPT`` bytes of them. Characters without a piece become
their bytes.

Null texts are empty; empty texts have no ids. Ids decode to the text again, but for what the
model's own decoder drops: one space at the start. Every row gives a result row. Further
columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.shared import chunks, utf8

#: Bytes of words and ids that a Python worker keeps; beyond that it starts anew, with the same
#: results. An entry's own objects count as ``ENTRY`` bytes.
KEPT, ENTRY, WORD = 64 << 20, 200, 64
#: Bytes of text that are matched together: looking up all pieces pays from about this size.
BATCH = 4 << 20
#: Bytes of new words whose suffixes are sorted together, which bounds a worker's memory.
SORTED = 1 << 20
#: Characters of a stretch from which it has a heap of its edges.
LONG = 48
SPACE = "▁"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_NONE = np.uint32(0xFFFFFFFF)


def default_file() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


class _Suffixes:
    """The sorted suffixes of words that each end in a byte 0xFF, as far as pieces reach.

    First by 8 bytes. A suffix whose first 8 bytes hold no end is then sorted by its rank and that
    of the suffix 8 bytes on, one that goes on after 16 bytes by ranks of 16 bytes, and so on; what
    ends before keeps its place, so a step sorts only what the one before has left open.
    """

    def __init__(self, data: bytes, longest: int):
        n = len(data)
        codes = np.frombuffer(data + bytes(64), np.uint8)
        key = np.zeros(n, np.uint64)
        for i in range(8):
            key = (key << np.uint64(8)) | codes[i : i + n]
        order = np.argsort(key)
        self.first = key[order]
        del key
        new = _new(self.first)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        self.distinct = self.first[new]
        self.orders, self.sorted = [order], [self.first]
        self.levels = []
        ends = np.flatnonzero(codes[:n] == 0xFF)
        left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
        width = 8
        while width < longest:
            open_ = np.flatnonzero(left >= width)
            both = (rank[open_] << 32) | (rank[open_ + width] + 1)
            order = np.argsort(both)
            both, order = both[order], open_[order]
            new = _new(both)
            distinct = both[new]
            # ranks of this level: as many for each rank before as it has distinct successors
            groups = int(rank.max()) + 1 if n else 0
            count = np.bincount(distinct >> 32, minlength=groups)
            firsts = np.cumsum(count) - count
            starts = np.append(0, np.cumsum(np.maximum(count, 1)))
            self.levels.append((width, distinct, starts, firsts))
            self.orders.append(order)
            self.sorted.append(both)
            later = starts[rank]
            later[order] += np.cumsum(new) - 1 - firsts[both >> 32]
            rank = later
            width *= 2

    def _first(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The least and greatest first 8 bytes of what begins with pieces of up to 8 bytes."""
        size = np.array([len(p) for p in pieces], np.uint64)
        low = np.array([int.from_bytes(p.ljust(8, b"\0"), "big") for p in pieces], np.uint64)
        shift = (np.uint64(8) - size) * np.uint64(8)
        # shifts by 64 are undefined, and no piece is empty
        return low, low | ((np.uint64(1) << shift) - np.uint64(1))

    def ranks(self, pieces: list[bytes], level: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of a level's ranks of the suffixes that begin with each piece."""
        if level == 0:
            low, high = self._first(pieces)
            return (
                np.searchsorted(self.distinct, low, "left"),
                np.searchsorted(self.distinct, high, "right"),
            )
        width, distinct, starts, firsts = self.levels[level - 1]
        low, high = np.zeros((2, len(pieces)), np.int64)
        long = np.array([len(p) > width for p in pieces], bool)
        if not long.all():
            a, b = self.ranks([p for p, x in zip(pieces, long) if not x], level - 1)
            low[~long], high[~long] = starts[a], starts[b]
        if long.any():
            head, after, before = self._long([p for p, x in zip(pieces, long) if x], level)
            a, b = np.searchsorted(distinct, after), np.searchsorted(distinct, before)
            some = head >= 0
            shift = np.where(some, starts[head] - firsts[head], 0) if len(firsts) else 0
            low[long], high[long] = np.where(some, a + shift, 0), np.where(some, b + shift, 0)
        return low, high

    def _long(self, pieces: list[bytes], level: int):
        """The rank of each piece's first bytes (-1: nowhere), and the range of its pairs."""
        width = self.levels[level - 1][0]
        head, stop = self.ranks([p[:width] for p in pieces], level - 1)
        low, high = self.ranks([p[width:] for p in pieces], level - 1)
        head = np.where(stop > head, head, -1)
        return head, (head << 32) | (low + 1), (head << 32) | (high + 1)

    def occurrences(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(piece, position) of every occurrence of every piece."""
        size = np.array([len(p) for p in pieces])
        found = []
        for level in range(len(self.orders)):
            least = 0 if level == 0 else self.levels[level - 1][0]
            here = np.flatnonzero((size > least) & (size <= max(8, 2 * least)))
            if not len(here):
                continue
            some = [pieces[i] for i in here.tolist()]
            if level == 0:
                low, high = self._first(some)
                low = np.searchsorted(self.first, low, "left")
                high = np.searchsorted(self.first, high, "right")
            else:
                head, low, high = self._long(some, level)
                low, high = (np.searchsorted(self.sorted[level], x) for x in (low, high))
                high = np.where(head >= 0, high, low)
            count = high - low
            piece = np.repeat(here, count)
            within = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
            found.append((piece, self.orders[level][np.repeat(low, count) + within]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _new(values: np.ndarray) -> np.ndarray:
    """Where sorted values change."""
    return np.append(True, values[1:] != values[:-1]) if len(values) else np.zeros(0, bool)


def _portions(words: Iterable[str]) -> Iterator[list[str]]:
    """The words in lists of ``SORTED`` bytes, or of one longer word; a character has four at most."""
    held, size = [], 0
    for word in words:
        more = len(word) + 1 if word.isascii() else 4 * len(word) + 1
        if held and size + more > SORTED:
            yield held
            held, size = [], 0
        held.append(word)
        size += more
    if held:
        yield held


class Codec:
    def __init__(self, file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=file)
        size = model.get_piece_size()
        self.byte_id = np.zeros(256, np.uint32)
        self.text_of: list[bytes] = []
        pieces, ids, scores = [], [], []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte = int(piece[3:5], 16)
                self.byte_id[byte] = i
                self.text_of.append(bytes([byte]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text_of.append(" ⁇ ".encode() if model.is_unknown(i) else b"")
            else:
                self.text_of.append(piece.replace(SPACE, " ").encode())
                pieces.append(piece.encode())
                ids.append(i)
                scores.append(model.get_score(i))
        self.longest = max(map(len, pieces))
        if self.longest > 64:
            raise ValueError("pieces of more than 64 bytes")
        self.cuts = not any(SPACE in p.decode().lstrip(SPACE) for p in pieces)
        self.pieces, self.ids = pieces, np.array(ids, np.uint32)
        # equal scores are not merged in one go: ties are told apart by position alone
        self.rank = np.unique(-np.array(scores), return_inverse=True)[1].astype(np.uint32)
        self.kept: dict[str, bytes] = {}
        self.size = 0

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return _WORD.findall(marked) if self.cuts else [marked]

    # Relaxing

    def _by_heap(
        self, starts: list[int], end: int, piece_at: dict[int, int]
    ) -> tuple[list[int], list[int]]:
        """Starts and ends of the parts of a stretch; ``piece_at`` has its edges by span."""
        n = len(starts)
        ends = [*starts[1:], end]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and ends[j] - starts[i] <= 64:
                piece = piece_at.get(starts[i] * 64 + ends[j] - starts[i] - 1)
                if piece is not None:
                    heapq.heappush(heap, (int(self.rank[piece]), i, ends[i], ends[j]))

        for i in range(n):
            offer(i)
        gone = bytearray(n)
        while heap:
            _, i, middle, stop = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or ends[i] != middle or ends[j] != stop:
                continue
            ends[i], gone[j], after[i] = stop, 1, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        left = [i for i in range(n) if not gone[i]]
        return [starts[i] for i in left], [ends[i] for i in left]

    def _learn(self, short: list[str]) -> dict[str, bytes]:
        """The ids of some words."""
        raw = [w.encode() for w in short]
        # a byte that is in no text ends each word
        data = b"\xff".join(raw) + b"\xff"
        codes = np.frombuffer(data, np.uint8)
        piece, start = _Suffixes(data, self.longest).occurrences(self.pieces)
        length = np.array([len(p) for p in self.pieces], np.int64)
        edge = start.astype(np.int64) * 64 + length[piece] - 1
        del start
        order = np.argsort(edge)
        edge, piece = edge[order], piece[order]
        del order

        def edges(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """The piece of each span a to b, or -1."""
            wanted = a * 64 + (b - a) - 1
            at = np.minimum(np.searchsorted(edge, wanted), len(edge) - 1)
            known = (edge[at] == wanted) & (b - a <= 64)
            return np.where(known, piece[at], -1)

        if not len(edge):
            edge, piece = np.array([-1]), np.array([-1])
        begin = (codes & 0xC0) != 0x80
        starts = np.flatnonzero(begin & (codes != 0xFF))
        ends = np.flatnonzero(begin)
        ends = ends[np.searchsorted(ends, starts, side="right")]
        bounds = np.flatnonzero(codes == 0xFF)
        # stretches: what no edge of several characters holds together falls apart
        first, last = edge // 64, edge // 64 + edge % 64 + 1
        inside = np.bincount(first[edge >= 0] + 1, minlength=len(codes) + 1)
        inside = np.cumsum(inside - np.bincount(last[edge >= 0], minlength=len(inside)))
        word = np.cumsum(inside[starts] == 0)
        done_start, done_end = [], []
        size = np.bincount(word, minlength=1)
        long = size[word] > LONG
        for number in np.flatnonzero(size > LONG).tolist():
            a, b = np.searchsorted(word, (number, number + 1))
            low, high = np.searchsorted(edge, (starts[a] * 64, starts[b - 1] * 64 + 64))
            own = dict(zip(edge[low:high].tolist(), piece[low:high].tolist(), strict=True))
            parts = self._by_heap(starts[a:b].tolist(), int(ends[b - 1]), own)
            done_start.append(np.array(parts[0], np.int64))
            done_end.append(np.array(parts[1], np.int64))
        s, e, word = starts[~long], ends[~long], word[~long]
        while len(s):
            last = np.append(word[1:] != word[:-1], True)
            found = edges(s, np.append(e[1:], 0))
            score = np.where(last | (found < 0), _NONE, self.rank[found])
            first = np.flatnonzero(np.append(True, last[:-1]))
            best = np.minimum.reduceat(score, first)
            finished = np.repeat(best == _NONE, np.diff(np.append(first, len(s))))
            done_start.append(s[finished])
            done_end.append(e[finished])
            # the leftmost of the best in each word that goes on
            is_best = (score == np.repeat(best, np.diff(np.append(first, len(s))))) & ~finished
            at = np.flatnonzero(is_best)
            at = at[np.append(True, word[at][1:] != word[at][:-1])] if len(at) else at
            e = e.copy()
            e[at] = e[at + 1]
            keep = ~finished
            keep[at + 1] = False
            s, e, word = s[keep], e[keep], word[keep]
        s, e = np.concatenate(done_start), np.concatenate(done_end)
        order = np.argsort(s)
        s, e = s[order], e[order]
        found = edges(s, e)
        # parts without a piece are characters, and become their bytes
        size = np.where(found < 0, e - s, 1)
        out = np.repeat(np.where(found < 0, 0, self.ids[found]), size).astype(np.uint32)
        loose = np.repeat(found < 0, size)
        within = np.arange(len(out)) - np.repeat(np.cumsum(size) - size, size)
        out[loose] = self.byte_id[codes[(np.repeat(s, size) + within)[loose]]]
        cut = np.concatenate([[0], np.cumsum(size)])
        ends = (4 * cut[np.searchsorted(s, bounds)]).tolist()
        packed = out.tobytes()
        return {
            text: packed[a:b] for text, a, b in zip(short, [0, *ends[:-1]], ends, strict=True)
        }

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        parts = [self.words(t) for t in texts]
        words = set().union(*parts)
        new = words - self.kept.keys()
        found = {}
        for portion in _portions(new):
            found |= self._learn(portion)
        short = [w for w in found if len(w) <= WORD]
        size = self._size(short, found)
        if self.size + size > KEPT:
            others = list(words - new)
            self.kept = dict(zip(others, map(self.kept.__getitem__, others)))
            self.size = self._size(others, self.kept)
        self.kept |= found
        known = self.kept.__getitem__
        out = [b"".join(map(known, p)) for p in parts]
        for word in found.keys() - set(short):
            del self.kept[word]
        self.size += size
        if self.size > KEPT:
            self.kept, self.size = {}, 0
        return out

    @staticmethod
    def _size(words: list[str], ids: dict[str, bytes]) -> int:
        """Bytes that these words and their ids take; a character has four at most."""
        return ENTRY * len(words) + 4 * sum(map(len, words)) + sum(len(ids[w]) for w in words)

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.text_of.__getitem__, np.frombuffer(ids, np.uint32).tolist()))
        return text.decode(errors="replace").removeprefix(" ")


@cache
def codec(file: str) -> Codec:
    """One for each Python worker."""
    return Codec(file)


def _encode(file: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = utf8(batch.column("text"))
            for a, b in chunks(offsets, BATCH):
                texts = batch.column("text").slice(a, b - a).fill_null("").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(a, b - a),
                        pa.array(codec(file).encode(texts), pa.binary()),
                    ],
                    ["id", "ids"],
                )

    return encode


def _decode(file: str):
    """Each batch gives one, so that it can follow ``_encode`` in the same worker."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [codec(file).decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("ids"), pa.array(texts, pa.string())],
                ["id", "ids", "text"],
            )

    return decode


def encoded(
    docs: DataFrame, id: str = "doc_id", text: str = "text", file: str | None = None
) -> DataFrame:
    """(id, ids) of each row; ``ids`` are 32-bit little-endian numbers."""
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    out = rows.mapInArrow(_encode(file or default_file()), "id long, ids binary")
    return out.withColumnRenamed("id", id)


def decoded(rows: DataFrame, id: str = "doc_id", file: str | None = None) -> DataFrame:
    """(id, ids, text) of rows of ``encoded``."""
    named = rows.select(F.col(id).alias("id"), "ids")
    out = named.mapInArrow(_decode(file or default_file()), "id long, ids binary, text string")
    return out.withColumnRenamed("id", id)


def round_trip(
    docs: DataFrame, id: str = "doc_id", text: str = "text", file: str | None = None
) -> DataFrame:
    """(id, ids, text) of each row, as ``decoded`` gives of ``encoded``.

    One Python worker of a task does both. Two would both keep words in the end, as Spark gives an
    idle worker either part.
    """
    file = file or default_file()
    encode, decode = _encode(file), _decode(file)
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    out = rows.mapInArrow(lambda batches: decode(encode(batches)), "id long, ids binary, text string")
    return out.withColumnRenamed("id", id)
