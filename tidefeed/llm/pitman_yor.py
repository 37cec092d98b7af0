"""Scores of texts by a hierarchical Pitman-Yor model of words, trained here by Gibbs sampling.

Every word that precedes another is the context of a restaurant, and so is the start of a text.
Their customers are the words that follow; every table of theirs sends a customer to the one
restaurant that they share as parent, whose tables draw from all words alike. A sweep takes each
dish's customers off their tables and seats them again, one by one, given the tables of all
others as the sweep before left them (restaurants by turns with their parent); that the dishes of
a sweep do not see each other's new tables is what lets them be seated side by side. A text is
scored by predictive probabilities averaged over the sweeps after ``BURN_IN``.

How it is dealt out:

1. Texts are gathered to parcels. A parcel sends its distinct pairs (context, word) with their
   counts to buckets by a hash of the pair, and its distinct words to buckets by a hash of the
   word. A pair or word is sent once for a parcel, so none makes a bucket large, however frequent.
2. Pairs that occur once have one table. The others are seated in their buckets; the buckets of
   words count the tables and seat the parent. What goes to and fro is an array for each pair of
   buckets, in an order that both sides know.
3. Parcels get for each of their pairs what it holds beyond its discount, and for each of their
   words its count, its probability in the parent and what its own restaurant leaves to the parent.

Words are 64-bit hashes; pairs are hashes of two names of 48 bits, the first ones of their words'.
Draws depend on the pair and the sweep alone, so a repeated
task draws the same. ``docs`` is read twice and has to come in the same partitions both times, as
files do; if it does not, the lists differ in length and the job fails.

A row is a document, repeated rows, rows of one id and rows without an id too: a null id counts as
an empty text when it is hashed, which puts its row among those learnt from. Null texts are empty:
their one token is the end. Further columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.shared import chunks, flat, lists, mixed, scratch, staged, utf8
from tidefeed.llm.shingles import words

#: Bytes of text of a parcel; a longer text is one by itself.
PARCEL = 16 << 20
#: Bytes of text for each bucket of pairs, and of words.
PAIR_TEXT, WORD_TEXT = 10 << 20, 40 << 20
#: Sweeps before the ones that are averaged, and those.
BURN_IN, SAMPLES = 1, 2
#: Strength of every restaurant.
STRENGTH = 1.0
#: Customers of a dish that are drawn by themselves, the share of those seated that is drawn
#: together then, and draws at a time.
ALONE, RUN, DRAWN = 32, 1 / 16, 1 << 20
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
#: Bits of a word's name that pairs do without, and tokens that are scored at a time (whole texts).
SHORT, SCORED = np.uint64(16), 1 << 18
#: Bytes of mail in a batch; a longer row is one by itself.
POSTED = 4 << 20

MAIL = (
    "at long, kind int, other long, x array<long>, y array<long>, z array<long>, "
    "gaps array<int>, f array<float>, customers long, tables long"
)
# Kinds of mail. Between parcels and buckets:
PAIRS, ASKED, MULTI, ONES, ASKS, WORDS, WANTED, SENT = range(8)
# In a sweep: the words' state, what a bucket of pairs gets of it, its tables, and their sums.
STATE, ANSWER, TABLES, TALLY = range(8, 12)


def _mail(rows: list[dict]) -> pa.Table:
    """Mail from rows whose missing fields are null, in chunks, each of which travels by itself."""
    parts, size = [[]], 0
    for row in rows:
        more = sum(v.nbytes for v in row.values() if isinstance(v, np.ndarray))
        if parts[-1] and size + more > POSTED:
            parts.append([])
            size = 0
        parts[-1].append(row)
        size += more
    return pa.concat_tables([_posted(part) for part in parts])


def _posted(rows: list[dict]) -> pa.Table:
    kinds = {
        "at": pa.int64(), "kind": pa.int32(), "other": pa.int64(),
        "x": pa.list_(pa.int64()), "y": pa.list_(pa.int64()), "z": pa.list_(pa.int64()),
        "gaps": pa.list_(pa.int32()), "f": pa.list_(pa.float32()),
        "customers": pa.int64(), "tables": pa.int64(),
    }
    columns = {}
    for name, kind in kinds.items():
        values = [row.get(name) for row in rows]
        if pa.types.is_list(kind) and any(v is not None for v in values):
            plain = kind.value_type.to_pandas_dtype()
            own = [np.zeros(0, plain) if v is None else np.asarray(v, plain) for v in values]
            made = lists(np.concatenate(own), np.array([len(v) for v in own]))
            columns[name] = made.cast(kind)
        else:
            columns[name] = pa.array(values, kind)
    return pa.table(columns)


def _batches(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    yield from _mail(rows).to_batches()


class _Box:
    """The mail of a bucket, by kind and in the order of the other sides."""

    def __init__(self, got: pa.Table):
        self.got = got.combine_chunks()
        self.kind = got.column("kind").to_numpy()
        self.other = got.column("other").fill_null(0).to_numpy()

    def rows(self, kind: int) -> list[int]:
        some = np.flatnonzero(self.kind == kind)
        return some[np.argsort(self.other[some], kind="stable")].tolist()

    def list(self, row: int, name: str) -> np.ndarray:
        return self.got.column(name)[row].values.to_numpy(zero_copy_only=False)

    def lists(self, kind: int, name: str) -> list[np.ndarray]:
        return [self.list(row, name) for row in self.rows(kind)]

    def one(self, kind: int, *names: str) -> list[np.ndarray]:
        (row,) = self.rows(kind)
        return [self.list(row, name) for name in names]


def _gaps(places: np.ndarray) -> np.ndarray:
    return np.diff(places, prepend=0).astype(np.int32)


def bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so what is sorted by name is sorted by bucket."""
    return ((names >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def pair_names(contexts: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mixed(mixed(contexts) + after * np.uint64(0x9FB21C651E98DF25))


def _merged(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names in order, a place of each, and the number of every name."""
    order = np.argsort(names)
    of = names[order]
    new = np.ones(len(of), bool)
    np.not_equal(of[1:], of[:-1], out=new[1:])
    distinct, places = of[new], order[new]
    del of
    place = np.cumsum(new, dtype=np.int32)
    place -= 1
    number = np.empty(len(place), np.int32)
    number[order] = place
    return distinct, places, number


# Parcels


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Whole rows of the batches with the number of their parcel, in the same way every time."""
    parcel, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        _, offsets = utf8(batch.column("text"))
        first = 0
        while first < len(batch):
            room = int(np.searchsorted(offsets, offsets[first] + PARCEL - size, "right")) - 1
            if room <= first:
                if size:
                    parcel, size = parcel + 1, 0
                    continue
                room = first + 1  # a long text
            room = min(room, len(batch))
            yield parcel, batch.slice(first, room - first)
            size += int(offsets[room] - offsets[first])
            first = room


class _Tokens:
    """The tokens of a parcel's texts: the distinct pairs and words, and which each token is."""

    def __init__(self, texts: list[pa.Array]):
        hashes, counts = [], []
        for text in texts:
            data, offsets = utf8(text)
            for a, b in chunks(offsets):
                part = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                hashes.append(part[0])
                counts.append(part[1])
                del part
        hashes = np.concatenate(hashes)
        self.counts = np.concatenate(counts) + 1  # the end is a token
        ends = np.cumsum(self.counts)
        after = np.full(int(ends[-1]) + 1, END, np.uint64)
        inside = np.ones(len(after), bool)
        inside[ends - 1] = inside[-1] = False
        after[inside] = hashes
        after[-1] = START
        del hashes, inside
        self.words, _, word = _merged(after)
        self.word, self.start = word[:-1], int(word[-1])
        after >>= SHORT
        self.starts = ends - self.counts
        context = np.empty(len(self.word), np.uint64)
        context[1:] = after[:-2]
        context[self.starts] = START >> SHORT
        names = pair_names(context, after[:-1])
        del context, after
        self.pairs, self.at, self.pair = _merged(names)

    def sides(self) -> tuple[np.ndarray, np.ndarray]:
        """The shortened names of each pair's context and word."""
        short = self.words >> SHORT
        before = np.append(self.start, self.word[:-1])
        before[self.starts] = self.start
        return short[before[self.at]], short[self.word[self.at]]


def _counted(pair_buckets: int, word_buckets: int):
    def sent(parcel: int, slices: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _Tokens([s.column("text") for s in slices])
        held = np.concatenate([s.column("held_out").to_numpy(zero_copy_only=False) for s in slices])
        learnt = np.repeat(~held.astype(bool), t.counts)
        often = np.bincount(t.pair[learnt], minlength=len(t.pairs))
        word_often = np.bincount(t.word[learnt], minlength=len(t.words))
        word_often[t.start] = (~held.astype(bool)).sum()  # texts that begin
        # two names of 48 bits in 64 and 32
        contexts, after = t.sides()
        both = ((contexts << np.uint64(16)) | (after >> np.uint64(32))).view(np.int64)
        low = (after & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
        rows = []
        for at, a, b in _runs(bucket_of(t.pairs, pair_buckets)):
            rows.append({"at": at, "kind": SENT, "other": parcel, "x": both[a:b],
                         "gaps": low[a:b], "z": often[a:b]})
        for at, a, b in _runs(bucket_of(t.words, word_buckets)):
            rows.append({"at": pair_buckets + at, "kind": SENT, "other": parcel,
                         "x": t.words[a:b].view(np.int64), "z": word_often[a:b]})
        yield from _batches(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for parcel, part in _cut(batches):
            if held and parcel != now:
                yield from sent(now, held)
                held = []
            now = parcel
            held.append(part)
        if held:
            yield from sent(now, held)

    return run


def _runs(numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
    if not len(numbers):
        return
    cuts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(numbers)], strict=True):
        yield int(numbers[a]), a, b


# Buckets: counts


def _gathered(pair_buckets: int, word_buckets: int):
    """Counts of a bucket's pairs or words, and where each parcel's are among them."""

    def run(got: pa.Table) -> pa.Table:
        at = got.column("at")[0].as_py()
        parcels = got.column("other").to_numpy()
        first, sizes = flat(got.column("x"))
        often, _ = flat(got.column("z"))
        ends = np.append(0, np.cumsum(sizes))
        is_pair = at < pair_buckets
        if is_pair:
            low, _ = flat(got.column("gaps"))
            first = first.view(np.uint64)
            after = (first & np.uint64(0xFFFF)) << np.uint64(32) | low.view(np.uint32)
            first = first >> np.uint64(16)
            keys = pair_names(first, after)
        else:
            at -= pair_buckets
            keys = first.view(np.uint64)
        keys, where, number = _merged(keys)
        counts = np.bincount(number, often, len(keys)).astype(np.int64)
        rows = [
            {"at": at, "kind": ASKED if is_pair else WANTED, "other": int(p), "gaps": _gaps(number[a:b])}
            for p, a, b in zip(parcels, ends, ends[1:], strict=False)
        ]
        if not is_pair:
            rows.append({"at": at, "kind": WORDS, "x": keys.view(np.int64), "y": counts})
            return _mail(rows)
        contexts, after = first[where].view(np.int64), after[where].view(np.int64)
        once, more = counts == 1, np.flatnonzero(counts > 1)
        rows.append({"at": at, "kind": PAIRS, "x": counts})
        rows.append({"at": at, "kind": MULTI, "x": contexts[more], "y": after[more],
                     "z": counts[more], "gaps": _gaps(more),
                     "customers": int(once.sum()), "tables": int((counts == 2).sum())})
        names, _, number = _merged(np.concatenate([contexts[once], after[once]]).view(np.uint64))
        n = int(once.sum())
        of = np.bincount(number[:n], minlength=len(names))
        dishes = np.bincount(number[n:], minlength=len(names))
        for to, a, b in _runs(bucket_of(names << SHORT, word_buckets)):
            rows.append({"at": to, "kind": ONES, "other": at, "x": names[a:b].view(np.int64),
                         "y": dishes[a:b], "z": of[a:b]})
        names = _known(contexts[more], after[more])
        for to, a, b in _runs(bucket_of(names << SHORT, word_buckets)):
            rows.append({"at": to, "kind": ASKS, "other": at, "x": names[a:b].view(np.int64)})
        return _mail(rows)

    return run


def _known(contexts: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The words that a bucket of pairs asks about, in order."""
    names = np.sort(np.concatenate([contexts, after]).view(np.uint64))
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    return names[new]


def _settled(got: pa.Table) -> pa.Table:
    """A bucket of words: pairs of one occurrence by dish and by context; who asks for which."""
    box = _Box(got)
    names, counts = box.one(WORDS, "x", "y")
    names = names.view(np.uint64)
    short = names >> SHORT
    ones = np.zeros((2, len(names)), np.int64)
    for row in box.rows(ONES):
        where = np.searchsorted(short, box.list(row, "x").view(np.uint64))
        ones[0, where] += box.list(row, "y")
        ones[1, where] += box.list(row, "z")
    at = got.column("at")[0].as_py()
    rows = [{"at": at, "kind": WORDS, "x": counts, "y": ones[0], "z": ones[1],
             "customers": int(counts[names != START].sum()),
             "tables": int((counts[names != START] > 0).sum())}]
    for row in box.rows(ASKS):
        where = np.searchsorted(short, box.list(row, "x").view(np.uint64))
        rows.append({"at": at, "kind": ASKS, "other": int(box.other[row]), "gaps": _gaps(where)})
    return _mail(rows)


# Seating


@dataclass(frozen=True)
class Room:
    """What all restaurants of a level share."""

    discount: float
    strength: float = STRENGTH


def _draws(keys: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers between 0 and 1, by key."""
    bits = mixed(keys ^ mixed(np.array([salt], np.uint64)))
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def seated(
    customers: np.ndarray, others: np.ndarray, share: np.ndarray, room: Room,
    keys: np.ndarray, sweep: int,
) -> np.ndarray:
    """Tables of each dish after its customers sat down one by one.

    ``others``: tables of the restaurant's other dishes; ``share``: the dish's probability in the
    parent. The first customer opens a table. One of ``n`` before them at ``t`` tables opens a new
    one with odds of (strength + discount * (others + t)) * share to n - discount * t. The first
    ``ALONE`` customers are drawn each by themselves. After them a run of customers, a share
    ``RUN`` of those seated, is drawn together, for as many tables as are expected by then along
    the run.
    """
    tables = np.minimum(customers, 1)
    left = np.flatnonzero(customers > 1)
    for there in range(1, ALONE):
        if not len(left):
            break
        t = tables[left]
        opens = (room.strength + room.discount * (others[left] + t)) * share[left]
        draw = _draws(keys[left], (sweep << 40) + there)
        tables[left[draw * (there - room.discount * t + opens) < opens]] += 1
        left = left[customers[left] > there + 1]
    seats = np.full(len(left), ALONE, np.int64)
    while len(left):
        length = np.maximum(1, (seats * RUN).astype(np.int64))
        length = np.minimum(length, customers[left] - seats)
        some = np.cumsum(length) <= max(DRAWN, int(length[0]))  # bounded memory
        now, size, at = left[some], length[some], seats[some]
        of = np.repeat(np.arange(len(now)), size)
        ahead = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        t = tables[now].astype(np.float64)
        opens = (room.strength + room.discount * (others[now] + t)) * share[now]
        rate = opens / (at - room.discount * t + opens)
        t = t[of] + rate[of] * ahead
        opens = (room.strength + room.discount * (others[now][of] + t)) * share[now][of]
        there = at[of] + ahead
        draw = _draws(keys[now][of] + mixed(there.astype(np.uint64)), sweep << 40)
        new = draw * (there - room.discount * t + opens) < opens
        tables[now] += np.bincount(of[new], minlength=len(now))
        seats[some] += size
        go = seats < customers[left]
        left, seats = left[go], seats[go]
    return tables


def _shares(customers, tables, all_customers: int, all_tables: int, room: Room, types: int):
    """Probabilities in the parent."""
    base = (room.strength + room.discount * all_tables) / (types + 1)
    return (customers - room.discount * tables + base) / (room.strength + all_customers)


def _counted_tables(sweep: int, room: Room, types: int, all_tables: int):
    """A bucket of words: the parent's customers, seated again; the tables of each restaurant."""

    def run(got: pa.Table) -> pa.Table:
        box = _Box(got)
        at = got.column("at")[0].as_py()
        _, dishes, of = box.one(WORDS, "x", "y", "z")
        customers, own = dishes.copy(), of.copy()
        places = {int(box.other[r]): np.cumsum(box.list(r, "gaps")) for r in box.rows(ASKS)}
        for row in box.rows(TALLY):
            where = places[int(box.other[row])]
            customers[where] += box.list(row, "x")
            own[where] += box.list(row, "y")
        tables = np.minimum(customers, 1)
        if sweep:
            (before,) = box.one(STATE, "y")
            share = np.full(len(customers), 1 / (types + 1))
            keys = mixed(np.arange(len(customers), dtype=np.uint64) + np.uint64(at << 32))
            tables = seated(customers, all_tables - before, share, room, keys, sweep)
        rows = [{"at": at, "kind": STATE, "x": customers, "y": tables, "z": own,
                 "customers": int(customers.sum()), "tables": int(tables.sum())}]
        for to, where in places.items():
            rows.append({"at": to, "kind": ANSWER, "other": at, "x": customers[where],
                         "y": tables[where], "z": own[where]})
        return _mail(rows)

    return run


def _seated_pairs(sweep: int, word_buckets: int, room: Room, parent: Room, types: int,
                  all_customers: int, all_tables: int):
    """A bucket of pairs: those of several occurrences, seated again."""

    def run(got: pa.Table) -> pa.Table:
        box = _Box(got)
        at = got.column("at")[0].as_py()
        contexts, after, counts = box.one(MULTI, "x", "y", "z")
        names = _known(contexts, after)
        context = np.searchsorted(names, contexts.view(np.uint64))
        dish = np.searchsorted(names, after.view(np.uint64))
        tables = np.minimum(counts, 1)
        if sweep and len(counts):
            (tables,) = box.one(TABLES, "x")
            customers, at_parent, own = (
                np.concatenate(box.lists(ANSWER, name)) for name in ("x", "y", "z")
            )
            share = _shares(customers, at_parent, all_customers, all_tables, parent, types)
            keys = pair_names(contexts.view(np.uint64), after.view(np.uint64))
            tables = seated(counts, own[context] - tables, share[dish], room, keys, sweep)
        rows = [{"at": at, "kind": TABLES, "x": tables}]
        sums = [np.bincount(i, tables, len(names)).astype(np.int64) for i in (dish, context)]
        for to, a, b in _runs(bucket_of(names << SHORT, word_buckets)):
            rows.append({"at": to, "kind": TALLY, "other": at, "x": sums[0][a:b], "y": sums[1][a:b]})
        return _mail(rows)

    return run


# Scores


def _pair_answers(room: Room):
    """For every parcel and each of its pairs: its customers without the discount of its tables."""

    def run(got: pa.Table) -> pa.Table:
        box = _Box(got)
        at = got.column("at")[0].as_py()
        (counts,) = box.one(PAIRS, "x")
        (more,) = box.one(MULTI, "gaps")
        tables = np.minimum(counts, 1).astype(np.float64)
        tables[np.cumsum(more)] = np.mean(box.lists(TABLES, "x"), axis=0)
        worth = (counts - room.discount * tables).astype(np.float32)
        return _mail([
            {"at": int(box.other[row]), "kind": PAIRS, "other": at,
             "f": worth[np.cumsum(box.list(row, "gaps"))]}
            for row in box.rows(ASKED)
        ])

    return run


def _word_answers(room: Room, parent: Room, types: int, totals: list[tuple[int, int, int]]):
    """For every parcel and each of its words: its count, and for each sample its probability in
    the parent, then what its restaurant leaves to the parent."""

    def run(got: pa.Table) -> pa.Table:
        box = _Box(got)
        at = got.column("at")[0].as_py()
        counts, _, _ = box.one(WORDS, "x", "y", "z")
        values = []
        sweeps = dict(zip(box.other[box.kind == STATE].tolist(), np.flatnonzero(box.kind == STATE)))
        for sweep, customers, tables in totals:
            x, y, z = (box.list(int(sweeps[sweep]), name) for name in ("x", "y", "z"))
            values.append(_shares(x, y, customers, tables, parent, types))
            values.append(room.strength + room.discount * z)
        values = np.array(values, np.float32)
        rows = []
        for row in box.rows(WANTED):
            where = np.cumsum(box.list(row, "gaps"))
            rows.append({"at": int(box.other[row]), "kind": WORDS, "other": at,
                         "x": counts[where], "f": values[:, where].ravel()})
        return _mail(rows)

    return run


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
)


def _scored(room: Room, n: int, types: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            raise ValueError("answers for a parcel that is not there")
        t = _Tokens(docs.column("text").chunks)
        del t.at  # only buckets want it
        box = _Box(answers)
        worth = np.concatenate(box.lists(PAIRS, "f"))
        counts = np.concatenate(box.lists(WORDS, "x"))
        values = np.concatenate(
            [f.reshape(2 * SAMPLES, -1) for f in box.lists(WORDS, "f")], axis=1
        ).astype(np.float64)
        if len(worth) != len(t.pairs) or len(counts) != len(t.words):
            raise ValueError("the documents came in other partitions when read again")
        sums = []
        for first, last in chunks(np.append(t.starts, len(t.word)), SCORED):
            a = t.starts[first]
            b = a + t.counts[first:last].sum()
            word, pair = t.word[a:b], t.pair[a:b]
            before = np.append(t.start, word[:-1])
            before[t.starts[first:last] - a] = t.start
            left = sum(values[i + 1][before] * values[i][word] for i in range(0, 2 * SAMPLES, 2))
            p = (worth[pair] + left / SAMPLES) / (room.strength + counts[before])
            known = counts[word]
            scores = np.array([known > 0, np.log10((known + 1) / (n + types + 1)), np.log10(p)])
            sums.append(np.add.reduceat(scores, t.starts[first:last] - a, axis=1))
        known, base, score = np.concatenate(sums, axis=1)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": docs.column("held_out"),
                "n_tokens": t.counts,
                "n_known": known.astype(np.int64),
                "base_score": base,
                "score": score,
            }
        )

    return run


def _with_parcels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for parcel, part in _cut(batches):
        yield part.append_column("parcel", pa.array(np.full(len(part), parcel)))


def _of(frame: DataFrame, *kinds: int) -> DataFrame:
    return frame.where(F.col("kind").isin(*kinds))


def _discount(ones: int | None, twos: int | None) -> float:
    """From the numbers of what occurs once and twice."""
    ones, twos = ones or 0, twos or 0
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones + twos else 0.5


def scored_texts(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    What is not ``held_out`` is learnt from. ``base_score``: the text's log10 probability by word
    counts, one added to each; ``score``: by the model, unknown words and the end included.
    """
    with scratch(docs.sparkSession):
        return staged(_scores(docs, held_out), "scores", keep=True)


def _answers(
    texts: DataFrame, pair_buckets: int, word_buckets: int
) -> tuple[DataFrame, Room, int, int]:
    """What the parcels are told; with it the restaurants, and the tokens and words learnt from."""

    def step(job, name: str, *frames: DataFrame, keep: bool = False) -> DataFrame:
        every = frames[0]
        for frame in frames[1:]:
            every = every.unionByName(frame)
        return staged(every.groupBy("at").applyInArrow(job, MAIL), name, keep, by="kind")

    sent = texts.select("held_out", "text").mapInArrow(_counted(pair_buckets, word_buckets), MAIL)
    counts = step(_gathered(pair_buckets, word_buckets), "counts", sent)
    whole = step(_settled, "words", _of(counts, WORDS, ONES, ASKS))
    n = _of(whole, WORDS).agg(F.sum("customers"), F.sum("tables")).first()
    train, types = n[0] or 0, n[1] or 0
    n = _of(counts, MULTI).agg(F.sum("customers"), F.sum("tables")).first()
    room = Room(_discount(*n))
    parent = None

    state = tables = totals = None
    samples, states, tabled = [], [], []
    for sweep in range(BURN_IN + SAMPLES + 1):
        answers = [] if state is None else [_of(state, ANSWER), _of(tables, TABLES)]
        at = totals[-1] if totals else (0, 0)
        tables = step(
            _seated_pairs(sweep, word_buckets, room, parent or room, types, *at),
            "tables", _of(counts, MULTI), *answers,
        )
        before = [] if state is None else [_of(state, STATE)]
        state = step(
            _counted_tables(sweep, parent or room, types, at[1]),
            "state", _of(whole, WORDS, ASKS), _of(tables, TALLY), *before,
        )
        sums = _of(state, STATE).agg(F.sum("customers"), F.sum("tables")).first()
        totals = [*(totals or []), (sums[0] or 0, sums[1] or 0)]
        if parent is None:
            dishes = _of(state, STATE).select(F.explode("x").alias("x"))
            few = dishes.agg(F.count_if(F.col("x") == 1), F.count_if(F.col("x") == 2)).first()
            parent = Room(_discount(*few))
        if sweep > BURN_IN:
            samples.append((sweep, *totals[-1]))
            states.append(_of(state, STATE).withColumn("other", F.lit(sweep).cast("long")))
            tabled.append(_of(tables, TABLES))

    pairs = step(_pair_answers(room), "pairs", _of(counts, PAIRS, ASKED, MULTI), *tabled,
                 keep=True)
    known = step(
        _word_answers(room, parent, types, samples), "known",
        _of(counts, WANTED), _of(whole, WORDS), *states, keep=True,
    )
    return pairs.unionByName(known), room, train, types


def _scores(docs: DataFrame, held_out: Column) -> DataFrame:
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    pair_buckets, word_buckets = 1 + size // PAIR_TEXT, 1 + size // WORD_TEXT

    with scratch(docs.sparkSession):  # the parcels need the answers alone
        answers, room, train, types = _answers(texts, pair_buckets, word_buckets)
    parcels = texts.mapInArrow(
        _with_parcels, "doc_id long, held_out boolean, text string, parcel long"
    )
    found = (
        parcels.groupBy("parcel")
        .cogroup(answers.withColumnRenamed("at", "parcel").groupBy("parcel"))
        .applyInArrow(_scored(room, train, types), SCORES)
    )
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(train).cast("long").alias("train_tokens"), "base_score", "score",
    )
