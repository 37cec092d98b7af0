"""How far the sources of a language differ in the terms they use, by a recount in dense slots.

1. First pass: in how many documents of its language each term is, exactly; a language keeps the
   terms of at least ``least`` documents.
2. The kept terms are dealt out to shards of bounded size. Each shard becomes a minimal perfect
   hash with its terms stored (``perfect_hash``).
3. Second pass: the shards are broadcast, as many at a time as ``WAVE`` bytes allow, and every
   task counts the texts it reads in dense slots, an array for each of its groups and shards. A
   look-up is verified against the stored term. What a task has counted is summed by Spark.
4. A block of slots, with a row for every group of its language, is a small matrix: it gives the
   block's part of every pair's divergence, and each group's candidates for its top terms.

Null text, lang and source are empty. A text without terms still makes its group occur. Every row
is a document, repeated rows and rows of one or of no id too. Further columns are not read. An
empty table gives no rows. All arithmetic is on whole numbers, exact while a language has fewer
than 9 * 10**15 kept occurrences and terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidefeed.llm.perfect_hash import Table, build, hashes, stored
from tidefeed.llm.shared import chunks, scratch, staged, utf8

#: Bytes of text that are counted at a time.
TEXT = 16 << 20
#: Terms of a shard, on average; their stored form takes at most some 230 bytes each.
KEYS = 1 << 15
#: Bytes of shards broadcast at a time; beyond it the second pass is made once more.
WAVE = 64 << 20
#: Slots that a task holds; then it hands on its counts and begins anew.
SLOTS = 1 << 24
#: Cells (groups by terms) of a block.
CELLS = 1 << 16
#: Parts of a whole that a share is counted in.
WHOLE = 1_000_000_000
LEAST, TOP = 3, 200

_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

DEALT = "lang_id long, part int, parts int, width int, term string"
SHARD = (
    "lang_id long, part int, parts int, width int, "
    "sizes binary, bits binary, terms binary, ends binary"
)


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts, A-Z in lower case, and the text of each."""
    inside = _TERM[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = ~inside[:-1]
    edge[offsets] = True
    starts = np.flatnonzero(inside & edge[:-1])
    kept = _LOWER[data[inside]]
    before = np.cumsum(inside, dtype=np.int64)[starts] - 1
    ends = np.append(before, len(kept)).astype(np.int32)
    found = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(ends.tobytes()), pa.py_buffer(kept.tobytes())
    )
    return found, np.searchsorted(offsets, starts, side="right") - 1


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else keys
    return keys[new], np.diff(np.append(new, len(keys)))


def _chunks_of(batches: Iterator[pa.RecordBatch], *columns: str):
    """(distinct terms, number of each term, text of each term, columns of the texts)."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        values = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        for a, b in chunks(offsets, TEXT):
            found, row = terms_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            coded = found.dictionary_encode()
            numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            yield coded.dictionary, numbers, row, [v[a:b] for v in values]


def _in_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for names, numbers, row, (langs,) in _chunks_of(batches, "lang_id"):
        n = max(1, len(names))
        once, _ = _counted(row * n + numbers)
        every, lang = np.unique(langs, return_inverse=True)
        keys, documents = _counted(lang[once // n] * n + once % n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(every[keys // n]), names.take(pa.array(keys % n)), pa.array(documents)],
            ["lang_id", "term", "documents"],
        )


def _shard(got: pa.Table) -> pa.Table:
    terms = got.column("term").combine_chunks()
    made = build(terms)
    made.pop("order")
    columns = {c: got.column(c)[:1] for c in ("lang_id", "part", "parts", "width")}
    return pa.table(columns | {k: pa.array([v], pa.binary()) for k, v in made.items()})


def _slots_of(got: pa.Table) -> pa.Table:
    """Where each term of a shard is: its block in the language, and its slot there."""
    terms = got.column("term").combine_chunks()
    order = build(terms)["order"]
    part, width = got.column("part")[0].as_py(), got.column("width")[0].as_py()
    slot = np.arange(len(order))
    return pa.table(
        {
            "lang_id": got.column("lang_id"),
            "block": pa.array(((part << 20) + slot // width).astype(np.int64)),
            "slot": pa.array((slot % width).astype(np.int32)),
            "term": terms.take(pa.array(order)),
        }
    )


class _Slots:
    """Dense counts of a task: an array for each group and shard."""

    def __init__(self, shards: dict[int, dict[int, tuple[int, Table]]]):
        self.shards, self.held, self.size = shards, {}, 0

    def add(self, group: int, lang: int, part: int, slots: np.ndarray, n: np.ndarray) -> None:
        key = (group, lang, part)
        if key not in self.held:
            self.held[key] = np.zeros(len(self.shards[lang][part][1]), np.int64)
            self.size += len(self.held[key])
        self.held[key][slots] += n  # a slot comes once a chunk and group

    def handed_on(self) -> Iterator[pa.RecordBatch]:
        for (group, lang, part), counts in self.held.items():
            width = self.shards[lang][part][0]
            slot = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(slot), lang)),
                    pa.array(np.full(len(slot), group)),
                    pa.array(((part << 20) + slot // width).astype(np.int64)),
                    pa.array((slot % width).astype(np.int32)),
                    pa.array(counts[slot]),
                ],
                ["lang_id", "group", "block", "slot", "n"],
            )
        self.held, self.size = {}, 0


def _recount(wave):
    """Counts the terms of the broadcast shards of a ``wave``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[int, dict[int, tuple[int, Table]]] = {}
        parts: dict[int, int] = {}  # shards of each language, also of other waves
        for sent in wave:
            lang, part, parts[sent.value[0]], width, *made = sent.value
            shards.setdefault(lang, {})[part] = (width, Table(*made))
        counts = _Slots(shards)
        for names, numbers, row, (langs, groups) in _chunks_of(batches, "lang_id", "group"):
            n = max(1, len(names))
            every, first, group = np.unique(groups, return_index=True, return_inverse=True)
            keys, often = _counted(group[row] * n + numbers)
            of, number = keys // n, keys % n
            names = stored(names)
            hashed = hashes(names)
            spoken = langs[first]
            for lang in np.unique(spoken).tolist():
                if lang not in shards:
                    continue
                mine = np.flatnonzero(spoken[of] == lang)
                some = np.unique(number[mine])
                dealt = part_of(hashed[some], parts[lang])
                slot = np.full(n, -1, np.int64)
                where = np.full(n, -1, np.int64)
                where[some] = dealt
                for part, (_, table) in shards[lang].items():
                    here = some[dealt == part]
                    slot[here] = table.find(names.take(pa.array(here)), hashed[here])
                mine = mine[slot[number[mine]] >= 0]
                mine = mine[np.lexsort((where[number[mine]], of[mine]))]
                both = of[mine] * parts[lang] + where[number[mine]]
                runs = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else []
                for a, b in zip(runs, np.append(runs, len(both))[1:].astype(int), strict=False):
                    x = mine[a:b]
                    part = int(where[number[x[0]]])
                    counts.add(int(every[of[x[0]]]), lang, part, slot[number[x]], often[x])
                    if counts.size >= SLOTS:
                        yield from counts.handed_on()
        yield from counts.handed_on()

    return run


def part_of(names: np.ndarray, parts: int | np.ndarray) -> np.ndarray:
    """The shard of a language that a term's hash deals it to."""
    return ((names >> np.uint64(33)).astype(np.int64) % parts).astype(np.int64)


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = hashes(stored(batch.column("term")))
        part = part_of(names, batch.column("parts").to_numpy()).astype(np.int32)
        yield batch.add_column(1, "part", pa.array(part))


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(WHOLE * (counts + 1) / total), digit by digit so that nothing overflows."""
    whole, rest = np.divmod(counts + 1, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + more
    return 1 + whole


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _compared(top: int):
    """What a block of terms adds to each pair of groups, and each group's best terms in it."""

    def run(got: pa.Table) -> pa.Table:
        groups = got.column("group").to_numpy()
        slot = got.column("slot").to_numpy()
        n = got.column("n").to_numpy()
        totals, kept = slot == -1, np.flatnonzero(slot == -2)
        order = np.argsort(groups[totals])
        every, sums = groups[totals][order], n[totals][order]
        vocabulary = int(got.column("v").combine_chunks().filter(pa.array(totals))[0].as_py())
        words = got.column("term").combine_chunks().take(pa.array(kept))
        slots = n[kept]  # of a term's row the number is its slot
        counts = np.zeros((len(every), int(slots.max()) + 1), np.int64)
        cells = slot >= 0
        counts[np.searchsorted(every, groups[cells]), slot[cells]] = n[cells]
        rank = np.zeros(counts.shape[1], np.int64)  # of each slot's term in UTF-8 order
        term_at = np.zeros(counts.shape[1], np.int64)
        rank[slots[pc.array_sort_indices(words.cast(pa.binary())).to_numpy()]] = np.arange(len(slots))
        term_at[slots] = np.arange(len(slots))
        p = np.stack([shares(c, int(t) + vocabulary) for c, t in zip(counts, sums, strict=True)])
        q = shares(counts.sum(0), int(sums.sum()) + vocabulary)
        out: dict[str, list] = {"group": [], "other": [], "term": [], "value": []}
        for g in range(len(every)):
            value = _divergence(p[g], p).sum(1)
            out["group"].append(np.full(len(every), every[g]))
            out["other"].append(every)
            out["value"].append(value)
            out["term"].append(pa.nulls(len(every), pa.string()))
            more = np.flatnonzero((counts[g] > 0) & (p[g] > q))
            value = _divergence(p[g][more], q[more])
            best = np.lexsort((rank[more], -value))[:top]
            out["group"].append(np.full(len(best), every[g]))
            out["other"].append(np.full(len(best), every[g]))
            out["value"].append(value[best])
            out["term"].append(words.take(pa.array(term_at[more[best]])))
        return pa.table(
            {k: np.concatenate(v) for k, v in out.items() if k != "term"}
            | {"term": pa.chunked_array(out["term"])}
        ).select(["group", "other", "term", "value"])

    return run


def _same_names(groups: DataFrame) -> None:
    """Groups and languages go by 64-bit hashes; two that share one are refused."""
    n = groups.agg(
        F.count("*").alias("n"),
        F.countDistinct("group").alias("groups"),
        F.countDistinct("lang").alias("langs"),
        F.countDistinct("lang_id").alias("lang_ids"),
    ).first()
    if n.n != n.groups or n.langs != n.lang_ids:
        raise ValueError("two sources or languages have the same 64-bit hash")


def source_divergence(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): each source of a language against the others.

    ``pair`` rows: the divergence from each other source of the language over all kept terms, all
    ranks. ``term`` rows: the terms that the source uses more than its language, by what they add
    to its divergence from it, the ``top`` first ones.
    """
    with scratch(docs.sparkSession):
        return staged(_audited(docs, least, top), "audit", keep=True)


def _audited(docs: DataFrame, least: int, top: int) -> DataFrame:
    spark = docs.sparkSession
    texts = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    ).withColumns({"lang_id": F.xxhash64("lang"), "group": F.xxhash64("lang", "source")})
    groups = staged(texts.select("lang", "source", "lang_id", "group").distinct(), "groups")
    _same_names(groups)

    found = texts.select("text", "lang_id").mapInArrow(
        _in_documents, "lang_id long, term string, documents long"
    )
    kept = found.groupBy("lang_id", "term").agg(F.sum("documents").alias("documents"))
    kept = staged(kept.where(F.col("documents") >= least).select("lang_id", "term"), "kept")
    langs = (
        groups.groupBy("lang_id")
        .agg(F.count("*").alias("n"))
        .join(kept.groupBy("lang_id").agg(F.count("*").alias("v")), "lang_id")
        .select(
            "lang_id",
            "v",
            F.ceil(F.col("v") / KEYS).cast("int").alias("parts"),
            F.greatest(F.lit(1), F.floor(CELLS / F.col("n"))).cast("int").alias("width"),
        )
    )
    langs = staged(langs, "langs")
    dealt = staged(
        kept.join(langs, "lang_id")
        .select("lang_id", "parts", "width", "term")
        .mapInArrow(_dealt, DEALT),
        "dealt",
    )
    shards = staged(dealt.groupBy("lang_id", "part").applyInArrow(_shard, SHARD), "shards")
    where = staged(
        dealt.groupBy("lang_id", "part").applyInArrow(
            _slots_of, "lang_id long, block long, slot int, term string"
        ),
        "slots",
    )
    counts = _counts(texts, shards)
    if counts is None:
        blocks = spark.createDataFrame([], "group long, other long, term string, value long")
    else:
        totals = counts.groupBy("lang_id", "group").agg(F.sum("n").alias("n"))
        totals = groups.join(totals, ["lang_id", "group"], "left").select(
            "lang_id", "group", F.coalesce("n", F.lit(0)).alias("n")
        )
        totals = totals.join(langs.select("lang_id", "v"), "lang_id")
        there = where.select("lang_id", "block").distinct()
        rows = (
            counts.select("lang_id", "block", "group", "slot", "n", _none("term"), _none("v", "long"))
            .unionByName(
                totals.join(there, "lang_id").select(
                    "lang_id", "block", "group", F.lit(-1).alias("slot"), "n", _none("term"), "v"
                )
            )
            .unionByName(
                where.select(
                    "lang_id", "block", F.lit(0).cast("long").alias("group"),
                    F.lit(-2).alias("slot"), F.col("slot").cast("long").alias("n"), "term",
                    _none("v", "long"),
                )
            )
        )
        blocks = staged(
            rows.groupBy("lang_id", "block").applyInArrow(
                _compared(top), "group long, other long, term string, value long"
            ),
            "blocks",
        )
    own = groups.select("lang", "source", "lang_id", "group")
    others = own.select("lang_id", F.col("group").alias("other"), F.col("source").alias("item"))
    pairs = (
        own.join(others, "lang_id")
        .where("`group` <> other")
        .join(
            blocks.where("term IS NULL").groupBy("group", "other").agg(F.sum("value").alias("value")),
            ["group", "other"],
            "left",
        )
        .select("lang", "source", F.lit("pair").alias("part"), "item",
                F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    )
    best = blocks.where("term IS NOT NULL").join(own, "group")
    best = best.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(by).alias("rank")
    return pairs.select("*", rank).unionByName(best.select("*", rank).where(F.col("rank") <= top))


def _none(name: str, kind: str = "string"):
    return F.lit(None).cast(kind).alias(name)


def _counts(texts: DataFrame, shards: DataFrame) -> DataFrame | None:
    """(lang_id, group, block, slot, n): the occurrences of kept terms in every group."""
    context = texts.sparkSession.sparkContext
    read = texts.select("text", "lang_id", "group")
    counts, wave, size = [], [], 0

    def pass_on() -> None:
        found = read.mapInArrow(
            _recount(list(wave)), "lang_id long, group long, block long, slot int, n long"
        )
        found = found.groupBy("lang_id", "group", "block", "slot").agg(F.sum("n").alias("n"))
        counts.append(staged(found, "counts"))
        for sent in wave:
            sent.destroy()
        wave.clear()

    for row in shards.toLocalIterator():  # the driver holds a shard at a time
        shard = (row.lang_id, row.part, row.parts, row.width, *map(bytes, (row.sizes, row.bits, row.terms, row.ends)))
        more = sum(map(len, shard[4:]))
        if wave and size + more > WAVE:
            pass_on()
            size = 0
        wave.append(context.broadcast(shard))
        size += more
    if wave:
        pass_on()
    if not counts:
        return None
    whole = counts[0]
    for more in counts[1:]:
        whole = whole.unionByName(more)
    return whole
