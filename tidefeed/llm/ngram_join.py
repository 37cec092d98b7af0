"""N-gram Jaccard join: documents whose sets of word shingles are alike, by a grouped prefix join.

1. A document can only link if at least the threshold's share of its shingles occurs in other
   documents (``repeats``). Most documents end here.
2. Documents with the same set are one class; classes take part once.
3. Shingles are ordered by how many classes have them, rarest first. Two classes that link share
   a shingle among the first ``n - ceil(t n) + 1`` of each (their prefixes).
4. Classes of one size and one prefix are collapsed into a group. Groups meet in the lists of
   their prefix shingles. Lists of the same groups are one list, that of the first shingle.
5. A list's classes are dealt out to blocks by a hash, and each pair of a list's blocks is one row.
   Two classes belong to the last list that they share, the most frequent one, where most of their
   like are. First group pairs are filtered by this, by size and by position, without sets. Then
   the members that are left in a list meet again with their whole sets, and are verified, a block
   against a block.

So every link between different sets is found and counted once, but no pair travels: a pair of
blocks hands on how many documents each member links with, and a link for each member to one that
it reaches in there, from which components follow.

Nulls, empty texts and texts without words have no shingles and link with nothing. Rows with the
same id and text are one document; the same id with different texts is one node of the result with
a row for each text. A null id comes after all others. Further columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.components import components
from tidefeed.llm.repeats import shingle_repeats
from tidefeed.llm.shared import (
    chunks,
    flat,
    keyed,
    lists,
    mixed,
    real_id,
    scratch,
    staged,
    utf8,
)
from tidefeed.llm.shingles import shingles

#: The similarity from which documents link: 3 / 4.
OF, PART = 4, 3
#: Classes of a block, on average; blocks meet in pairs.
BLOCK = 256
#: Shingles in the rows of a partition that is verified, on average.
VERIFIED = 4 << 20
#: Columns of the matrices that are multiplied at a time.
WIDE = 4096

SETS = "id long, version long, n int, low long, high long, shingles array<long>"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for a, b in chunks(offsets):
            values, sizes = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            sums = np.zeros((2, len(values) + 1), np.uint64)
            np.cumsum(values, out=sums[0, 1:])
            np.cumsum(mixed(values), out=sums[1, 1:])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            low, high = (sums[:, ends[1:]] - sums[:, ends[:-1]]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(a, b - a),
                    batch.column("version").slice(a, b - a),
                    pa.array(sizes.astype(np.int32)),
                    pa.array(low),
                    pa.array(high),
                    lists(values.view(np.int64), sizes),
                ],
                ["id", "version", "n", "low", "high", "shingles"],
            )


def _prefixes(sets: DataFrame) -> DataFrame:
    """(class, documents, n, before, prefix, shared): the shingles that others have too, rarest
    first, those of them in the prefix, and how many shingles that nobody else has precede."""
    tokens = sets.select("class", F.explode("shingles").alias("s"))
    often = tokens.groupBy("s").agg(F.count("*").alias("often")).where("often > 1")
    shared = (
        tokens.join(often, "s")
        .groupBy("class")
        .agg(F.sort_array(F.collect_list(F.struct("often", "s"))).alias("ordered"))
    )
    before = F.col("n") - F.size("ordered")
    length = F.expr(f"n - (n * {PART} + {OF - 1}) div {OF} + 1").cast("int") - before
    return (
        shared.join(sets.select("class", "n", "documents"), "class")
        .withColumn("before", before)
        .withColumn("length", length)
        .where("length > 0")
        .select(
            "class", "documents", "n", "before",
            F.expr("slice(ordered, 1, length)").alias("prefix"),
            F.col("ordered.s").alias("shared"),
        )
    )


def _places(prefixes: DataFrame) -> DataFrame:
    """(s, blocks, i, class, group, n, place, later): each class in each of its lists, the block it
    is dealt to, its place in the order of shingles, and its lists after this one."""
    same = ["n", "before", F.col("prefix.s").alias("names")]
    keyed_prefixes = prefixes.withColumn("names", F.col("prefix.s"))
    groups = prefixes.groupBy(*same).agg(
        F.min("class").alias("group"),
        F.count("*").alias("classes"),
        F.first("prefix").alias("prefix"),
    )
    groups = staged(groups, "groups")
    places = groups.select(
        "group", "classes", "before", F.posexplode("prefix").alias("i", "x")
    ).select("group", "classes", (F.col("before") + F.col("i")).alias("place"), "x.often", "x.s")
    lists_of = (
        places.groupBy("s")
        .agg(
            F.min("often").alias("often"),
            F.sum("classes").alias("members"),
            F.bit_xor(F.xxhash64("group")).alias("one"),
            F.bit_xor(F.xxhash64(F.lit(1), "group")).alias("other"),
        )
        .where("members > 1")
        .groupBy("members", "one", "other")
        .agg(F.min(F.struct("often", "s")).alias("first"))
        .select("first.s", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    )
    own = (
        places.join(staged(lists_of, "lists"), "s")
        .groupBy("group")
        .agg(F.sort_array(F.collect_list(F.struct("often", "s", "place", "blocks"))).alias("own"))
    )
    members = keyed_prefixes.join(groups.select("n", "before", "names", "group"), ["n", "before", "names"])
    members = members.select("class", "n", "group").join(own, "group")
    rows = members.select("*", F.posexplode("own").alias("at", "list")).select(
        F.col("list.s").alias("s"),
        F.col("list.blocks").alias("blocks"),
        F.pmod(F.xxhash64("class"), "list.blocks").cast("int").alias("i"),
        "class",
        "group",
        F.col("n").cast("long").alias("n"),
        F.col("list.place").cast("long").alias("place"),
        F.expr("slice(own.s, at + 2, size(own))").alias("later"),
    )
    return staged(rows, "places")


FIELDS = ("class", "group", "n", "place", "later")


def _paired(rows: DataFrame, fields: Sequence[str], purpose: str) -> DataFrame:
    """Pairs of blocks (s, i, j, left, right) of every list's members; ``right`` is empty where a
    block meets itself."""
    blocks = rows.groupBy("s", "blocks", "i").agg(F.collect_list(F.struct(*fields)).alias("left"))
    blocks = staged(blocks, purpose)
    alone = blocks.where("size(left) > 1").select(
        "s", "i", F.col("i").alias("j"), "left", F.expr("slice(left, 1, 0)").alias("right")
    )
    several = blocks.where("blocks > 1")
    ahead = several.where("i < blocks - 1").select(
        "s", "i", "left", F.explode(F.sequence(F.col("i") + 1, F.col("blocks") - 1)).alias("j")
    )
    right = several.select("s", F.col("i").alias("j"), F.col("left").alias("right"))
    return alone.unionByName(ahead.join(right, ["s", "j"]))


class _Members:
    """The members of many rows' blocks, flat."""

    def __init__(self, column: pa.Array):
        self.ends = np.append(0, np.cumsum(flat_counts(column)))
        members = column.flatten()
        self.values, self.lists = {}, {}
        for field in members.type:
            values = members.field(field.name)
            if pa.types.is_list(field.type):
                values, counts = flat(values)
                self.lists[field.name] = (values, np.append(0, np.cumsum(counts)))
            else:
                self.values[field.name] = values.to_numpy(zero_copy_only=False)

    def block(self, row: int) -> slice:
        return slice(int(self.ends[row]), int(self.ends[row + 1]))

    def elements(self, name: str, of: slice) -> tuple[np.ndarray, np.ndarray]:
        """The elements of some members' lists, and each one's member among them."""
        values, ends = self.lists[name]
        counts = np.diff(ends[of.start : of.stop + 1])
        return values[ends[of.start] : ends[of.stop]], np.repeat(np.arange(len(counts)), counts)


def flat_counts(column: pa.Array) -> np.ndarray:
    return column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _common(a, b, rows: int, columns: int) -> np.ndarray:
    """How many elements each of ``rows`` sets has in common with each of ``columns`` sets."""
    (x, x_of), (y, y_of) = a, b
    both = np.intersect1d(x, y)
    out = np.zeros((rows, columns), np.float32)
    at = []
    for values, of in (a, b):
        place = np.searchsorted(both, values)
        here = np.flatnonzero(place < len(both))
        here = here[both[place[here]] == values[here]]
        order = here[np.argsort(place[here], kind="stable")]
        at.append((place[order], of[order]))
    for first in range(0, len(both), WIDE):
        parts = []
        for (place, of), n in zip(at, (rows, columns), strict=True):
            low, high = np.searchsorted(place, (first, first + WIDE))
            matrix = np.zeros((n, min(WIDE, len(both) - first)), np.float32)
            matrix[of[low:high], place[low:high] - first] = 1
            parts.append(matrix)
        out += parts[0] @ parts[1].T
    return out


def _candidates(left: _Members, a: slice, right: _Members, b: slice, alone: bool) -> np.ndarray:
    """Which members of two blocks belong to this list and may link."""
    x, y = ({n: v[of] for n, v in m.values.items()} for m, of in ((left, a), (right, b)))
    # group pairs first
    groups, of = [], []
    for side in (x, y):
        _, first, number = np.unique(side["group"], return_index=True, return_inverse=True)
        groups.append((side["n"][first], side["place"][first]))
        of.append(number)
    (n, p), (m, q) = groups
    n, p = n[:, None], p[:, None]
    most = np.minimum(p, q) + 1 + np.minimum(n - p, m - q) - 1
    fits = (np.minimum(n, m) * OF >= np.maximum(n, m) * PART) & (most * (OF + PART) >= (n + m) * PART)
    maybe = fits[of[0]][:, of[1]]
    if alone:
        maybe &= np.arange(len(x["n"]))[:, None] < np.arange(len(y["n"]))
    if maybe.any():
        later = left.elements("later", a), right.elements("later", b)
        maybe &= _common(*later, *maybe.shape) == 0
    return maybe


def _linked(left: _Members, a: slice, right: _Members, b: slice, alone: bool) -> np.ndarray:
    """Which members of two blocks link, in the list that they belong to."""
    maybe = _candidates(left, a, right, b, alone)
    if not maybe.any():
        return maybe
    n, m = left.values["n"][a][:, None], right.values["n"][b]
    common = _common(left.elements("shared", a), right.elements("shared", b), *maybe.shape)
    return maybe & (common * OF >= (n + m - common) * PART)


def _meetings(batch: pa.RecordBatch):
    """(row, left, its block, right, its block, whether they are one) of each row."""
    left, right = _Members(batch.column("left")), _Members(batch.column("right"))
    i, j = batch.column("i").to_numpy(), batch.column("j").to_numpy()
    for row in range(len(batch)):
        alone = bool(i[row] == j[row])
        other = left if alone else right
        yield row, left, left.block(row), other, other.block(row), alone


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(s, i, classes): the members of a list's block that may link with another one here."""
    for batch in batches:
        i, j = batch.column("i").to_numpy(), batch.column("j").to_numpy()
        kept, rows, blocks = [], [], []
        for row, left, a, right, b, alone in _meetings(batch):
            maybe = _candidates(left, a, right, b, alone)
            sides = [maybe.any(1), maybe.any(0)]
            if alone:
                sides = [sides[0] | sides[1]]
            for members, of, block, some in zip((left, right), (a, b), (i, j), sides):
                if some.any():
                    kept.append(members.values["class"][of][some])
                    rows.append(row)
                    blocks.append(block[row])
        every = np.concatenate(kept) if kept else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("s").take(pa.array(rows, pa.int64())),
                pa.array(blocks, pa.int32()),
                lists(every, np.array([len(k) for k in kept], np.int64)),
            ],
            ["s", "i", "classes"],
        )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, links): documents that a member links with here, and one member that it reaches."""
    for batch in batches:
        out: list[list[np.ndarray]] = [[], [], []]
        for _, left, a, other, b, alone in _meetings(batch):
            links = _linked(left, a, other, b, alone)
            if not links.any():
                continue
            x, y = left.values["class"][a], other.values["class"][b]
            least = [x.copy(), y.copy()]
            while True:  # labels of the parts that hang together here
                far = np.iinfo(np.int64).max
                up = np.minimum(least[0], np.where(links, least[1], far).min(1))
                down = np.minimum(least[1], np.where(links, up[:, None], far).min(0))
                if alone:
                    up = down = np.minimum(up, down)
                if (up == least[0]).all() and (down == least[1]).all():
                    break
                least = [up, down]
            sums = [links @ other.values["documents"][b], left.values["documents"][a] @ links]
            for names, reached, n in zip((x, y), least, sums, strict=True):
                some = n > 0
                for column, values in zip(out, (names, reached, n), strict=True):
                    column.append(values[some])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out],
            ["a", "b", "links"],
        )


def _dealt(meetings: DataFrame, size: Column) -> DataFrame:
    """The meetings in partitions of about ``VERIFIED`` elements."""
    n = meetings.agg(F.sum(size)).first()[0] or 0
    return meetings.repartition(max(1, -(-n // VERIFIED)), "s", "i", "j")


def _links(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect whatever links connect, and (class, links): all of a class's
    links, by the documents that they lead to."""
    prefixes = staged(_prefixes(sets), "prefixes")
    places = _places(prefixes)
    needed = _dealt(_paired(places, FIELDS, "narrow"), F.size("left") + F.size("right"))
    needed = needed.mapInArrow(_needed, "s long, i int, classes array<long>")
    every = F.array_distinct(F.flatten(F.collect_list("classes")))
    needed = needed.groupBy("s", "i").agg(every.alias("classes"))
    needed = staged(needed.select("s", F.explode("classes").alias("class")), "needed")
    rows = places.join(needed, ["s", "class"]).join(
        prefixes.select("class", "documents", "shared"), "class"
    )
    size = F.aggregate("left", F.lit(0), lambda n, m: n + F.size(m["shared"])) + F.aggregate(
        "right", F.lit(0), lambda n, m: n + F.size(m["shared"])
    )
    dealt = _dealt(_paired(rows, (*FIELDS, "documents", "shared"), "blocks"), size)
    found = staged(dealt.mapInArrow(_verified, "a long, b long, links long"), "links")
    counts = found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    return found.where("a <> b").select("a", "b").distinct(), counts


def similar_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, version, n_shingles, component_id, n_links, group, rows) of each distinct document.

    ``version`` is ``xxhash64`` of the text, ``n_links`` counts the other documents it links with,
    copies included, ``group`` names the documents that reach each other (null: alone), and
    ``rows`` counts the rows of the same id and text.
    """
    with scratch(docs.sparkSession):
        return staged(_similar(docs, text), "similar", keep=True)


def _similar(docs: DataFrame, text: str) -> DataFrame:
    whole = keyed(docs, text)
    stats = staged(shingle_repeats(whole), "repeats")
    suspects = stats.where(f"n > 0 AND repeated * {OF} >= n * {PART}").select("id", "version")
    all_sets = whole.join(suspects, ["id", "version"], "left_semi").mapInArrow(_sets, SETS)
    all_sets = staged(
        all_sets.withColumn("class", F.xxhash64("n", "low", "high")).drop("low", "high"), "sets"
    )
    texts = all_sets.select("id", "version", "class").distinct()
    heads = texts.groupBy("class").agg(
        F.min(F.struct("id", "version")).alias("head"), F.count("*").alias("documents")
    )
    sets = (
        all_sets.join(
            heads.select(
                F.col("head.id").alias("id"), F.col("head.version").alias("version"), "documents"
            ),
            ["id", "version"],
        )
        .select("class", "n", "documents", "shingles")
        .dropDuplicates(["class"])
    )
    links, counts = _links(staged(sets, "sets"))
    reached = components(links)
    known = (
        texts.join(reached.withColumnRenamed("id", "class"), "class", "left")
        .join(heads.select("class", "documents"), "class")
        .join(counts, "class", "left")
    )
    known = known.select(
        "id", "version", F.coalesce("component", "class").alias("group"),
        (F.coalesce("links", F.lit(0)) + F.col("documents") - 1).alias("links"),
    )
    # a class may be some texts of one id
    least = known.groupBy("group").agg(F.min("id").alias("least"))
    found = known.join(least, "group")
    return stats.join(found, ["id", "version"], "left").select(
        real_id("id").alias("doc_id"),
        "version",
        F.col("n").alias("n_shingles"),
        real_id(F.coalesce("least", "id")).alias("component_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        "group",
        "rows",
    )
