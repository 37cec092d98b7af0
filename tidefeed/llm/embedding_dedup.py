"""Embedding near-duplicates by lattice hashing, verified by cosine.

A table projects unit vectors at random to one or more blocks of 8 dimensions and decodes each to
the nearest point of the lattice E8; the points together are the cell. A vector is entered under
its own cell and looks in it and in neighbouring ones: those with the points of any of the blocks
moved to the next nearest lattice point. Blocks and their scale are chosen such that a cell holds
some dozens of scattered vectors on average. Projections are normal, so whether a pair meets in a
table depends on its cosine alone, and tables are independent: as many are taken as let a pair at
the threshold meet with probability ``RECALL``, whatever the number of rows. Tables are done a few
at a time, so that more of them need no more disk. Nothing is fitted, every row is indexed, and
there is no cap on a cell.

Equal vectors are one class and looked up once. A cell of many classes is cut into slices, and
every pair of slices is one task's matrix product. A pair counts where it first meets, in the order
of tables, so that counts of links add up; and a task sends on counts and, of the links, a spanning
forest, so that a large group of near copies makes no square of rows.

Vectors that are null, zero, or hold null or non-finite components link with nothing; vectors of
different lengths do not meet. Every row gives a result row. Rows of one id are counted as other
vectors of each other, and share a component. A null id comes after all others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.components import components
from tidefeed.llm.shared import flat, mixed, real_id, row_id, scratch, staged
from tidefeed.llm.topk_search import whole_vectors

#: Links have this cosine at least.
COSINE = 0.9
SCALE = 0.6
CELLS, IN_CELL = 1400, 48
#: Cells of one block that scattered vectors seem to have, at some scales.
CELLS_AT, SCALES = (29, 210, 868), (0.4, 0.5, SCALE)
#: Part of the pairs at the threshold that meet; of those above it more do.
RECALL = 0.99
PAIRS = 20_000  # drawn to find it
#: Cells that a class looks in at a time.
LOOKS = 8
#: Rows of a slice of a cell.
SLICE = 1024


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest points of E8: (+-1, +-1, 0 ...) and (+-1/2 ...) with an even sign count."""
    pairs = [(i, j, a, b) for i in range(8) for j in range(i) for a in (1, -1) for b in (1, -1)]
    whole = np.zeros((len(pairs), 8))
    for row, (i, j, a, b) in zip(whole, pairs, strict=True):
        row[i], row[j] = a, b
    signs = ((np.arange(256)[:, None] >> np.arange(8)) & 1) * 2 - 1
    return np.concatenate([whole, signs[(signs < 0).sum(1) % 2 == 0] / 2])


NEIGHBOURS = _minimal_vectors()


def _nearest_even(y: np.ndarray) -> np.ndarray:
    """The nearest point with whole coordinates and an even sum, for each row."""
    near = np.rint(y)
    odd = near.sum(1) % 2 != 0
    worst = np.abs(y - near).argmax(1)
    at = np.flatnonzero(odd)
    away = y[at, worst[at]] - near[at, worst[at]]
    near[at, worst[at]] += np.where(away >= 0, 1, -1)
    return near


def nearest_points(y: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row."""
    whole = _nearest_even(y)
    half = _nearest_even(y - 0.5) + 0.5
    closer = ((y - half) ** 2).sum(1) < ((y - whole) ** 2).sum(1)
    return np.where(closer[:, None], half, whole)


@cache
def tables_for(blocks: int, cosine: float, scale: float = SCALE) -> int:
    """Tables in one of which a pair of this cosine meets with probability ``RECALL``."""
    draw = np.random.default_rng([9, blocks])
    one, other = np.ones(PAIRS, bool), np.ones(PAIRS, bool)
    for _ in range(blocks):
        x, y = draw.standard_normal((2, PAIRS, 8))
        y = cosine * x + np.sqrt(max(1 - cosine * cosine, 0)) * y
        (a, near_a), (b, near_b) = _two_points(scale * x), _two_points(scale * y)
        one &= (a == b).all(1) | (near_a == b).all(1)
        other &= (a == b).all(1) | (near_b == a).all(1)
    meet = max((one | other).sum(), 1) / PAIRS
    return 1 if meet == 1 else max(1, int(np.ceil(np.log(1 - RECALL) / np.log(1 - meet))))


def _two_points(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and the next nearest point of E8 to each row."""
    near = nearest_points(y)
    return near, near + NEIGHBOURS[((y - near) @ NEIGHBOURS.T).argmax(1)]


@dataclass(frozen=True)
class Lattices:
    """Random projections of all tables, the same in every task."""

    width: int
    blocks: int
    cosine: float = COSINE
    scale: float = SCALE

    @property
    def tables(self) -> int:
        return tables_for(self.blocks, self.cosine, self.scale)

    def cells(self, unit: np.ndarray, first: int = 0, end: int | None = None) -> np.ndarray:
        """Cell numbers by row, table (from ``first``) and probe; probe 0 is the own cell."""
        end = self.tables if end is None else end
        out = np.zeros((len(unit), end - first, 1 << self.blocks), np.uint64)
        weights = mixed(np.arange(1, 8 * self.blocks + 1, dtype=np.uint64))
        for t in range(first, end):
            draw = np.random.default_rng([8, self.width, self.blocks, t])
            for b in range(self.blocks):
                y = unit @ (self.scale * draw.standard_normal((self.width, 8)))
                for moved, point in enumerate(_two_points(y)):
                    twice = np.rint(2 * point).astype(np.int64).view(np.uint64)
                    number = (twice * weights[8 * b : 8 * b + 8]).sum(1, dtype=np.uint64)
                    probes = np.flatnonzero((np.arange(1 << self.blocks) >> b) & 1 == moved)
                    out[:, t - first, probes] += number[:, None]
        return mixed(out)


def _unit(vectors: np.ndarray, width: int) -> np.ndarray:
    x = vectors.reshape(-1, width).astype(np.float64)
    # no overflow of squares: first by the largest component
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _entries(lattices: Callable[[int], Lattices], first: int, end: int):
    """(table, cell, entered) for each cell that a class is entered in or looks in."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, len(b), SLICE)):
            values, widths = flat(batch.column("vector"))
            starts = np.concatenate([[0], np.cumsum(widths)])
            for width in np.unique(widths).tolist():
                rows = np.flatnonzero(widths == width)
                at = starts[rows][:, None] + np.arange(width)
                cells = lattices(width).cells(_unit(values[at], width), first, end)
                n, tables, probes = cells.shape
                table = first + np.tile(np.repeat(np.arange(tables), probes), n)
                who = pa.array(np.repeat(rows, tables * probes))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("class").take(who),
                        pa.array(np.full(len(table), width, np.int32)),
                        pa.array(table.astype(np.int32)),
                        pa.array(cells.reshape(-1).view(np.int64)),
                        pa.array(np.tile(np.arange(probes), n * tables) == 0),
                    ],
                    ["class", "width", "table", "cell", "entered"],
                )

    return enter


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which links join two parts that those before did not join."""
    head: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := head.setdefault(x, x)) != x:
            head[x] = head[up]
            x = head[x]
        return x

    keep = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            head[max(x, y)] = min(x, y)
            keep[i] = True
    return keep


def _verify(lattices: Callable[[int], Lattices], cosine: float):
    def verify(got: pa.Table) -> pa.Table:
        width, table = got.column("width")[0].as_py(), got.column("table")[0].as_py()
        ids = got.column("class").to_numpy()
        copies = got.column("copies").to_numpy()
        entered = got.column("entered").to_numpy(zero_copy_only=False)
        unit = _unit(flat(got.column("vector"))[0], width)
        inside, looking = np.flatnonzero(entered), np.flatnonzero(got.column("looks").to_numpy(zero_copy_only=False))
        cells = None
        links_a, links_b, counted = [], [], np.zeros(len(ids), np.int64)
        for first in range(0, len(looking), 256):
            rows = looking[first : first + 256]
            near = np.argwhere(unit[rows] @ unit[inside].T >= cosine)
            p, q = rows[near[:, 0]], inside[near[:, 1]]
            apart = ids[p] != ids[q]
            p, q = p[apart], q[apart]
            if not len(p):
                continue
            if cells is None:
                cells = lattices(width).cells(unit, 0, table + 1)
            # met before: in an earlier table, or here with the smaller id looking
            for t in range(table):
                seen = (cells[p, t] == cells[q, t, :1]).any(1)
                seen |= (cells[q, t] == cells[p, t, :1]).any(1)
                p, q = p[~seen], q[~seen]
            seen = (ids[p] > ids[q]) & (cells[q, table] == cells[p, table, :1]).any(1)
            p, q = p[~seen], q[~seen]
            np.add.at(counted, p, copies[q])
            np.add.at(counted, q, copies[p])
            links_a.append(ids[p])
            links_b.append(ids[q])
        a = np.concatenate([np.zeros(0, np.int64), *links_a])
        b = np.concatenate([np.zeros(0, np.int64), *links_b])
        keep = _forest(a, b)
        some = counted > 0
        return pa.table(
            {
                "a": np.concatenate([ids[some], a[keep]]),
                "b": np.concatenate([ids[some], b[keep]]),
                "n": np.concatenate([counted[some], np.zeros(int(keep.sum()), np.int64)]),
            }
        )

    return verify


def _known(usable: DataFrame, cosine: float) -> DataFrame:
    """(vector, n_links, component_id) of each different vector."""
    classes = usable.groupBy("vector").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    classes = staged(
        classes.withColumn("class", F.xxhash64("vector")), "classes"
    )
    blocks, scale = shape(classes.count())
    tables = tables_for(blocks, cosine, scale)
    at_once = max(1, LOOKS >> blocks)
    found = [
        _met(classes, blocks, scale, cosine, first, min(first + at_once, tables))
        for first in range(0, tables, at_once)
    ]
    found = reduce(DataFrame.unionAll, found)
    counts = found.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("linked"))
    reached = components(found.select("a", "b")).withColumnRenamed("id", "class")
    known = (
        classes.join(counts, "class", "left")
        .join(reached, "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(smallest, "component").select(
        "vector", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    return known

def shape(n: int) -> tuple[int, float]:
    """Blocks of a table, and their scale, for n different vectors."""
    blocks = 1
    while n > IN_CELL * CELLS**blocks:
        blocks += 1
    cells = max(n / IN_CELL, 1) ** (1 / blocks)
    return blocks, float(np.interp(np.log(cells), np.log(CELLS_AT), SCALES))


def _met(
    classes: DataFrame, blocks: int, scale: float, cosine: float, first: int, end: int
) -> DataFrame:
    """Links (a, b) that a table from ``first`` on is the first to show, and their numbers n."""

    def lattices(width: int) -> Lattices:
        return Lattices(width, blocks, cosine, scale)

    entries = classes.select("class", "vector").mapInArrow(
        _entries(lattices, first, end),
        "class long, width int, table int, cell long, entered boolean",
    )
    # a class looks in every cell listed, and is entered in its own
    place = ["width", "table", "cell"]
    entries = staged(entries, "entries")
    sizes = (
        entries.groupBy(*place)
        .agg(F.count("*").alias("looking"), F.sum(F.col("entered").cast("int")).alias("inside"))
        .where("inside > 0 AND looking > 1")
        .select(
            *place,
            F.ceil(F.col("looking") / SLICE).cast("int").alias("looking"),
            F.ceil(F.col("inside") / SLICE).cast("int").alias("inside"),
        )
    )
    met = entries.join(sizes, place)
    deal = F.xxhash64("class", "table")
    own_look = F.pmod(deal, F.col("looking")).cast("int")
    own_inside = F.pmod(deal, F.col("inside")).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    looks = met.select(
        *place, "class", F.lit(True).alias("looks"), F.lit(False).alias("entered"),
        own_look.alias("i"), every("inside").alias("j"),
    )
    inside = met.where("entered").select(
        *place, "class", F.lit(False).alias("looks"), F.lit(True).alias("entered"),
        every("looking").alias("i"), own_inside.alias("j"),
    )
    task = [*place, "i", "j"]
    both = (
        looks.unionByName(inside)
        .groupBy(*task, "class")
        .agg(F.max("looks").alias("looks"), F.max("entered").alias("entered"))
        .join(classes.select("class", "vector", "copies"), "class")
    )
    verified = both.groupBy(*task).applyInArrow(
        _verify(lattices, cosine), "a long, b long, n long"
    )
    return staged(verified, "links")


def near_duplicates(rows: DataFrame, vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row with vec_id and a vector."""
    named = rows.select(
        row_id("vec_id").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    )
    usable = whole_vectors(named, "vector").where(F.exists("vector", lambda x: x != 0))
    # zero has two signs, and one value
    usable = usable.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    with scratch(rows.sparkSession):
        known = staged(_known(usable, cosine), "known", keep=True)
    by_class = usable.select("id", F.xxhash64("vector").alias("class")).join(
        known.select(F.xxhash64("vector").alias("class"), "n_links", "component_id"), "class"
    )
    out = by_class.select("id", "n_links", "component_id")
    apart = named.where(~F.coalesce(_usable(), F.lit(False))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return out.unionByName(apart).select(
        real_id("id").alias("vec_id"),
        "n_links",
        real_id("component_id").alias("component_id"),
        (F.col("id") == F.col("component_id")).alias("kept"),
    )


def _usable():
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)
