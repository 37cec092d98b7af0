"""Exact top-k search over vectors by vector-approximation files.

Every component is an integer, and its cell is the eight integers it lies among. Vectors are laid
out in blocks of some thousand rows, and queries in blocks too; a task takes a block of queries and
a slice of vector blocks. From the cells alone it gets bounds of each inner product: with the
lowest value of every cell the product is q.low, and the rest adds at most 7 for each positive and
takes at most 7 for each negative component of q. The kth best lower bound rules out most vectors;
the exact vectors of the others are read best upper bound first, until the kth result so far beats
the next bound. A slice gives k rows for each query, and the best k of all slices are the result.

Every query meets every row, in blocks: that is the search asked for. A block is the same for all
queries; there is no hot key. Components must stay below 2**22, so that products are exact.

Vectors that are null, or hold null or non-finite components, and rows with a null id take no part.
Rows of the query's own id are no candidates for it; repeated rows of another id are candidates
each. Vectors of different lengths do not meet. Ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefeed.llm.shared import flat, staged

#: Rows of a block of vectors, of a block of queries, and blocks that a task scans.
ROWS, QUERIES, BLOCKS = 4096, 1024, 16
CELL = 3  # bits of a component that its cell leaves out


def whole_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """Rows with an id and a vector of finite numbers."""
    usable = F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    return rows.where(usable)


def integers(vector: str, scale: int = 64) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(width, name, ids, values): one row for each block."""
    n = rows.count()
    count = max(1, -(-n // size))

    def gather(got: pa.Table) -> pa.Table:
        values, _ = flat(got.column("vector"))
        return pa.table(
            {
                "width": pa.array([got.column("width")[0].as_py()], pa.int32()),
                name: pa.array([got.column(name)[0].as_py()], pa.int64()),
                "ids": pa.array([got.column("id").to_pylist()], pa.list_(pa.int64())),
                "values": pa.array([values.astype(np.int32).tobytes()], pa.binary()),
            }
        )

    block = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(count))
    return (
        rows.select("id", "vector", F.size("vector").alias("width"), block.alias(name))
        .groupBy("width", name)
        .applyInArrow(gather, f"width int, {name} long, ids array<long>, values binary")
    )


def best_of(
    q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int
) -> tuple[list, list, list]:
    """For each query the k best rows of one block: (query ids, row ids, scores)."""
    low = ((x >> CELL) << CELL).astype(np.float64)
    exact = x.astype(np.float64)
    span = (1 << CELL) - 1
    out_q, out_x, out_s = [], [], []
    for first in range(0, len(q), 256):
        tile = q[first : first + 256].astype(np.float64)
        base = tile @ low.T
        base[q_ids[first : first + 256, None] == x_ids[None, :]] = -np.inf
        more = span * np.maximum(tile, 0).sum(1)
        less = span * np.minimum(tile, 0).sum(1)
        m = base.shape[1]
        kth = np.partition(base, m - k, axis=1)[:, m - k] if m > k else np.full(len(tile), -np.inf)
        for i, vector in enumerate(tile):
            # its least product, against the greatest that others can reach
            near = np.flatnonzero((base[i] + more[i] >= kth[i] + less[i]) & (base[i] > -np.inf))
            near = near[np.argsort(-base[i][near], kind="stable")]
            upper = base[i][near] + more[i]
            scores, at, limit = [], 0, -np.inf
            while at < len(near) and upper[at] >= limit:
                scores.append(exact[near[at : at + 64]] @ vector)
                at += 64
                read = np.concatenate(scores)
                if len(read) >= k:
                    limit = np.partition(read, len(read) - k)[len(read) - k]
            if scores:
                read = np.concatenate(scores)
                ids = x_ids[near[: len(read)]]
                top = np.lexsort((ids, -read))[:k]
                out_q.append(np.full(len(top), q_ids[first + i]))
                out_x.append(ids[top])
                out_s.append(read[top].astype(np.int64))
    return out_q, out_x, out_s


def _search(k: int):
    def search(got: pa.Table) -> pa.Table:
        rows = got.to_pylist()
        found: list[tuple] = []
        query = next((r for r in rows if r["is_query"]), None)
        if query is not None:
            width = query["width"]
            q = np.frombuffer(query["values"], np.int32).reshape(len(query["ids"]), width)
            q_ids = np.array(query["ids"], np.int64)
            for r in rows:
                if not r["is_query"]:
                    x = np.frombuffer(r["values"], np.int32).reshape(len(r["ids"]), width)
                    found += zip(*best_of(q, q_ids, x, np.array(r["ids"], np.int64), k), strict=True)
        empty = np.zeros(0, np.int64)
        ids, others, scores = (
            np.concatenate([empty, *[f[i] for f in found]]) for i in range(3)
        )
        order = np.lexsort((others, -scores, ids))
        ids, others, scores = ids[order], others[order], scores[order]
        first = np.searchsorted(ids, ids)
        keep = np.arange(len(ids)) - first < k
        return pa.table(
            {"query_id": ids[keep], "vec_id": others[keep], "score": scores[keep]}
        )

    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score); both tables have (id, vector) with integer components."""
    data = staged(_blocks(vectors, ROWS, "block"), "vectors")
    asked = staged(_blocks(queries.dropDuplicates(["id"]), QUERIES, "query"), "queries")
    query_blocks = max(1, (asked.agg(F.max("query")).first()[0] or 0) + 1)
    slices = max(1, -(-data.count() // BLOCKS))
    every_query = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long")))
    every_slice = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long")))
    part = F.pmod("block", F.lit(slices))
    meeting = data.select(
        "width", every_query.alias("query"), part.alias("part"), F.lit(False).alias("is_query"),
        "ids", "values",
    ).unionByName(
        asked.select(
            "width", "query", every_slice.alias("part"), F.lit(True).alias("is_query"),
            "ids", "values",
        )
    )
    found = meeting.groupBy("width", "query", "part").applyInArrow(
        _search(k), "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
