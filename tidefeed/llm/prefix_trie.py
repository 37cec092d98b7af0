"""The trie of all conversations' prefixes, with totals of every subtree, by time-forward passing.

1. Turns are numbered within their conversation, in ranges, so a conversation may be of any
   length. The name of a prefix is the sum of its turns' hashes, each mixed with its place: 128
   bits. A trie's nodes are the distinct names, counted by a combining aggregate.
2. A node below which more than ``LIGHT`` turns lie is heavy; heavy nodes are the top of the trie.
   A light node with a heavy parent is the root of a shard, and the light nodes below it are the
   shard. Shards are small; Spark deals them out to tasks.
3. A task's nodes come in reverse level order, sorted by Spark. Each adds up what its children
   sent, and sends its own totals to its parent through a queue that is ordered like the nodes and
   spills sorted runs.
4. What the roots of the shards send is summed for each heavy node. The heavy nodes, of which each
   level has at most one for ``LIGHT`` turns, are passed through in the same way.

Rows without a conversation's id take no part. Null roles and texts are empty. Turns are ordered
by their number, null first, and where these tie by role and text; repeated rows are turns of their
own. Further columns are not read. Without conversations there is no trie: no rows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.running import running
from tidefeed.llm.shared import mixed, scratch, staged

#: Turns below a node, with repetitions, from which on it is heavy.
LIGHT = 1 << 14
#: Messages that a queue holds in memory; more are written as a sorted run.
HELD = 1 << 18
#: Ids of a piece of a node's list, whose digest is taken piece by piece.
PIECE = 512

NODE = (
    "depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, weight long, "
    "children long, leaves long, saved long"
)
MESSAGE = np.dtype([("k1", "i8"), ("k2", "i8"), ("children", "i8"), ("leaves", "i8"), ("saved", "i8")])
_TOTALS = ("children", "leaves", "saved")


# Turns and nodes


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, t1, t2, length): every turn, its place from 0, and its hashes."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    placed = running(turns, "conv_id", ("turn", "role", "text"), _ones, ("_n",))
    return placed.select(
        "conv_id",
        (F.col("_n") - 1).alias("place"),
        F.xxhash64("role", "text").alias("t1"),
        F.xxhash64(F.lit(1), "text", F.lit(2), "role").alias("t2"),
        F.length("text").cast("long").alias("length"),
    )


def _ones(batch: pa.RecordBatch):
    return (np.ones(len(batch), np.int64),)


def _words(batch: pa.RecordBatch):
    """A count, and both hashes of each turn mixed with its depth."""
    depth = batch.column("depth").to_numpy().astype(np.uint64)
    words = []
    for i, name in enumerate(("t1", "t2")):
        turn = batch.column(name).to_numpy().view(np.uint64)
        words.append(mixed(turn ^ mixed(depth + np.uint64(i << 40))).view(np.int64))
    return np.ones(len(batch), np.int64), *words


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, w1, w2 = _words(batch)
        k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
        names = ["conv_id", "depth", "turns", "length", "k1", "k2"]
        arrays = [batch.column(c) for c in names] + [pa.array(k1 - w1), pa.array(k2 - w2)]
        yield pa.RecordBatch.from_arrays(arrays, [*names, "p1", "p2"])


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, turns, length, k1, k2, p1, p2): each prefix of each conversation by name.

    ``turns`` has (conv_id, depth, turns, t1, t2, length), depths from 1 without gaps.
    """
    sums = running(turns, "conv_id", ("depth",), _words, ("_n", "k1", "k2"))
    return sums.mapInArrow(
        _prefixes,
        "conv_id long, depth long, turns long, length long, k1 long, k2 long, p1 long, p2 long",
    )


def _nodes(path: DataFrame, members: DataFrame) -> DataFrame:
    """Every node with its members, its smallest one, what it weighs, and the turns below it."""
    inner = path.groupBy("k1", "k2", "depth").agg(
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("length").alias("length"),
        F.sum(F.col("turns") - F.col("depth") + 1).alias("below"),
    )
    zero = F.lit(0).cast("long")
    top = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).select(
        *[zero.alias(c) for c in ("k1", "k2", "depth", "p1", "p2")],
        "conv_id",
        "n_convs",
        zero.alias("length"),
        zero.alias("below"),
    )
    return inner.unionByName(top.where("n_convs > 0")).withColumn(
        "weight", (F.col("n_convs") - 1) * F.col("length")
    )


# Passing totals on


class Queue:
    """Messages to the level above, by the name of the node they are for."""

    def __init__(self, held: int = HELD):
        self.most, self.held, self.n, self.runs, self.at = held, [], 0, [], []
        self.files: list = []

    def push(self, messages: np.ndarray) -> None:
        self.held.append(messages)
        self.n += len(messages)
        if self.n >= self.most:
            run = _combined(np.concatenate(self.held))
            self.held, self.n = [run], len(run)
            if 2 * len(run) >= self.most:
                self._spill(run)

    def _spill(self, run: np.ndarray) -> None:
        file = tempfile.TemporaryFile()  # deleted with the queue
        run.tofile(file)
        file.flush()
        self.files.append(file)
        self.runs.append(np.memmap(file, MESSAGE, "r"))
        self.held, self.n = [], 0

    def ready(self) -> None:
        """All messages are there; from now on they are taken."""
        if self.held:
            self.runs.append(_combined(np.concatenate(self.held)))
            self.held, self.n = [], 0
        self.at = [0] * len(self.runs)

    def take(self, k1: int, k2: int) -> np.ndarray:
        """All messages up to this name."""
        found = []
        for i, run in enumerate(self.runs):
            a, b = (int(np.searchsorted(run["k1"], k1, side)) for side in ("left", "right"))
            end = a + int(np.searchsorted(run["k2"][a:b], k2, "right"))
            found.append(np.array(run[self.at[i] : end]))
            self.at[i] = max(end, self.at[i])
        return np.concatenate(found) if found else np.zeros(0, MESSAGE)

    def empty(self) -> bool:
        return all(at == len(run) for at, run in zip(self.at, self.runs, strict=True))


def _groups(k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by name, and the number of each distinct name along it."""
    order = np.lexsort((k2, k1))
    a, b = k1[order], k2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.cumsum(new) - 1


def _combined(messages: np.ndarray) -> np.ndarray:
    order, name = _groups(messages["k1"], messages["k2"])
    first = np.flatnonzero(np.diff(name, prepend=-1))
    out = messages[order[first]]
    for total in _TOTALS:
        out[total] = np.add.reduceat(messages[total][order], first) if len(first) else 0
    return out


def time_forward(held: int = HELD):
    """Nodes in reverse level order, sorted by name within a level, to nodes with their totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, coming, going = None, Queue(held), Queue(held)
        for batch in batches:
            columns = {n: batch.column(n).to_numpy() for n in batch.schema.names}
            depth = columns["depth"]
            cuts = np.flatnonzero(np.append(True, depth[1:] != depth[:-1])) if len(depth) else []
            for a, b in zip(cuts, [*cuts[1:], len(depth)], strict=True):
                here = {n: c[a:b] for n, c in columns.items()}
                if depth[a] != level:
                    if level is not None and not coming.empty():
                        raise ValueError("a node's parent is missing")
                    going.ready()
                    coming, going, level = going, Queue(held), depth[a]
                messages = coming.take(int(here["k1"][-1]), int(here["k2"][-1]))
                n = b - a
                order, name = _groups(
                    np.append(here["k1"], messages["k1"]), np.append(here["k2"], messages["k2"])
                )
                of = np.empty(len(order), np.int64)
                of[order] = name
                nodes = np.zeros(name[-1] + 1, bool)
                nodes[of[:n]] = True
                if not nodes.all():
                    raise ValueError("a node's parent is missing")
                for total in _TOTALS:
                    sums = np.zeros(len(nodes), np.int64)
                    np.add.at(sums, of[n:], messages[total])
                    here[total] = here[total] + sums[of[:n]]
                here["leaves"] = np.where(here["children"] == 0, 1, here["leaves"])
                here["saved"] = here["saved"] + here["weight"]
                send = here["is_root"] == 0
                sent = np.zeros(int(send.sum()), MESSAGE)
                sent["k1"], sent["k2"], sent["children"] = here["p1"][send], here["p2"][send], 1
                sent["leaves"], sent["saved"] = here["leaves"][send], here["saved"][send]
                going.push(sent)
                names = [c.split()[0] for c in NODE.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(here[c]) for c in [*names, "is_root"]], [*names, "is_root"]
                )

    return run


def _passed(nodes: DataFrame, held: int) -> DataFrame:
    sorted_nodes = nodes.sortWithinPartitions(F.desc("depth"), "k1", "k2")
    return sorted_nodes.mapInArrow(time_forward(held), NODE + ", is_root int")


def _with_totals(path: DataFrame, nodes: DataFrame, light: int, held: int) -> DataFrame:
    none = {total: F.lit(0).cast("long") for total in _TOTALS}
    is_heavy = (F.col("depth") == 0) | ((F.col("n_convs") > 1) & (F.col("below") > light))
    heavy = staged(nodes.where(is_heavy), "heavy")
    # the root of each conversation's shard: what follows its last heavy node
    top = heavy.agg(F.max("depth")).first()[0] or 0
    upper = path.where(F.col("depth") <= top + 1).select("conv_id", "depth", "k1", "k2")
    last = (
        upper.join(heavy.where("depth > 0").select("k1", "k2"), ["k1", "k2"])
        .groupBy("conv_id")
        .agg((F.max("depth") + 1).alias("top"))
    )
    roots = (
        upper.join(last, "conv_id", "left")
        .where(F.col("depth") == F.coalesce("top", F.lit(1)))
        .select("conv_id", F.col("depth").alias("top"), F.xxhash64("k1", "k2").alias("shard"))
    )
    below = nodes.where(~is_heavy).join(staged(roots, "roots"), "conv_id")
    below = below.withColumns(none | {"is_root": (F.col("depth") == F.col("top")).cast("int")})
    columns = [c.split()[0] for c in NODE.split(", ")]
    done = staged(
        _passed(below.repartition("shard").select(*columns, "is_root"), held), "light"
    )
    sent = (
        done.where("is_root = 1")
        .groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        .agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )
    above = heavy.join(sent, ["k1", "k2"], "left").withColumns(
        {total: F.coalesce(total, F.lit(0)) for total in _TOTALS}
        | {"is_root": (F.col("depth") == 0).cast("int")}
    )
    above = _passed(above.select(*columns, "is_root").repartition(1), held)
    return staged(done.unionByName(above), "totals")


# Lists of members that end at a node


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k1, k2, conv = (batch.column(c).to_numpy() for c in ("k1", "k2", "conv_id"))
        if not len(conv):
            continue
        new = np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
        run = np.flatnonzero(new)
        since = np.arange(len(conv)) - run[np.cumsum(new) - 1]
        cuts = np.flatnonzero(since % PIECE == 0)
        texts = conv.astype(str).tolist()
        ends = [*cuts[1:].tolist(), len(conv)]
        lists = [",".join(texts[a:b]) for a, b in zip(cuts.tolist(), ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(k1[cuts]), pa.array(k2[cuts]), pa.array(conv[cuts]), pa.array(lists)],
            ["k1", "k2", "first", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, digest = None, None

    def row():
        columns = [pa.array([now[0]]), pa.array([now[1]]), pa.array([digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, ["k1", "k2", "ends_sha256"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("k1", "k2", "ids")]
        for k1, k2, ids in zip(*columns, strict=True):
            if (k1, k2) != now:
                if now is not None:
                    yield row()
                now, digest = (k1, k2), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if now is not None:
        yield row()


def _ends(path: DataFrame, members: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the nodes where a conversation ends."""
    zero = F.lit(0).cast("long")
    ends = path.where("depth = turns").select("k1", "k2", "conv_id")
    ends = ends.unionAll(members.where("turns = 0").select(zero, zero, "conv_id"))
    keys = ("k1", "k2", "conv_id")
    pieces = ends.repartitionByRange(*keys).sortWithinPartitions(*keys)
    pieces = pieces.mapInArrow(_pieces, "k1 long, k2 long, first long, ids string")
    dealt = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return dealt.mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(
    turns: DataFrame, members: DataFrame, light: int = LIGHT, held: int = HELD
) -> DataFrame:
    """A row for each node of the trie of ``members`` (conv_id, turns) with these ``turns``.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256):
    a node goes by its smallest member and its depth; ``saved_tokens`` sums over its subtree what
    sharing saves, each node's last turn once for every member but one; ``ends_sha256`` digests the
    members that end at it. ``turns`` is what ``paths`` takes, ``length`` what a turn weighs.
    """
    with scratch(turns.sparkSession):
        return staged(_trie(turns, members, light, held), "trie", keep=True)


def _trie(turns: DataFrame, members: DataFrame, light: int, held: int) -> DataFrame:
    path = staged(paths(turns), "paths")
    nodes = staged(_nodes(path, members), "nodes")
    done = _with_totals(path, nodes, light, held)
    ends = staged(_ends(path, members), "ends")
    parents = done.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    inner = done.where("depth > 0").join(parents, ["p1", "p2"], "left")
    top = done.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return (
        inner.unionByName(top)
        .join(ends, ["k1", "k2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


# Conversations that begin with another one's turns


def restarted_trie(
    conversations: DataFrame, start: Column, most: int, base: Column, light: int = LIGHT
) -> DataFrame:
    """``prefix_trie`` of conversations whose first ``start`` turns are replaced by the same number
    of turns (all, if it has fewer) of conversation ``base``.

    ``start`` and ``base`` are columns over conv_id, ``start`` at most ``most``.
    """
    with scratch(conversations.sparkSession):
        turns, members = _restarted(conversations, start, most, base)
        return staged(_trie(turns, members, light, HELD), "trie", keep=True)


def _restarted(
    conversations: DataFrame, start: Column, most: int, base: Column
) -> tuple[DataFrame, DataFrame]:
    turns = staged(numbered(conversations), "turns")
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    own = own.select("conv_id", "n", start.cast("long").alias("start"), base.alias("base"))
    sizes = own.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    members = own.join(sizes, "base", "left").select(
        "conv_id",
        "base",
        "start",
        F.least("start", F.coalesce("there", F.lit(0))).alias("taken"),
        F.greatest(F.col("n") - F.col("start"), F.lit(0)).alias("rest"),
    )
    members = members.withColumn("turns", F.col("taken") + F.col("rest"))
    members = staged(members, "members")
    body = ("t1", "t2", "length")
    first = turns.where(F.col("place") < most).withColumnRenamed("conv_id", "base")
    first = members.join(first, "base").where("place < taken")
    first = first.select("conv_id", (F.col("place") + 1).alias("depth"), "turns", *body)
    after = turns.join(members.where("rest > 0"), "conv_id").where("place >= start")
    depth = F.col("place") - F.col("start") + F.col("taken") + 1
    after = after.select("conv_id", depth.alias("depth"), "turns", *body)
    return staged(first.unionAll(after), "rebuilt"), members.select("conv_id", "turns")
