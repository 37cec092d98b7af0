"""Change tables read from a database over JDBC.

The filter on the LSN runs in the database. A JDBC partition column must be a number or a
date, and an LSN is neither, so parallel reads are given as predicates: ranges of log position,
each a seek in the change table's own index.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidefeed.functions.lsn import ZERO_LSN
from tidefeed.operators.changes import LSN, SEQVAL, changes_since, scan_changes

# A log position between two slices: an LSN, and a sequence value where the table has one.
CutPoint = tuple[bytes, bytes | None]


def hex_literal(value: bytes) -> str:
    """A binary literal as SQL Server and many others write it."""
    return "0x" + value.hex().upper()


# How far a slice's end may be from where it should be, as a share of a slice.
TOLERANCE = 0.05


class _Search:
    """A search for the position up to which a given number of rows lie.

    Positions are whole numbers between two known ones. Each probe counts the rows from the lower
    one to a guess, first where even spacing would put the cut, and the middle by turns, so that a
    lopsided log costs no more probes than the range has bits, twice.
    """

    def __init__(self, low: int, high: int, before: int, through: int, target: float, slack: float):
        self.low, self.high, self.before, self.through = low, high, before, through
        self.target, self.slack, self.turns = target, slack, 0

    @property
    def open(self) -> bool:
        return self.high - self.low > 1 and self.through - self.target > self.slack

    def guess(self) -> int:
        share = (self.target - self.before) / max(1, self.through - self.before)
        even = self.low + round((self.high - self.low) * share)
        middle = (self.low + self.high) // 2
        self.turns += 1
        return min(max(middle if self.turns % 2 == 0 else even, self.low + 1), self.high - 1)

    def told(self, guess: int, rows: int) -> None:
        there = self.before + rows
        if there < self.target - self.slack:
            self.low, self.before = guess, there
        else:
            self.high, self.through = guess, there


def _number(value: bytes) -> int:
    return int.from_bytes(value)


def searched_cuts(
    ask: Callable[[str], Sequence],
    change_table: str,
    slices: int,
    after: bytes = ZERO_LSN,
    through: bytes | None = None,
    literal: Callable[[bytes], str] = hex_literal,
    tolerance: float = TOLERANCE,
) -> list[CutPoint]:
    """At most ``slices - 1`` positions that cut the wanted rows into about equal parts.

    ``ask`` has the database answer a query. All cuts are searched for at once: each round is one
    query that counts a range for every cut still open, and the ranges shrink, so that no row is
    numbered or sorted, and few rounds look at much of the log. Cuts are LSNs; one that falls into
    a transaction larger than the tolerance is searched for among its sequence values as well.
    """
    upper = "" if through is None else f' AND "{LSN}" <= {literal(through)}'
    ((total, oldest, newest),) = ask(
        f'SELECT COUNT(*), MIN("{LSN}"), MAX("{LSN}") FROM {change_table} '
        f'WHERE "{LSN}" > {literal(after)}{upper}'
    )
    if not total:
        return []
    width = len(bytes(oldest))
    slack = tolerance * total / slices / 2

    def run(searches: dict, where: Callable[[int, int, int], str]) -> None:
        while left := {k: s for k, s in searches.items() if s.open}:
            guesses = {k: s.guess() for k, s in left.items()}
            # one number of rows each; NULLs of a sequence belong to the end of their transaction
            parts = [
                f"SELECT {i} AS cut, COUNT(*) AS n FROM {change_table} WHERE "
                + where(k, left[k].low, guesses[k])
                for i, k in enumerate(left)
            ]
            found = {int(row[0]): int(row[1]) for row in ask(" UNION ALL ".join(parts))}
            for i, (k, search) in enumerate(left.items()):
                search.told(guesses[k], found[i])

    def lsns(_, low: int, high: int) -> str:
        a, b = (literal(x.to_bytes(width)) for x in (low, high))
        return f'"{LSN}" > {a} AND "{LSN}" <= {b}'

    first, last = _number(bytes(oldest)) - 1, _number(bytes(newest))
    targets = {k: k * total / slices for k in range(1, slices)}
    by_lsn = {k: _Search(first, last, 0, total, t, slack) for k, t in targets.items()}
    run(by_lsn, lsns)

    cuts: set[CutPoint] = set()
    inside = {}
    for k, search in by_lsn.items():
        if search.through - search.target <= search.slack:
            if search.through < total:
                cuts.add((search.high.to_bytes(width), None))
        else:
            inside[k] = search
    if inside:
        hot = sorted({s.high.to_bytes(width) for s in inside.values()})
        ranges = " UNION ALL ".join(
            f'SELECT {i}, MIN("{SEQVAL}"), MAX("{SEQVAL}"), COUNT("{SEQVAL}") FROM {change_table} '
            f'WHERE "{LSN}" = {literal(lsn)}'
            for i, lsn in enumerate(hot)
        )
        ends = {hot[int(i)]: (a, b, n) for i, a, b, n in ask(ranges) if a is not None}
        seqvals = {}
        for k, search in inside.items():
            lsn = search.high.to_bytes(width)
            if lsn in ends:
                low, high, n = ends[lsn]
                low, high = _number(bytes(low)) - 1, _number(bytes(high))
                through_rows = search.before + int(n)
                seqvals[k] = _Search(low, high, search.before, through_rows, search.target, slack)

        def seqs(k, low: int, high: int) -> str:
            lsn = literal(inside[k].high.to_bytes(width))
            a, b = (literal(max(0, x).to_bytes(width)) for x in (low, high))
            above = f' AND "{SEQVAL}" > {a}' if low >= 0 else ""
            return f'"{LSN}" = {lsn}{above} AND "{SEQVAL}" <= {b}'

        run(seqvals, seqs)
        for k, search in seqvals.items():
            if search.through < total:
                cuts.add((inside[k].high.to_bytes(width), search.high.to_bytes(width)))
    return sorted(cuts, key=lambda cut: (cut[0], cut[1] is None, cut[1] or b""))


def slice_predicates(
    cuts: Sequence[CutPoint],
    after: bytes = ZERO_LSN,
    through: bytes | None = None,
    literal: Callable[[bytes], str] = hex_literal,
) -> list[str]:
    """One SQL predicate per slice. Together they hold each wanted row exactly once.

    A row without a sequence value counts as later than any cut inside its transaction.
    """

    def beyond(cut: CutPoint) -> str:
        lsn, seqval = cut
        later = f'"{LSN}" > {literal(lsn)}'
        if seqval is None:
            return later
        rest = f'("{SEQVAL}" > {literal(seqval)} OR "{SEQVAL}" IS NULL)'
        return f'({later} OR ("{LSN}" = {literal(lsn)} AND {rest}))'

    def up_to(cut: CutPoint) -> str:
        lsn, seqval = cut
        if seqval is None:
            return f'"{LSN}" <= {literal(lsn)}'
        same = f'("{LSN}" = {literal(lsn)} AND "{SEQVAL}" <= {literal(seqval)})'
        return f'("{LSN}" < {literal(lsn)} OR {same})'

    wanted = [f'"{LSN}" > {literal(after)}']
    if through is not None:
        wanted.append(f'"{LSN}" <= {literal(through)}')
    ordered = sorted(set(cuts), key=lambda cut: (cut[0], cut[1] is None, cut[1] or b""))
    lower = [[], *([beyond(cut)] for cut in ordered)]
    upper = [*([up_to(cut)] for cut in ordered), []]
    return [" AND ".join([*wanted, *a, *b]) for a, b in zip(lower, upper)]


def jdbc_newest(
    spark: SparkSession,
    url: str,
    change_table: str,
    properties: Mapping[str, str] | None = None,
) -> bytes | None:
    """The newest LSN of a change table, looked up by the database; none if it is empty."""
    return _end(spark, url, change_table, properties, "MAX", "newest")


def jdbc_oldest(
    spark: SparkSession,
    url: str,
    change_table: str,
    properties: Mapping[str, str] | None = None,
) -> bytes | None:
    """The oldest LSN that a change table still holds; none if it is empty."""
    return _end(spark, url, change_table, properties, "MIN", "oldest")


def _end(
    spark: SparkSession,
    url: str,
    change_table: str,
    properties: Mapping[str, str] | None,
    which: str,
    name: str,
) -> bytes | None:
    query = f'SELECT {which}("{LSN}") AS {name} FROM {change_table}'
    options = {**(properties or {}), "url": url, "query": query}
    lsn = spark.read.format("jdbc").options(**options).load().first()[0]
    return None if lsn is None else bytes(lsn)


def jdbc_changes(
    spark: SparkSession,
    url: str,
    change_table: str,
    after: bytes = ZERO_LSN,
    through: bytes | None = None,
    slices: int = 1,
    columns: Sequence[str] | None = None,
    properties: Mapping[str, str] | None = None,
    literal: Callable[[bytes], str] = hex_literal,
) -> DataFrame:
    """Changes of one table with ``after < LSN <= through``.

    With more than one slice, the cuts are searched for in the database (``searched_cuts``), and
    each slice is read by a task of its own. The change table then needs a sequence column.
    """
    options = dict(properties or {})

    def ask(query: str) -> Sequence:
        return spark.read.format("jdbc").options(**options, url=url, query=query).load().collect()

    if slices > 1:
        cuts = searched_cuts(ask, change_table, slices, after, through, literal)
        predicates = slice_predicates(cuts, after, through, literal)
        rows = spark.read.jdbc(url, change_table, predicates=predicates, properties=options)
        return scan_changes(rows, columns)
    rows = spark.read.format("jdbc").options(**options, url=url, dbtable=change_table).load()
    return scan_changes(changes_since(rows, after, through), columns)
