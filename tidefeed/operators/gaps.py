"""Whether a change table still holds everything past its saved position.

A database removes old changes on its own schedule. A feed that was down for longer than that
goes on from its position as if nothing had been in between; what was removed is lost without a
sign. The oldest change that is left tells: while it is not past the position, nothing is missing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.functions.lsn import ZERO_LSN, format_lsn, lsn_literal
from tidefeed.operators.changes import LSN, quoted
from tidefeed.operators.envelope import fan_in


class RetentionGap(Exception):
    """Changes past a saved position have been removed before they were read."""

    def __init__(self, gaps: list):
        self.gaps = gaps
        said = "; ".join(f"{g.table_name}: saved {g.saved}, oldest left {g.oldest}" for g in gaps)
        super().__init__(f"changes may be missing past the saved positions ({said})")


def retention_gaps(
    tables: Mapping[str, DataFrame],
    last_lsns: Mapping[str, bytes],
    oldest: Mapping[str, bytes | None] | None = None,
) -> DataFrame:
    """One row per table: ``table_name``, ``saved``, ``oldest``, ``gap``.

    ``gap`` is true where the oldest change that is left is past the saved position, so whatever
    lay between may be gone. A table that was never read has nothing to miss, and in an empty one
    nothing can be seen: no gap. ``oldest`` comes from the LSN columns, one minimum per table over
    that column alone, or is given where the source can tell, as ``jdbc_oldest`` does.
    """
    rows = []
    for name, changes in tables.items():
        saved = lsn_literal(last_lsns.get(name))
        if oldest is None:
            row = changes.agg(F.min(quoted(LSN)).alias("oldest"))
        else:
            row = changes.sparkSession.range(1).select(
                F.lit(oldest.get(name)).cast("binary").alias("oldest")
            )
        past = (saved > F.lit(ZERO_LSN)) & (F.col("oldest") > saved)
        rows.append(
            row.select(
                F.lit(name).alias("table_name"),
                saved.alias("saved"),
                "oldest",
                F.coalesce(past, F.lit(False)).alias("gap"),
            )
        )
    return fan_in(rows)


def guard_gaps(
    tables: Mapping[str, DataFrame],
    last_lsns: Mapping[str, bytes],
    oldest: Mapping[str, bytes | None] | None = None,
) -> None:
    """Raises ``RetentionGap`` if a table has one."""
    found = retention_gaps(tables, last_lsns, oldest).where("gap")
    gaps = found.select(
        "table_name", format_lsn("saved").alias("saved"), format_lsn("oldest").alias("oldest")
    ).collect()  # at most one per table
    if gaps:
        raise RetentionGap(gaps)
