"""From change tables and saved positions to one feed of envelopes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.functions.lsn import ZERO_LSN
from tidefeed.operators.changes import changes_since
from tidefeed.operators.envelope import envelopes, fan_in
from tidefeed.operators.offsets import merge_offsets


def change_feed(
    tables: Mapping[str, DataFrame],
    after: Mapping[str, bytes] | None = None,
    through: Mapping[str, bytes] | None = None,
    **envelope_options,
) -> DataFrame:
    """Every table's changes past its position, as one feed of envelopes.

    ``tables`` maps a table's name to its change table, all batch or all streaming. ``after``
    holds positions, such as ``last_lsns`` reads from the saved ones; a table without one is
    read from the start. They become literals, so each scan reads only newer rows; ``through``
    adds an upper end. There is no shuffle. Other arguments go to ``envelopes``.
    """
    lower, upper = after or {}, through or {}
    return fan_in(
        envelopes(
            changes_since(changes, lower.get(name), upper.get(name)), name, **envelope_options
        )
        for name, changes in tables.items()
    )


def mixed_feed_since(feed: DataFrame, offsets: DataFrame) -> DataFrame:
    """The part of a feed that already mixes tables which is past each table's position.

    Positions are one row per table and are read into the driver; the newer part is then a filter
    on the table and its LSN alone, which Spark moves below the union and the rendering of
    messages, down to the scans. ``with_last_lsn`` is the same by a join.
    """
    newest = merge_offsets(offsets).where("last_lsn IS NOT NULL").collect()
    known = [row.table_name for row in newest]
    past = F.col("lsn") > F.lit(ZERO_LSN)
    if known:
        past = past & ~F.col("table_name").isin(known)
    for row in newest:
        past = past | ((F.col("table_name") == row.table_name) & (F.col("lsn") > F.lit(bytes(row.last_lsn))))
    return feed.where(past)
