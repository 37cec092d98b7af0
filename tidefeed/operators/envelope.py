"""The common envelope, and the union of many tables' envelopes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefeed.functions.messages import payload_json
from tidefeed.operators.changes import with_record

# Fixed value: the only event type a feed emits.
CHANGE_DETECTED = "ChangeDetected"


def envelopes(
    changes: DataFrame,
    table_name: str,
    columns: Sequence[str] | None = None,
    before_image: str = "delete",
    pretty: bool = False,
    json_options: Mapping[str, str] | None = None,
    row_key: Column | None = None,
) -> DataFrame:
    """Changes of one table as ``table_name``, ``event_type``, ``message``.

    ``lsn``, ``seqval`` and ``operation`` come along, so that a reader can order the messages
    and recognise one that was delivered twice. ``row_key``, an expression over the record's
    fields such as ``F.col("record.id")``, adds a column to order by where order per table is
    stricter than needed.
    """
    records = with_record(changes, columns, before_image)
    key = [] if row_key is None else [row_key.cast("string").alias("row_key")]
    file = ["source_file"] if "source_file" in records.columns else []
    return records.select(
        F.lit(table_name).alias("table_name"),
        F.lit(CHANGE_DETECTED).alias("event_type"),
        payload_json("record", pretty, json_options).alias("message"),
        "lsn",
        "seqval",
        "operation",
        *key,
        *file,
    )


def fan_in(feeds: Iterable[DataFrame]) -> DataFrame:
    """All feeds as one. Narrow; every feed keeps its own partitions."""
    level = list(feeds)
    if not level:
        raise ValueError("a feed needs at least one table")
    # Pairwise, so that a thousand tables nest ten unions deep and not a thousand.
    while len(level) > 1:
        paired = [a.unionByName(b) for a, b in zip(level[::2], level[1::2])]
        level = paired + level[len(paired) * 2 :]
    return level[0]
