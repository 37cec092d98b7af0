"""Reading a change table: columns, incremental filter, decoded records.

Everything here is narrow (no shuffle), works on batch and streaming DataFrames alike,
and stays inside JVM expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefeed.functions.lsn import lsn_literal
from tidefeed.functions.messages import BEFORE_IMAGE_CODE, operation_type

# Metadata columns of a change table, and the prefix they share.
LSN = "__$start_lsn"
SEQVAL = "__$seqval"
OPERATION = "__$operation"
METADATA_PREFIX = "__$"

# The file that a change was read from, where a source adds it.
SOURCE_FILE = METADATA_PREFIX + "source_file"

# Fixed value: the key that holds the decoded operation in a record.
OPERATION_KEY = "OperationType"


def quoted(name: str) -> Column:
    """The column of that name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def data_columns(changes: DataFrame) -> list[str]:
    """The captured columns, in the change table's own order: all but the metadata columns."""
    return [name for name in changes.columns if not name.startswith(METADATA_PREFIX)]


def scan_changes(changes: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The metadata columns, then the data columns (all of them unless ``columns`` names some)."""
    metadata = [name for name in (LSN, SEQVAL, OPERATION) if name in changes.columns]
    wanted = data_columns(changes) if columns is None else list(columns)
    return changes.select(*[quoted(name) for name in [*metadata, *wanted]])


def changes_since(
    changes: DataFrame, last_lsn: bytes | None = None, through: bytes | None = None
) -> DataFrame:
    """Changes strictly newer than ``last_lsn`` and, if given, not newer than ``through``.

    The comparison is on unsigned bytes. A change without an LSN is never newer.
    """
    newer = changes.filter(quoted(LSN) > lsn_literal(last_lsn))
    return newer if through is None else newer.filter(quoted(LSN) <= lsn_literal(through))


def with_record(
    changes: DataFrame, columns: Sequence[str] | None = None, before_image: str = "delete"
) -> DataFrame:
    """One row per change: ``lsn``, ``seqval``, ``operation``, and the change as a ``record``.

    The record starts with ``OperationType`` and goes on with the data columns. A data column
    of exactly that name replaces the decoded value and keeps the first place; one that differs
    in case is a key of its own. ``seqval`` is null where the change table has none. Where the
    source tells the file of a change, it comes along as ``source_file``.
    """
    wanted = data_columns(changes) if columns is None else list(columns)
    # Names that differ only in case would be ambiguous to the analyzer, so refer by position.
    by_position = [f"_{i}" for i in range(len(changes.columns))]
    column = dict(zip(changes.columns, map(F.col, by_position)))

    operation = column[OPERATION]
    fields = {OPERATION_KEY: operation_type(operation, before_image)}
    fields.update((name, column[name]) for name in wanted)

    rows = changes.toDF(*by_position)
    if before_image == "drop":
        rows = rows.filter(~operation.eqNullSafe(BEFORE_IMAGE_CODE))
    seqval = column.get(SEQVAL, F.lit(None).cast("binary"))
    file = [column[SOURCE_FILE].alias("source_file")] if SOURCE_FILE in column else []
    return rows.select(
        column[LSN].alias("lsn"),
        seqval.alias("seqval"),
        operation.alias("operation"),
        F.struct(*[value.alias(name) for name, value in fields.items()]).alias("record"),
        *file,
    )
