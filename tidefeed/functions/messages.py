"""What a change looks like to a reader: its type, its JSON payload, its console line."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation codes of a change table.
INSERT_CODE = 2
BEFORE_IMAGE_CODE = 3
UPDATE_CODE = 4

# How the before-image of an update may be treated.
BEFORE_IMAGE_MODES = ("delete", "drop", "label")

# JSON rendering. Nulls stay as keys, and times do not depend on the session.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def operation_type(operation: Column | str, before_image: str = "delete") -> Column:
    """``Insert`` for 2, ``Update`` for 4, ``Delete`` for everything else.

    Code 3, the before-image of an update, is a ``Delete`` unless ``before_image="label"``
    asks for ``UpdateBefore``. ``"drop"`` is a row filter, applied where the rows are.
    """
    if before_image not in BEFORE_IMAGE_MODES:
        raise ValueError(f"before_image must be one of {BEFORE_IMAGE_MODES}, not {before_image!r}")
    code = F.col(operation) if isinstance(operation, str) else operation
    decoded = F.when(code == INSERT_CODE, "Insert").when(code == UPDATE_CODE, "Update")
    if before_image == "label":
        decoded = decoded.when(code == BEFORE_IMAGE_CODE, "UpdateBefore")
    return decoded.otherwise("Delete")


def payload_json(
    record: Column | str, pretty: bool = False, options: Mapping[str, str] | None = None
) -> Column:
    """A record as JSON text: compact, or indented with ``pretty``."""
    settings = {**JSON_OPTIONS, "pretty": str(pretty).lower(), **(options or {})}
    return F.to_json(record, settings)


def console_line(
    table_name: Column | str = "table_name",
    event_type: Column | str = "event_type",
    message: Column | str = "message",
    prefix: str = "",
) -> Column:
    """``[event type] table: message``, after ``prefix``."""
    as_column = [F.col(c) if isinstance(c, str) else c for c in (table_name, event_type, message)]
    table, event, text = as_column
    return F.concat(F.lit(prefix + "["), event, F.lit("] "), table, F.lit(": "), text)
