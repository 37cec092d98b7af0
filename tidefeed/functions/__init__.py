"""Column functions: LSN handling, operation decoding, JSON payloads, text lines."""

from tidefeed.functions.lsn import (
    ZERO_LSN,
    format_lsn,
    lsn_literal,
    lsn_number,
    lsn_of_number,
    parse_lsn,
)
from tidefeed.functions.messages import console_line, operation_type, payload_json

__all__ = [
    "ZERO_LSN",
    "console_line",
    "format_lsn",
    "lsn_literal",
    "lsn_number",
    "lsn_of_number",
    "operation_type",
    "parse_lsn",
    "payload_json",
]
