"""Log sequence numbers: ten bytes, ordered as unsigned bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The position of a table that has no saved position yet.
ZERO_LSN = bytes(10)


def lsn_literal(lsn: bytes | None) -> Column:
    """A literal LSN; ``None`` means "from the start".

    A literal, unlike a joined column, is pushed into parquet and JDBC scans.
    """
    return F.lit(ZERO_LSN if lsn is None else bytes(lsn))


def format_lsn(lsn: Column | str) -> Column:
    """``0x`` and upper-case hex digits."""
    return F.concat(F.lit("0x"), F.hex(lsn))


def parse_lsn(text: str) -> bytes:
    """The bytes of an LSN written as ``0x...`` (or as bare hex digits)."""
    return bytes.fromhex(text.removeprefix("0x"))


# Five bytes: an LSN is two numbers of that size.
_HALF = 1 << 40


def lsn_number(lsn: Column | str) -> Column:
    """A ten-byte LSN as a whole number, which a hash aggregate can hold and bytes cannot."""
    digits = F.lpad(F.hex(lsn), 20, "0")
    high, low = (F.conv(F.substring(digits, i, 10), 16, 10) for i in (1, 11))
    return (high.cast("decimal(13,0)") * _HALF + low.cast("decimal(13,0)")).cast("decimal(25,0)")


def lsn_of_number(number: Column | str) -> Column:
    """The LSN of a number."""
    value = F.col(number) if isinstance(number, str) else number
    high = F.floor(value / F.lit(_HALF).cast("decimal(13,0)")).cast("long")
    low = (value % F.lit(_HALF).cast("decimal(13,0)")).cast("long")
    return F.unhex(F.concat(*[F.lpad(F.hex(half), 10, "0") for half in (high, low)]))
