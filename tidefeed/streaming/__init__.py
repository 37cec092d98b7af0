"""Continuous feeds: sources to sinks, with positions saved after each published batch."""

from tidefeed.streaming.feed import (
    CatalogOffsets,
    LoggedOffsets,
    Offsets,
    deliver,
    poll,
    start_feed,
    start_polling,
)
from tidefeed.streaming.follow import follow, schema_ledger
from tidefeed.streaming.frontier import Frontier
from tidefeed.streaming.once import committed_positions, read_once
from tidefeed.streaming.sinks import (
    Batch,
    ConsolePrinter,
    DeadLetters,
    Publisher,
    Sink,
    TooManyFailed,
    publish,
    sink,
)

__all__ = [
    "Batch",
    "CatalogOffsets",
    "ConsolePrinter",
    "DeadLetters",
    "Frontier",
    "LoggedOffsets",
    "Offsets",
    "Publisher",
    "Sink",
    "TooManyFailed",
    "committed_positions",
    "deliver",
    "follow",
    "poll",
    "publish",
    "read_once",
    "schema_ledger",
    "sink",
    "start_feed",
    "start_polling",
]
