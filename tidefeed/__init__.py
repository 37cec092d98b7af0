"""Change-data-capture feeds on Spark: DataFrames in, messages and saved positions out."""

from tidefeed.plans.feed import change_feed, mixed_feed_since
from tidefeed.streaming.feed import poll, start_feed, start_polling
from tidefeed.streaming.follow import follow
from tidefeed.streaming.once import read_once
from tidefeed.streaming.sinks import ConsolePrinter, Publisher, publish, sink

__all__ = [
    "ConsolePrinter",
    "Publisher",
    "change_feed",
    "follow",
    "mixed_feed_since",
    "poll",
    "publish",
    "read_once",
    "sink",
    "start_feed",
    "start_polling",
]
