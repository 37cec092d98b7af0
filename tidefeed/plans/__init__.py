"""Whole feeds, put together from the operators."""

from tidefeed.plans.feed import change_feed, mixed_feed_since

__all__ = ["change_feed", "mixed_feed_since"]
