"""Incremental order feed."""

from tillbook.streaming.feed import OrderFeed

__all__ = ["OrderFeed"]
