"""Paths of the three layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tillbook.sources.tables import MergeTable, VersionedTable


@dataclass(frozen=True)
class Layers:
    """One folder per layer under ``root``, one folder per table in it.

    ``order_buckets`` is the number of buckets of the staged orders; a bucket should suit one task.
    """

    root: str
    order_buckets: int | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def raw(self, table: str) -> str:
        return self.path("raw", table)

    def staged(self, spark: SparkSession, table: str) -> VersionedTable:
        return VersionedTable(spark, self.path("stg", table))

    def staged_orders(self, spark: SparkSession) -> MergeTable:
        return MergeTable(spark, self.path("stg", "orders"), buckets=self.order_buckets)

    def mart(self, spark: SparkSession, table: str) -> VersionedTable:
        return VersionedTable(spark, self.path("mart", table))

    def checkpoint(self, feed: str) -> str:
        return self.path("feeds", feed)
