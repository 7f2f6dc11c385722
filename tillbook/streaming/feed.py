"""New raw orders into the staged orders, by Structured Streaming.

The checkpoint remembers which files of the raw table were read; a run without new ones calls no batch. Each batch is
cleaned by the same code as a batch build and merged into the staged table, which skips a batch it has committed before.
So a run that dies anywhere can simply be started again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillbook.plans import staging
from tillbook.sources import Layers, stream_raw


@dataclass(frozen=True)
class OrderFeed:
    """The first batch into an empty staged table is the seed and drops orders of unknown customers or products.

    Later batches keep them unless ``enforce_refs`` is set. ``load_ts`` replaces the clock as load stamp. After
    ``compact_after`` batches (a day of five-minute runs) the staged table is compacted. ``last_line`` settles equal stamps
    by file and line instead of by the largest values.
    """

    spark: SparkSession
    layers: Layers
    name: str = "orders"
    enforce_refs: bool = False
    load_ts: datetime | None = None
    compact_after: int = 288
    last_line: bool = False

    def seed(self) -> None:
        """First run: everything landed so far, as one batch."""
        if self.layers.staged_orders(self.spark).state()["last_batch"] >= 0:
            raise RuntimeError("the feed has run before")
        self.run_once()

    def run_once(self) -> None:
        """Merge what has landed since the last run, then stop."""
        self._start(availableNow=True).awaitTermination()

    def resume(self, interval: str = "5 minutes") -> StreamingQuery:
        """Run on a schedule until ``stop()`` is called on the result."""
        return self._start(processingTime=interval)

    def _start(self, **trigger: object) -> StreamingQuery:
        return (
            stream_raw(self.spark, self.layers, "orders", self.last_line)
            .writeStream.foreachBatch(self._merge)
            .option("checkpointLocation", self.layers.checkpoint(self.name))
            .queryName(self.name)
            .trigger(**trigger)
            .start()
        )

    def _merge(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        orders = staging.clean_orders(batch)
        staged = self.layers.staged_orders(spark)
        # by the table's state, as set_up may have emptied it; a batch that died before its commit decides the same
        if self.enforce_refs or staged.state()["last_batch"] < 0:
            customers = self.layers.staged(spark, "customers").read()
            products = self.layers.staged(spark, "products").read()
            orders = staging.valid_orders(orders, customers, products, among=staging.type_orders(batch))
        feed = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        staged.merge(staging.stamped(orders, self.load_ts), feed, batch_id)
        if len(staged.state()["batches"]) >= self.compact_after:
            staged.compact()
