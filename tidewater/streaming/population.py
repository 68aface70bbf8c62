"""Population of the queue as a series: one row per tier after every batch of its event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import queue as Q
from ..sources.kept import KeptTable

STATE = "key bigint, tier int, due_ts double, claimed boolean"


class PopulationSeries:
    """The queue's state in a kept table under path, and the series beside it. A batch touches only the buckets of its creators.

    The table's mark is the number of the last batch taken in, so a batch that is handed over again, as after a failure, changes no
    state, and its rows of the series are written over, not added."""

    def __init__(self, spark: SparkSession, path: str, last_tier: int, buckets: int = 64):
        self.spark, self.path, self.last_tier = spark, path.rstrip("/"), last_tier
        self.state = KeptTable(spark, f"{self.path}/state", STATE, "key", buckets)

    def take(self, events: DataFrame, number: int) -> None:
        """Take in batch `number` (from 0) of events (key, seq, op, tier, due_ts), whose seq grows from batch to batch."""
        mark = self.state.mark()
        if mark is None or number > mark:
            self.state.merge(events, lambda old, delta: Q.advance(old, delta, self.last_tier), number)
        elif number < mark:
            return  # its rows were written before the batch after it came
        Q.population(self.state.rows()).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/series/batch={number}")

    def start(self, events: DataFrame, checkpoint: str, every: str | None = "300 seconds"):
        """Start the series over a stream of events; every None: what is there now."""
        writer = events.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()

    def series(self) -> DataFrame:
        """(batch, tier, queued, claimed)."""
        return self.spark.read.schema("tier int, queued bigint, claimed bigint, batch bigint").option("basePath", f"{self.path}/series").parquet(f"{self.path}/series").select("batch", "tier", "queued", "claimed")
