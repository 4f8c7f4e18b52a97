"""A statistics store that is kept up to date batch by batch.

Each batch of readings adds its partial moments per (keys, window) under its own batch id; the
readings themselves are not kept. Reading the store merges the parts (Chan). A batch id that is
written again replaces its own part, so a repeated batch changes nothing, and a part is at most one
row per group however many readings the batch had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.stats import STDDEV, WINDOW_END, WINDOW_START
from ..operators.merge import merge_parts
from ..operators.windows import as_keys, window_stats

BATCH = "batch"


class StatsStore:
    """Partial moments below ``path`` (a shared folder), one subfolder per batch id.

    One writer at a time; readers see a batch's part whole or, while it is being replaced, not at
    all.
    """

    def __init__(self, spark: SparkSession, path: str, keys: str | Sequence[str], time_col: str,
                 value_col: str, window: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.time_col, self.value_col, self.window = as_keys(keys), time_col, value_col, window

    def append(self, readings: DataFrame, batch_id: int) -> None:
        """Add (or replace) the part of one batch. The readings are aggregated once, in the map tasks
        first, and only the statistics are shuffled and written."""
        part = window_stats(readings, self.keys, self.time_col, self.value_col, self.window)
        part.drop(STDDEV).write.mode("overwrite").parquet(f"{self.path}/{BATCH}={int(batch_id)}")

    def append_stream(self, readings: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        """Add every micro-batch of a stream under the stream's own batch ids: a batch that is run
        again after a failure replaces its part. Windows need no watermark, so no row is late."""
        writer = (readings.writeStream.foreachBatch(lambda batch, batch_id: self.append(batch, batch_id))
                  .option("checkpointLocation", checkpoint))
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def parts(self) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/{BATCH}=*")

    def read(self) -> DataFrame:
        """``keys, window_start, window_end, n, mean, m2, lo, hi, stddev`` over all batches; a window
        without a value has null moments."""
        return merge_parts(self.parts().drop(BATCH), [*self.keys, WINDOW_START, WINDOW_END])
