"""Helpers shared by the operators: written intermediates, Arrow batches, a global order."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    The files outlive any executor, so later stages never recompute what lies before them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def slices(batches: Iterable[pa.RecordBatch], rows: int, text: str | None = None,
           text_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``rows`` rows and, where ``text`` names a column,
    about ``text_bytes`` bytes of it (one row may be longer), so memory does not follow the
    session's batch size."""
    for batch in batches:
        if text is None:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
            continue
        lengths = pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist()
        at = size = 0
        for i, n in enumerate(lengths):
            if i > at and (i - at >= rows or size + n > text_bytes):
                yield batch.slice(at, i - at)
                at, size = i, 0
            size += n
        if at < batch.num_rows:
            yield batch.slice(at)


def strings(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null is the empty string."""
    return column.fill_null("").to_pylist()


def ranked_blocks(df: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """``df`` (distinct on ``keys``) in one global order, as written blocks.

    Adds ``_block`` (blocks are ordered like the keys) and ``_at`` (position within the block,
    from 1). The rows are range-partitioned by ``keys`` and written once, so the block numbers
    stay as they are; no task sees more than one block.
    """
    n = shuffle_partitions(df.sparkSession)
    placed = df.repartitionByRange(n, *[F.col(k).asc_nulls_last() for k in keys])
    written = materialise(placed.withColumn("_block", F.spark_partition_id()), purpose)
    inside = Window.partitionBy("_block").orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    return written.withColumn("_at", F.row_number().over(inside))


def block_offsets(blocks: DataFrame) -> DataFrame:
    """``(_block, _before)``: rows in all earlier blocks. One row per block, so the single-task
    window over them is bounded by the number of shuffle partitions."""
    sizes = blocks.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
