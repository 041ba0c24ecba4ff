"""Tables placed once by their join key: bucketed and sorted, so that joins and groupings on it need no exchange."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

from textsignal.session import scratch_path

BUCKET_ROWS = 4_000_000


def bucket_count(rows: int, least: int = 8) -> int:
    """Buckets for the larger of the tables that are to meet, a power of two, so that growing tables still match."""
    return max(least, 1 << max(0, math.ceil(math.log2(max(1, rows / BUCKET_ROWS)))))


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str, path: str | None = None) -> DataFrame:
    """Stores ``df`` as a table of ``buckets`` buckets by ``key``, sorted inside them, and reads it back.

    One exchange places the rows, so every bucket is one file.  The table's files lie at ``path`` (a new folder of the
    shared scratch by default); its name in the catalog is unique.  Null keys share a bucket.
    """
    spark: SparkSession = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    placed = df.repartition(buckets, key).sortWithinPartitions(key)
    writer = placed.write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path or scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table)
