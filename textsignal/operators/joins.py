"""Placement and join helpers."""

from pyspark.sql import DataFrame

from textsignal.session import scratch_path


def stored_side(df: DataFrame, name: str = "side") -> DataFrame:
    """A join side written once and read back.

    Its lineage runs once, and its size in bytes is known, so Spark itself broadcasts it if it
    is small and else shuffles, where adaptive execution splits skewed keys.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def place_by(df: DataFrame, key: str) -> DataFrame:
    """Hash-place rows by ``key`` into the session's number of shuffle partitions.

    The number is explicit: texts grow many times over when they are exploded, and
    adaptive coalescing, which only sees their size before that, would put them
    into too few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
