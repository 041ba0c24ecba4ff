"""Helpers shared by the operators of this package."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from textsignal.session import scratch_path


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared scratch root and read it back.

    Cuts the lineage: a lost executor re-reads files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` minus columns an operator is about to add; the operator's results win over clashing inputs."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def box(df: DataFrame, *replaced: str) -> Column:
    """All columns of ``df`` but those an operator replaces as one column ``row``: names inside it clash with none."""
    return F.struct(*[F.col(f"`{c}`") for c in without(df, *replaced).columns]).alias("row")


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def gapless(df: DataFrame, group: str, order: list[Column], out: str, bins: int = 1024) -> DataFrame:
    """Numbers 0, 1, 2 … within ``group`` without one task per group.

    Rows are dealt to ``bins`` hash bins of ``order`` per group; each bin is numbered
    on its own and shifted by the rows of the bins before it.  ``group`` takes few
    values (a documented number of shards or buckets), so the offset table holds at
    most groups x ``bins`` rows.  ``order`` should tell rows apart; equal rows share a bin
    and get different numbers.  Null groups are numbered as a group of their own.
    """
    keyed = without(df, "_bin", "_from").withColumn("_bin", F.pmod(F.xxhash64(*order), F.lit(bins)).cast("int"))
    sizes = keyed.groupBy(group, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col(group).alias("_group"), F.col("_bin").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from")
    )
    inside = Window.partitionBy(group, "_bin").orderBy(*order)
    numbered = keyed.withColumn(out, F.row_number().over(inside).cast("long") - 1)
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bin") == F.col("_b"))
    joined = numbered.join(F.broadcast(sizes), same)  # groups x bins rows at most
    return joined.withColumn(out, F.col(out) + F.col("_from")).drop("_bin", "_from", "_group", "_b")
