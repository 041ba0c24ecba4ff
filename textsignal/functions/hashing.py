"""Deterministic pseudo-random numbers from md5: the same on every run and partitioning."""

from pyspark.sql import Column, functions as F


def uniform(*parts: Column | str | int) -> Column:
    """Uniform number in [0, 1) from the ``|``-joined parts (32 bits of md5)."""
    return F.conv(F.substring(digest(*parts), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def digest(*parts: Column | str | int) -> Column:
    """md5 hex digest of the ``|``-joined parts."""
    cols = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *cols))
