"""Exact moments for count series and an engine-neutral rounding.

Volumes are integer counts.  Their mean and sample standard deviation are
computed from exact integer sums (sum, sum of squares, n as DECIMAL(38,0)),
then converted to DOUBLE once: the result does not depend on the order in
which partial aggregates are merged, so it is the same on every cluster
layout and in every engine.  `round_half_up` rounds with plain double
arithmetic (floor(x * 10^d + 0.5) / 10^d) for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, _INTEGRAL)


def moment_sums(c: str, where: Column | None = None) -> list[Column]:
    """Aggregates `_s`, `_ss`, `_n` over an integral column (exact); with
    `where`, only rows satisfying it count (a conditional aggregate, so the
    input subtree stays identical to other consumers and can be reused)."""
    v = F.col(c).cast("decimal(38,0)")
    if where is not None:
        v = F.when(where, v)
    return [F.sum(v).alias("_s"), F.sum(v * v).alias("_ss"), F.count(v).cast("decimal(38,0)").alias("_n")]


def mean_from_sums() -> Column:
    return F.col("_s").cast("double") / F.col("_n").cast("double")


def variance_numerator() -> Column:
    """n * sum(v^2) - sum(v)^2 (exact; > 0 iff the sample stddev is > 0)."""
    return F.col("_n") * F.col("_ss") - F.col("_s") * F.col("_s")


def stddev_from_sums() -> Column:
    n = F.col("_n")
    return F.when(n > 1, F.sqrt(variance_numerator().cast("double") / (n * (n - 1)).cast("double")))


def round_half_up(c: Column, digits: int) -> Column:
    k = float(10 ** digits)
    return F.floor(c * k + 0.5) / k
