"""Per-key volume surges.

Plan shape: one partial+final aggregation to (key, bucket) counts, which also
picks the sample attribute (`min`, deterministic, C8); one aggregation of that
series to per-key stats; one equi-join of the two on the key.  No window over
the raw rows: a key holding a third of all rows is pre-aggregated map-side,
and its series has one row per bucket, so no task ever holds its raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.functions.stats import (mean_from_sums, moment_sums, round_half_up, stddev_from_sums,
                                      variance_numerator)


def sample_attribute_join(df: DataFrame, key: str, bucket: Column, sample_col: str,
                          bucket_name: str = "bucket", sample_name: str = "sample") -> DataFrame:
    """(key, bucket, vol, sample) — the sample is min(sample_col) per group."""
    return (df.groupBy(key, bucket.alias(bucket_name))
              .agg(F.count(F.lit(1)).alias("vol"), F.min(sample_col).alias(sample_name)))


def sender_stats_having(series: DataFrame, key: str, min_buckets: int = 12) -> DataFrame:
    """Per-key mean / sample stddev of vol, HAVING count >= n AND stddev > 0
    (exact integer moments of the counts)."""
    return (series.groupBy(key).agg(*moment_sums("vol"))
                  .filter((F.col("_n") >= min_buckets) & (variance_numerator() > 0))
                  .select(key, F.col("_n").cast("long").alias("n_buckets"), mean_from_sums().alias("mu"),
                          stddev_from_sums().alias("sigma")))


def stats_join(series: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Series rows joined to their key's stats (keys failing HAVING drop)."""
    return series.join(stats.select(key, "mu", "sigma"), key)


def zscore_per_key(df: DataFrame, key: str, bucket: Column, *, sample_col: str,
                   min_buckets: int = 12, z: float = 5.0,
                   window: tuple[str | None, str | None] = (None, None),
                   bucket_name: str = "bucket", sample_name: str = "sample") -> DataFrame:
    """A2 / H6: buckets whose volume is >= z sigma above the key's own history.

    The history is every bucket of the key, the NULL bucket included (C11);
    the window only restricts which buckets are reported.
    """
    series = sample_attribute_join(df, key, bucket, sample_col, bucket_name, sample_name)
    stats = sender_stats_having(series, key, min_buckets)
    j = stats_join(series, stats, key)
    raw_z = (F.col("vol") - F.col("mu")) / F.col("sigma")  # sigma > 0 by HAVING
    b = F.col(bucket_name)
    lo, hi = window
    cond = raw_z >= z
    if lo is not None:
        cond = cond & (b >= F.lit(lo).cast("date"))
    if hi is not None:
        cond = cond & (b <= F.lit(hi).cast("date"))
    return j.filter(cond).select(key, bucket_name, "vol", round_half_up(raw_z, 2).alias("zscore"), sample_name)


def top_surge(surge: DataFrame, key: str, bucket_name: str = "bucket") -> DataFrame:
    """K3: the single highest-z row, ties broken by (key, bucket)."""
    return surge.orderBy(F.desc("zscore"), key, bucket_name).limit(1)
