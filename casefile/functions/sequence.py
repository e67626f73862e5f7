"""Ordered-sequence helpers that do not put a whole key into one task.

A plain `Window.partitionBy(key).orderBy(t)` sends every row of a key to one
task; when one key holds a third of all rows that task becomes the job.  Here
rows are range-partitioned by key and order and written once, each with the
number of its slice: a key's rows lie in as many neighbouring slices as they
fill, however close together they are.  Windows run within (key, slice), and
what they need from the slices before comes from a summary with one row per
(key, slice), of which only keys that go on over a border are kept: one a
slice at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefile.session import work_path


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`df`, written, with its slice number in `_slice`."""
    path = work_path(df.sparkSession, "sliced", uuid.uuid4().hex)
    df.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("_slice", T.IntegerType())])).parquet(path)


def _going_on(rows: DataFrame, keys: Sequence[str], summary: Column, before: Callable[[WindowSpec], Column]) -> DataFrame:
    """(keys..., _slice, _before): what `before` makes of the summaries (`_of`)
    of a key's earlier slices, for the slices that are not its first."""
    each = rows.groupBy(*keys, "_slice").agg(summary.alias("_of"))
    several = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    return (each.join(several, keys, "left_semi").withColumn("_before", before(by_slice)).drop("_of")
            .filter(F.col("_before").isNotNull()))


def segmented_prev(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
                   prefix: str = "prev_") -> DataFrame:
    """Add `prev_<v>` = value of the previous row of the same key in `order`.
    Keys are not null."""
    rows = sliced(df, keys, order)
    w = Window.partitionBy(*keys, "_slice").orderBy(*_cols(order))
    inner = rows.select("*", F.row_number().over(w).alias("_pos"), *[F.lag(v).over(w).alias(prefix + v) for v in values])
    before = _going_on(rows, keys, F.max_by(F.struct(*values), F.struct(*order)), lambda w: F.lag("_of").over(w))
    out = inner.join(before, [*keys, "_slice"], "left")
    for v in values:
        out = out.withColumn(prefix + v, F.when(F.col("_pos") == 1, F.col("_before")[v]).otherwise(F.col(prefix + v)))
    return out.select(*df.columns, *[prefix + v for v in values])


def segmented_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn") -> DataFrame:
    """1-based position of each row within its key in `order`.  Keys are not null."""
    rows = sliced(df, keys, order)
    inner = rows.withColumn("_pos", F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*_cols(order))))
    before = _going_on(rows, keys, F.count(F.lit(1)), lambda w: F.sum("_of").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    out = inner.join(before, [*keys, "_slice"], "left")
    return out.withColumn(name, (F.coalesce("_before", F.lit(0)) + F.col("_pos")).cast("long")).select(*df.columns, name)
