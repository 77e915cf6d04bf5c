"""Ordered operators that never put a whole key into one task.

A plain window over (key order by time) sends every row of a key to one task. Here
the window runs inside (key, bucket) only, where a bucket is a slice of the order,
such as a day. What has to cross a bucket is one summary row per (key, bucket),
computed with map-side aggregation and carried by a window over those few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsledger.session import materialize


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key in an explicit order.

    An aggregate, not a window: each map task keeps one row per key, so a key holding
    a third of the table shrinks before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order))
    return (df.groupBy(*keys).agg(best.alias("_row"))
            .select(*keys, "_row.*").select(*df.columns))


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return (df.groupBy(*keys).agg(best.alias("_row"))
            .select(*keys, "_row.*").select(*df.columns))


def _join_summary(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach one summary row per (key, bucket); AQE splits a skewed side."""
    on = [*keys, "_bucket"]
    condition = [df[c].eqNullSafe(summary[c]) for c in on]
    extra = [summary[c] for c in summary.columns if c not in on]
    return df.join(summary, condition, "left").select(*[df[c] for c in df.columns], *extra)


def with_lag(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str],
             columns: Sequence[str]) -> DataFrame:
    """Add ``prev_<column>``: the values on the preceding row of the key.

    ``bucket`` must not decrease along ``order``. Adds ``is_first`` as well.
    """
    rows = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    across = Window.partitionBy(*keys).orderBy("_bucket")
    values = F.struct(*columns)
    summary = (rows.groupBy(*keys, "_bucket")
               .agg(F.max_by(values, F.struct(*order)).alias("_last"))
               .withColumn("_carry", F.lag("_last").over(across)).drop("_last"))
    rows = rows.withColumn("_prev", F.lag(values).over(inside))
    rows = _join_summary(rows, summary, keys)
    prev = F.coalesce("_prev", "_carry")
    for column in columns:
        rows = rows.withColumn(f"prev_{column}", prev[column])
    return rows.withColumn("is_first", prev.isNull()).drop("_bucket", "_prev", "_carry")


def with_rank(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str],
              name: str = "rank") -> DataFrame:
    """Add the row number within the key."""
    rows = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    before = (Window.partitionBy(*keys).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    summary = (rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .drop("_n"))
    rows = rows.withColumn("_inside", F.row_number().over(inside))
    rows = _join_summary(rows, summary, keys)
    return rows.withColumn(name, F.col("_inside") + F.col("_offset")).drop(
        "_bucket", "_inside", "_offset")


def with_running_max(df: DataFrame, keys: Sequence[str], bucket: Column,
                     order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add the maximum of ``value`` over the key's rows up to and including this one."""
    rows = df.withColumn("_bucket", bucket).withColumn("_value", value)
    inside = (Window.partitionBy(*keys, "_bucket").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    before = (Window.partitionBy(*keys).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    summary = (rows.groupBy(*keys, "_bucket").agg(F.max("_value").alias("_top"))
               .withColumn("_carry", F.max("_top").over(before)).drop("_top"))
    rows = rows.withColumn("_inside", F.max("_value").over(inside))
    rows = _join_summary(rows, summary, keys)
    return rows.withColumn(name, F.greatest("_inside", "_carry")).drop(
        "_bucket", "_value", "_inside", "_carry")


def newest(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str],
           count: int) -> DataFrame:
    """The newest ``count`` rows of every key.

    Each bucket keeps its newest rows first (Spark limits a ranked window before the
    shuffle), so at most buckets * count rows per key reach the final ranking.
    """
    newest_first = [F.col(c).desc() for c in order]
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*newest_first)
    overall = Window.partitionBy(*keys).orderBy(*newest_first)
    return (df.withColumn("_bucket", bucket)
            .withColumn("_rank", F.row_number().over(inside)).where(F.col("_rank") <= count)
            .withColumn("_rank", F.row_number().over(overall)).where(F.col("_rank") <= count)
            .drop("_bucket", "_rank"))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  count: int) -> DataFrame:
    """Top-k report per group; Spark pre-limits each group before the shuffle."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(ranked))
            .where(F.col("_rank") <= count).drop("_rank"))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str,
                 step: float = 1.0) -> DataFrame:
    """Exact median per key, without holding a key's values in one task.

    Equal values combine on the map side. Counts per slice of ``step`` find the slice
    that holds the middle; only that slice is ordered row by row.
    """
    keys = list(keys)
    counts = (df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v"))
              .agg(F.count("*").alias("_n")).withColumn("_slice", F.floor(F.col("_v") / step)))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_m").over(whole)
    slices = (counts.groupBy(*keys, "_slice").agg(F.sum("_n").alias("_m"))
              .select(*keys, "_slice", "_m", total.alias("_total"),
                      F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_before"))
              .withColumn("_low", F.floor((F.col("_total") + 1) / 2))
              .withColumn("_high", F.floor(F.col("_total") / 2) + 1)
              .where((F.col("_before") < F.col("_high"))
                     & (F.col("_before") + F.col("_m") >= F.col("_low"))))
    inside = Window.partitionBy(*keys, "_slice").orderBy("_v")
    rows = (counts.join(slices, [*keys, "_slice"])
            .withColumn("_upto", F.col("_before") + F.sum("_n").over(inside)))
    low = F.min(F.when(F.col("_upto") >= F.col("_low"), F.col("_v")))
    high = F.min(F.when(F.col("_upto") >= F.col("_high"), F.col("_v")))
    return rows.groupBy(*keys).agg(((low + high) / 2.0).alias(name))


def with_running_sum(df: DataFrame, bucket: Column, order: Sequence[str], value: Column,
                     name: str) -> DataFrame:
    """Add the running sum of ``value`` over the whole table in an explicit order.

    Only the bucket totals, one row per bucket, meet in one task.
    """
    rows = df.withColumn("_bucket", bucket).withColumn("_value", value)
    inside = (Window.partitionBy("_bucket").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (rows.groupBy("_bucket").agg(F.sum("_value").alias("_total"))
              .withColumn("_carry", F.coalesce(F.sum("_total").over(before), F.lit(0)))
              .drop("_total"))
    rows = _join_summary(rows.withColumn("_inside", F.sum("_value").over(inside)), totals, [])
    return rows.withColumn(name, F.col("_inside") + F.col("_carry")).drop(
        "_bucket", "_value", "_inside", "_carry")


def with_ranged_sum(df: DataFrame, order: Sequence[Column], value: Column, name: str) -> DataFrame:
    """Add the running sum of ``value`` over the whole table, in any order of distinct keys.

    The buckets are the ranges of one distributed sort, so they are even whatever the keys
    hold; one total a range meets in one task.
    """
    ranged = df.repartitionByRange(*order).select(
        "*", F.spark_partition_id().alias("_range"), value.cast("long").alias("_value"))
    rows = materialize(ranged)  # ranges are drawn from a sample: they must not be drawn twice
    inside = (Window.partitionBy("_range").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (rows.groupBy("_range").agg(F.sum("_value").alias("_total"))
              .select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0))
                      .alias("_carry")))
    return (rows.withColumn("_inside", F.sum("_value").over(inside)).join(totals, "_range")
            .withColumn(name, F.col("_inside") + F.col("_carry"))
            .drop("_range", "_value", "_inside", "_carry"))
