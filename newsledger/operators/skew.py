"""Joins and broadcasts that stay safe when one key holds a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_ROWS = 100_000
HOT_ROWS = 1_000_000


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Bounded count: stops reading after ``rows`` + 1 rows."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a check of the size; otherwise a shuffle join."""
    return F.broadcast(df) if small_enough(df, rows) else df


def collect_bounded(df: DataFrame, rows: int = 10_000) -> list:
    """Rows of a configuration table on the driver, refused beyond the bound."""
    found = df.limit(rows + 1).collect()
    if len(found) > rows:
        raise ValueError(f"more than {rows} rows: too many to compile into a plan")
    return found


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of splits each needs.

    Counting combines on the map side. At most total/``hot_rows`` keys qualify.
    """
    return (df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
            .select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_splits")))


def salted_join(big: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner",
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Equi-join that spreads the hot keys of ``big`` over several tasks.

    Rows of ``big`` with a hot key get a split from a hash of the whole row, so a task
    that runs again splits the same way; ``other`` is repeated once per split for those
    keys only. All other rows keep split 0.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("the salted side must be the left side")
    hot = broadcast_if_small(hot_keys(big, keys, hot_rows))
    split = F.when(F.col("_splits").isNull(), 0).otherwise(
        F.pmod(F.xxhash64(*big.columns), F.col("_splits"))).cast("int")
    left = big.join(hot, list(keys), "left").withColumn("_salt", split).drop("_splits")
    right = (other.join(hot, list(keys), "left")
             .withColumn("_salt", F.explode(
                 F.sequence(F.lit(0), F.coalesce(F.col("_splits"), F.lit(1)) - 1)))
             .drop("_splits"))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def any_null(*columns: Column) -> Column:
    found = F.lit(False)
    for column in columns:
        found = found | column.isNull()
    return found
