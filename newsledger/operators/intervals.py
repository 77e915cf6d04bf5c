"""Matching within a time distance, without producing pairs.

For every probe time the question is what lies within ``width`` of it under the same
key: the earliest time, and whether more than one source is present. A band join
would answer it by listing pairs, quadratic in a hot key. Here the time line is cut
into grains. Whole grains inside the band are read from one summary row per
(key, grain); only the two grains at the edges are looked at row by row, by a running
minimum inside (key, grain).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

HOUR = 3_600_000_000
FACTS = ["earliest", "low", "high"]


def interval_profile(points: DataFrame, probes: DataFrame, keys: Sequence[str],
                     width_days: int = 30, grain_hours: int = 6) -> DataFrame:
    """Facts about the points within ``width_days`` of each distinct probe.

    ``points`` has the keys, ``ts`` and ``source``; ``probes`` the keys and ``ts``.
    Returns keys, ``ts``, ``earliest`` (timestamp), ``low`` and ``high`` (least and
    greatest source). More than one source is near exactly when low differs from high.
    Probes with no point in reach are left out.
    """
    keys = list(keys)
    grain, width = grain_hours * HOUR, width_days * 24 * HOUR
    if width % grain:
        raise ValueError("the width must be a whole number of grains")
    reach = width // grain
    seen = (points.where(F.col("ts").isNotNull())
            .groupBy(*keys, F.unix_micros("ts").alias("t"))
            .agg(F.min("source").alias("low"), F.max("source").alias("high"))
            .withColumn("g", F.floor(F.col("t") / grain)))
    asked = (probes.where(F.col("ts").isNotNull())
             .select(*keys, F.unix_micros("ts").alias("t")).distinct())

    inner = _whole_grains(seen, asked, keys, grain, reach)
    before = _edge(seen, asked, keys, grain, -width, newest_first=True)
    after = _edge(seen, asked, keys, grain, width, newest_first=False)
    return (inner.unionByName(before).unionByName(after)
            .where(F.col("low").isNotNull())
            .groupBy(*keys, "t")
            .agg(F.min("earliest").alias("earliest"), F.min("low").alias("low"),
                 F.max("high").alias("high"))
            .select(*keys, F.timestamp_micros("t").alias("ts"),
                    F.timestamp_micros("earliest").alias("earliest"), "low", "high"))


def _whole_grains(seen, asked, keys, grain, reach) -> DataFrame:
    """Facts of the grains that lie inside the band entirely."""
    grains = (seen.groupBy(*keys, "g")
              .agg(F.min("t").alias("earliest"), F.min("low").alias("low"),
                   F.max("high").alias("high")))
    asked = asked.withColumn("g", F.floor(F.col("t") / grain))
    places = asked.select(*keys, "g").distinct()
    lines = grains.unionByName(places, allowMissingColumns=True)
    band = Window.partitionBy(*keys).orderBy("g").rangeBetween(-(reach - 1), reach - 1)
    near = (lines.groupBy(*keys, "g")
            .agg(*[F.first(c, ignorenulls=True).alias(c) for c in FACTS])
            .select(*keys, "g", F.min("earliest").over(band).alias("earliest"),
                    F.min("low").over(band).alias("low"),
                    F.max("high").over(band).alias("high")))
    return asked.join(near, [*keys, "g"]).select(*keys, "t", *FACTS)


def _edge(seen, asked, keys, grain, shift, newest_first) -> DataFrame:
    """Facts of the one grain the band cuts through on one side."""
    points = seen.select(*keys, "g", "t", F.col("t").alias("earliest"), "low", "high",
                         F.lit(None).cast("bigint").alias("probe"))
    nothing = F.lit(None)
    source_type = dict(seen.dtypes)["low"]
    marks = (asked.withColumn("probe", F.col("t")).withColumn("t", F.col("t") + shift)
             .select(*keys, F.floor(F.col("t") / grain).alias("g"), "t",
                     nothing.cast("bigint").alias("earliest"),
                     nothing.cast(source_type).alias("low"),
                     nothing.cast(source_type).alias("high"), "probe"))
    along = F.col("t").desc() if newest_first else F.col("t").asc()
    upto = (Window.partitionBy(*keys, "g").orderBy(along)
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (points.unionByName(marks)
            .select(*keys, "probe", F.min("earliest").over(upto).alias("earliest"),
                    F.min("low").over(upto).alias("low"), F.max("high").over(upto).alias("high"))
            .where(F.col("probe").isNotNull()).withColumnRenamed("probe", "t"))
