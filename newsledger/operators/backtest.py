"""What would change under other rules: a full outer join of two classifications."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from newsledger import fixed_values as fixed
from newsledger.operators.classify import Rules, classify
from newsledger.operators.ordered import last_wins
from newsledger.session import materialize

Classifier = Callable[[DataFrame], DataFrame]
KEEP = ["day", "source_item_id", "source_id", "tier", "title", "url", "section",
        "section_ord", "payload_ord", "item_ord"]


def _indexed(classified: DataFrame) -> DataFrame:
    """One row per (day, item): the last one in reading order."""
    return last_wins(classified.select(*KEEP), ["day", "source_item_id"],
                     ["section_ord", "payload_ord", "item_ord"])


def compare_rules(items: DataFrame, baseline: Rules | Classifier,
                  candidate: Rules | Classifier, window_days: int = 3) -> DataFrame:
    """Every item kept by either side, with its sections and the kind of change."""
    def run(rules):
        return rules(items) if callable(rules) else classify(items, rules, window_days)

    old, new = _indexed(run(baseline)), _indexed(run(candidate))
    both = old.alias("o").join(new.alias("n"), ["day", "source_item_id"], "full_outer")
    change = (F.when(F.col("o.section").isNull(), "added")
              .when(F.col("n.section").isNull(), "removed")
              .when(F.col("o.section") != F.col("n.section"), "moved").otherwise("kept"))
    kept = ["source_id", "tier", "title", "url"]
    rows = both.select(
        "day", "source_item_id",
        *[F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in kept],
        F.col("o.section").alias("baseline_section"),
        F.col("n.section").alias("candidate_section"), change.alias("change"))
    return materialize(rows)


def change_summary(compared: DataFrame) -> DataFrame:
    return compared.agg(
        F.count("baseline_section").alias("baseline_kept"),
        F.count("candidate_section").alias("candidate_kept"),
        *[F.count(F.when(F.col("change") == c, 1)).alias(c)
          for c in ("added", "removed", "moved")])


def section_deltas(compared: DataFrame) -> DataFrame:
    """Items per section on both sides; sections without items stay, with zeros."""
    spark = compared.sparkSession
    sections = spark.createDataFrame([(s,) for s in fixed.SECTIONS], "section string")
    sides = F.inline(F.array(
        F.struct(F.col("baseline_section").alias("section"), F.lit(1).alias("b"),
                 F.lit(0).alias("c")),
        F.struct(F.col("candidate_section").alias("section"), F.lit(0).alias("b"),
                 F.lit(1).alias("c"))))
    counts = compared.select(sides).groupBy("section").agg(
        F.sum("b").alias("baseline"), F.sum("c").alias("candidate"))
    return (sections.join(counts, "section", "left")
            .fillna(0, ["baseline", "candidate"])
            .withColumn("delta", F.col("candidate") - F.col("baseline")))


def source_deltas(compared: DataFrame) -> DataFrame:
    return (compared.groupBy("source_id")
            .agg(F.count("baseline_section").alias("baseline"),
                 F.count("candidate_section").alias("candidate"))
            .withColumn("delta", F.col("candidate") - F.col("baseline")))
