"""Idempotent writers and file manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from newsledger.session import materialize


def content_fingerprint(df: DataFrame, keys: list[str]) -> DataFrame:
    """Order-insensitive content hash per partition: row count and sum of row hashes.

    Rows are hashed as JSON with their NULLs, since a hash of columns skips a NULL and with it
    the place where it stood.
    """
    rest = sorted(c for c in df.columns if c not in keys)
    row = F.xxhash64(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"})).cast(
        "decimal(38,0)")
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum(row).alias("hash"))


def _store(rows: DataFrame, path: str, key: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        key).parquet(path)


def write_if_changed(df: DataFrame, path: str, key: str = "day") -> int:
    """Rewrite only the partitions whose content differs; returns how many.

    Partitions are compared by count and hash with the fingerprints stored beside the table, so
    no stored row is read, and replaced one folder at a time; an unchanged run touches no file.
    Fingerprints of changed partitions are taken back before the data is written and stored
    after it: a run that breaks off in between is made good by the next one.
    """
    spark = df.sparkSession
    rows = materialize(df)
    new = materialize(content_fingerprint(rows, [key]))
    marks = f"{path.rstrip('/')}.fingerprints"
    try:
        old = spark.read.schema(new.schema).parquet(marks)
        same = new.join(old, [key, "rows", "hash"], "left_semi").select(key)
        changed = new.join(same, key, "left_anti")
    except AnalysisException as error:  # only a table that is not there yet is written whole
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        changed = new
    changed = materialize(changed)
    count = changed.count()
    if count:
        _store(changed.withColumn("rows", F.lit(-1).cast("long")), marks, key)
        # rebalance gathers a day's rows into few files and splits a day that is too large
        _store(rows.join(changed.select(key), key, "left_semi").hint("rebalance", key), path, key)
        _store(changed, marks, key)
    return count


def manifest(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, sha256) of every file under a folder, hashed where it is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", glob).load(root))
    relative = F.regexp_replace("path", r"^(?:file:)?/*" + root.strip("/") + "/", "")
    return files.select(relative.alias("path"), F.sha2("content", 256).alias("sha256"))


def manifest_fingerprint(files: DataFrame) -> DataFrame:
    """One row: a hash that changes with any path or content."""
    row = F.xxhash64("path", "sha256").cast("decimal(38,0)")
    return files.agg(F.count("*").alias("files"), F.sum(row).alias("fingerprint"))


def manifest_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Paths that are missing, hash differently, or are extra in the target."""
    both = expected.withColumnRenamed("sha256", "want").join(
        actual.withColumnRenamed("sha256", "have"), "path", "full_outer")
    failure = (F.when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "extra")
               .when(F.col("want") != F.col("have"), "hash"))
    return both.withColumn("failure", failure).where(F.col("failure").isNotNull()).select(
        "path", "failure")
