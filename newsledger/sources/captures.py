"""Reading the capture archive.

Layout: ``<root>/day=YYYY-MM-DD/<source>.json`` and one ``fetch_log.json`` per day. Spark
skips files whose names start with ``_``, so a log of that kind is landed without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsledger import schemas
from newsledger.functions import ids
from newsledger.operators.barrier import computed

LOG = "fetch_log"


def _names(column: str = "_metadata.file_name") -> Column:
    return F.regexp_replace(F.col(column), r"\.json$", "")


def _days(rows: DataFrame, first=None, last=None) -> DataFrame:
    """Partition filter on the day folders."""
    day = F.to_date(F.col("day").cast("string"))
    rows = rows.withColumn("day", day)
    if first is not None:
        rows = rows.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col("day") <= F.lit(last).cast("date"))
    return rows.where(F.col("day").isNotNull())


def read_captures(spark: SparkSession, root: str, first=None, last=None,
                  schema: str = schemas.CAPTURE, strict: bool = True) -> DataFrame:
    """One row per source and day.

    ``strict`` fails on a broken file; otherwise broken files are left out.
    """
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    rows = (spark.read.schema(schema).option("multiLine", True).option("mode", mode)
            .option("basePath", root).option("pathGlobFilter", "*.json")
            .json(f"{root}/day=*"))
    rows = rows.withColumn("file", _names()).where(F.col("file") != LOG)
    if not strict:
        rows = rows.where(F.col("items").isNotNull() | F.col("status").isNotNull())
    return _days(rows, first, last)


def observations(captures: DataFrame) -> DataFrame:
    """One row per captured item. File name and position give the reading order."""
    kept = [c for c in captures.columns if c != "items"]
    rows = captures.select(*kept, F.posexplode("items").alias("item_ord", "item"))
    rows = rows.select(*kept, "item_ord", "item.*")
    return (rows.withColumn("source_id", ids.fallback_source_id(F.col("source"), F.col("name")))
            .withColumn("payload_ord", F.col("file")))


def collection_identity(captures: DataFrame) -> DataFrame:
    """Add collection_id and collection_hash of a whole capture.

    Works on the landed row, whose item list has the order that counts; nothing has to
    be gathered again.
    """
    source = ids.fallback_source_id(F.col("source"), F.col("name"))
    items = F.transform("items", lambda i: ids.collection_item(
        i["title"], i["url"], i["published"], i["summary"], i["content_sha256"],
        i["external_url"], i["x_links"]))
    body = F.concat(F.lit('{"items":['), F.array_join(items, ","), F.lit('],"source":'),
                    F.regexp_extract(F.to_json(F.struct(source.alias("s"))), r'^\{"s":(.*)\}$', 1),
                    F.lit("}"))
    return computed(captures, {"source_id": source,
                               "collection_id": F.concat(source, F.lit(":collection")),
                               "collection_hash": F.sha2(body, 256)})


def read_fetch_log(spark: SparkSession, root: str, first=None, last=None) -> DataFrame:
    """One row per day and source from ``_fetch_log.json`` files."""
    rows = (spark.read.schema(schemas.FETCH_LOG).option("multiLine", True)
            .option("basePath", root).option("pathGlobFilter", f"{LOG}.json")
            .json(f"{root}/day=*"))
    rows = _days(rows, first, last)
    return (rows.select("day", "run_mode", "fetched_at", "completed_at", "finished_at",
                        F.explode("sources").alias("source", "entry"))
            .select("day", "run_mode", "fetched_at", "completed_at", "finished_at", "source",
                    "entry.*"))


def read_audit_samples(spark: SparkSession, root: str, last, origin: str = "candidate",
                       days: list | None = None) -> DataFrame:
    """Sampled captures up to a day, or of chosen days; broken files are left out."""
    rows = read_captures(spark, root, None, last, schemas.AUDIT_CAPTURE, strict=False)
    if days is not None:
        rows = rows.where(F.col("day").cast("string").isin([str(d) for d in days]))
    role = "incumbent" if origin == "incumbent" else "candidate"
    return (rows.withColumn("origin", F.lit(origin))
            .withColumn("status", F.coalesce("status", F.lit("ok")))
            .withColumn("role", F.coalesce("role", F.lit(role)))
            .withColumn("routing", F.coalesce("routing", F.lit("classify"))))


def malformed_line(lines: DataFrame, schema: str) -> str | None:
    """``path:number`` of the first line that is no JSON object of the schema, or None.

    ``lines`` come from the text reader. Lines are numbered from the blocks of bytes that tasks
    read: full counts of the blocks before, and the place within the block.
    """
    column = "_corrupt"
    parsed = F.from_json("value", f"{schema}, {column} string", {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": column})
    rows = lines.select("value", F.col("_metadata.file_path").alias("path"),
                        F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("place"))
    bad = rows.where((F.trim("value") != "") & (parsed[column].isNotNull() | parsed.isNull()))
    first = bad.agg(F.min(F.struct("path", "block", "place")).alias("b")).first()["b"]
    if first is None:
        return None
    before = rows.where((F.col("path") == first.path) & (
        (F.col("block") < first.block)
        | ((F.col("block") == first.block) & (F.col("place") < first.place)))).count()
    return f"{first.path}:{before + 1}"


def read_inbox(spark: SparkSession, root: str, first=None, last=None) -> DataFrame:
    """Inbox rows from month shards ``month=YYYY-MM``; a malformed line of a month that is read
    fails with its file and number."""
    months = F.lit(True)
    days = F.lit(True)
    if first is not None:
        first = F.lit(first).cast("date")
        months = months & (F.col("month").cast("string") >= F.date_format(first, "yyyy-MM"))
        days = days & (F.col("date") >= first)
    if last is not None:
        last = F.lit(last).cast("date")
        months = months & (F.col("month").cast("string") <= F.date_format(last, "yyyy-MM"))
        days = days & (F.col("date") <= last)
    lines = spark.read.option("basePath", root).text(f"{root}/month=*").where(months)
    place = malformed_line(lines, schemas.INBOX)
    if place:
        raise ValueError(f"malformed inbox row at {place}")
    rows = (spark.read.schema(schemas.INBOX).option("mode", "FAILFAST")
            .option("basePath", root).json(f"{root}/month=*"))
    return rows.where(months & days)


def read_baseline(spark: SparkSession, root: str, last) -> DataFrame:
    """Compact baseline rows up to a day."""
    rows = spark.read.schema(schemas.BASELINE).parquet(root)
    return rows.where(F.col("day") <= F.lit(last).cast("date"))
