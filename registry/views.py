"""The engine's input tables derived from the given test tables, in Spark and in SQL.

``observations`` pairs every document with a page: the page gives the URL, the
document the text; the fourth copy of a page keeps its URL but takes its title from
the document. Sources, days and links follow from the ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import text as T
from newsledger.operators.classify import Rules, classify
from newsledger.session import configure

TIERS = ["official", "community", "index", "aggregator", "finance", "radar"]
FIRST_DAY = "2024-01-01"
LAST_DAY = "2024-01-30"
SOURCES = 20
WINDOW_DAYS = 3

RULES = Rules.of(
    ["ndble", "heit", "sur"],
    [("release", fixed.SECTION_RELEASE, ["thing", "of the", "ment"]),
     ("field_test", fixed.SECTION_FIELD_TEST, ["erly", "pour", "ung"]),
     ("pricing", fixed.SECTION_PRICING, ["rest", "é"]),
     ("degradation", fixed.SECTION_DEGRADATION, ["inble", "ench", "las"]),
     ("company", fixed.SECTION_COMPANY, ["edble", "dem", "ñ"])])
CANDIDATE_RULES = Rules.of(
    ["ndble", "heit", "wh"],
    [("release", fixed.SECTION_RELEASE, ["thing", "ment"]),
     ("field_test", fixed.SECTION_FIELD_TEST, ["erly", "pour", "ung", "in the"]),
     ("pricing", fixed.SECTION_PRICING, ["rest", "ê"]),
     ("degradation", fixed.SECTION_DEGRADATION, ["inble", "las"]),
     ("company", fixed.SECTION_COMPANY, ["edble", "ñ"])])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(k: Column, values: list[int]) -> Column:
    out = F.lit(values[-1])
    for i, value in enumerate(values[:-1]):
        out = F.when(k == i, value).otherwise(out)
    return out


def tier_of(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in TIERS]), (number % 6 + 1).cast("int"))


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pages = table(spark, sf_dir, "pages")
    n = pages.count()
    d, p = F.col("doc_id"), F.col("p")
    k = F.floor(d / n)
    number = (p + _pick(F.col("k"), [0, 7, 7, 0])) % SOURCES
    day = F.date_add(F.lit(FIRST_DAY).cast("date"),
                     ((p + _pick(F.col("k"), [0, 0, 3, 6])) % 30).cast("int"))
    lag = F.when(d % 7 == 5, 1).when(d % 7 == 6, 5).otherwise(0)
    stamp = F.timestamp_add("HOUR", (d % 24).cast("int"),
                            F.to_timestamp(F.date_sub(F.col("day"), lag)))
    iso = F.date_format("stamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    mail = F.date_format("stamp", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    link = F.when(d % 4 == 0, F.concat(F.lit(" https://arxiv.org/abs/"), p % 40)).otherwise("")
    post = F.when(d % 3 == 0, F.concat(F.lit(" https://x.com/Author"), p % 23,
                                       F.lit("/status/"), 1000 + p % 97)).otherwise("")
    external = F.when(d % 5 == 0, F.concat(F.lit("http://www.github.com/Team"), p % 50,
                                           F.lit("/repo/?utm_source=feed&v="), p % 3)).otherwise("")
    rows = (docs.withColumn("p", d % n).withColumn("k", k)
            .join(pages.select(F.col("page_id").alias("p"), "url",
                               page_title(F.col("html")).alias("page_title")), "p")
            .withColumn("number", number).withColumn("day", day).withColumn("stamp", stamp))
    return rows.select(
        "day", F.concat(F.lit("src"), F.col("number")).alias("source_id"),
        F.concat(F.lit("Source "), F.col("number")).alias("name"),
        tier_of(F.col("number")).alias("tier"), F.lit(False).alias("injection_warning"),
        F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T20:"),
                 F.lpad(F.col("number").cast("string"), 2, "0"),
                 F.lit(":00Z")).alias("fetched_at"),
        F.concat(F.lit("src"), F.col("number")).alias("payload_ord"),
        d.alias("item_ord"),
        F.when(F.col("k") < 3, F.col("page_title"))
        .otherwise(F.regexp_extract("text", "^[^.\n]*", 0)).alias("title"),
        "url", F.when(F.col("n_chars") % 11 == 0, "")
        .when(F.col("number") % 2 == 0, iso).otherwise(mail).alias("published"),
        F.concat(F.col("text"), link, post).alias("summary"),
        external.alias("external_url"), T.empty_strings().alias("external_urls"),
        F.sha2("text", 256).alias("content_sha256"),
        F.when(d % 17 == 0, False).alias("changed"),
        F.when(d % 19 == 0, False).when(d % 19 == 1, True).alias("readable"))


def classified(spark: SparkSession, sf_dir: str, rules: Rules = RULES,
               first_url_wins: bool = True) -> DataFrame:
    return classify(observations(spark, sf_dir), rules, WINDOW_DAYS, first_url_wins)


# --- the same in SQL ----------------------------------------------------------
_TIER_LIST = "[" + ", ".join(f"'{t}'" for t in TIERS) + "]"


def case(k: str, values: list[int]) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"(CASE {k} {whens} END)"


OBSERVATIONS = f"""
obs0 AS (
  SELECT d.*, p.url AS page_url, p.html AS html, d.doc_id % n AS p, d.doc_id // n AS k
  FROM documents d, (SELECT count(*) AS n FROM pages) c, pages p
  WHERE p.page_id = d.doc_id % n),
obs1 AS (
  SELECT *, (p + {case('k', [0, 7, 7, 0])}) % {SOURCES} AS number,
    CAST(DATE '{FIRST_DAY}' + CAST((p + {case('k', [0, 0, 3, 6])}) % 30 AS INTEGER) AS DATE) AS day
  FROM obs0),
obs2 AS (
  SELECT *, CAST(day AS TIMESTAMP)
      - to_days(CAST(CASE doc_id % 7 WHEN 5 THEN 1 WHEN 6 THEN 5 ELSE 0 END AS INTEGER))
      + to_hours(CAST(doc_id % 24 AS INTEGER)) AS stamp
  FROM obs1),
obs AS (
  SELECT day, 'src' || number AS source_id, 'Source ' || number AS name, number,
    {_TIER_LIST}[CAST(number % 6 AS INTEGER) + 1] AS tier,
    CAST(day AS TIMESTAMP) + to_hours(20) + to_minutes(CAST(number AS INTEGER)) AS fetched_ts,
    doc_id AS item_ord,
    CASE WHEN k < 3 THEN regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)
         ELSE regexp_extract(text, '^[^.\\n]*') END AS title,
    page_url AS url,
    CASE WHEN n_chars % 11 = 0 THEN NULL ELSE stamp END AS published_at,
    CASE WHEN n_chars % 11 = 0 THEN ''
         WHEN number % 2 = 0 THEN strftime(stamp, '%Y-%m-%dT%H:%M:%SZ')
         ELSE strftime(stamp, '%a, %d %b %Y %H:%M:%S GMT') END AS published,
    text || CASE WHEN doc_id % 4 = 0 THEN ' https://arxiv.org/abs/' || (p % 40) ELSE '' END
         || CASE WHEN doc_id % 3 = 0 THEN ' https://x.com/Author' || (p % 23) || '/status/'
                 || (1000 + p % 97) ELSE '' END AS summary,
    CASE WHEN doc_id % 5 = 0 THEN 'http://www.github.com/Team' || (p % 50)
         || '/repo/?utm_source=feed&v=' || (p % 3) ELSE '' END AS external_url,
    CASE WHEN doc_id % 4 = 0 THEN 'https://arxiv.org/abs/' || (p % 40) END AS paper_link,
    CASE WHEN doc_id % 3 = 0 THEN 'https://x.com/Author' || (p % 23) || '/status/'
         || (1000 + p % 97) END AS post_link,
    sha256(text) AS content_sha256,
    CASE WHEN doc_id % 17 = 0 THEN FALSE END AS changed,
    CASE WHEN doc_id % 19 = 0 THEN FALSE WHEN doc_id % 19 = 1 THEN TRUE END AS readable
  FROM obs2)"""


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_keyword(body: str, keyword: str) -> str:
    if keyword.isascii():
        flank = "[^0-9A-Za-z_]"
        return f"regexp_matches({body}, '(?i)(^|{flank}){keyword}({flank}|$)')"
    return f"contains(lower({body}), {quote(keyword.lower())})"


def sql_hits(body: str, keywords) -> str:
    cases = ", ".join(f"CASE WHEN {sql_keyword(body, k)} THEN {quote(k)} END" for k in keywords)
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def sql_canonical(url: str) -> str:
    query = (f"array_to_string(list_sort(list_filter(string_split(regexp_extract({url}, "
             r"'^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT "
             "regexp_matches(lower(x), '^(utm_|(fbclid|gclid|mc_cid|mc_eid)=)'))), '&')")
    path = f"rtrim(regexp_extract({url}, '^https?://[^/?#]*([^?#]*)', 1), '/')"
    host = (f"regexp_replace(lower(regexp_extract({url}, '^https?://([^/?#]*)', 1)), "
            r"'^www\.', '')")
    return (f"(CASE WHEN regexp_matches({url}, '^https?://') THEN "
            f"regexp_extract({url}, '^(https?)://', 1) || '://' || {host} || "
            f"CASE WHEN {path} = '' THEN '/' ELSE {path} END || "
            f"CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END END)")


def sql_match_url(url: str, drop=fixed.MATCH_DROP_KEYS) -> str:
    query = (f"array_to_string(list_filter(string_split(regexp_extract({url}, "
             r"'^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT "
             f"regexp_matches(lower(x), '^({'|'.join(drop)})=')), '&')")
    path = f"rtrim(regexp_extract({url}, '^https?://[^/?#]*([^?#]*)', 1), '/')"
    host = f"lower(regexp_extract({url}, '^https?://([^/?#]*)', 1))"
    return (f"('https://' || {host} || CASE WHEN {path} = '' THEN '/' ELSE {path} END || "
            f"CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END)")


def sql_classified(rules: Rules = RULES, first_url_wins: bool = True, source: str = "obs",
                   prefix: str = "") -> str:
    """CTEs ending in ``<prefix>classified``."""
    x = prefix
    hits = ", ".join(f"{sql_hits('match_text', t.keywords)} AS t{i}"
                     for i, t in enumerate(rules.topics))
    total = " + ".join(f"len(t{i})" for i in range(len(rules.topics)))
    best = "greatest(" + ", ".join(f"len(t{i})" for i in range(len(rules.topics))) + ")"
    chosen = "CASE " + " ".join(f"WHEN len(t{i}) = {best} THEN {quote(t.section)}"
                                for i, t in enumerate(rules.topics)) + " END"
    both = " || ".join(f"t{i}" for i in range(len(rules.topics)))
    sections = "[" + ", ".join(quote(s) for s in fixed.SECTIONS) + "]"
    first = ("WHERE rn = 1" if first_url_wins else "")
    labels = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in fixed.TIER_LABELS.items())
    return f"""
{x}eligible AS (
  SELECT *, title || ' ' || summary AS match_text FROM {source}
  WHERE url <> '' AND coalesce(changed, TRUE)
    AND (published_at IS NULL
         OR published_at >= CAST(day AS TIMESTAMP) - to_days({WINDOW_DAYS}))),
{x}hits AS (SELECT *, {sql_hits('match_text', rules.model_keywords)} AS model_hits, {hits}
  FROM {x}eligible),
{x}sectioned AS (
  SELECT *, list_sort(list_distinct({both})) AS topic_hits,
    CASE WHEN {total} > 0 THEN {chosen} WHEN tier = 'official' THEN {quote(fixed.SECTION_RELEASE)}
         ELSE {quote(fixed.SECTION_FIELD_TEST)} END AS raw_section,
    row_number() OVER (PARTITION BY day, url ORDER BY source_id, item_ord) AS rn
  FROM {x}hits WHERE len(model_hits) > 0 OR {total} > 0),
{x}classified AS (
  SELECT * EXCLUDE (title, summary, rn),
    CASE WHEN trim(title) = '' THEN url ELSE trim(title) END AS title,
    left(summary, 300) AS summary, {sql_canonical('url')} AS canonical_url,
    source_id || ':' || left(sha256(source_id || chr(0) || {sql_canonical('url')}), 20)
      AS source_item_id,
    sha256(CAST(to_json(struct_pack(content_sha256 := content_sha256, published := published,
      summary := summary, title := title, url := {sql_canonical('url')})) AS VARCHAR))
      AS snapshot_hash,
    CASE tier {labels} END AS tier_label,
    CASE WHEN raw_section = {quote(fixed.SECTION_FIELD_TEST)} AND tier IN ('official', 'index')
         THEN {quote(fixed.SECTION_RELEASE)} ELSE raw_section END AS section,
    CAST(list_position({sections}, section) AS INTEGER) AS section_ord
  FROM {x}sectioned {first})"""


CLASSIFIED = "WITH " + OBSERVATIONS + "," + sql_classified()
STORY_INPUT = "WITH " + OBSERVATIONS + "," + sql_classified(first_url_wins=False)
