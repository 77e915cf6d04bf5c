"""Chat formatting by perspective rotation. DataFrame functions only.

For every participant of a conversation the whole dialogue is rendered once with that
speaker as the assistant and all others as named users; system turns stay system turns. The
loss spans cover exactly the speaker's own words and their end marks, in code points of the
rendered text, ends exclusive.

A conversation is rendered whole. Only one of more than ``part_chars`` code points is cut, by
the running size of its ordered rows, into parts that are texts of their own with spans of
their own, so no conversation has to fit one task; the earliest system turn is repeated at
the head of each part after its own. A single turn is never cut. Rows of one turn number and
copies of one row are numbered by a distributed sort like all others.

Defined results: rows follow turn, role and text, nulls first. A null or blank role is
``unknown``; null text is empty; a null conv_id is a conversation, a null turn counts as -1.
Repeated rows are rendered one by one. Only ``system`` is no participant: a conversation without
another role has no perspective and no row. Marks of the format inside a text are broken up
by a space, so a text cannot forge a turn. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsledger.operators.ordered import with_ranged_sum
from newsledger.operators.skew import broadcast_if_small
from newsledger.session import materialize

#: Code points from which a conversation is cut into parts.
PART_CHARS = 1 << 18
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"

ORACLE = r"""
WITH cleaned AS (
  SELECT conv_id, coalesce(turn, -1) AS turn,
         CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE trim(role) END AS role,
         replace(coalesce(text, ''), '<|im_', '<| im_') AS text
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM cleaned WHERE role <> 'system'),
pieces AS (
  SELECT c.conv_id, s.speaker, turn, role, text,
         '<|im_start|>' || CASE WHEN role = 'system' THEN 'system'
           WHEN role = s.speaker THEN 'assistant' ELSE 'user name=' || role END
           || chr(10) AS head, role = s.speaker AS own
  FROM cleaned c JOIN speakers s ON c.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, length(head) AS a, length(text) + 10 AS b,
         coalesce(sum(length(head) + length(text) + 11) OVER (
           PARTITION BY conv_id, speaker ORDER BY turn, role, text
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM pieces)
SELECT conv_id, speaker, CAST(0 AS BIGINT) AS part, count(*) AS n_turns,
       string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS text,
       coalesce(string_agg(CASE WHEN own THEN (pos + a)::BIGINT::VARCHAR || ':'
         || (pos + a + b)::BIGINT::VARCHAR END, ',' ORDER BY turn, role, text), '') AS loss_spans,
       CAST(coalesce(sum(CASE WHEN own THEN b END), 0) AS BIGINT) AS loss_chars
FROM placed GROUP BY conv_id, speaker
"""


def _cleaned(turns: DataFrame) -> DataFrame:
    role = F.trim(F.coalesce(turns["role"], F.lit("")))
    return turns.select(
        turns["conv_id"].alias("conv_id"),
        F.coalesce(turns["turn"], F.lit(-1)).cast("long").alias("turn"),
        F.when(role == "", "unknown").otherwise(role).alias("role"),
        F.replace(F.coalesce(turns["text"], F.lit("")), F.lit("<|im_"), F.lit("<| im_"))
        .alias("text"))


def _head(role: Column, speaker: Column) -> Column:
    name = (F.when(role == "system", "system").when(role == speaker, "assistant")
            .otherwise(F.concat(F.lit("user name="), role)))
    return F.concat(F.lit(OPEN), name, F.lit("\n"))


_TURN = ["turn", "role", "text"]


def _ordered(rows: DataFrame, *keys: str) -> DataFrame:
    turns = F.sort_array(F.collect_list(F.struct(*_TURN)))
    return rows.groupBy(*keys).agg(turns.alias("turns"))


def _whole(rows: DataFrame) -> DataFrame:
    """Short conversations; their speakers come from their own rows."""
    said = F.array_distinct(F.transform("turns", lambda t: t["role"]))
    return (_ordered(rows, "conv_id")
            .select("conv_id", F.lit(0).cast("long").alias("part"), "turns",
                    F.size("turns").cast("long").alias("n_turns"),
                    F.explode(F.array_remove(said, "system")).alias("speaker")))


def _cut(rows: DataFrame, part_chars: int) -> DataFrame:
    """Long conversations in parts of about ``part_chars``, each with every speaker."""
    rows = materialize(rows.withColumn("copy", F.monotonically_increasing_id()))
    order = [F.asc(c) for c in ("conv_id", *_TURN, "copy")]
    summed = with_ranged_sum(rows, order, F.col("cost"), "upto").withColumn(
        "before", F.col("upto") - F.col("cost"))
    starts = summed.groupBy(F.col("conv_id").alias("c")).agg(F.min("before").alias("start"))
    placed = summed.join(broadcast_if_small(starts), F.col("conv_id").eqNullSafe(F.col("c")))
    placed = materialize(placed.select("conv_id", *_TURN, F.floor(
        (F.col("before") - F.col("start")) / part_chars).cast("long").alias("part")))
    heads = (placed.where(F.col("role") == "system").groupBy(F.col("conv_id").alias("h"))
             .agg(F.min(F.struct(*_TURN, "part")).alias("head")))
    speakers = (placed.where(F.col("role") != "system")
                .select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct())
    head = F.struct(*[F.col(f"head.{c}") for c in _TURN])
    return (_ordered(placed, "conv_id", "part")
            .withColumn("n_turns", F.size("turns").cast("long"))
            .join(broadcast_if_small(heads), F.col("conv_id").eqNullSafe(F.col("h")), "left")
            .withColumn("turns", F.when(F.col("part") > F.col("head.part"),
                                        F.concat(F.array(head), "turns")).otherwise(F.col("turns")))
            .join(broadcast_if_small(speakers), F.col("conv_id").eqNullSafe(F.col("c")))
            .select("conv_id", "part", "turns", "n_turns", "speaker"))


def dialogues(turns: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, turns, n_turns, speaker): ordered rows of each part, once per speaker.

    ``n_turns`` does not count a repeated system turn.
    """
    marks = len(f"{OPEN}user name=\n{CLOSE}\n")
    rows = _cleaned(turns).withColumn(
        "cost", F.char_length("text") + F.char_length("role") + F.lit(marks))
    long_ = materialize(rows.groupBy("conv_id").agg(F.sum("cost").alias("size"))
                        .where(F.col("size") > part_chars)
                        .select(F.col("conv_id").alias("c"), F.lit(True).alias("long")))
    if long_.isEmpty():
        return _whole(rows)
    rows = rows.join(broadcast_if_small(long_), F.col("conv_id").eqNullSafe(F.col("c")),
                     "left").drop("c")
    return _whole(rows.where(F.col("long").isNull()).drop("long", "cost")).unionByName(
        _cut(rows.where("long").drop("long"), part_chars))


def rotate(turns: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """One row per conversation, speaker and part: n_turns, text, loss_spans, loss_chars."""
    seen = dialogues(turns, part_chars)
    speaker = F.col("speaker")
    text = F.array_join(F.transform("turns", lambda t: F.concat(
        _head(t["role"], speaker), t["text"], F.lit(f"{CLOSE}\n"))), "")

    def walk(held: Column, t: Column) -> Column:
        start = held["at"] + F.char_length(_head(t["role"], speaker))
        end = start + F.char_length(t["text"]) + len(CLOSE)
        own = t["role"] == speaker
        span = F.concat(start.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(
            (end + 1).cast("long").alias("at"),
            F.when(own, F.concat(held["spans"], F.array(span))).otherwise(held["spans"])
            .alias("spans"),
            (held["chars"] + F.when(own, end - start).otherwise(0)).cast("long").alias("chars"))

    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<string>").alias("spans"),
                     F.lit(0).cast("long").alias("chars"))
    walked = F.aggregate("turns", start, walk)
    return (seen.select("conv_id", "speaker", "part", "n_turns", text.alias("text"),
                        walked.alias("walked"))
            .select("conv_id", "speaker", "part", "n_turns", "text",
                    F.array_join("walked.spans", ",").alias("loss_spans"),
                    F.col("walked.chars").alias("loss_chars")))
