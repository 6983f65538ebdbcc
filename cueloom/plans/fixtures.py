"""The conversations table as transcripts with synthetic, exactly representable timings."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Rule
from ..functions.text import text_to_words

RULES = (
    Rule("literal", "the ", "THE "),
    Rule("regex", r"\b([a-z]+)tion\b", "$1tion/$1"),
    Rule("literal", "and", "and so"),
    Rule("literal", "never-found", "x"),
    Rule("regex", r"(\w)\. ", "$1! "),
    Rule("literal", "the ", "THE "),
)
NAMES = (("SPEAKER_00", "Alice"), ("SPEAKER_01", "Bob"), ("SPEAKER_02", ""))

#: The same rows in DuckDB: seg (t, s, speaker, text, toks, n, off, start, end) and w (t, s, pos, word, start, end, speaker).
BASE_SQL = r"""
WITH tok AS (
  SELECT conv_id AS t, turn AS s, role, CASE WHEN turn % 5 = 4 THEN text || ' <&>' ELSE text END AS text FROM conversations
), o AS (
  SELECT *, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS toks FROM tok
), p AS (
  SELECT *, len(toks) AS n, COALESCE(SUM(len(toks)) OVER (PARTITION BY t ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM o
), seg AS (
  SELECT t, s, role, text, toks, n, off,
    CASE WHEN role = 'system' THEN 'SPEAKER_02' WHEN (s // 2) % 2 = 0 THEN 'SPEAKER_00' ELSE 'SPEAKER_01' END AS base,
    CASE WHEN s % 6 = 5 THEN NULL WHEN role = 'system' THEN 'SPEAKER_02' WHEN (s // 2) % 2 = 0 THEN 'SPEAKER_00' ELSE 'SPEAKER_01' END AS speaker,
    off * 0.5::DOUBLE AS "start", CASE WHEN s % 7 = 6 THEN 0::DOUBLE ELSE (off + n - 1) * 0.5::DOUBLE + 0.375::DOUBLE END AS "end"
  FROM p
), w AS (
  SELECT t, s, i - 1 AS pos, toks[i] AS word, n, seg."start" AS seg_start, seg."end" AS seg_end, seg.speaker AS seg_speaker,
    CASE WHEN (i - 1) % 13 = 5 THEN NULL ELSE (off + i - 1) * 0.5::DOUBLE END AS "start",
    CASE WHEN (i - 1) % 13 = 5 THEN NULL WHEN (i - 1) % 17 = 11 THEN (off + i - 1) * 0.5::DOUBLE ELSE (off + i - 1) * 0.5::DOUBLE + 0.375::DOUBLE END AS "end",
    CASE WHEN (i - 1) % 31 = 7 THEN NULL WHEN (i - 1) % 29 = 23 THEN 'SPEAKER_09' ELSE base END AS speaker
  FROM seg, UNNEST(range(1, n + 1)) AS r(i)
)"""


def aligned_sql(given: str, name: str) -> str:
    """CTEs that align word lists in SQL: <name>_kept (t, s, p, q), places counted from 0, of rows given as (t, s, a, b).

    The table of a longest common subsequence a row at a time, then the way back through it; on a tie b's word is left out first.
    """
    return f"""
, {name}_pair AS MATERIALIZED (SELECT t, s, a, b, len(a) AS n, len(b) AS m FROM ({given}))
, {name}_a AS MATERIALIZED (SELECT t, s, UNNEST(a) AS x, UNNEST(range(1, n + 1)) AS i FROM {name}_pair)
, {name}_b AS MATERIALIZED (SELECT t, s, UNNEST(b) AS y, UNNEST(range(1, m + 1)) AS j FROM {name}_pair)
, {name}_cell AS (
  SELECT t, s, 0::BIGINT AS i, j, 0 AS best, false AS hit FROM {name}_pair, UNNEST(range(0, m + 1)) AS r(j)
  UNION ALL
  SELECT t, s, i, j, max(v) OVER (PARTITION BY t, s ORDER BY j), hit FROM (
    SELECT t, s, c.i + 1 AS i, j, COALESCE(x = y, false) AS hit, CASE WHEN x = y THEN lag(best) OVER (PARTITION BY t, s ORDER BY j) + 1 ELSE best END AS v
    FROM {name}_cell c JOIN {name}_a a USING (t, s) LEFT JOIN {name}_b USING (t, s, j) WHERE a.i = c.i + 1))
, {name}_move AS MATERIALIZED (
  SELECT t, s, i, list(CASE WHEN hit THEN 2 WHEN best > before THEN 1 ELSE 0 END ORDER BY j) AS moves FROM (SELECT *, lag(best) OVER (PARTITION BY t, s, i ORDER BY j) AS before FROM {name}_cell WHERE i > 0) WHERE j > 0 GROUP BY t, s, i)
, {name}_way AS (
  SELECT t, s, n AS i, m AS j, 0 AS move FROM {name}_pair
  UNION ALL
  SELECT t, s, i - (moves[j] > 0)::INT, j - (moves[j] <> 1)::INT, moves[j] FROM {name}_way JOIN {name}_move USING (t, s, i) WHERE j > 0)
, {name}_kept AS MATERIALIZED (SELECT t, s, i AS p, j AS q FROM {name}_way WHERE move = 2)
, {name}_gap AS MATERIALIZED (
  SELECT t, s, lag(p, 1, -1) OVER w AS p, lag(q, 1, -1) OVER w AS q, p AS until_p, q AS until_q, row_number() OVER w - 1 AS g
  FROM (SELECT t, s, p, q FROM {name}_kept UNION ALL SELECT t, s, n, m FROM {name}_pair) WINDOW w AS (PARTITION BY t, s ORDER BY p, q))"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as segments: a turn is a segment, a token a word of half a second."""
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    text = F.when(F.col("turn") % 5 == 4, F.concat("text", F.lit(" <&>"))).otherwise(F.col("text"))
    made = c.select(F.col("conv_id").alias("transcript_id"), F.col("turn").alias("seg_idx"), "role", text.alias("text")).withColumn("toks", text_to_words("text"))
    before = Window.partitionBy("transcript_id").orderBy("seg_idx").rowsBetween(Window.unboundedPreceding, -1)
    made = made.withColumns({"n": F.size("toks"), "off": F.coalesce(F.sum(F.size("toks")).over(before), F.lit(0))})
    base = F.when(F.col("role") == "system", "SPEAKER_02").when(F.floor(F.col("seg_idx") / 2) % 2 == 0, "SPEAKER_00").otherwise("SPEAKER_01")
    made = made.withColumn("base", base)
    none, at = F.lit(None), lambda i: (F.col("off") + i) * F.lit(0.5)
    words = F.transform(
        "toks",
        lambda w, i: F.struct(
            w.alias("word"),
            F.when(i % 13 == 5, none).otherwise(at(i)).cast("double").alias("start"),
            F.when(i % 13 == 5, none).when(i % 17 == 11, at(i)).otherwise(at(i) + 0.375).cast("double").alias("end"),
            F.when(i % 31 == 7, none).when(i % 29 == 23, F.lit("SPEAKER_09")).otherwise(F.col("base")).alias("speaker"),
            F.lit(0.9).alias("score"),
        ),
    )
    return made.select(
        "transcript_id", "seg_idx",
        (F.col("off") * F.lit(0.5)).cast("double").alias("start"),
        F.when(F.col("seg_idx") % 7 == 6, F.lit(0.0)).otherwise((F.col("off") + F.col("n") - 1) * F.lit(0.5) + 0.375).cast("double").alias("end"),
        "text", F.when(F.col("seg_idx") % 6 == 5, none).otherwise(F.col("base")).alias("speaker"), words.alias("words"),
    )


def updates(made: DataFrame) -> DataFrame:
    """One suggested edit a segment, by turn: the same text, some words dropped, the first word doubled, all reversed; and one out of range."""
    toks = F.transform("words", lambda w: w["word"])
    dropped = F.filter(toks, lambda w, i: i % 7 != 3)
    first = F.get(toks, F.lit(0))
    doubled = F.concat(F.array(first, F.concat(first, F.lit("x"))), F.slice(toks, 2, F.greatest(F.size(toks) - 1, F.lit(0))))
    kind = F.col("seg_idx") % 4
    new = F.when(kind == 0, toks).when(kind == 1, dropped).when(kind == 2, doubled).otherwise(F.reverse(toks))
    rows = made.select("transcript_id", F.col("seg_idx").alias("ord"), F.col("seg_idx").alias("idx"), F.array_join(new, " ").alias("text"))
    beyond = made.where("seg_idx = 0").select("transcript_id", F.lit(10**6).cast("long").alias("ord"), F.lit(10**6).cast("long").alias("idx"), "text")
    return rows.union(beyond)


def names(made: DataFrame) -> DataFrame:
    entries = F.array(*(F.struct(F.lit(a).alias("speaker"), F.lit(b).alias("name")) for a, b in NAMES))
    return made.select("transcript_id").distinct().select("transcript_id", F.explode(entries).alias("x")).select("transcript_id", "x.*")


def deterministic_client():
    """A client that answers by rule: every third line, of those with five words or more, gets an x at its end; SPEAKER_00 is Alice."""

    def answer(prompt: str) -> str:
        lines = re.findall(r"^\[(\d+)\] \[(\w+)\] (.*)$", prompt, re.M)
        updates = [{"idx": int(i), "text": f"{text}x"} for i, _, text in lines if int(i) % 3 == 1 and len(text.split()) >= 5]
        return "Here it is: " + json.dumps({"identifiedSpeakers": {"SPEAKER_00": "Alice"}, "updates": updates}) + " That is all."

    return answer
