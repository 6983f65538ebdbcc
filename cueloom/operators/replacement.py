"""Rule-based replacement over segments, with match counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Rule
from ..functions.alignment import reconcile_words
from ..functions.text import count_matches, join_words, replace_all, rule_key, text_to_words, words_text


def patched_text(segments: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """segments with original_text, patched_text and rule_counts (matches of each rule on the text as the rules before left it)."""
    out = segments.withColumn("original_text", words_text()).withColumn("_t0", F.col("original_text"))
    for i, rule in enumerate(rules):
        out = out.withColumns({f"_n{i}": count_matches(f"_t{i}", rule), f"_t{i + 1}": replace_all(f"_t{i}", rule)})
    counts = F.array(*(F.struct(F.lit(rule_key(r)).alias("rule"), F.col(f"_n{i}").cast("long").alias("n")) for i, r in enumerate(rules)))
    empty = F.array().cast("array<struct<rule:string,n:bigint>>")
    return out.select(*segments.columns, "original_text", F.col(f"_t{len(rules)}").alias("patched_text"), (counts if rules else empty).alias("rule_counts"))


def apply_replacements(segments: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(segments, stats): stats has a row per transcript: segments_modified, word_changes, replacement_counts."""
    made = patched_text(segments, rules)
    changed = F.col("patched_text") != F.col("original_text")
    timed = F.size("words") > 0
    made = made.withColumn("_changed", changed).withColumn("_patched", F.when(changed, text_to_words("patched_text")))
    # only changed rows with another number of words reach Python; the rest are rewritten in place
    words = F.when(changed & timed, reconcile_words("words", "_patched", "start")).otherwise(F.col("words"))
    made = made.withColumn("_words", words).withColumn("_text", F.when(changed, join_words("_patched")).otherwise(F.col("text")))
    before, after = F.greatest(F.size("words"), F.lit(0)), F.greatest(F.size("_words"), F.lit(0))
    moved = F.when(changed, F.greatest(F.abs(after - before), F.lit(1))).otherwise(F.lit(0))
    made = made.withColumn("_moved", moved)
    out = made.select(*[{"words": F.col("_words"), "text": F.col("_text")}.get(c, F.col(c)).alias(c) for c in segments.columns])
    return out, replacement_stats(made)


def replacement_stats(made: DataFrame) -> DataFrame:
    totals = made.groupBy("transcript_id").agg(F.count_if("_changed").alias("segments_modified"), F.coalesce(F.sum("_moved"), F.lit(0)).alias("word_changes"))
    counts = rule_counts(made).groupBy("transcript_id").agg(F.map_from_entries(F.collect_list(F.struct("rule", "n"))).alias("replacement_counts"))
    none = F.create_map().cast("map<string,bigint>")
    return totals.join(counts, "transcript_id", "left").withColumn("replacement_counts", F.coalesce("replacement_counts", none))


def rule_counts(made: DataFrame) -> DataFrame:
    """(transcript_id, rule, n) of rules that matched; equal rules share a key."""
    each = made.select("transcript_id", F.explode(F.filter("rule_counts", lambda x: x["n"] > 0)).alias("x"))
    return each.groupBy("transcript_id", F.col("x.rule").alias("rule")).agg(F.sum("x.n").alias("n"))
