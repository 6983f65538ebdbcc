"""Suggested edits: lookup, validation, application, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Validation
from ..functions.alignment import reconcile_words, word_change_ratio, word_changes
from ..functions.distance import distance_beyond, norm_edit_distance
from ..functions.text import bracketed_json, join_words, labelled_line, text_to_words, words_text
from .speakers import apply_speaker_names

RESPONSE = "identifiedSpeakers map<string,string>, updates array<struct<idx:double,text:string>>"


def prompt_lines(segments: DataFrame) -> DataFrame:
    """One text per transcript: a labelled line a segment."""
    line = labelled_line("seg_idx", "speaker", words_text())
    rows = segments.groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct("seg_idx", line.alias("line")))).alias("x"))
    return rows.select("transcript_id", F.array_join(F.transform("x", lambda r: r["line"]), "\n").alias("transcript"))


def parse_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(updates, names) of responses (transcript_id, response); one that can't be parsed gives none. An index must be whole."""
    got = responses.select("transcript_id", F.from_json(bracketed_json("response"), RESPONSE).alias("r"))
    each = got.select("transcript_id", F.posexplode("r.updates").alias("ord", "u")).where("u.idx = floor(u.idx)")
    updates = each.select("transcript_id", F.col("ord").cast("long").alias("ord"), F.col("u.idx").cast("long").alias("idx"), F.col("u.text").alias("text"))
    names = got.select("transcript_id", F.explode("r.identifiedSpeakers").alias("speaker", "name"))
    return updates, names


def validated(pairs: DataFrame, config: Validation = Validation(), distances: bool = True) -> DataFrame:
    """pairs (original, corrected) with ratio, distance, run and ignore_reason (null: the edit is good).

    Equal texts never reach the alignment. Without validation every pair is good, equal texts too. Where
    distances are not asked for, only texts that pass the ratio are measured, and only as far as the limit.
    """
    a, b = text_to_words(F.lower("original")), text_to_words(F.lower("corrected"))
    made = pairs.withColumns({"_a": a, "_b": b})
    differ = F.col("original") != F.col("corrected")
    made = made.withColumn("_d", word_changes(F.when(differ, F.col("_a")), F.when(differ, F.col("_b"))))
    n, m = F.size("_a"), F.size("_b")
    run = F.when(~differ, 0).when((n == 0) | (m == 0), F.greatest(n, m)).otherwise(F.col("_d.max_run"))
    made = made.withColumns({"ratio": F.when(differ, word_change_ratio("_d.lcs", n, m)).otherwise(F.lit(0.0)), "run": run})
    limit = config.max_normalized_edit_distance
    if distances:
        made = made.withColumn("distance", norm_edit_distance("original", "corrected"))
        far = F.col("distance") > limit
    else:
        open_still = differ & (n >= config.min_words_for_ratio_check) & (F.col("ratio") <= config.max_word_change_ratio)
        made = made.withColumn("_far", distance_beyond(F.when(open_still, F.col("original")), F.when(open_still, F.col("corrected")), limit))
        far = F.coalesce("_far", F.lit(False))
    long_run = F.when(F.col("run") > config.max_consecutive_changes, F.lit("consecutive-changes"))
    ladder = (
        F.when(F.lit(not config.enabled), F.lit(None))
        .when(~differ, F.lit("no-change"))
        .when(n < config.min_words_for_ratio_check, long_run)
        .when(F.col("ratio") > config.max_word_change_ratio, F.lit("word-change-ratio"))
        .when(far, F.lit("edit-distance"))
        .otherwise(long_run)
    )
    return made.withColumn("ignore_reason", ladder).drop("_a", "_b", "_d", "_far")


def apply_suggestions(
    segments: DataFrame, updates: DataFrame, names: DataFrame, config: Validation = Validation(), most_rounds: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(segments, applied, ignored, stats). Names first, then the updates in order.

    Updates of one segment see each other's results, so they are applied in rounds by
    rank; there are as many rounds as updates to the most updated segment (nearly
    always one), found by one aggregate unless most_rounds says it.
    """
    current = apply_speaker_names(segments, names)
    rank = F.row_number().over(Window.partitionBy("transcript_id", "idx").orderBy("ord"))
    ranked = updates.withColumn("_rank", rank)
    rounds = most_rounds if most_rounds is not None else (ranked.agg(F.max("_rank")).first()[0] or 0)
    logs = None
    for k in range(1, rounds + 1):
        own = ranked.where(F.col("_rank") == k).select("transcript_id", F.col("idx").alias("seg_idx"), "ord", F.col("text").alias("corrected"))
        met = current.join(own, ["transcript_id", "seg_idx"], "left").withColumn("original", words_text())
        judged = validated(met, config, distances=False)
        same = F.col("original") == F.col("corrected")  # nothing to apply, validation or not
        judged = judged.withColumn("ignore_reason", F.when(same, F.lit("no-change")).otherwise(F.col("ignore_reason")))
        use = F.col("ord").isNotNull() & F.col("ignore_reason").isNull()
        judged = judged.withColumn("_new", F.when(use, text_to_words("corrected")))
        words = F.when(use & (F.size("words") > 0), reconcile_words("words", "_new", "start")).otherwise(F.col("words"))
        text = F.when(use, join_words("_new")).otherwise(F.col("text"))
        judged = judged.withColumns({"_words": words, "_text": text})
        log = judged.where("ord IS NOT NULL").select("transcript_id", "ord", F.col("seg_idx").alias("idx"), "original", "corrected", "ratio", "run", "ignore_reason")
        logs = log if logs is None else logs.union(log)
        current = judged.select(*[{"words": F.col("_words"), "text": F.col("_text")}.get(c, F.col(c)).alias(c) for c in segments.columns])
    if logs is None:
        logs = updates.limit(0).selectExpr("transcript_id", "ord", "idx", "text AS original", "text AS corrected", "0D AS ratio", "0 AS run", "text AS ignore_reason")
    applied, ignored = logs.where("ignore_reason IS NULL"), logs.where("ignore_reason IS NOT NULL")
    stats = segments.groupBy("transcript_id").agg(F.count("*").alias("segments_processed"))
    stats = stats.join(applied.groupBy("transcript_id").agg(F.count("*").alias("segments_updated")), "transcript_id", "left")
    stats = stats.join(names.groupBy("transcript_id").agg(F.count("*").alias("speakers_identified")), "transcript_id", "left")
    return current, applied, ignored, stats.fillna(0, ["segments_updated", "speakers_identified"])
