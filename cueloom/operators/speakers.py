"""Speakers: who there is, labels, names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import DEFAULT_SPEAKER


def distinct_speakers(segments: DataFrame) -> DataFrame:
    """(transcript_id, speaker) of segments and words together; the default where a transcript names nobody."""
    own = segments.select("transcript_id", "speaker")
    words = segments.select("transcript_id", F.explode("words").alias("w")).select("transcript_id", F.col("w.speaker").alias("speaker"))
    named = own.union(words).where("speaker <> ''").distinct()
    silent = segments.select("transcript_id").distinct().join(named, "transcript_id", "left_anti").select("transcript_id", F.lit(DEFAULT_SPEAKER).alias("speaker"))
    return named.union(silent)


def speaker_labels(segments: DataFrame) -> DataFrame:
    """(transcript_id, speaker, label): spk_0, spk_1, ... in order of name."""
    rank = F.dense_rank().over(Window.partitionBy("transcript_id").orderBy("speaker")) - 1
    return distinct_speakers(segments).select("transcript_id", "speaker", F.concat(F.lit("spk_"), rank.cast("string")).alias("label"))


def apply_speaker_names(segments: DataFrame, names: DataFrame) -> DataFrame:
    """segments with speakers renamed by names (transcript_id, speaker, name): one pass, no chains; a missing or empty name changes nothing.

    The names of a transcript travel as one map, joined by transcript.
    """
    entries = names.where("name <> ''").dropDuplicates(["transcript_id", "speaker"])
    maps = entries.groupBy("transcript_id").agg(F.map_from_entries(F.collect_list(F.struct("speaker", "name"))).alias("_names"))
    named = segments.join(maps, "transcript_id", "left")

    def name(speaker):
        return F.coalesce(F.try_element_at("_names", speaker), speaker)

    words = F.transform("words", lambda w: w.withField("speaker", name(w["speaker"])))
    return named.withColumns({"speaker": name(F.col("speaker")), "words": words}).select(*segments.columns)
