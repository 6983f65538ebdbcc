"""Caption cues and documents: WebVTT, SubRip and simplified JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Captions
from ..functions.text import effective_speaker, escape_html, highlight, json_number, json_string, speaker_prefix, trim
from ..functions.timing import even_end, even_start, segment_valid, srt_timestamp, vtt_timestamp, word_valid
from .speakers import speaker_labels

def with_prefix(segments: DataFrame, mode: str = "when-changes") -> DataFrame:
    """segments with who, previous and prefix; the previous speaker is taken over all segments, with or without cues."""
    made = segments.withColumn("who", effective_speaker())
    made = made.withColumn("previous", F.lag("who").over(Window.partitionBy("transcript_id").orderBy("seg_idx")))
    return made.withColumn("prefix", speaker_prefix("who", "previous", mode))


def evenly_timed(words: Column | str, start: Column | str, end: Column | str) -> Column:
    """words with missing starts and ends filled evenly, if the segment's own times are valid."""
    n = F.size(words)
    filled = F.transform(
        words, lambda w, i: w.withField("start", even_start(w["start"], i, n, start, end)).withField("end", even_end(w["end"], i, n, start, end))
    )
    return F.when(segment_valid(start, end), filled).otherwise(F.col(words) if isinstance(words, str) else words)


def _highlighted(how: str) -> tuple[Column, Column]:
    """Words with valid times, and a segment's cues: fillers before late words, a cue a valid word, a filler up to the segment's end.

    The clock is the end of the valid word before, wherever it is. Words are escaped
    once a segment; a cue's text is put together from slices of them.
    """
    n = F.size("_escaped")
    plain = F.array_join("_escaped", " ")
    cue = "array<struct<start:double,end:double,text:string>>"

    def lit_text(pos: Column) -> Column:
        marked = F.array(highlight(F.get("_escaped", pos), how))
        return F.concat(F.col("prefix"), F.concat_ws(" ", F.slice("_escaped", 1, pos), marked, F.slice("_escaped", pos + 2, n)))

    filler_text = F.concat(F.col("prefix"), plain)

    def one(start: Column, end: Column, text: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), text.alias("text"))

    valid = F.filter(
        F.transform("_words", lambda w, i: F.struct(w["start"].alias("start"), w["end"].alias("end"), i.alias("pos"))), lambda w: word_valid(w["start"], w["end"])
    )

    def around(w: Column, k: Column) -> Column:
        before = F.get("_valid", k - 1)["end"]
        gap = F.when(before.isNotNull() & (w["start"] > before), F.array(one(before, w["start"], filler_text)))
        return F.concat(F.coalesce(gap, F.array().cast(cue)), F.array(one(w["start"], w["end"], lit_text(w["pos"]))))

    last = F.get("_valid", F.size("_valid") - 1)["end"]
    tail = F.when(segment_valid("start", "end") & (F.size("_valid") > 0) & (F.col("end") > last), F.array(one(last, F.col("end"), filler_text)))
    return valid, F.concat(F.flatten(F.transform("_valid", around)), F.coalesce(tail, F.array().cast(cue)))


def cues(segments: DataFrame, config: Captions = Captions()) -> DataFrame:
    """(transcript_id, seg_idx, cue_idx, start, end, text). Only the previous speaker needs other rows: one window a transcript."""
    made = with_prefix(segments, config.include_speaker_names)
    basic = F.array(F.struct("start", "end", F.concat("prefix", escape_html(trim(F.coalesce("text", F.lit(""))))).alias("text")))
    if config.highlight_words:
        valid, lit = _highlighted(config.highlight_with)
        made = made.withColumn("_words", evenly_timed("words", "start", "end"))
        made = made.withColumns({"_valid": valid, "_escaped": F.transform("_words", lambda w: escape_html(w["word"]))})
        basic = F.when(F.size("words") > 0, lit).otherwise(basic)
    made = made.withColumn("_cues", basic)
    # outer, as the optimizer would else build the cues a second time to see that there are any
    rows = made.select("transcript_id", "seg_idx", F.posexplode_outer("_cues").alias("cue_idx", "cue")).where("cue_idx IS NOT NULL")
    return rows.select("transcript_id", "seg_idx", "cue_idx", "cue.*")


def numbered(cue_rows: DataFrame) -> DataFrame:
    """Cues with n, counted from 1 through each transcript."""
    return cue_rows.withColumn("n", F.row_number().over(Window.partitionBy("transcript_id").orderBy("seg_idx", "cue_idx")))


def _documents(segments: DataFrame, blocks: DataFrame, head: str, join: str) -> DataFrame:
    """One text per transcript, also for those without cues, from blocks (transcript_id, seg_idx, cue_idx, block)."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("seg_idx", "cue_idx", "block"))), lambda x: x["block"])
    made = blocks.groupBy("transcript_id").agg(F.array_join(ordered, join).alias("_body"))
    ids = segments.select("transcript_id").distinct()
    return ids.join(made, "transcript_id", "left").select("transcript_id", F.concat(F.lit(head), F.coalesce("_body", F.lit(""))).alias("document"))


def render_vtt(segments: DataFrame, config: Captions = Captions()) -> DataFrame:
    line = F.concat(F.lit("\n"), vtt_timestamp("start"), F.lit(" --> "), vtt_timestamp("end"), F.lit("\n"), F.col("text"), F.lit("\n"))
    return _documents(segments, cues(segments, config).withColumn("block", line), "WEBVTT\n", "")


def render_srt(segments: DataFrame, config: Captions = Captions()) -> DataFrame:
    line = F.concat(F.col("n").cast("string"), F.lit("\n"), srt_timestamp("start"), F.lit(" --> "), srt_timestamp("end"), F.lit("\n"), F.col("text"), F.lit("\n"))
    return _documents(segments, numbered(cues(segments, config)).withColumn("block", line), "", "\n")


def json_segments(segments: DataFrame) -> DataFrame:
    """(transcript_id, seg_idx, speaker_label, start, end, text); a speaker without a label is spk_0."""
    labels = speaker_labels(segments).withColumnRenamed("speaker", "who")
    made = segments.withColumn("who", effective_speaker()).join(labels, ["transcript_id", "who"], "left")
    return made.select("transcript_id", "seg_idx", F.coalesce("label", F.lit("spk_0")).alias("speaker_label"), "start", "end", trim(F.coalesce("text", F.lit(""))).alias("text"))


def render_json(segments: DataFrame) -> DataFrame:
    """The simplified JSON document, two spaces deep, numbers without needless fractions."""
    labels = speaker_labels(segments)
    rank = F.substring("label", 5, 12).cast("int")
    entry = F.concat(F.lit("    "), json_string("label"), F.lit(": "), json_string("speaker"))
    names = labels.groupBy("transcript_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(rank.alias("r"), entry.alias("e")))), lambda x: x["e"]), ",\n").alias("_speakers"))
    fields = (("speakerLabel", json_string("speaker_label")), ("start", json_number("start")), ("end", json_number("end")), ("text", json_string("text")))
    body = F.concat_ws(",\n", *(F.concat(F.lit(f'      "{k}": '), v) for k, v in fields))
    block = F.concat(F.lit("    {\n"), body, F.lit("\n    }"))
    made = json_segments(segments).groupBy("transcript_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_idx", block.alias("b")))), lambda x: x["b"]), ",\n").alias("_segments"))
    document = F.concat(F.lit('{\n  "speakers": {\n'), "_speakers", F.lit('\n  },\n  "segments": [\n'), "_segments", F.lit("\n  ]\n}"))
    return names.join(made, "transcript_id").select("transcript_id", document.alias("document"))
