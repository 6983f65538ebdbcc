"""Caption-friendly re-segmentation in one walk over each segment's words, and its statistics."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Normalization
from ..functions.alignment import flat_lists, listed
from ..functions.text import join_words, utf16_length, words_text
from ..functions.timing import round_half_up


RANGES = "array<struct<first:int,to:int,who:string>>"


def _ranges(words: list[str], speakers: list[str | None], who: str | None, config: Normalization, out: tuple[list, list, list]) -> int:
    """Add the parts of one segment's words to out: first word, end (exclusive) and speaker. Returns how many they are."""
    most_words, most_chars, enough = config.max_words_per_segment, config.max_chars_per_segment, config.punctuation_split_threshold
    firsts, ends, names = out
    by_speaker, marks, last = config.split_segment_at_speaker_change, tuple(config.punctuation_chars), len(words) - 1
    before, first, n, chars = len(firsts), 0, 0, 0

    def close(to: int) -> None:
        nonlocal first, n, chars
        firsts.append(first)
        ends.append(to)
        names.append(who)
        first, n, chars = to, 0, 0

    for i, word in enumerate(words):
        speaker = speakers[i]
        if by_speaker and n and speaker and who and speaker != who:
            close(i)
            who = speaker
        size = len(word) if word.isascii() else len(word.encode("utf-16-le", "surrogatepass")) // 2
        if n and (n + 1 > most_words or chars + 1 + size > most_chars):
            close(i)
        chars += size + (n > 0)
        n += 1
        if speaker is not None:
            who = speaker
        if i < last and max(chars / most_chars, n / most_words) >= enough and word.endswith(marks):
            close(i + 1)
    if n:
        close(len(words))
    return len(firsts) - before


def _splitter(config: Normalization):
    def split(words: pa.Array, speakers: pa.Array, whos: pa.Array) -> pa.Array:
        at, flat, there = flat_lists(words)
        flat, own, counts, out = flat.to_pylist(), flat_lists(speakers)[1].to_pylist(), [], ([], [], [])
        for i, who in enumerate(whos.to_pylist()):
            a, b = at[i], at[i + 1]
            counts.append(_ranges(flat[a:b], own[a:b], who, config, out) if there[i] else None)
        kinds = {"first": pa.int32(), "to": pa.int32(), "who": pa.string()}
        return listed(counts, pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(out, kinds.values(), strict=True)], list(kinds)))

    return split


def split_ranges(words: Column, speaker: Column, config: Normalization) -> Column:
    """array of struct(first, to, who): the words of each part (to is exclusive) and its speaker, by the greedy rule.

    Before a word a part is closed at a change of speaker, or where the word would go
    over a limit; after it, where the part is full enough and the word ends with
    punctuation. Lengths are UTF-16 units. What a part holds depends on where the last one ended, so
    each segment's words are walked over once, in an Arrow function that gets words and speakers only; its time grows with the words, whatever their number.
    """
    timed = F.when(F.size(words) > 0, words)
    return F.arrow_udf(_splitter(config), RANGES)(F.transform(timed, lambda w: F.coalesce(w["word"], F.lit(""))), F.transform(timed, lambda w: w["speaker"]), speaker)


def split_parts(segments: DataFrame, config: Normalization) -> DataFrame:
    """segments with parts: the segments each is split into. Segments without words are their own only part."""

    def part(r: Column) -> Column:
        own = F.slice("words", r["first"] + 1, r["to"] - r["first"])
        return F.struct(
            F.coalesce(F.get("words", r["first"])["start"], F.lit(0.0)).alias("start"), F.coalesce(F.get("words", r["to"] - 1)["end"], F.lit(0.0)).alias("end"),
            join_words(F.transform(own, lambda x: x["word"])).alias("text"), r["who"].alias("speaker"), own.alias("words"),
        )

    itself = F.array(F.struct("start", "end", "text", "speaker", "words"))
    split = F.transform(split_ranges(F.col("words"), F.col("speaker"), config), part)
    return segments.withColumn("parts", F.when(F.size("words") > 0, split).otherwise(itself))


def normalize_segments(segments: DataFrame, config: Normalization = Normalization()) -> tuple[DataFrame, DataFrame]:
    """(segments, stats). Parts are numbered anew in each transcript; other columns of a segment are dropped."""
    if not config.normalize:
        return segments, normalization_stats(segments.withColumn("parts", F.array(F.struct("start", "end", "text", "speaker", "words"))))
    made = split_parts(segments, config)
    parts = made.select("transcript_id", "seg_idx", F.posexplode_outer("parts").alias("part_idx", "part"))  # parts are never empty; outer spares a second fold
    order = Window.partitionBy("transcript_id").orderBy("seg_idx", "part_idx")
    out = parts.select("transcript_id", (F.row_number().over(order) - 1).cast("long").alias("seg_idx"), "part.*")
    return out, normalization_stats(made)


def distribution(value: Column, name: str) -> list[Column]:
    """min, max, mean (two decimals) and 95th percentile (nearest rank); 0 for no rows."""
    return [
        F.coalesce(F.min(value), F.lit(0)).alias(f"{name}_min"),
        F.coalesce(F.max(value), F.lit(0)).alias(f"{name}_max"),
        F.coalesce(round_half_up(F.avg(value)), F.lit(0.0)).alias(f"{name}_avg"),
        F.coalesce(_nearest(value), F.lit(0)).alias(f"{name}_p95"),
    ]


def _nearest(value: Column) -> Column:
    """Nearest-rank 95th percentile from a sorted list of one transcript's values."""
    values = F.array_sort(F.collect_list(value))
    return F.get(values, F.ceil(F.size(values) * 0.95).cast("int") - 1)


def normalization_stats(made: DataFrame) -> DataFrame:
    """A row per transcript: segments before and after, splits, and distributions of words and characters."""
    timed = F.size("words") > 0
    before = made.groupBy("transcript_id").agg(
        F.count("*").alias("original_segments"), F.sum(F.size("parts")).alias("normalized_segments"), F.sum(F.when(timed, F.greatest(F.size("parts"), F.lit(1)) - 1).otherwise(0)).alias("splits")
    )
    part = made.select("transcript_id", F.explode_outer("parts").alias("part"))
    words, chars = F.greatest(F.coalesce(F.size("part.words"), F.lit(0)), F.lit(0)), F.coalesce(utf16_length("part.text"), F.lit(0))
    return before.join(part.groupBy("transcript_id").agg(*distribution(words, "words"), *distribution(chars, "chars")), "transcript_id")


def segment_chars(segments: DataFrame) -> DataFrame:
    return segments.select("transcript_id", "seg_idx", F.greatest(F.size("words"), F.lit(0)).alias("n_words"), utf16_length(words_text()).alias("n_chars"))
