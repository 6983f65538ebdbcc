"""Time columns: media timestamps, validity, durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def timestamp(seconds: Column | str, mark: str, carry: bool = False) -> Column:
    """``HH:MM:SS<mark>mmm``; milliseconds are rounded half up and, unless carry is set, may come to 1000."""
    s = col(seconds)
    if carry:
        s = F.floor(s * 1000 + 0.5) / 1000
    whole = F.floor(s)
    ms = F.floor((s - whole) * 1000 + 0.5)
    return F.format_string(f"%02d:%02d:%02d{mark}%03d", F.floor(s / 3600), F.floor((s % 3600) / 60), F.floor(s % 60), ms)


def vtt_timestamp(seconds: Column | str, carry: bool = False) -> Column:
    return timestamp(seconds, ".", carry)


def srt_timestamp(seconds: Column | str, carry: bool = False) -> Column:
    return timestamp(seconds, ",", carry)


def word_valid(start: Column | str, end: Column | str) -> Column:
    return F.coalesce((col(start) >= 0) & (col(end) > col(start)), F.lit(False))


def segment_valid(start: Column | str, end: Column | str) -> Column:
    return F.coalesce((col(end) > 0) & (col(end) > col(start)), F.lit(False))


def even_start(start, pos, n, seg_start, seg_end) -> Column:
    """A word's start, or its even share of the segment where it has none."""
    return F.coalesce(col(start), col(seg_start) + col(pos) * ((col(seg_end) - col(seg_start)) / col(n)))


def even_end(end, pos, n, seg_start, seg_end) -> Column:
    return F.coalesce(col(end), col(seg_start) + (col(pos) + 1) * ((col(seg_end) - col(seg_start)) / col(n)))


def duration_ms(start: Column | str, end: Column | str) -> Column:
    """Whole milliseconds between two times in seconds, cut off."""
    return ((col(end) - col(start)) * 1000).cast("int")


def epoch_of(iso: Column | str) -> Column:
    return F.unix_micros(F.to_timestamp(col(iso))) / 1e6


def iso_of(epoch: Column | str) -> Column:
    """An ISO-8601 UTC string of epoch seconds; the session's zone must be UTC."""
    return F.date_format(F.timestamp_micros((col(epoch) * 1_000_000).cast("long")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def expiry(until: Column | str, now: Column, minutes: int = 30) -> Column:
    """When a warm-up ends: the time it names, or half an hour from now."""
    return F.coalesce(F.to_timestamp(col(until)), now + F.expr(f"INTERVAL {minutes} MINUTES"))


def round_half_up(x: Column, digits: int = 2) -> Column:
    return F.floor(x * 10**digits + 0.5) / 10**digits
