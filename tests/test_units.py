"""Lengths and distances in UTF-16 units, long segments, and functions without a query of their own."""

import random
import time

import pytest
from pyspark.sql import functions as F

from cueloom.config import Normalization
from cueloom.functions import distance as ds
from cueloom.functions.text import fill_template
from cueloom.functions.timing import iso_of
from cueloom.operators.jobs import is_warm
from cueloom.operators.normalization import _ranges, normalize_segments, segment_chars
from cueloom.schema import SEGMENTS


def by_table(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_distance_equals_the_table():
    rng = random.Random(4)
    for _ in range(4000):
        few = range(rng.randint(1, 5))
        a, b = ([rng.choice(few) for _ in range(rng.randint(0, 14))] for _ in "ab")
        d, most = by_table(a, b), rng.randint(0, 14)
        assert ds.distance(a, b) == d and ds.distance(a, b, most) == min(d, most + 1)


def test_distance_columns(spark):
    rows = [("", ""), ("", "ab"), ("a😀", "ab"), ("same", "same"), (None, "x"), ("lantern", "pattern")]
    made = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    got = made.select(ds.edit_distance("a", "b"), ds.norm_edit_distance("a", "b"), ds.distance_beyond("a", "b", 0.5)).collect()
    # the smile is two units, one of which becomes a letter
    assert [tuple(r) for r in got] == [(0, 0.0, False), (2, 1.0, True), (2, pytest.approx(2 / 3), True), (0, 0.0, False), (None, None, None), (2, pytest.approx(2 / 7), False)]


def test_time_of_a_split_grows_with_the_words():
    words = ["word," if i % 9 == 8 else "word" for i in range(100_000)]
    out, started = ([], [], []), time.process_time()
    n = _ranges(words, ["A"] * len(words), None, Normalization(), out)
    assert time.process_time() - started < 5
    assert n == len(out[0]) and out[0][1:] == out[1][:-1] and out[1][-1] == len(words) and max(b - a for a, b in zip(*out[:2], strict=True)) <= 10


def test_characters_are_units(spark):
    word = {"word": "😀" * 12, "start": 0.0, "end": 1.0, "speaker": None, "score": None}
    made = spark.createDataFrame([(1, 0, 0.0, 2.0, "x", "A", [word, word, word])], SEGMENTS)
    parts, stats = normalize_segments(made)
    assert parts.count() == 3  # two words of 24 units and a space are over 48
    row = stats.first()
    assert (row.chars_min, row.chars_max, row.splits) == (24, 24, 2) and segment_chars(made).first().n_chars == 74


def test_functions_without_a_query(spark):
    at = F.to_timestamp(F.lit("2024-05-06T07:08:09Z"))
    row = spark.range(1).select(
        iso_of(F.lit(1714979289.5)), fill_template("a {{transcript}} b {{additionalContext}}", F.lit("$& {{x}}"), "C"),
        is_warm(at, F.to_timestamp(F.lit("2024-05-06T07:08:08Z"))), is_warm(at, at), is_warm(F.lit(None).cast("timestamp"), at),
    ).first()
    assert row[0].startswith("2024-05-06T07:08:09.5") and row[1] == "a $& {{x}} b C" and tuple(row)[2:] == (True, False, False)
