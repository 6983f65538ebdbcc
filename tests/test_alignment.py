"""Word alignment against a plain table of all cells; memory of long lists; columns."""

import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from cueloom.functions import alignment as al


def by_table(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif best[i - 1][j] > best[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return pairs[::-1]


@pytest.mark.parametrize("block", [1, 3, 512])
def test_pairs_equal_the_table(block, monkeypatch):
    monkeypatch.setattr(al, "BLOCK", block)
    monkeypatch.setattr(al, "OFTEN", 2)
    rng = random.Random(block)
    for _ in range(1500):
        few = "abcdefgh"[: rng.randint(1, 8)]
        a = [rng.choice(few) for _ in range(rng.randint(0, 18))]
        b = [rng.choice(few) for _ in range(rng.randint(0, 18))] if rng.random() < 0.6 else [x for x in a if rng.random() < 0.7]
        assert al.common(a, b) == by_table(a, b)


def test_long_lists_take_little_memory():
    rng = random.Random(2)
    a = [str(rng.randrange(20000)) for _ in range(30000)]
    b = [w for w in a if rng.random() < 0.7] + ["end"]
    tracemalloc.start()
    kept = al.common(a, b)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(kept) == len(b) - 1 and most < 100e6
    assert all(a[p] == b[q] for p, q in kept)


def test_columns_keep_nulls_apart(spark):
    timed = "array<struct<word:string,start:double,end:double,speaker:string,score:double>>"
    w = [("a", 0.0, 1.0, "X", 0.5), ("b", None, None, None, None), ("c", 2.0, 3.0, None, 0.1)]
    rows = [(1, w, ["a", "c"], 0.0), (2, None, ["a"], 0.0), (3, w, None, 0.0), (4, [], ["n", "o"], 7.0), (5, w, [], 1.0), (6, w, ["z", "b", "y", "c"], None)]
    made = spark.createDataFrame(rows, f"k int, words {timed}, patched array<string>, at double").coalesce(1)
    got = {r.k: r.x for r in made.select("k", al.reconcile_words("words", "patched", "at").alias("x")).collect()}
    assert got[2] is None and got[3] is None and got[5] == []
    assert [tuple(x) for x in got[1]] == [("a", 0.0, 1.0, "X", None), ("c", 2.0, 3.0, None, 0.1)]
    assert [tuple(x) for x in got[4]] == [("n", 7.0, 7.0, None, None), ("o", 7.0, 7.0, None, None)]
    assert [x.word for x in got[6]] == ["z", "b", "y", "c"] and got[6][0].start == 0.0 and got[6][0].end == 1.0
    for k, words, patched, at in rows:
        if words is not None and patched is not None:
            named = [dict(zip(("word", "start", "end", "speaker", "score"), x, strict=True)) for x in words]
            assert [x.asDict() for x in got[k]] == al.reconciled(named, patched, at)
    text = made.select("k", F.transform("words", lambda x: x["word"]).alias("a"), "patched")
    ops = {r.k: r.d for r in text.select("k", al.word_diff("a", "patched").alias("d")).collect()}
    assert ops[2] is None and ops[3] is None and ops[5][0].op == "remove" and [tuple(x) for x in ops[1]] == [("keep", 0, 0, "a"), ("remove", 1, None, "b"), ("keep", 2, 1, "c")]
