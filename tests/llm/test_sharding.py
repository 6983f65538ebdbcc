import random
import zlib

import pytest

from cueloom.llm.kd_sharding import KdTree, placed, write_shards

KINDS = "doc_id long, text string, lang string, source string, n_chars long, shard string, k0 int, size double"


def rows_of(n, seed=1):
    rng, out = random.Random(seed), []
    for i in range(n):
        text = None if i % 41 == 3 else "é" * rng.choice([0, 1, 5, 20, 60]) + "x" * int(rng.expovariate(1 / 80))
        hot = rng.random() < 0.4
        source = None if i % 53 == 7 else "http://hot" if hot else f"http://s{rng.randrange(30)}"
        out.append((None if i % 97 == 5 else i, text, rng.choice(["de", "en", None]), source, None if i % 19 == 1 else len(text or ""), "own", 3, 1.5))
    return out + [(7, "the same row", "en", "http://hot", 12, "own", 3, 1.5)] * 60


def by_sorting(rows, dims, first, shards):
    """The same tree over collected rows."""
    if shards == 1 or not rows:
        return {r["place"]: first for r in rows}
    widths = [max(r[f"k{i}"] for r in rows) - min(r[f"k{i}"] for r in rows) for i in range(dims)]
    k, less = f"k{widths.index(max(widths))}", shards // 2
    rows = sorted(rows, key=lambda r: (r[k], r["hash"], r["place"]))
    target, before, n = sum(r["size"] for r in rows) * less / shards, 0, 0
    while n < len(rows) and before + rows[n]["size"] < target:
        before, n = before + rows[n]["size"], n + 1
    n += n < len(rows) and target - before >= rows[n]["size"] / 2
    return by_sorting(rows[:n], dims, first, less) | by_sorting(rows[n:], dims, first + less, shards - less)


@pytest.mark.parametrize("shards", [5, 24])
def test_tree_equals_sorting(spark, shards):
    docs = spark.createDataFrame(rows_of(900), KINDS).repartition(4)
    tree = KdTree(docs, ("source", "lang", "n_chars"), shards)
    got = {r["place"]: r["s"] for r in tree.rows.select("place", tree.shard().alias("s")).collect()}
    rows = [r.asDict() for r in tree.rows.collect()]
    assert got == by_sorting(rows, 3, 0, shards)
    sizes = [sum(r["size"] for r in rows if got[r["place"]] == k) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 2.1 * max(r["size"] for r in rows)


def test_placed_digest(spark):
    rows = rows_of(700, seed=2)
    got = placed(spark.createDataFrame(rows, KINDS).repartition(6), shards=24).collect()
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted((repr(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)} and {r["shard"] for r in got} == set(range(24))
    for k in range(24):
        own = sorted(r["slot"] for r in got if r["shard"] == k)
        assert own == list(range(len(own)))


def test_few_and_no_documents(spark, empty):
    assert placed(empty, shards=24).collect() == []
    few = placed(spark.createDataFrame([(1, "a", "en", "s", 1), (2, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long"), shards=24).collect()
    assert len({r["shard"] for r in few}) == 2 and {r["size"] for r in few} == {8, 9} and {r["slot"] for r in few} == {0}


def test_one_document_repeated(spark):
    docs = spark.createDataFrame([(1, "abc", "en", "s", 3)] * 120, "doc_id long, text string, lang string, source string, n_chars long")
    counts = [r["count"] for r in placed(docs, shards=6).groupBy("shard").count().collect()]
    assert len(counts) == 6 and max(counts) - min(counts) <= 2


def test_numbers_that_are_not_finite(spark):
    docs = spark.createDataFrame([(i, "abc", float(x)) for i, x in enumerate(["nan", "inf", "-inf", "1", "2", "3", "4", "5"])], "doc_id long, text string, v double")
    tree = KdTree(docs, ("v",), 4)
    got = tree.rows.select("doc_id", tree.shard().alias("s")).collect()
    assert sorted(r["s"] for r in got) == [0, 0, 1, 1, 2, 2, 3, 3]
    assert {r["s"] for r in got if r["doc_id"] in (6, 7)} == {3}


def test_written_shards_hold_every_document_whole(spark, tmp_path):
    rows = rows_of(300, seed=3)
    write_shards(spark.createDataFrame(rows, KINDS), str(tmp_path / "out"), shards=6, files=2)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, (tuple(r) for r in got.select("doc_id", "text", "lang", "source", "n_chars", "k0", "size").collect()))) == sorted(repr((*r[:5], *r[6:])) for r in rows)
    sizes = [r["n"] for r in got.selectExpr("shard", "coalesce(octet_length(text), 0) + 8 AS n").groupBy("shard").sum("n").toDF("shard", "n").collect()]
    assert len(sizes) == 6 and max(sizes) - min(sizes) < 2000
