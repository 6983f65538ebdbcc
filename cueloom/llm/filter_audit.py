"""Filter interaction audit: what each of five filters removes, in every order in which they can be applied.

Filters (a document fails): A under 50 words; B 100 * distinct words < 65 * words; C 100 * capitals A-Z >
5 * code points; D holds one of ``#$%&*|``; E its text is that of a document with a smaller doc_id.

E is found by partition refinement. Documents are split by code-point length, then by the hashes of
successive blocks of 64, 1024, 16384, ... bytes, and classes of one are dropped in each round; so the
rounds grow with the logarithm of the longest text. The texts of the classes that are left are compared
whole: equal texts are put together before the shuffle, so a text that a third of the documents share leaves
a task once. Where a class holds two texts after all (a hash collision), its documents are compared text by
text. Each document then is one of 32 masks, and every order is read off the counts of masks of its part.

Null text counts as empty; equal empty texts are duplicates like others. A null source belongs to part ``''``.
A null doc_id comes after all others and has no labels. Rows that share a doc_id are documents of their own:
of equal texts those with the smallest doc_id all stay. Labels that are repeated for a doc_id count if any of them says 1.
Texts may be of any length. An empty table gives no rows. Further columns are not looked at.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, small

LAST = (1 << 63) - 1
FILTERS = "ABCDE"
BLOCK = 64
GROWTH = 16
STEPS = "array<struct<filter_order:string,step:int,own:int,before:int>>"
ROUNDS = 8  # hashed apart; the eighth block takes the rest of a text


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _blocks(bits: int) -> Column:
    """Hashes of successive blocks of the text's bytes; how many there are follows from its size alone."""
    data, n, at, out = _text().cast("binary"), F.octet_length(_text()), 0, []
    for r in range(ROUNDS):
        size = BLOCK * GROWTH**r if r < ROUNDS - 1 else 1 << 30
        part = F.xxhash64(F.substring(data, at + 1, size))
        out.append(F.when(n > at, F.shiftrightunsigned(part, 64 - bits) if bits < 64 else part))
        at += size
    return F.array_compact(F.array(*out))


def _words() -> Column:
    """struct(n, m): words and distinct words."""
    # inside a lambda, so the words are made once for both counts; a text may begin or end with white space
    tokens = F.array(F.array_remove(F.split(_text(), r"[\x20\x09-\x0D]+"), ""))
    return F.get(F.transform(tokens, lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("m"))), F.lit(0))


def _judged(docs: DataFrame, bits: int, *more: Column) -> DataFrame:
    """(d, part, n, blocks, mask) of every document; mask has the bits of A to D."""
    text, n = _text(), F.length(_text()).cast("long")
    made = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        n.alias("n"),
        _blocks(bits).alias("blocks"),
        _words().alias("w"),
        (100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * n).alias("c"),
        text.rlike("[#$%&*|]").alias("s"),
        *more,
    )
    fails = (F.col("w.n") < 50, 100 * F.col("w.m") < 65 * F.col("w.n"), F.col("c"), F.col("s"))
    mask = sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails)), F.lit(0))
    return made.withColumn("mask", mask.cast("int")).drop("w", "c", "s")


def _key(n: Column, blocks: Column) -> Column:
    """The class of a document after all its rounds."""
    return F.aggregate(blocks, F.xxhash64(n), lambda k, x: F.xxhash64(k, x))


def _classes(scratch: Scratch, judged: DataFrame) -> DataFrame:
    """(k) of the classes that hold two documents or more after their last round."""
    live = judged.select(F.xxhash64("n").alias("k"), F.col("blocks").alias("left"))
    done = live.select("k").limit(0)
    for r in range(ROUNDS + 1):
        classes = scratch.save(live.groupBy("k", (F.size("left") == 0).alias("over")).agg(F.count("*").alias("c")).where("c > 1"), f"classes-{r}")
        done = done.union(classes.where("over").select("k"))
        n = classes.where("NOT over").count()
        if not n:
            break
        stay = live.join(small(classes.where("NOT over").select("k"), 8, n), "k", "left_semi")
        live = scratch.save(stay.select(F.xxhash64("k", F.get("left", F.lit(0))).alias("k"), F.slice("left", 2, ROUNDS).alias("left")), f"live-{r}")
    return done.distinct()


def _marked(docs: DataFrame, scratch: Scratch, bits: int) -> DataFrame:
    """(d, part, mask) of every document, with the bit of E."""
    judged = scratch.save(_judged(docs, bits), "judged")
    classes = scratch.save(_classes(scratch, judged), "classes")
    key = _key(F.length(_text()).cast("long"), _blocks(bits))
    whole = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"), key.alias("k"), _text().alias("t"))
    equal = whole.join(small(classes, 8), "k", "left_semi").groupBy("k", "t").agg(F.min("d").alias("first"))
    firsts = scratch.save(equal.select("k", "first"), "firsts")
    several = scratch.save(firsts.groupBy("k").count().where("count > 1").select("k"), "several")
    later = (F.col("mask") + F.when(F.col("first") < F.col("d"), 16).otherwise(0)).alias("mask")
    keyed = judged.select("d", "part", "mask", _key(F.col("n"), F.col("blocks")).alias("k"))
    if several.isEmpty():
        return keyed.join(small(firsts, 16), "k", "left").select("d", "part", later)
    several = small(several, 8)
    sure = keyed.join(several, "k", "left_anti").join(small(firsts.join(several, "k", "left_anti"), 16), "k", "left").select("d", "part", later)
    mixed = _judged(docs, bits, _text().alias("t")).withColumn("k", _key(F.col("n"), F.col("blocks"))).join(several, "k", "left_semi")
    return sure.union(mixed.join(mixed.groupBy("t").agg(F.min("d").alias("first")), "t").select("d", "part", later))


def _counts(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic)."""
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("d"))
    said = said.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    both = marked.join(said, "d", "left")
    return both.groupBy("part", "mask").agg(F.count("*").alias("n"), *(F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in ("good", "toxic")))


def _steps() -> list[dict]:
    """Every step of every order: the bit of its own filter, and those of the filters before it."""
    out = []
    for order in permutations(FILTERS):
        bits = [1 << FILTERS.index(x) for x in order]
        out += [{"filter_order": "".join(order), "step": i + 1, "own": bits[i], "before": sum(bits[:i])} for i in range(len(order))]
    return out


def audit(docs: DataFrame, labels: DataFrame, hash_bits: int = 64) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every part, order and step.

    docs: doc_id, text, source; labels: doc_id, quality, toxic. hash_bits: fewer make collisions of blocks, for tests.
    """
    scratch = Scratch(docs.sparkSession, "filter-audit")
    counts = scratch.save(_counts(_marked(docs, scratch, hash_bits), labels), "counts")
    # a part has 32 masks at most
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    steps = parts.select("part", "masks", F.explode(F.from_json(F.lit(json.dumps(_steps())), STEPS)).alias("x")).select("part", "masks", "x.*")

    def total(column: str, of) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"), lambda s, x: s + F.when(of(x["mask"]), x[column]).otherwise(0))

    fails, earlier = lambda m: m.bitwiseAND(F.col("own")) != 0, lambda m: m.bitwiseAND(F.col("before")) != 0
    here = lambda m: fails(m) & ~earlier(m)
    # among the filters that a document fails each comes first in the same share of the 120 orders
    share = F.aggregate("masks", F.lit(0).cast("long"), lambda s, x: s + F.when(fails(x["mask"]), (x["n"] * 120 / F.bit_count(x["mask"])).cast("long")).otherwise(0))
    out = steps.select(
        "part", "filter_order", "step",
        total("n", lambda m: ~fails(m) & ~earlier(m)).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & earlier(m)).alias("redundant"),
        total("n", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        share.alias("shapley"),
    )
    scratch.leave()
    return out
