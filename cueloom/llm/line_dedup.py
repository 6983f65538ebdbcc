"""Line dedup: an exact set-similarity join of lines, in built-in DataFrame functions only.

A line's tokens are its distinct words. A line is removed if an earlier line of
the corpus (smaller doc_id, or the same one and a smaller line number) has a
Jaccard similarity of at least ``percent`` / 100 with it, judged on the input. Lines
without words stay.

Tokens are ordered by rarity: a token's count is that of its hash bucket, over all
documents; the counts' classes come as one scalar, of a byte a bucket, and there are
2**24 buckets at most. Lines with equal token sets are one set, known by its first
line. A token that occurs once in all documents is shared by no two sets and leaves
the prefixes before anything is shuffled. Prefix tokens are joined with length,
positional and parity filters (two sets that differ in k tokens differ in at most k
bits of their parity, of which long sets have 128 bits and others 64), and what is left is verified on whole token sets.

Families of near copies stay linear: a set picks the three of its commoner prefix tokens with the smallest hashes,
and where many sets of like length pick the same, each is first held against the
earliest of them alone; those that match it are settled, the others go on with the
earliest of themselves, for some rounds. Settled sets need no further match; the join
offers them to others only as the earlier side, and so misses nothing.

Null text has no lines and stays null; an empty text is one line without words. A
text may be of any length and have any number of lines. An empty table gives an empty
one. A null doc_id comes after all others. Rows that share a doc_id share line places,
of which none is earlier; repeated rows give repeated results. Other columns are
carried along unchanged, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import MOST_BROADCAST, Scratch, fresh, small

LAST = (1 << 63) - 1
PICKS = 3
HOT = 32  # a crowd: sets of like length that pick one token; smaller ones go to the join as they are
ROUNDS = 2
WORDS = 128  # a bucket of token counts
LONG = 96  # sets of more tokens have 128 bits of parity
SHARED = 1 << 56  # tokens of the lowest class, which occur once, lie below
COMMON = (2 * HOT.bit_length() - 2) << 56  # and those that occur too seldom for a crowd below this
WHITE = ("\t", "\x0b", "\x0c", "\r")  # white space that is neither a line end nor the space
NO_WORD = "^[\\x20\\x09-\\x0D]*$"


def _rows(docs: DataFrame) -> DataFrame:
    """(d, t, text) of the rows that have text; white space other than line ends is made spaces, which tell words apart faster than a pattern."""
    text = plain = F.col("text").cast("string")
    for x in WHITE:
        plain = F.replace(plain, F.lit(x), F.lit(" "))
    # these are rare, and seen to be absent in a third of the time that replacing takes
    text = F.when(reduce(or_, (F.contains(text, F.lit(x)) for x in WHITE)), plain).otherwise(text)
    return docs.where("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"), F.xxhash64(F.col("text").cast("string")).alias("t"), text.alias("text"))


def _lines(rows: DataFrame) -> DataFrame:
    return rows.select("d", "t", F.posexplode_outer(F.split("text", "\n")).alias("p", "line"))  # outer: else the split is done twice, to see that there are lines


def _rarity(rows: DataFrame, bits: int) -> DataFrame:
    """One row: for each bucket of token hashes the class of its count (0: once, two classes a doubling)."""
    words = _lines(rows).select(F.explode_outer(F.split("line", " ")).alias("w"))
    counts = words.select(F.shiftrightunsigned(F.xxhash64("w"), 64 - bits).alias("b")).groupBy("b").count().select("b", F.floor(2 * F.log2("count")).cast("int").alias("c"))
    every = rows.sparkSession.range(1 << bits).toDF("b").join(counts, "b", "left").select("b", F.coalesce("c", F.lit(0)).alias("c"))
    # blocks are put together first, so that the last task takes 256 arrays and not all counts one by one; place and class are one long, as such are sorted fast
    blocks = every.groupBy(F.shiftright("b", bits - 8).alias("k")).agg(F.transform(F.sort_array(F.collect_list(F.shiftleft("b", 8) + F.col("c"))), lambda x: x.bitwiseAND(127).cast("tinyint")).alias("part"))
    return blocks.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "part"))), lambda x: x["part"])).alias("counts"))


def _with_tokens(lines: DataFrame, counts: DataFrame, bits: int) -> DataFrame:
    """lines with w, their distinct tokens as sorted longs: the class of rarity in the top bits, then 56 bits of the token's hash."""
    lines = lines.withColumn("_rank", counts.scalar())  # used once below, so the optimizer puts the scalar in its place
    # without repeats before they are looked up
    hashes = F.array_except(F.transform(F.split("line", " "), lambda w: F.xxhash64(w)), F.array(F.xxhash64(F.lit(""))))
    # never null, as arrays that may hold nulls are sorted as objects
    rank = lambda h: F.shiftleft(F.coalesce(F.get("_rank", F.shiftrightunsigned(h, 64 - bits).cast("int")), F.lit(0).cast("tinyint")).cast("long"), 56)
    keyed = F.transform(hashes, lambda h: rank(h).bitwiseOR(F.shiftrightunsigned(h, 8)))
    return lines.select(*[c for c in lines.columns if c not in ("_rank", "line")], F.sort_array(keyed).alias("w"))


def _near(a: str, b: str, percent: int, places: bool = True) -> str:
    """SQL of the length, positional and parity filters for rows aliased a and b."""
    need = f"ceil({percent} * ({a}.n + {b}.n) / {100 + percent}D)"
    apart = f"IF(least({a}.n, {b}.n) > {LONG}, bit_count({a}.s2 ^ {b}.s2) + bit_count({a}.s1 ^ {a}.s2 ^ {b}.s1 ^ {b}.s2), bit_count({a}.s1 ^ {b}.s1))"
    # the first token that two sets share has all others behind it, so they need not be found at a later one
    by_place = f" AND least({a}.n - {a}.i, {b}.n - {b}.i) >= {need}" * places
    return (
        f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n){by_place}"
        f" AND {apart} <= {a}.n + {b}.n - 2 * {need}"
    )


def _earlier(a: str, b: str) -> str:
    return f"({a}.d < {b}.d OR ({a}.d = {b}.d AND {a}.p < {b}.p))"


def _similar(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """(d, p, t) of the lines b of pairs (ad, ap, d, p, t) that are similar enough to their a."""
    a = whole.select(F.col("d").alias("ad"), F.col("p").alias("ap"), F.col("w").alias("aw"))
    same = F.size(F.array_intersect("aw", "w"))
    both = pairs.join(a, ["ad", "ap"]).join(whole, ["d", "p", "t"])
    return both.where(100 * same >= percent * (F.size("aw") + F.size("w") - same)).select("d", "p", "t").distinct()


def _whole(scratch: Scratch, places: DataFrame, rows: DataFrame, counts: DataFrame, bits: int, name: str) -> DataFrame:
    """(d, p, t, w): whole token sets, from their texts, of the lines at these (d, p) only."""
    places = scratch.save(places.distinct(), f"{name}-places")
    texts = rows.join(small(places.select("d").distinct(), 8), "d", "left_semi")
    lines = _lines(texts).join(small(places, 16), ["d", "p"], "left_semi")
    whole = scratch.save(_with_tokens(lines, counts, bits).dropDuplicates(["d", "p", "t"]), f"{name}-whole")
    scratch.drop(f"{name}-places")
    return whole


def _settled(scratch: Scratch, sets: DataFrame, rows: DataFrame, counts: DataFrame, percent: int, bits: int) -> DataFrame:
    """(d, p, t) of sets that are similar to an early one of those that share a pick with them."""
    # similar sets are of one class of lengths or of two that are neighbours
    picked = sets.select("d", "p", "t", "n", "s1", "s2", F.floor(F.log("n") / math.log(100 / percent)).alias("m"), F.explode_outer("picks").alias("pick")).where(f"pick < {LAST}")
    crowded = lambda x: x.groupBy("pick", "m").agg(F.count("*").alias("c"), F.min(F.struct("d", "p", "n", "s1", "s2")).alias("a")).where(f"c >= {HOT}").drop("c")
    heads = scratch.save(picked.groupBy("pick", "m").count().where(f"count >= {HOT}").select("pick", "m"), "hot")
    there = picked.join(small(heads, 16), ["pick", "m"])
    there = scratch.save(there, "there-0")
    done = there.select("d", "p", "t").limit(0)
    if there.isEmpty():
        return done
    whole = _whole(scratch, there.select("d", "p"), rows, counts, bits, "there")
    for k in range(1, ROUNDS + 1):
        heads = scratch.save(crowded(there), f"heads-{k}")
        if heads.isEmpty():
            break
        met = there.select("pick", "m", "t", F.struct("d", "p", "n", "s1", "s2").alias("b")).join(small(heads, 56), ["pick", "m"])
        pairs = met.where(f"{_earlier('a', 'b')} AND {_near('a', 'b', percent, places=False)}").selectExpr("a.d AS ad", "a.p AS ap", "b.d", "b.p", "t").distinct()
        sure = scratch.save(_similar(pairs, whole, percent), f"settled-{k}")
        done = done.union(sure)
        left = there.join(small(sure, 24), ["d", "p", "t"], "left_anti")
        # the firsts have met all of their crowd
        left = left.join(small(heads.selectExpr("pick", "m", "a.d AS d", "a.p AS p"), 32), ["pick", "m", "d", "p"], "left_anti")
        there = scratch.save(left, f"there-{k}")
    return scratch.save(done.distinct(), "settled")


def _removed(docs: DataFrame, scratch: Scratch, percent: int, bits: int | None) -> DataFrame:
    """(d, t, gone) of the texts that lose lines: their places, in order."""
    rows = _rows(docs)
    if bits is None:
        size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
        bits = min(max((size // (6 * WORDS)).bit_length(), 16), 24)
    # the counts are a table of their own: a scalar read from it is not computed again with each use
    counts = scratch.save(_rarity(rows, bits), "rarity")
    fold = "aggregate(w, 0L, (a, x) -> a ^ shiftleft({}, cast(x & 63 as int)))"
    parts = {
        "k": "xxhash64(w)",
        "k2": "xxhash64(17, w)",
        "n": "size(w)",
        "s1": fold.format("1L"),
        "s2": f"IF(size(w) > {LONG}, {fold.format('shiftrightunsigned(x, 12) & 1L')}, 0L)",  # of a half of the tokens; s1 ^ s2 is that of the others
    }
    # lines without words are left out later: a filter here would have the tokens made twice
    prefix = f"slice(w, 1, IF(size(w) > 0, size(w) - cast(ceil({percent} * size(w) / 100D) as int) + 1, 0))"
    # a hash for each of the commoner ones, LAST for others
    picks = f"slice(sort_array(transform(w, x -> IF(x < {COMMON}, {LAST}, xxhash64(x)))), 1, {PICKS})"
    lines = _with_tokens(_lines(rows), counts, bits).selectExpr("d", "t", "p", *(f"{sql} AS {name}" for name, sql in parts.items()), f"{prefix} AS w")
    lines = lines.selectExpr("*", f"{picks} AS picks")
    lines = scratch.save(lines, "lines", "snappy", dictionary=False).where("n > 0")  # hashes do not compress
    again = scratch.save(lines.groupBy("k", "k2").count().where("count > 1").select("k", "k2"), "again")
    firsts = lines.join(small(again, 16), ["k", "k2"]).groupBy("k", "k2").agg(F.min(F.struct("d", "p", "t")).alias("f"))
    firsts = scratch.save(firsts.selectExpr("k", "k2", "f.d AS fd", "f.p AS fp", "f.t AS ft"), "firsts")
    n = firsts.count()
    known = lines.join(small(firsts, 40, n), ["k", "k2"], "left")
    known = known.selectExpr("d", "t", "p", "n", "s1", "s2", "w", "picks", "fd IS NULL OR (d = fd AND p = fp AND t = ft) AS first", "fd IS NOT NULL AND (d > fd OR (d = fd AND p > fp)) AS again")
    if n * 40 > MOST_BROADCAST:
        known = scratch.save(known, "known")
    sets = known.where("first")

    settled = _settled(scratch, sets, rows, counts, percent, bits)
    marked = sets.join(small(settled.select("d", "p", "t", F.lit(1).alias("f")), 28), ["d", "p", "t"], "left")
    tokens = marked.select("d", "p", "n", "s1", "s2", F.coalesce("f", F.lit(0)).alias("f"), F.posexplode_outer("w").alias("i", "w")).where(F.col("w") >= SHARED)
    # a is the larger set, or the later of two of one size; every filter takes both sides' columns, so one shuffle serves both
    order = f"b.n < a.n OR (b.n = a.n AND {_earlier('b', 'a')})"
    wanted = f"IF({_earlier('b', 'a')}, a.f, b.f) = 0 AND (a.d <> b.d OR a.p <> b.p)"
    both = tokens.alias("a").join(tokens.alias("b"), F.expr(f"a.w = b.w AND 100 * b.n >= {percent} * a.n AND ({order}) AND {_near('a', 'b', percent)} AND {wanted}"))
    both = both.selectExpr(f"{_earlier('b', 'a')} AS back", "a.d AS d1", "a.p AS p1", "b.d AS d2", "b.p AS p2").selectExpr("IF(back, d2, d1) AS ad", "IF(back, p2, p1) AS ap", "IF(back, d1, d2) AS d", "IF(back, p1, p2) AS p")
    pairs = scratch.save(both.distinct(), "pairs")
    whole = _whole(scratch, pairs.selectExpr("ad AS d", "ap AS p").union(pairs.select("d", "p")), rows, counts, bits, "pair")
    # one match is enough: most lines find it in their first candidate
    pairs = pairs.join(whole.select("d", "p", "t"), ["d", "p"])
    one = pairs.groupBy("d", "p", "t").agg(F.min(F.struct("ad", "ap")).alias("a")).select("a.*", "d", "p", "t")
    late = scratch.save(_similar(one, whole, percent), "late")
    late = late.union(_similar(pairs.join(late, ["d", "p", "t"], "left_anti"), whole, percent))
    gone = known.where("again").select("d", "t", "p").union(settled.select("d", "t", "p")).union(late.select("d", "t", "p"))
    return scratch.only(gone.groupBy("d", "t").agg(F.sort_array(F.collect_set("p")).alias("gone")), "gone")


def dedup_lines(docs: DataFrame, percent: int = 80, bucket_bits: int | None = None, drop_emptied: bool = False, counts: bool = True) -> DataFrame:
    """docs with their text's later similar lines removed; with counts, n_lines and n_removed are appended (in place of columns of that name).

    drop_emptied leaves out documents that lose every line that has words. bucket_bits:
    the rarity order takes counts of 2**bucket_bits buckets; by default one a 128 words.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    gone = _removed(docs, scratch, percent, bucket_bits)
    names = [c for c in docs.columns if not counts or c.lower() not in ("n_lines", "n_removed")]
    d, t, lines, places = fresh(docs.columns, "d", "t", "lines", "gone")
    text = F.col("text").cast("string")
    keyed = docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias(d), F.xxhash64(text).alias(t), F.split(text, "\n").alias(lines))
    longs = gone.agg(F.count("*"), F.sum(F.size("gone"))).first()
    gone = gone.toDF(d, t, places)
    # the places lie beside the split text, so the projection below stays above the join and splits no text twice
    out = keyed.join(small(gone, 32, longs[0] + (longs[1] or 0) // 8), [d, t], "left")
    stay = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places), lambda i: F.get(lines, i))
    out = out.withColumns(
        {
            "text": F.when(F.col(places).isNull(), text).otherwise(F.array_join(stay, "\n")),
            lines: F.coalesce(F.when(text.isNotNull(), F.size(lines)), F.lit(0)).cast("long"),
            places: F.coalesce(F.size(places), F.lit(0)).cast("long"),
        }
    )
    if drop_emptied:
        out = out.where(~((F.col(places) > 0) & F.col("text").rlike(NO_WORD)))
    scratch.leave()
    return out.select(*names, *([F.col(lines).alias("n_lines"), F.col(places).alias("n_removed")] * counts))
