"""N-gram Jaccard join: documents whose shingle sets overlap enough, as components.

Documents with equal sets are one node. A node's shingles are ordered rare first
(a merged count-min sketch gives the order, one order for all documents) and only
those of its prefix that the sketch holds for shared go into the join, with length,
positional and parity filters (sets that differ in k shingles differ in at most k
bits of their 256-bit parity words). Candidate pairs are verified once, after a suffix filter,
against the whole sorted sets.

The join runs in two rounds so that large groups of copies stay linear. First
each prefix shingle links its documents to one of them only; verified links give
components. Then only prefix shingles that still span several components are
joined, first as components and then as documents, and only pairs across components are verified. A pair inside a component
cannot change it, so the components equal those of all links.

Null or wordless text is linked with nothing. Rows that share a doc_id count as
one document (their links are joined). A null doc_id has a null component and
links to nothing. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch, SortedTable
from .sketch import FLUSH, CountMin
from .substring_dedup import expected_words
from .text import left_in_row, mix, rolling, streams


def shingle_sets(texts: pa.Array, k: int):
    """(first row, number of rows, row of each shingle, shingle hashes): distinct in each row, rows ascending."""
    for row, counts, h in streams(texts, lower=True):
        left = left_in_row(counts)
        doc = np.repeat(np.arange(len(counts)), counts)
        full = left >= k
        got, of = rolling(h, k)[full], doc[full]
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            ends = np.cumsum(counts)
            extra = []
            for i in short:
                m = int(counts[i])
                extra.append(rolling(h[ends[i] - m : ends[i]], m)[0])
            got, of = np.concatenate([got, np.array(extra, np.uint64)]), np.concatenate([of, short])
        salted = mix(of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ got  # equal only for one row's equal shingles, but for chance
        order = np.lexsort((got, of)) if len(counts) < 2 else np.argsort(of, kind="stable")
        got, of, salted = got[order], of[order], salted[order]
        _, first = np.unique(salted, return_index=True)
        first.sort()
        yield row, len(counts), of[first], got[first]


def _prefix(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (n * percent + 99) // 100 + 1


def _overlap(n: int, m: int, percent: int) -> int:
    """The least intersection with percent * union <= 100 * intersection."""
    return -(-percent * (n + m) // (100 + percent))


PARITY = ("s0", "s1", "s2", "s3")


def _near(a: str, b: str, percent: int) -> str:
    """SQL of the length, positional and parity filters for rows a and b."""
    need = f"ceil({percent} * ({a}.n + {b}.n) / {100 + percent}D)"
    apart = " + ".join(f"bit_count({a}.{s} ^ {b}.{s})" for s in PARITY)
    return (
        f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)"
        f" AND least({a}.place, {b}.place) + least({a}.n - {a}.place, {b}.n - {b}.place) >= {need}"
        f" AND {apart} <= {a}.n + {b}.n - 2 * {need}"
    )


def _suffix_apart(x: np.ndarray, y: np.ndarray, most: int, depth: int = 0) -> int:
    """A lower bound of the symmetric difference of two sorted arrays, by halving around a probe."""
    if depth == 3 or not len(x) or not len(y):
        return abs(len(x) - len(y))
    probe = y[len(y) // 2]
    i, j = int(np.searchsorted(x, probe)), len(y) // 2
    same = i < len(x) and x[i] == probe
    xr, yr = x[i + same :], y[j + 1 :]
    least = abs(i - j) + abs(len(xr) - len(yr)) + (not same)
    if least > most:
        return least
    low = _suffix_apart(x[:i], y[:j], most - abs(len(xr) - len(yr)) - (not same), depth + 1)
    if low + abs(len(xr) - len(yr)) + (not same) > most:
        return low + abs(len(xr) - len(yr)) + (not same)
    return low + _suffix_apart(xr, yr, most - low - (not same), depth + 1) + (not same)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets overlap enough; each b's set goes to a's task, one at a time."""
    heads = pairs.select("a").distinct().join(sets.withColumnRenamed("id", "a"), "a").select("a", F.lit(None).cast("long").alias("b"), "items")
    rows = pairs.join(sets.withColumnRenamed("id", "b"), "b").select("a", "b", "items")
    # a hot a is dealt over several tasks; its own set goes to each
    salts = 8
    heads = heads.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = rows.withColumn("s", F.pmod(F.xxhash64("b"), F.lit(salts)).cast("int"))
    both = heads.unionByName(rows).repartition("a", "s").sortWithinPartitions("a", "s", F.col("b").asc_nulls_first())

    def check(batches):
        head, of = [], None
        for batch in batches:
            out: list[tuple[int, int]] = []
            a_s, b_s, items = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for i, (a, b) in enumerate(zip(a_s, b_s, strict=True)):
                own = np.frombuffer(items[i].as_buffer(), np.uint64)
                if b is None:
                    head, of = (head if of == a else []) + [own.copy()], a
                    continue
                for x in head if of == a else []:
                    need = _overlap(len(x), len(own), percent)
                    most = len(x) + len(own) - 2 * need
                    if abs(len(x) - len(own)) > most or _suffix_apart(x, own, most) > most:
                        continue
                    if len(np.intersect1d(x, own, assume_unique=True)) >= need:
                        out.append((a, b))
                        break
            yield pa.record_batch([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], ["a", "b"])

    return both.select("a", "b", "items").mapInArrow(check, "a long, b long")


def ngram_components(docs: DataFrame, k: int = 5, percent: int = 80, cells_per_shingle: float = 1.5, flush: int = FLUSH) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that links reach). flush: shingles that a task holds for its sketch; fewer take less memory and more shuffle."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scratch = Scratch(docs.sparkSession, "ngram-join")
    sketch = CountMin.build(
        scratch, "sketch/s", docs.select("text"), lambda b: (got for *_, got in shingle_sets(b.column(0), k)), expected_words(docs), cells_per_shingle, flush=flush
    )

    def signatures(batches):
        for batch in batches:
            ids, n_all, sums, xors, prefixes, places, parities = batch.column(0), [], [], [], [], [], []
            for _, rows, of, got in shingle_sets(batch.column(1), k):
                counts = sketch.estimate(got)
                n = np.bincount(of, minlength=rows)
                order = np.lexsort((got, counts, of))
                starts = np.concatenate([[0], np.cumsum(n)])
                place = np.arange(len(got)) - np.repeat(starts[:-1], n)
                got, counts = got[order], counts[order]
                use = (place < np.repeat(_prefix(n, percent), n)) & (counts > 1)
                edge = np.searchsorted(np.flatnonzero(use), starts)
                got_use, place_use = got[use].view(np.int64), place[use].astype(np.int32)
                keyed = mix(got, 0x6A09E667)
                odd = np.bincount(np.repeat(np.arange(rows), n) * 256 + (keyed & np.uint64(255)).astype(np.int64), minlength=256 * rows) & 1
                parities.append(np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(rows, 4))
                for i in range(rows):
                    a, b = starts[i], starts[i + 1]
                    sums.append(int(np.add.reduce(got[a:b]).view(np.int64)) if b > a else 0)
                    xors.append(int(np.bitwise_xor.reduce(keyed[a:b]).view(np.int64)) if b > a else 0)
                    prefixes.append(got_use[edge[i] : edge[i + 1]])
                    places.append(place_use[edge[i] : edge[i + 1]])
                n_all.append(n)
            words = np.concatenate(parities) if parities else np.zeros((0, 4), np.int64)
            yield pa.record_batch(
                [ids, pa.array(np.concatenate(n_all) if n_all else [], pa.int64()), pa.array(sums, pa.int64()), pa.array(xors, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32())), *(pa.array(words[:, i]) for i in range(4))],
                ["doc_id", "n", "k1", "k2", "prefix", "place", *PARITY],
            )

    own = docs.mapInArrow(signatures, "doc_id long, n long, k1 long, k2 long, prefix array<long>, place array<int>, s0 long, s1 long, s2 long, s3 long")
    own = scratch.save(own, "signatures")
    scratch.drop("sketch")
    linked = own.where("n > 0 AND doc_id IS NOT NULL")
    same = linked.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("last"))
    reps = own.join(same.withColumnRenamed("id", "doc_id"), ["k1", "k2", "n", "doc_id"]).dropDuplicates(["k1", "k2", "n"])
    rows = reps.select(F.col("doc_id").alias("id"), "n", *PARITY, F.explode(F.arrays_zip("prefix", "place")).alias("x"))
    rows = scratch.save(rows.select(F.col("x.prefix").alias("h"), "id", "n", F.col("x.place").alias("place"), *PARITY), "rows")

    # a shared passage can be long in few documents or short in thousands: h alone is never a task's whole work
    groups = rows.groupBy("h").agg(F.count("*").alias("c"), F.min(F.struct("id", "n", "place", *PARITY)).alias("m")).where("c > 1")
    shared = scratch.save(rows.join(groups.drop("c"), "h"), "shared")
    # the ids whose sets are wanted, as mapped arrays: looked up where the texts are read, so no text is shuffled
    need = scratch.save(shared.select(F.xxhash64("id").alias("h")).distinct(), "need")
    wanted = SortedTable.build(scratch, "wanted/w", need, max(0, need.count().bit_length() - 19), [])

    def sets(batches):
        for batch in batches:
            batch = batch.filter(pa.array(wanted.find(batch.column(2).to_numpy().view(np.uint64))[0]))
            ids, out_id, out = batch.column(0), [], []
            for row, n_rows, of, got in shingle_sets(batch.column(1), k):
                edge = np.searchsorted(of, np.arange(n_rows + 1))
                for i in range(n_rows):
                    out_id.append(ids[row + i].as_py())
                    out.append(np.sort(got[edge[i] : edge[i + 1]]).tobytes())
            yield pa.record_batch([pa.array(out_id, pa.int64()), pa.array(out, pa.binary())], ["id", "items"])

    known = docs.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(sets, "id long, items binary")
    known = scratch.save(known, "sets")

    star = shared.select(F.struct("id", "n", "place", *PARITY).alias("b"), F.col("m").alias("a")).where("a.id <> b.id").where(_near("a", "b", percent))
    star = star.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    edges = scratch.save(_verify(star, known, percent), "star")
    first = scratch.save(components(scratch, edges, "c1"), "first")

    marked = shared.drop("m").join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    marked = scratch.save(marked, "marked")
    open_ = marked.groupBy("h").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("h")
    left = scratch.save(marked.join(open_, "h", "left_semi"), "open")
    # components meet first; where both have one document with the shingle, its own filters decide
    sides = left.groupBy("h", "component").agg(F.count("*").alias("c"), F.min("n").alias("n"), F.max("n").alias("most"), F.min("place").alias("place"), *(F.min(x).alias(x) for x in PARITY))
    sides = scratch.save(sides, "sides")
    meet = sides.alias("a").join(sides.alias("b"), F.col("a.h") == F.col("b.h"))
    lengths = f"100 * a.most >= {percent} * b.n AND 100 * b.most >= {percent} * a.n"
    meet = meet.where(f"a.component < b.component AND {lengths} AND (a.c > 1 OR b.c > 1 OR ({_near('a', 'b', percent)}))")
    meet = meet.select(F.col("a.component").alias("ca"), F.col("b.component").alias("cb")).distinct()
    # each pair of components once: the members of the smaller come first, those of the larger meet them inside the join's condition
    nodes = scratch.save(left.select("id", "component", "n", F.lit(0).alias("place"), *PARITY).distinct(), "nodes")
    sizes = nodes.groupBy("component").agg(F.count("*").alias("c"))
    meet = meet.join(sizes.select(F.col("component").alias("ca"), F.col("c").alias("na")), "ca").join(sizes.select(F.col("component").alias("cb"), F.col("c").alias("nb")), "cb")
    meet = meet.selectExpr("IF(na <= nb, ca, cb) AS small", "IF(na <= nb, cb, ca) AS large")
    few = meet.join(nodes.withColumnRenamed("component", "small"), "small").drop("small").alias("a")
    across = few.join(nodes.alias("b"), F.expr(f"a.large = b.component AND {_near('a', 'b', percent)}")).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    across = across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).join(tried, ["a", "b"], "left_anti").distinct()
    edges = edges.union(_verify(across, known, percent))
    # rows that share a doc_id have one node but several sets: their classes meet in it
    twice = linked.join(same, ["k1", "k2", "n"]).where("id <> doc_id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    final = scratch.save(components(scratch, edges.union(twice), "c2"), "final")
    out = own.select("doc_id", F.col("n").alias("n_shingles")).join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return scratch.finish(out, "signatures", "rows", "shared", "need", "wanted", "sets", "star", "first", "marked", "open", "sides", "nodes", "final")
