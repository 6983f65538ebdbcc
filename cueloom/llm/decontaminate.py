"""Benchmark decontamination by greedy string tiling.

The benchmark is a stated query set: it is compared with all documents in blocks
whose size is bounded, so neither side is ever crossed with the other. For each block, the seeds
(``seed`` consecutive tokens) that a document shares with an item are joined by
hash; around them, running Karp-Rabin matching marks the longest common
non-overlapping tiles again and again, down to ``tile`` tokens, in any order of
the passage. An item of which at least ``coverage`` of the tokens are tiled is
contained in the document.

Tokens are the lower-cased words without punctuation at their ends. Items with
fewer than ``tile`` tokens are matched whole. Null or empty texts contain nothing;
null or empty items are contained in nothing. Repeated items and rows give
repeated results.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import tidy

BLOCK_BYTES = 8 << 20
STRIP = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def tokens(text: str | None) -> list[str]:
    return [w for w in (x.strip(STRIP) for x in (text or "").lower().split()) if w]


def _hash(token: str) -> int:
    return int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "little")


def _matches(pattern: list[int], text: list[int], free_p: list[bool], free_t: list[bool], size: int) -> list[tuple[int, int, int]]:
    """Maximal matches of at least size free tokens: (length, start in pattern, start in text), by a rolling hash."""
    base, mod = 1_000_003, (1 << 61) - 1
    top = pow(base, size - 1, mod)

    def windows(items: list[int], free: list[bool]) -> Iterator[tuple[int, int]]:
        h = run = 0
        for i, (x, ok) in enumerate(zip(items, free, strict=True)):
            if not ok:
                h = run = 0
                continue
            if run >= size:
                h = (h - items[i - size] * top) % mod
            h = (h * base + x) % mod
            run += 1
            if run >= size:
                yield i - size + 1, h

    table: dict[int, list[int]] = defaultdict(list)
    for at, h in windows(pattern, free_p):
        table[h].append(at)
    found, done = [], {}
    for t, h in windows(text, free_t):
        for p in table.get(h, ()):
            if done.get(p - t, -1) > t:  # inside a match already seen on this diagonal
                continue
            n = 0
            while p + n < len(pattern) and t + n < len(text) and free_p[p + n] and free_t[t + n] and pattern[p + n] == text[t + n]:
                n += 1
            if n >= size:
                found.append((n, p, t))
                done[p - t] = t + n - size + 1
    return found


def greedy_tiles(pattern: list[int], text: list[int], tile: int) -> list[tuple[int, int, int]]:
    """(length, start in pattern, start in text) of the tiles, longest first; ties by place in the pattern, then the text."""
    free_p, free_t, tiles, size = [True] * len(pattern), [True] * len(text), [], max(tile, 1)
    search = max(min(len(pattern), 20), size)
    while True:
        found, marked = _matches(pattern, text, free_p, free_t, search), False
        longest = max((n for n, _, _ in found), default=0)
        if longest > 2 * search:  # the very long ones first
            search = longest
            continue
        for n, p, t in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if all(free_p[p : p + n]) and all(free_t[t : t + n]):
                tiles.append((n, p, t))
                free_p[p : p + n] = free_t[t : t + n] = [False] * n
                marked = True
        if search > size:
            search = max(size, search // 2)
        elif not marked:
            return tiles


def coverage_of(item: list[int], doc: list[int], tile: int) -> int:
    return sum(n for n, _, _ in greedy_tiles(item, doc, min(tile, len(item))))


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most BLOCK_BYTES (or one item), in one pass."""
    block, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        if r["text"] is None:
            continue
        n = len(r["text"].encode())
        if block and size + n > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += n
    yield block


def contained_items(docs: DataFrame, benchmark: DataFrame, seed: int = 4, tile: int = 5, coverage: float = 0.6) -> DataFrame:
    """One row per (document, contained item): doc_id, item_id, n_tokens, n_tiled."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in _blocks(benchmark):
        part = docs.mapInArrow(_tiler(block, seed, tile, coverage), "doc_id long, item_id long, n_tokens long, n_tiled long")
        out = part if out is None else out.union(part)
    return out


def _tiler(block: list[tuple[int, str]], seed: int, tile: int, coverage: float):
    index: list = []

    def prepare():
        items = [(i, [_hash(t) for t in tokens(text)]) for i, text in block]
        items = [(i, t) for i, t in items if t]
        seeds: dict[tuple[int, ...], list[int]] = defaultdict(list)
        sizes = set()
        for k, (_, t) in enumerate(items):
            n = min(seed, len(t))
            sizes.add(n)
            for s in {tuple(t[i : i + n]) for i in range(len(t) - n + 1)}:
                seeds[s].append(k)
        return items, seeds, sizes, {x for _, t in items for x in t}

    def tile_batches(batches):
        if not index:
            index.extend(prepare())
        items, seeds, sizes, vocabulary = index
        known: dict[str, int] = {}
        least = min(sizes, default=0)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if items else ():
                doc = []
                for w in (text or "").lower().split():
                    h = known.get(w)
                    if h is None:
                        bare = w.strip(STRIP)
                        h = _hash(bare) if bare else -1
                        if h not in vocabulary and h != -1:
                            h = 0
                        if len(known) > 400_000:
                            known.clear()
                        known[w] = h
                    if h != -1:
                        doc.append(h)
                out.extend((doc_id, *x) for x in contained(doc, items, seeds, sizes, least, tile, coverage))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "n_tokens", "n_tiled"])

    return tile_batches


def contained(doc: list[int], items: list, seeds: dict, sizes: set[int], least: int, tile: int, coverage: float) -> list[tuple[int, int, int]]:
    """Items of which the document covers enough: (item_id, tokens, tiled tokens). A token that no item has is 0."""
    n = len(doc)
    code = np.array(doc, np.uint64)
    inside = code != 0
    run = np.ones(max(n - least + 1, 0), bool)  # starts of `least` tokens that all occur in some item
    for j in range(least):
        run &= inside[j : j + len(run)]
    near: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i in np.flatnonzero(run).tolist():
        for size in sizes:
            for k in seeds.get(tuple(doc[i : i + size]), ()):
                near[k].append((i, i + size))
    out = []
    for k, hits in near.items():
        item_id, item = items[k]
        # all tiles are made of seeds, so tokens outside shared seeds can't be tiled
        used = np.zeros(n, bool)
        for a, b in hits:
            used[a:b] = True
        if used.sum() < min(coverage * len(item), len(item)):
            continue
        at = np.flatnonzero(used)
        cut = np.flatnonzero(np.diff(at) > 1) + 1
        text: list[int] = []
        for piece in np.split(at, cut):
            text.extend(doc[piece[0] : piece[-1] + 1])
            text.append(0)
        tiled = coverage_of(item, text, tile)
        if tiled >= coverage * len(item):
            out.append((item_id, len(item), tiled))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row per contaminated document: doc_id, item_ids (ascending), n_items, best_coverage."""
    pairs = contained_items(docs, benchmark, **how)
    return pairs.groupBy("doc_id").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"),
        F.countDistinct("item_id").alias("n_items"),
        F.max(F.col("n_tiled") / F.col("n_tokens")).alias("best_coverage"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, seed: int = 4, tile: int = 5, coverage: float = 0.6) -> DataFrame:
    """docs without the contaminated ones, judged row by row; nothing is shuffled."""
    for block in _blocks(benchmark):
        docs = docs.where(~F.coalesce(_holds(block, seed, tile, coverage)(F.col("text").cast("string")), F.lit(False)))
    return docs


def _holds(block: list[tuple[int, str]], seed: int, tile: int, coverage: float):
    tiler = _tiler(block, seed, tile, coverage)

    def holds(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            rows = pa.array(range(len(column)), pa.int64())
            hit = {i for b in tiler([pa.record_batch([rows, column], ["doc_id", "text"])]) for i in b.column(0).to_pylist()}
            yield pa.array([i in hit for i in range(len(column))], pa.bool_())

    work = tidy(holds)
    work.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(work, "boolean")
