"""Interpolated modified Kneser-Ney word model, counted in Spark and mapped by workers.

Any order from 2. Words and their n-grams are counted as sorted arrays: a map task sends,
for each shard of the hash range, the distinct entries it met with their counts;
a shard's task adds them up. Nothing passes through the driver but the number of
entries a shard and the counts of counts, and no shard holds more than its share, as
entries are dealt by a hash of their own. The model is families of files in the
shared folder, of one file a shard: words (hash, count, id; context total, how many follow
once, twice, more often, how many precede), and for each length from 3 the contexts
(hash, how many follow; where these are many, total, once, twice) with the last words of
their n-grams and these n-grams' counts side by side. A bigram's count lies beside the context that it is.
Counts take one byte, with a list of those that are larger. Workers map the files and
read the pages they touch. Each length is counted in an action of its own, the longest
in passes over the texts, each of which takes its share of the shards.

    P(w|v) = max(c(vw) - D(c), 0) / c(v.) + (D1 N1(v) + D2 N2(v) + D3 N3(v)) / c(v.) * P(w)
    P(w)   = max(N(.w) - E(N), 0) / N(..) + (E1 M1 + E2 M2 + E3 M3) / N(..) / (V + 1)

Longer contexts go on in the same way: P(w|uv) is what c(uvw) leaves after discounts,
and its gamma(uv) times P(w|v). Below the highest order, c is the number of distinct words
before, or the plain count where the n-gram begins the text. k-grams are told apart by
64-bit hashes of their words.

After an unknown word, P(w) alone; an unseen longer context leaves P as it is. D and E are the usual estimates from counts of
counts, kept within 0 and the count they belong to.

A text is its words (A-Z lower-cased) and one end. Null text counts as empty: the
end alone. Without any training text the score is that of V = 0: log10(1) a token.
At most 2**32 distinct words.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, SortedTable, columns, narrow, write_columns
from .substring_dedup import expected_words
from .text import mix, streams, unmix

END, START = (np.uint64(x) for x in (0x656E645F6F665F74, 0x73746172745F6F66))
FLUSH = 3 << 20
SHARD = 22
U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)
ROW = "level long, shard long, keys binary, counts binary, info array<long>"
RAW = [np.uint64, None, np.uint32]  # hash, count, id
WORD = [None] * 5  # context total, followers by count (1, 2, more), words before; in order of RAW
GRAMS = [np.uint64, None, np.uint32, np.uint32, None, *[np.int64] * 4]  # contexts: hash, followers, where each block's n-grams begin; n-grams: last word, count; contexts of many: place, total, followers by count (1, 2)
PAIRS = [None, np.uint64, None]  # counts of the bigrams that are contexts; hash and count of others
BLOCK = MANY = 8
PASSES = 2


def _pack(values: np.ndarray, counts: np.ndarray | None = None) -> bytes:
    """Sorted values as compressed differences, byte planes apart."""
    data = np.diff(values, prepend=values.dtype.type(0)) if counts is None else values
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(data).view(np.uint8).reshape(-1, data.dtype.itemsize).T.tobytes())


def _unpack(data: bytes, dtype, differences: bool = True) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    values = raw.reshape(np.dtype(dtype).itemsize, -1).T.copy().view(dtype).ravel()
    return np.cumsum(values, dtype=dtype) if differences else values


def _parts(keys: np.ndarray, bits: int):
    """(shard, from, to) of runs of sorted keys."""
    shards = SortedTable.shard(keys, bits)
    cuts = np.flatnonzero(np.diff(shards)) + 1
    return [(int(shards[a]), a, b) for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True)] if len(keys) else []


def _sum(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[first], *(np.add.reduceat(c[order].astype(np.int64), first) if len(first) else c.astype(np.int64) for c in counts)


def _context(ids: list[np.ndarray]) -> np.ndarray:
    """Hash of two words or more."""
    key = mix(ids[0].astype(np.uint64) << U(32) | ids[1].astype(np.uint64))
    for x in ids[2:]:
        key = mix(key + GOLDEN * (x.astype(np.uint64) + U(1)))
    return key


def _at(keys: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of want are among sorted keys, and the places of these."""
    at = np.searchsorted(keys, want)
    hit = np.flatnonzero(at < len(keys))
    hit = hit[keys[at[hit]] == want[hit]]
    return hit, at[hit]


def _within(values: np.ndarray, start: np.ndarray, stop: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same, each of want in its own sorted range of values."""
    low, high = start.copy(), stop.copy()
    live = np.flatnonzero(low < high)
    while len(live):
        mid = (low[live] + high[live]) // 2
        less = values[mid] < want[live]
        low[live[less]] = mid[less] + 1
        high[live[~less]] = mid[~less]
        live = live[low[live] < high[live]]
    hit = np.flatnonzero(low < stop)
    hit = hit[values[low[hit]] == want[hit]]
    return hit, low[hit]


class Files:
    """A family of column files, one a shard."""

    def __init__(self, scratch: Scratch, name: str, bits: int, shards, types: list):
        self.uri, self.bits, self.shards, self.types = scratch.path(f"model/{name}"), bits, set(shards), types
        scratch.publish([f"model/{name}-{s}.bin" for s in self.shards])

    def read(self, shard: int) -> list:
        return columns(f"{self.uri}-{shard}.bin", self.types)

    def parts(self, keys: np.ndarray):
        """(shard, from, to) of runs of sorted keys, where there are files."""
        return [x for x in _parts(keys, self.bits) if x[0] in self.shards]


def _sum_grams(ids: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct n-grams in order of their words, and the sums of their counts."""
    if len(ids) == 2:
        keys, counts = _sum(ids[0].astype(np.uint64) << U(32) | ids[1].astype(np.uint64), counts)
        return [(keys >> U(32)).astype(np.uint32), keys.astype(np.uint32)], counts
    order = np.lexsort(ids[::-1])
    ids = [x[order] for x in ids]
    first = np.flatnonzero(_changes(ids))
    return [x[first] for x in ids], np.add.reduceat(counts[order].astype(np.int64), first) if len(first) else counts.astype(np.int64)


def _count_grams(ranks: list[np.ndarray], ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The same for n-grams given by their words' ranks among sorted ids, once each; in one number where they fit."""
    width = max(len(ids) - 1, 1).bit_length()
    if width * len(ranks) > 64:
        return _sum_grams([ids[r] for r in ranks], np.ones(len(ranks[0]), np.int64))
    keys = reduce(lambda a, b: a << U(width) | b.astype(np.uint64), ranks[1:], ranks[0].astype(np.uint64))
    keys, counts = np.unique(keys, return_counts=True)
    mask = U((1 << width) - 1)
    return [ids[keys >> U(width * j) & mask] for j in range(len(ranks) - 1, -1, -1)], counts


def _changes(ids: list[np.ndarray]) -> np.ndarray:
    new = np.zeros(len(ids[0]), bool)
    new[:1] = True
    for x in ids:
        new[1:] |= x[1:] != x[:-1]
    return new


def _rows(ids: list[np.ndarray], counts: np.ndarray, bits: int, turn: int | None = None) -> list[tuple]:
    """Rows of ROW: distinct n-grams, in order of their words, for each shard of contexts; bigrams for each shard of their own. turn: of those shards only."""
    by = _context(ids if len(ids) == 2 else ids[:-1])
    if turn is not None:
        own = np.flatnonzero(SortedTable.shard(by, bits) % PASSES == turn)
        ids, counts, by = [x[own] for x in ids], counts[own], by[own]
    order = np.argsort(SortedTable.shard(by, bits), kind="stable")
    ids, counts = [x[order].astype(np.uint32) for x in ids], counts[order].astype(np.uint32)
    return [(len(ids), s, _pack(np.concatenate([x[a:b] for x in ids]), counts), _pack(counts[a:b], counts), []) for s, a, b in _parts(by[order], bits)]


def _table(rows: list[tuple]) -> pa.Table:
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(("level", "shard", "keys", "counts", "info"), types, strict=True))})


def _sentences(texts: pa.Array):
    """(first row, tokens of each row with START before and END after, all hashes) of runs of rows."""
    for row, counts, h in streams(texts, lower=True):
        sizes = counts + 2
        ends = np.cumsum(sizes)
        out = np.empty(int(ends[-1]), np.uint64)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = inner[ends - sizes] = False
        out[ends - 1], out[ends - sizes], out[inner] = END, START, h
        yield row, sizes, out


def _discounts(n: list[int]) -> tuple[float, float, float]:
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a else k * y
        out.append(min(max(d, 0.0), float(k)))
    return out[0], out[1], out[2]


class Model:
    """The files' places and the scalars of a trained model; small enough for a closure."""

    def __init__(self, raw: Files, words: Files, pairs: Files, longer: list[tuple[int, Files, tuple]], tokens: int, types: int, d, e, n_pairs: int, spread: float):
        self.raw, self.words, self.pairs, self.tokens, self.types = raw, words, pairs, tokens, types
        self.longer = longer  # length, its n-grams and their contexts, discounts
        self.d, self.e, self.n_pairs, self.spread = d, e, n_pairs, spread

    def _find_words(self, kinds: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        there = np.zeros(len(kinds), bool)
        v = {name: np.zeros(len(kinds), np.int64) for name in ("id", "c", "context", "n1", "n2", "n3", "before")}
        for s, a, b in self.raw.parts(kinds):
            keys, c, ids = self.raw.read(s)
            hit, at = _at(keys, kinds[a:b])
            there[a + hit] = True
            for x, values in zip(v.values(), (ids, c, *self.words.read(s)), strict=True):
                x[a + hit] = values[at]
        return there, v

    def _count_pairs(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for s, a, b in self.pairs.parts(keys):
            n, rest, n_rest = self.pairs.read(s)
            kinds = [(rest, n_rest)]
            if self.longer and s in self.longer[0][1].shards:
                kinds.append((self.longer[0][1].read(s)[0], n))
            for hashes, values in kinds:
                hit, at = _at(hashes, keys[a:b])
                out[a + hit] = values[at]
        return out

    def _follow(self, grams: Files, keys: np.ndarray, last: np.ndarray, known: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """For each key of a context, the context's totals, and the count of its n-gram with this last word."""
        order = np.argsort(keys)
        new = _changes([keys[order]])
        kinds, back = keys[order[new]], np.empty(len(keys), np.int64)
        back[order] = np.cumsum(new) - 1
        v = {name: np.zeros(len(kinds), np.int64) for name in ("total", "n1", "n2", "n", "start")}
        seen = np.zeros(len(keys), np.int64)
        order = order[known[order]]
        for s, a, b in grams.parts(kinds):
            hashes, n, blocks, lasts, counts, places, *many = grams.read(s)
            hit, at = _at(hashes, kinds[a:b])
            if not len(hit):
                continue
            first = at // BLOCK * BLOCK
            start, size = blocks[at // BLOCK].astype(np.int64), n[at]
            for j in range(BLOCK - 1):
                some = np.flatnonzero(first + j < at)
                start[some] += n[first[some] + j]
            found = {name: np.zeros(len(at), np.int64) for name in ("total", "n1", "n2")} | {"n": size, "start": start}
            for j in range(MANY):
                some = np.flatnonzero((size > j) & (size <= MANY))
                c = counts[start[some] + j]
                for name, x in zip(found, (c, c == 1, c == 2), strict=False):
                    found[name][some] += x
            some = np.flatnonzero(size > MANY)
            for name, x in zip(found, many, strict=False):
                found[name][some] = x[np.searchsorted(places, at[some])]
            for name, x in found.items():
                v[name][a + hit] = x
            own = order[slice(*np.searchsorted(back[order], (a, b)))]
            start, stop = v["start"][back[own]], v["start"][back[own]] + v["n"][back[own]]
            hit, at = _within(lasts, start, stop, last[own].astype(np.uint32))
            seen[own[hit]] = counts[at]
        return {name: x[back] for name, x in v.items()}, seen

    def score(self, texts: pa.Array) -> list[np.ndarray]:
        """For each row: tokens, known tokens, base log10 probability, model log10 probability."""
        out: list[list[np.ndarray]] = [[], [], [], []]
        d, e = np.array([0.0, *self.d]), np.array([0.0, *self.e])
        for _, sizes, h in _sentences(texts):
            kinds, at = np.unique(h, return_inverse=True)
            there, v = self._find_words(kinds)
            ends = np.cumsum(sizes)
            token = np.ones(len(h), bool)
            token[ends - sizes] = False
            now = np.flatnonzero(token)
            w, before = at[now], at[now - 1]
            c = v["c"][w]
            n = v["before"].astype(np.float64)
            lower = np.full(len(kinds), 1.0)
            if self.n_pairs:
                lower = np.maximum(n - e[np.minimum(v["before"], 3)], 0) / self.n_pairs + self.spread / (self.types + 1)
            lower = lower[w]
            context = v["context"][before].astype(np.float64)
            both = there[w] & there[before]
            key = mix(v["id"][before[both]].astype(np.uint64) << U(32) | v["id"][w[both]].astype(np.uint64))
            seen = np.zeros(len(now), np.int64)
            if len(key):
                some, back = np.unique(key, return_inverse=True)
                seen[both] = self._count_pairs(some)[back]
            with np.errstate(divide="ignore", invalid="ignore"):
                gamma = (d[1] * v["n1"][before] + d[2] * v["n2"][before] + d[3] * v["n3"][before]) / context
                p = np.maximum(seen - d[np.minimum(seen, 3)], 0) / context + gamma * lower
            p = np.where(context > 0, p, lower)
            ids, known = v["id"][at], there[at]
            place = now - np.repeat(ends - sizes, sizes - 1)
            for k, grams, discounts in self.longer:
                some = place >= k - 1
                for j in range(1, k):
                    some[some] = known[now[some] - j]
                some = np.flatnonzero(some)
                if not len(some):
                    continue
                dk = np.array([0.0, *discounts])
                key = _context([ids[now[some] - j] for j in range(k - 1, 0, -1)])
                of, seen = self._follow(grams, key, ids[now[some]], known[now[some]])
                met = np.flatnonzero(of["total"] > 0)
                some, seen, of = some[met], seen[met], {name: x[met] for name, x in of.items()}
                gamma = dk[1] * of["n1"] + dk[2] * of["n2"] + dk[3] * (of["n"] - of["n1"] - of["n2"])
                p[some] = (np.maximum(seen - dk[np.minimum(seen, 3)], 0) + gamma * p[some]) / of["total"]
            base = np.log10((c + 0.1) / (self.tokens + 0.1 * (self.types + 1)))
            first = ends - sizes - np.arange(len(sizes))
            out[0].append(sizes - 1)
            for k, x in enumerate(((c > 0).astype(np.int64), base, np.log10(p)), 1):
                out[k].append(np.add.reduceat(x, first))
        return [np.concatenate(x) if x else np.zeros(0) for x in out]


def train(texts: DataFrame, scratch: Scratch, order: int = 2) -> Model:
    """texts: one string column. Counts every row."""
    if order < 2:
        raise ValueError("order must be 2 at least")
    bits = max(0, int(max(expected_words(texts.toDF("text")), 1)).bit_length() - SHARD)
    spark, uri = scratch.spark, scratch.path("model")
    parallel = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def count_words(batches):
        held, n = [], 0

        def emit():
            u, c = np.unique(np.concatenate(held), return_counts=True)
            parts = _parts(u, bits)
            return pa.record_batch(
                [pa.array([s for s, _, _ in parts], pa.int64()), pa.array([_pack(u[a:b]) for _, a, b in parts], pa.binary()), pa.array([_pack(c[a:b].astype(np.uint32), c) for _, a, b in parts], pa.binary())],
                ["shard", "keys", "counts"],
            )

        for batch in batches:
            for _, _, h in _sentences(batch.column(0)):
                held.append(h)
                n += len(h)
                if n >= FLUSH:
                    yield emit()
                    held, n = [], 0
        if n:
            yield emit()

    def add_words(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        keys = np.concatenate([_unpack(x.as_py(), np.uint64) for x in group["keys"]])
        counts = np.concatenate([_unpack(x.as_py(), np.uint32, False) for x in group["counts"]])
        keys, counts = _sum(keys, counts)
        if len(keys) >= 1 << (32 - bits):
            raise ValueError("more than 2**32 distinct words")
        # common words first, so that ids in a shuffle compress well
        ids = np.empty(len(keys), np.uint32)
        ids[np.argsort(-counts, kind="stable")] = np.arange(len(keys), dtype=np.uint32)
        write_columns(f"{uri}/raw-{shard}.bin", keys, narrow(counts), ids | np.uint32(shard << (32 - bits)) if bits else ids)
        special = np.isin(keys, [START])
        return pa.table({"shard": [shard], "tokens": [int(counts[~special].sum())], "types": [int((~special).sum())]}, pa.schema([("shard", pa.int64()), ("tokens", pa.int64()), ("types", pa.int64())]))

    made = texts.mapInArrow(count_words, "shard long, keys binary, counts binary").groupBy("shard").applyInArrow(add_words, "shard long, tokens long, types long").collect()
    raw = Files(scratch, "raw", bits, [r["shard"] for r in made], RAW)

    def ids_of(kinds: np.ndarray) -> np.ndarray:
        out = np.zeros(len(kinds), np.uint32)
        for s, a, b in raw.parts(kinds):
            keys, _, ids = raw.read(s)
            hit, at = _at(keys, kinds[a:b])
            out[a + hit] = ids[at]
        return out

    tokens, types = sum(r["tokens"] for r in made), sum(r["types"] for r in made)

    def count_grams(turn: int | None):
        """Rows of ROW; of the longest n-grams, those in this turn's shards."""

        def count(batches):
            held, starts, n = [], [], 0

            def emit():
                h, start = np.concatenate(held), np.concatenate(starts)
                kinds, at = np.unique(h, return_inverse=True)
                ids, i = ids_of(kinds), np.arange(len(h))
                by = np.argsort(ids)
                ranks = np.empty(len(ids), np.int64)
                ranks[by] = np.arange(len(ids))
                ids, ranks = ids[by], ranks[at]
                place = i - np.maximum.accumulate(np.where(start, i, 0))
                rows = []
                for k in range(order if turn else 2, order + 1):  # shorter ones only where they begin the text
                    to = np.flatnonzero(place >= k - 1 if k == order else place == k - 1)
                    if len(to):
                        rows += _rows(*_count_grams([ranks[to - j] for j in range(k - 1, -1, -1)], ids), bits, turn if k == order else None)
                return _table(rows).combine_chunks().to_batches()

            for batch in batches:
                for _, sizes, h in _sentences(batch.column(0)):
                    start = np.zeros(len(h), bool)
                    start[np.cumsum(sizes) - sizes] = True
                    held.append(h)
                    starts.append(start)
                    n += len(h)
                    if n >= FLUSH:
                        yield from emit()
                        held, starts, n = [], [], 0
            if n:
                yield from emit()

        return count

    def add_grams(k: int):
        def add(group: pa.Table) -> pa.Table:
            if group["level"][0].as_py() != k:
                return group
            shard = group["shard"][0].as_py()
            got = [_unpack(x.as_py(), np.uint32, False).reshape(k, -1) for x in group["keys"]]
            counts = np.concatenate([_unpack(x.as_py(), np.uint32, False) for x in group["counts"]])
            ids = [np.concatenate([x[j] for x in got]) for j in range(k)]
            del got
            # contexts in order of their hashes, their n-grams in order of the last word
            context, group = np.unique(_context(ids[:-1]), return_inverse=True)
            keys = group.astype(np.uint64) << U(32) | ids[-1].astype(np.uint64)
            by = np.argsort(keys)
            keys = keys[by]
            distinct = np.flatnonzero(_changes([keys]))
            counts = np.add.reduceat(counts[by].astype(np.int64), distinct)
            ids = [x[by[distinct]] for x in ids]
            first = np.flatnonzero(_changes([keys[distinct] >> U(32)]))
            one, two = counts == 1, counts == 2
            n = np.diff(np.append(first, len(counts)))
            total, ones, twos = (np.add.reduceat(x.astype(np.int64), first) for x in (counts, one, two))
            places = np.flatnonzero(n > MANY)
            many = [x[places] for x in (total, ones, twos)]
            write_columns(f"{uri}/grams{k}-{shard}.bin", context, narrow(n), first[::BLOCK].astype(np.uint32), ids[-1].astype(np.uint32), narrow(counts), places, *many)
            info = [shard, *(int((counts == x).sum()) for x in (1, 2, 3, 4))]
            return _table([*_rows(*_sum_grams(ids[1:], np.ones(len(counts), np.int64)), bits), (0, -k, b"", b"", info)])

        return add

    def add_pairs(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        keys = np.concatenate([_context(list(_unpack(x.as_py(), np.uint32, False).reshape(2, -1))) for x in group["keys"]])
        counts = np.concatenate([_unpack(x.as_py(), np.uint32, False) for x in group["counts"]])
        keys, counts = _sum(keys, counts)
        rest, n = np.ones(len(keys), bool), counts[:0]
        if longer and shard in longer[0][1].shards:
            at = np.searchsorted(keys, longer[0][1].read(shard)[0])  # a context of two words is a bigram
            rest[at], n = False, counts[at]
        write_columns(f"{uri}/pairs-{shard}.bin", narrow(n), keys[rest], narrow(counts[rest]))
        keys = unmix(keys)
        a, b = (keys >> U(32)).astype(np.uint32), (keys & U(0xFFFFFFFF)).astype(np.uint32)
        one, two = counts == 1, counts == 2
        firsts = _sum(a, counts, one, two, ~(one | two))
        seconds = _sum(b, np.ones(len(b), np.int64))
        to = [(-1, b"", [b""] * 5, [len(keys), *(int((counts == k).sum()) for k in (1, 2, 3, 4))], shard)]
        for part, kind in ((firsts, 0), (seconds, 1)):
            for s, x, y in _parts(part[0].astype(np.uint64) << U(32), bits):
                blobs = [_pack(v[x:y].astype(np.uint64), v) for v in part[1:]]
                to.append((s, _pack(part[0][x:y]), blobs, [kind], shard))
        return pa.table(
            {"shard": pa.array([t[0] for t in to], pa.int64()), "keys": pa.array([t[1] for t in to], pa.binary()), "counts": pa.array([t[2] for t in to], pa.list_(pa.binary())), "info": pa.array([t[3] for t in to], pa.list_(pa.int64())), "source": pa.array([t[4] for t in to], pa.int64())}
        )

    def close(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        if shard < 0:  # one row a shard of pairs
            info = np.array(group["info"].to_pylist(), np.int64).sum(axis=0)
            return pa.table({"shard": pa.array([-1], pa.int64()), "info": pa.array([info.tolist() + group["source"].to_pylist()], pa.list_(pa.int64()))})
        ids = raw.read(shard)[2].astype(np.int64)
        base, n = int(ids.min()), len(ids)
        totals = [np.zeros(n, np.int64) for _ in range(5)]
        for keys, counts, info in zip(group["keys"], group["counts"], group["info"], strict=True):
            at = _unpack(keys.as_py(), np.uint32).astype(np.int64) - base
            names = range(4) if info.as_py()[0] == 0 else (4,)
            for k, blob in zip(names, counts.as_py(), strict=False):
                totals[k][at] += _unpack(blob, np.uint64, False).astype(np.int64)
        write_columns(f"{uri}/words-{shard}.bin", *(narrow(x[ids - base]) for x in totals))
        before = totals[4]
        return pa.table({"shard": pa.array([shard], pa.int64()), "info": pa.array([[*(int((before == k).sum()) for k in (1, 2, 3, 4)), int((before > 2).sum())]], pa.list_(pa.int64()))})

    longer: list[tuple[int, Files, tuple]] = []
    if order == 2:
        counted = texts.mapInArrow(count_grams(None), ROW)
    else:
        turns = range(PASSES) if bits else [None]
        for k in range(order, 2, -1):
            parts = [texts.mapInArrow(count_grams(t), ROW) for t in turns] if k == order else [counted]
            saved = []
            for t, part in enumerate(parts):  # a table each, so that one turn's shuffle files go before the next begins
                added = part.repartition(parallel, "level", "shard").groupBy("level", "shard").applyInArrow(add_grams(k), ROW)
                saved.append(scratch.save(added, f"level-{k}/{t}", "uncompressed"))
            every = reduce(DataFrame.unionAll, saved)
            info = np.array([r["info"] for r in every.where("level = 0").select("info").collect()], np.int64).reshape(-1, 5)
            longer.insert(0, (k, Files(scratch, f"grams{k}", bits, info[:, 0].tolist(), GRAMS), _discounts(info[:, 1:].sum(axis=0).tolist())))
            counted = every.where("level > 0")
            scratch.drop(f"level-{k + 1}")
    added = counted.select("shard", "keys", "counts").repartition(parallel, "shard").groupBy("shard")
    added = added.applyInArrow(add_pairs, "shard long, keys binary, counts array<binary>, info array<long>, source long")
    done = added.groupBy("shard").applyInArrow(close, "shard long, info array<long>").collect()
    parts = {r["shard"]: r["info"] for r in done}
    total = parts.pop(-1, [0] * 5)
    m = [sum(x[k] for x in parts.values()) for k in range(5)]
    d, e = _discounts(total[1:5]), _discounts(m[:4])
    spread = (e[0] * m[0] + e[1] * m[1] + e[2] * m[4]) / total[0] if total[0] else 1.0
    words = Files(scratch, "words", bits, parts, WORD)
    raw.shards &= words.shards
    pairs = Files(scratch, "pairs", bits, total[5:], PAIRS)
    scratch.drop("level-3")
    return Model(raw, words, pairs, longer, tokens, types, d, e, total[0], spread)


def score_documents(docs: DataFrame, held_out: Column, order: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    The model learns from the documents of which held_out is false (null counts as false).
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    scratch = Scratch(docs.sparkSession, "kneser-ney")
    model = train(docs.where("NOT held_out").select("text"), scratch, order)

    def score(batches):
        for batch in batches:
            n, known, base, own = model.score(batch.column(2))
            total = np.full(len(n), model.tokens)
            columns = [n.astype(np.int64), known.astype(np.int64), total.astype(np.int64), base.astype(float), own.astype(float), 10 ** (-own / n) if len(n) else own.astype(float)]
            yield pa.record_batch([batch.column(0), batch.column(1), *map(pa.array, columns)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    shape = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return scratch.finish(docs.mapInArrow(score, shape), "model")
