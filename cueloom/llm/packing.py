"""Best-fit packing of token pieces by the sum-of-squares rule.

A document's token ids, then one end id, are cut into pieces of at most
``capacity`` tokens (the first may be shorter, the others are full). Full pieces
are sequences of their own. Every other piece goes where the squared counts of
open bins per residual gap become smallest: taking a bin with gap g down to
g - s changes the sum by 2 (N[g-s] - N[g]) + 2, filling it exactly by
1 - 2 N[g], a new bin by 2 N[capacity-s] + 1. Pieces come longest first, and a
new bin is opened only where no open one has room: sequences are to be few.

Packing needs lengths alone. Only the number of pieces of each length is
gathered: at most ``capacity`` rows, whatever the input. The rule runs once over
those counts, to the piece and by no other way for larger inputs, and gives a plan: how many sequences of each composition. The
pieces then take their places by rank within their length, which is a window per
length dealt over ``SALTS`` ranges, so no task holds all pieces of a length.

Null text counts as empty: one piece, the end id. Repeated rows are packed as
often as they occur. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import json
import sys
import zlib
from array import array
from collections import Counter
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, tidy

MOST_CACHED = 400_000
SALTS = 64
# Fixed value: the public byte-level BPE pre-tokenizer's pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace()]


class _Words(dict):
    """Ids, as bytes, of words with the space in front of them."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        got = self[word] = array("I", self.encode(" " + word)).tobytes()
        return got


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, with a memo of words.

    A boundary in front of a single space between two non-space characters is
    always a boundary of the byte-level pre-tokenizer, so a text may be cut there
    and its words encoded once each. Texts with other white space beside a space,
    or with a special token's string, are encoded whole. Where the file is a plain byte-level BPE
    whose merges stand in order of id, tiktoken runs the same vocabulary, several
    times as fast; otherwise the tokenizer itself does all.
    """

    def __init__(self, path: str, cached: int = MOST_CACHED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.encode_one = _ranked(path) or self._ids
        self.words = _Words(self.encode_one, cached)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return array("I", self._ids(text)).tobytes()
        if not text or text[0].isspace() or text[-1].isspace() or any(c in text and (c + " " in text or " " + c in text) for c in WHITE):
            return array("I", self.encode_one(text)).tobytes()
        first, *rest = text.split(" ")
        return array("I", self.encode_one(first)).tobytes() + b"".join(map(self.words.__getitem__, rest))


def _ranked(path: str):
    """tiktoken's encoder for a byte-level BPE file, or None where the file is of another kind."""
    spec = json.loads(Path(path).read_text())
    model, before = spec.get("model", {}), spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
    if not plain or spec.get("normalizer") or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")):
        return None
    vocabulary = {k: v for k, v in model["vocab"].items() if k not in {t["content"] for t in spec.get("added_tokens", [])}}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)) or len(vocabulary) != 256 + len(merges) or sys.byteorder != "little":
        return None
    shown = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]
    letters = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}
    import tiktoken

    ranks = {bytes(letters[c] for c in token): rank for token, rank in vocabulary.items()}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0, cached: int = MOST_CACHED) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. cached: words whose ids a task remembers."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    encoder: list[Encoder] = []
    last = np.array([end], "<u4").tobytes()

    def cut(batches):
        for batch in batches:
            if not encoder:
                encoder.append(Encoder(tokenizer, cached))
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder[0].encode(text or "") + last
                n = len(ids) // 4
                first = n % capacity or capacity
                for p, start in enumerate([0, *range(first, n, capacity)]):
                    to = first if not p else start + capacity
                    out.append((doc_id, p, start, to - start, zlib.crc32(ids[4 * start : 4 * to])))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(tidy(cut, encoder), "doc_id long, piece int, start long, length long, ids_crc32 long")


def _take(bins: list, g: int, to: int, size: int, n: int, done: Counter) -> None:
    """Put a piece of this size into each of n bins of gap g."""
    while n:
        what, there = bins[g][-1]
        k = min(there, n)
        n -= k
        bins[g][-1:] = [(what, there - k)] if there > k else []
        what = (*what, size)
        if not to:
            done[what] += k
        elif bins[to] and bins[to][-1][0] == what:
            bins[to][-1] = (what, bins[to][-1][1] + k)
        else:
            bins[to].append((what, k))


def _score(gaps: list, size: int, g: int) -> int:
    return 2 * (gaps[g - size] - gaps[g]) + 2 if g > size else 1 - 2 * gaps[g]


def _rounds(gaps: list, seen: dict, least: dict, taken: dict, most: int, size: int, left: int) -> int:
    """How many times more the choices since the snapshot (seen, least, taken, most) are sure to come again, in their order.

    They do if the scores of all gaps chosen have moved by one amount, as long as no
    other gap comes below them, none runs empty that did not, and pieces are left. A
    gap that ran empty does so again if it has as many bins as it had.
    """
    score = lambda g: _score(gaps, size, g)
    if len(moves := {score(g) - seen[g][0] for g in taken}) > 1 or any(not least[g] and gaps[g] != n for g, (_, n) in seen.items() if g >= size):
        return 0
    (d,) = moves
    m = left // sum(taken.values())
    for g, (_, n) in seen.items():
        if g >= size and gaps[g] < n:
            m = min(m, (least[g] - 1) // (n - gaps[g]))
    for g in range(size, len(gaps)):
        if g not in taken and (gaps[g] or g in seen and seen[g][1]):
            # a gap beside chosen ones falls by some amount a round
            ahead, nearer = score(g) - most, d - (score(g) - seen[g][0] if g in seen else 0)
            if ahead <= 0:
                return 0
            if nearer > 0:
                m = min(m, (ahead - 1) // nearer)
    return m


def _place(gaps: list, bins: list, done: Counter, size: int, left: int) -> int:
    """Put pieces of one size into open bins by the rule; returns how many found no room."""
    top = len(gaps) - 1

    def score(g: int) -> int | None:
        return _score(gaps, size, g) if size <= g <= top and gaps[g] else None

    now = [score(g) for g in range(top + 1)]
    heap = [(x, g) for g, x in enumerate(now) if x is not None]
    heapify(heap)
    seen, least, taken, most, anchor, age, limit = {}, {}, {}, 0, -1, 0, 4
    while left:
        while heap and now[heap[0][1]] != heap[0][0]:
            heappop(heap)
        if not heap:
            break
        best, g = heap[0]  # ties: the smallest gap
        if g == anchor and age and (m := _rounds(gaps, seen, least, taken, most, size, left)):
            moved = {h: gaps[h] - n for h, (_, n) in seen.items()}
            for h in sorted(taken, reverse=True):  # a gap receives before it gives
                _take(bins, h, h - size, size, m * taken[h], done)
            left -= m * sum(taken.values())
            for h, n in moved.items():
                gaps[h] += m * n
            for h in {x for h in moved for x in (h, h + size) if size <= x <= top}:
                now[h] = score(h)
                if now[h] is not None:
                    heappush(heap, (now[h], h))
            anchor = -1
            continue
        if anchor < 0 or age >= limit:
            limit = 4 if anchor < 0 else 2 * limit
            seen, least, taken, most, anchor, age = {}, {}, {}, best, g, 0
        heappop(heap)
        while heap and now[heap[0][1]] != heap[0][0]:
            heappop(heap)
        # how many times in a row this gap stays the best choice: its score rises, those a piece above and below fall
        rise, to = 4 if g > size else 2, g - size
        run = min(left, gaps[g])
        others = [(*heap[0], 0)] if heap else []
        others += [(now[h], h, 2) for h in (g + size, to) if size <= h <= top and now[h] is not None]
        for other, h, fall in others:
            run = min(run, (other - best) // (rise + fall) + 1 if h > g else -((best - other) // (rise + fall)))
        if to >= size and not gaps[to]:
            run = 1  # opens a gap that is a choice too
        run = max(run, 1)
        beside = [h for h in (to, g, g + size) if 0 < h <= top]
        for h in beside:
            if h not in seen:
                seen[h], least[h] = (_score(gaps, size, h), gaps[h]), gaps[h]
        _take(bins, g, to, size, run, done)
        left -= run
        gaps[g] -= run
        if to:
            gaps[to] += run
        taken[g] = taken.get(g, 0) + run
        most = max(most, best + rise * (run - 1))
        least[g] = min(least[g], gaps[g])
        age += 1
        for h in beside:
            if h >= size:
                now[h] = score(h)
                if now[h] is not None:
                    heappush(heap, (now[h], h))
    return left


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Compositions (lengths in order of placing) with how many sequences have each, by the sum-of-squares rule.

    Equal bins are kept together: a state is a gap with the compositions of its
    open bins. The result is that of the rule, piece by piece, whatever the counts.
    A length's pieces are placed in runs for which the best gap stays the same; where
    a row of choices has moved all gaps in it by one amount, it comes again until
    another gap is met or one runs empty, and those rounds are placed at once. So the
    work grows with the number of such events and not with that of pieces.
    """
    gaps = [0] * (capacity + 1)
    bins: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    done: Counter = Counter()
    for size in sorted(counts, reverse=True):
        left = counts[size]
        if size == capacity:
            done[(size,)] += left
            continue
        while left := _place(gaps, bins, done, size, left):
            # no open bin has room: new ones, of which each may hold several of this size
            each = capacity // size
            n = left // each
            if n and each > 1:
                # what single placing into bins of one's own comes to
                take, fill = n, (size,) * each
            else:
                take, fill = (left, (size,)) if each == 1 else (1, (size,) * left)
            left -= take * len(fill)
            g = capacity - size * len(fill)
            if g:
                bins[g].append((fill, take))
                gaps[g] += take
            else:
                done[fill] += take
            if not left:
                break
    for g in range(capacity + 1):
        for what, n in bins[g]:
            done[what] += n
    return sorted(done.items())


def pack(made: DataFrame, capacity: int = 2048) -> DataFrame:
    """made (with a column length of 1 to capacity) with sequence_id and offset appended. made is read twice and should be a written table."""
    counts = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}
    runs, base, ranks = [], 0, Counter()
    for lengths, n in plan(counts, capacity):
        offset = 0
        for size in lengths:
            # the pieces of this length with the next n ranks go to sequences base, base + 1, ...
            runs.append((size, ranks[size], base, offset))
            ranks[size] += n
            offset += size
        base += n
    runs.sort()
    keys = np.array([(size << 48) + first for size, first, _, _ in runs], np.int64)
    bases, offsets = (np.array([r[i] for r in runs], np.int64) for i in (2, 3))

    def find(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        key = (lengths.to_numpy(zero_copy_only=False).astype(np.int64) << 48) + ranks.to_numpy(zero_copy_only=False)
        at = np.searchsorted(keys, key, "right") - 1
        return pa.StructArray.from_arrays([pa.array(bases[at] + key - keys[at]), pa.array(offsets[at])], ["sequence_id", "offset"])

    find.__annotations__ = {"lengths": pa.Array, "ranks": pa.Array, "return": pa.Array}
    names = made.columns
    order = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in names]
    salted = made.withColumn("_s", F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int"))
    ranked = salted.withColumn("_r", F.row_number().over(Window.partitionBy("length", "_s").orderBy(*order)) - 1)
    before = Window.partitionBy("length").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    tally = salted.groupBy("length", "_s").count().select("length", "_s", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_b"))
    ranked = ranked.join(tally, ["length", "_s"]).withColumn("_p", F.arrow_udf(find, "sequence_id long, offset long")("length", F.col("_r") + F.col("_b")))
    return ranked.select(*names, "_p.sequence_id", "_p.offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0, cached: int = MOST_CACHED) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. cached: words whose ids a task remembers; fewer take less memory and more time."""
    scratch = Scratch(docs.sparkSession, "packing")
    return pack(scratch.save(pieces(docs, tokenizer, capacity, end, cached), "pieces"), capacity)
