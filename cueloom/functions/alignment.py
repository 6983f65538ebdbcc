"""Word alignment: one Arrow function each for the edit script and for reconciled timings.

Both work on pairs of word lists inside one row; nothing is shuffled. A longest common subsequence is found with a
bit for each cell of the table instead of a number: a row says where its values rise by one, and is made from the
one before it by a few operations on whole integers. The way back needs these bits only. Lists of up to BLOCK words
keep all rows; of longer ones each BLOCK-th row is kept and those between are made again on the way back, so memory grows with
the length of a list, not with the product of two. Timed words are read from and built as flat Arrow columns.
"""

from __future__ import annotations

from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import WORDS_SQL
from .text import col

SCRIPT = "array<struct<op:string,original_index:int,patched_index:int,word:string>>"
BLOCK = 512
OFTEN = 8  # words with more places than this keep their places as bits


class _Table:
    """Rows of the table of b's prefixes (a bit each, 0 where the value rises) for the prefixes of a."""

    def __init__(self, a: list[str], b: list[str]):
        self.a, self.full = a, (1 << len(b)) - 1
        self.places: dict[str, list[int]] = {}
        for j, w in enumerate(b):
            self.places.setdefault(w, []).append(j)
        self.often: dict[str, int] = {}
        self.kept = [self.full]
        row = self.full
        for i in range(len(a)):
            row = self._next(row, a[i])
            if (i + 1) % BLOCK == 0:
                self.kept.append(row)
        self.start, self.rows = -1, []

    def _match(self, word: str) -> int:
        got = self.often.get(word)
        if got is None:
            places = self.places.get(word, ())
            got = sum(1 << j for j in places) if len(places) <= OFTEN else int.from_bytes(np.packbits(np.bincount(places), bitorder="little").tobytes(), "little")
            if len(places) > OFTEN:
                self.often[word] = got
        return got

    def _next(self, row: int, word: str) -> int:
        hit = row & self._match(word)
        return (row + hit | row - hit) & self.full if hit else row

    def rises(self, i: int, j: int) -> bool:
        """Whether the first i words of a have more in common with the first j of b than with the first j - 1."""
        at = (i - 1) // BLOCK
        if at != self.start:
            self.start, self.rows = at, [self.kept[at]]
            for word in self.a[at * BLOCK : (at + 1) * BLOCK]:
                self.rows.append(self._next(self.rows[-1], word))
            self.rows = [r.to_bytes(self.full.bit_length() // 8 + 1, "little") for r in self.rows]
        return not self.rows[i - at * BLOCK][(j - 1) >> 3] >> ((j - 1) & 7) & 1


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence; walking back, a tie leaves the second list's word out first."""
    n, m = len(a), len(b)
    while n and m and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    ends = [(n + k, m + k) for k in range(len(a) - n)]  # walked back over without a choice
    if not n or not m:
        return ends
    table, pairs, i, j = _Table(a[:n], b[:m]), [], n, m
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif table.rises(i, j):  # so the value comes from above
            i -= 1
        else:
            j -= 1
    return pairs[::-1] + ends


def edit_script(a: list[str], b: list[str]) -> list[tuple[str, int | None, int | None, str]]:
    """keep, remove and add steps; at a divergence all removals come first."""
    out: list[tuple[str, int | None, int | None, str]] = []
    i = j = 0
    for p, q in [*common(a, b), (len(a), len(b))]:
        out += [("remove", k, None, a[k]) for k in range(i, p)]
        out += [("add", None, k, b[k]) for k in range(j, q)]
        if p < len(a) and q < len(b):
            out.append(("keep", p, q, a[p]))
        i, j = p + 1, q + 1
    return out


def changes(a: list[str], b: list[str]) -> tuple[int, int]:
    """(length of the common subsequence, most steps in a row that keep nothing)."""
    kept = common(a, b)
    gaps = pairwise([(-1, -1), *kept, (len(a), len(b))])
    return len(kept), max(to - p - 1 + until - q - 1 for (p, q), (to, until) in gaps)


#: Columns of timed words: word, start, end, speaker, score.
Columns = tuple[list, list, list, list, list]


def _shared(out: Columns, lead: tuple, followers: list[str]) -> None:
    """Add a timed word and those that follow it without times: each takes the later half of what its predecessor has left."""
    word, start, end, speaker, score = lead
    cuts = None
    if followers and start is not None and end is not None:
        cuts, score = [*accumulate(followers, lambda cut, _: (cut + end) / 2, initial=start), end], None
    n = len(followers)
    out[0].extend([word, *followers])
    out[1].extend(cuts[:-1] if cuts else [start, *[None] * n])
    out[2].extend(cuts[1:] if cuts else [end, *[None] * n])
    out[3].extend([speaker] * (n + 1))
    out[4].extend([score, *[None] * n])


def reconcile(words: Columns, patched: list[str], seg_start: float | None, out: Columns) -> None:
    """Add to out the patched words with timings carried over from the original ones.

    Kept words cut both lists into blocks. A block's lead is its kept word, which lasts until
    the end of the words removed behind it; before the first kept word it is the first added
    one, which takes the whole span removed there, or the segment's start. The other added
    words of a block share the lead's time. If words are removed from the front and none is
    added, the first kept word starts where they did.
    """
    word, start, end, speaker, score = words
    n, m = len(word), len(patched)
    if n == m:
        for to, column in zip(out, (patched, start, end, speaker, score), strict=True):
            to.extend(column)
        return
    for (p, q), (to, until) in pairwise([(-1, -1), *common(word, patched), (n, m)]):
        new = patched[q + 1 : until]
        last = next((end[k] for k in range(to - 1, p, -1) if end[k] is not None), None)
        if p >= 0:
            lead = [word[p], start[p], end[p], speaker[p], score[p]]
            if q == 0 < p:
                lead[1], lead[4] = start[p] if start[0] is None else start[0], None
            if p + 1 < to:
                lead[2], lead[4] = end[p] if last is None else last, None
        elif new:
            first, *new = new
            lead = [first, start[0], last, speaker[0], None] if to > 0 else [first, seg_start, seg_start, None, None]
        else:
            continue
        _shared(out, tuple(lead), new)


def reconciled(words: list[dict], patched: list[str], seg_start: float | None) -> list[dict]:
    """:func:`reconcile` for words as mappings."""
    names, out = ("word", "start", "end", "speaker", "score"), ([], [], [], [], [])
    reconcile(tuple([w[k] for w in words] for k in names), patched, seg_start, out)
    return [dict(zip(names, row, strict=True)) for row in zip(*out, strict=True)]


def flat_lists(column: pa.Array) -> tuple[np.ndarray, pa.Array, list[bool]]:
    """Offsets and flat values of a list column, and which rows are there."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = column.offsets.to_numpy()
    return at - at[0], column.values.slice(at[0], at[-1] - at[0]), column.is_valid().to_pylist()


def listed(counts: list[int | None], values: pa.Array) -> pa.Array:
    """Flat values as lists of so many each; None is a null."""
    ends = np.cumsum([0, *(n or 0 for n in counts)])
    at = pa.array(np.where([*(n is None for n in counts), False], 0, ends), pa.int32(), mask=np.array([*(n is None for n in counts), False]))
    return pa.ListArray.from_arrays(at, values)


def _script(a: pa.Array, b: pa.Array) -> pa.Array:
    counts, out = [], ([], [], [], [])
    for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
        script = None if x is None or y is None else edit_script(x, y)
        counts.append(None if script is None else len(script))
        for step in script or ():
            for to, v in zip(out, step, strict=True):
                to.append(v)
    kinds = {"op": pa.string(), "original_index": pa.int32(), "patched_index": pa.int32(), "word": pa.string()}
    return listed(counts, pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(out, kinds.values(), strict=True)], list(kinds)))


def _changes(a: pa.Array, b: pa.Array) -> pa.Array:
    got = [(None, None) if x is None or y is None else changes(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)]
    return pa.StructArray.from_arrays([pa.array([x for x, _ in got], pa.int32()), pa.array([x for _, x in got], pa.int32())], ["lcs", "max_run"])


def _reconciled(words: pa.Array, patched: pa.Array, starts: pa.Array) -> pa.Array:
    at, flat, there = flat_lists(words)
    columns = tuple(flat.field(k).to_pylist() for k in ("word", "start", "end", "speaker", "score"))
    to, new, given = flat_lists(patched)
    new, counts, out = new.to_pylist(), [], ([], [], [], [], [])
    for i, start in enumerate(starts.to_pylist()):
        if not there[i] or not given[i]:
            counts.append(None)
            continue
        before = len(out[0])
        reconcile(tuple(c[at[i] : at[i + 1]] for c in columns), new[to[i] : to[i + 1]], start, out)
        counts.append(len(out[0]) - before)
    kinds = {"word": pa.string(), "start": pa.float64(), "end": pa.float64(), "speaker": pa.string(), "score": pa.float64()}
    return listed(counts, pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(out, kinds.values(), strict=True)], list(kinds)))


def word_diff(a: Column | str, b: Column | str) -> Column:
    """The edit script of two word arrays, an array of struct(op, original_index, patched_index, word)."""
    return F.arrow_udf(_script, SCRIPT)(col(a), col(b))


def word_changes(a: Column | str, b: Column | str) -> Column:
    """struct(lcs, max_run) of two word arrays: two numbers come back from Python, not the script."""
    return F.arrow_udf(_changes, "lcs int, max_run int")(col(a), col(b))


def reconcile_words(words: Column | str, patched: Column | str, seg_start: Column | str) -> Column:
    """words brought in line with the patched word list. Equal counts keep all timings, without leaving the JVM."""
    w, p = col(words), col(patched)
    same = F.zip_with(w, p, lambda x, y: F.when(x.isNotNull(), x.withField("word", y)))
    changed = F.arrow_udf(_reconciled, WORDS_SQL)(F.when(F.size(w) != F.size(p), w), F.when(F.size(w) != F.size(p), p), col(seg_start))
    return F.when(F.size(w) == F.size(p), same).otherwise(changed)


def word_change_ratio(lcs: Column | str, n: Column | str, m: Column | str) -> Column:
    """Share of the longer word list outside the common subsequence."""
    most = F.greatest(col(n), col(m))
    return F.when(most == 0, F.lit(0.0)).when(F.least(col(n), col(m)) == 0, F.lit(1.0)).otherwise((most - col(lcs)) / most)
