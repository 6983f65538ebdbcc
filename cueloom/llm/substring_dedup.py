"""Substring dedup: remove words of repeated word windows, all but the first document's.

A window is ``k`` consecutive words of one document. Two passes: merged
partition count-min sketches overestimate how often each window occurs, then
only windows estimated to occur twice are grouped exactly, by a 96-bit hash of
their words, for the smallest and largest doc_id they start in. A window whose
two differ is kept as (hash, smallest doc_id) in sorted arrays that workers map
while they cover words. No key is ever gathered in one task: the group step is a
minimum and a maximum, combined before the shuffle.

Null text has no words. A null doc_id never precedes another and its document is
judged against all others. Rows that share a doc_id are one document.
Repeated rows give repeated results. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, SortedTable
from .sketch import CountMin
from .text import left_in_row, mix, rolling, streams

LAST = (1 << 63) - 1


def _windows(texts: pa.Array, k: int):
    """(first row, words a row, valid window starts, their hashes, second hashes) of runs of rows."""
    for row, counts, h in streams(texts):
        at = np.flatnonzero(left_in_row(counts) >= k)
        got = rolling(h, k)[at] if len(at) else np.zeros(0, np.uint64)
        yield row, counts, h, at, got


def _second(h: np.ndarray, k: int, at: np.ndarray) -> np.ndarray:
    """32 further bits of each window, from other word values."""
    return (rolling(mix(h, 0x51ED270B), k)[at] >> np.uint64(32)).astype(np.uint32)


def expected_words(docs: DataFrame) -> int:
    return int(docs.select(F.sum(F.length("text"))).first()[0] or 0) // 5


def substring_dedup(docs: DataFrame, k: int = 13, cells_per_window: float = 4.0, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, if asked for, the kept text."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scratch = Scratch(spark, "substring-dedup")
    sketch = CountMin.build(
        scratch, "sketch/s", docs.select("text"), lambda b: (got for *_, got in _windows(b.column(0), k)), expected_words(docs), cells_per_window, bits=True
    )

    def repeated(batches):
        for batch in batches:
            ids = batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
            for row, counts, h, at, got in _windows(batch.column(1), k):
                twice = sketch.estimate(got) > 0
                if not twice.any():
                    continue
                doc = np.repeat(ids[row : row + len(counts)], counts)[at[twice]]
                yield pa.record_batch(
                    [pa.array(got[twice].view(np.int64)), pa.array(_second(h, k, at[twice]).view(np.int32)), pa.array(doc)], ["h", "h2", "doc"]
                )

    groups = docs.mapInArrow(repeated, "h long, h2 int, doc long").groupBy("h", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    found = scratch.save(groups.where("first < last").select("h", F.col("h2").cast("long").alias("h2"), "first"), "repeats")
    n = found.count()
    # two windows that share 64 bits but not 96 stay apart: the table's key takes both in
    keyed = found.select(F.xxhash64("h", "h2").alias("h"), "h2", "first")
    table = SortedTable.build(scratch, "table/t", keyed, max(0, int(n).bit_length() - 19), [("h2", "int32"), ("first", "int64")])
    scratch.drop("repeats")
    from .xx64 import xxhash64_pair

    def cover(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            own = ids.fill_null(LAST).to_numpy(zero_copy_only=False)
            n_words, n_removed, shas, kept = [], [], [], []
            for row, counts, h, at, got in _windows(texts, k):
                covered = np.zeros(len(h) + 1, np.int32)
                twice = np.flatnonzero(sketch.estimate(got) > 0) if len(got) else np.zeros(0, int)
                if len(twice):
                    second = _second(h, k, at[twice]).view(np.int32)
                    there, value = table.find(xxhash64_pair(got[twice], second))
                    doc = np.repeat(own[row : row + len(counts)], counts)[at[twice]]
                    start = at[twice][there & (value["h2"] == second) & (value["first"] < doc)]
                    np.add.at(covered, start, 1)
                    np.add.at(covered, start + k, -1)
                keep = np.cumsum(covered[:-1]) == 0
                edge = np.concatenate([[0], np.cumsum(counts)])
                for i, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
                    words = (texts[row + i].as_py() or "").encode().split()
                    stays = keep[a:b]
                    gone = int(b - a - stays.sum())
                    text = b" ".join(compress(words, stays.tolist()) if gone else words)
                    n_words.append(len(words))
                    n_removed.append(gone)
                    shas.append(hashlib.sha256(text).hexdigest())
                    if with_text:
                        kept.append(text.decode())
            columns = [ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(shas, pa.string())]
            yield pa.record_batch(columns + [pa.array(kept, pa.string())] * with_text, ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["text"] * with_text)

    shape = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    return scratch.finish(docs.mapInArrow(cover, shape), "table", "sketch")
