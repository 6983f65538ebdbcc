"""A count-min sketch built from merged partition sketches and memory-mapped by workers.

Each map task emits, for each sketch row and segment of cells, the cells it
touched with their counts; segments are merged by a shuffle of their own and
written as byte arrays (counts stop at 255) or, for ``bits=True``, as one bit
for "2 or more". An estimate never lies below the true count, stopped at 255.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .scratch import Scratch, mapped, write_array

SEGMENT = 23
MOST_CELLS = 34
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
FLUSH = 1 << 21


class CountMin:
    def __init__(self, uri: str, width: int, depth: int, bits: bool, there: set[int]):
        self.uri, self.width, self.depth, self.bits, self.there = uri, width, depth, bits, there

    @property
    def segment(self) -> int:
        return min(self.width, SEGMENT)

    def cells(self, h: np.ndarray, row: int) -> np.ndarray:
        return (h * _ODD[row]) >> np.uint64(64 - self.width)

    def estimate(self, h: np.ndarray) -> np.ndarray:
        """Counts (bits: 1 for "2 or more", else 0), never too small."""
        least = np.full(len(h), 255, np.uint8)
        for row in range(self.depth):
            cells = self.cells(h, row)
            order = np.argsort(cells)
            cells = cells[order]
            segments = (cells >> np.uint64(self.segment)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(segments)) + 1
            got = np.zeros(len(h), np.uint8)
            for a, b in zip([0, *cuts], [*cuts, len(h)], strict=True) if len(h) else ():
                key = (row << 16) + int(segments[a])
                if key not in self.there:
                    continue
                cell = (cells[a:b] & np.uint64((1 << self.segment) - 1)).astype(np.int64)
                data = mapped(f"{self.uri}-{key}.bin", np.uint8)
                got[order[a:b]] = data[cell >> 3] >> (cell & 7).astype(np.uint8) & 1 if self.bits else data[cell]
            np.minimum(least, got, out=least)
        return least

    @classmethod
    def build(
        cls,
        scratch: Scratch,
        name: str,
        df: DataFrame,
        hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
        expected: int,
        per_item: float,
        depth: int = 2,
        bits: bool = False,
        flush: int = FLUSH,
    ) -> CountMin:
        """hashes: the items of a batch, as often as they count. per_item: cells of each row per expected item. flush: items that a task puts together before it sends their cells."""
        width = int(min(max(round(np.log2(max(expected, 1) * per_item)), 12), MOST_CELLS))
        uri, segment = scratch.path(name), min(width, SEGMENT)
        self = cls(uri, width, depth, bits, set())

        def emit(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            h = np.concatenate(parts)
            pack = zstandard.ZstdCompressor(1).compress
            for row in range(depth):
                cells, n = np.unique(self.cells(h, row), return_counts=True)
                n = np.minimum(n, 255).astype(np.uint8)
                segments = (cells >> np.uint64(segment)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(segments)) + 1
                keys, where, counts = [], [], []
                for a, b in zip([0, *cuts], [*cuts, len(cells)], strict=True):
                    own = (cells[a:b] & np.uint64((1 << segment) - 1)).astype(np.uint32)
                    keys.append((row << 16) + int(segments[a]))
                    where.append(pack(np.diff(own, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()))
                    counts.append(pack(n[a:b].tobytes()))
                yield pa.record_batch([pa.array(keys, pa.int32()), pa.array(where, pa.binary()), pa.array(counts, pa.binary())], ["key", "cells", "counts"])

        def sketch(batches):
            parts, n = [], 0
            for batch in batches:
                for h in hashes(batch):
                    if len(h):
                        parts.append(h)
                        n += len(h)
                    if n >= flush:
                        yield from emit(parts)
                        parts, n = [], 0
            if n:
                yield from emit(parts)

        def merge(batches):
            unpack = zstandard.ZstdDecompressor().decompress
            last, total, done = None, None, []

            def close():
                data = np.minimum(total, 255).astype(np.uint8)
                write_array(f"{uri}-{last}.bin", np.packbits(data >= 2, bitorder="little") if bits else data)
                done.append(last)

            for batch in batches:
                for key, cells, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    if key != last:
                        if last is not None:
                            close()
                        last, total = key, np.zeros(1 << segment, np.uint16)
                    gaps = np.frombuffer(unpack(cells), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
                    at = np.cumsum(gaps, dtype=np.uint32)
                    total[at] = np.minimum(total[at] + np.frombuffer(unpack(counts), np.uint8), 255)
            if last is not None:
                close()
            yield pa.record_batch([pa.array(done, pa.int32())], ["key"])

        blobs = df.mapInArrow(sketch, "key int, cells binary, counts binary")
        made = blobs.repartition("key").sortWithinPartitions("key").mapInArrow(merge, "key int").collect()
        self.there = {r["key"] for r in made}
        scratch.publish([f"{name}-{k}.bin" for k in self.there])
        return self
