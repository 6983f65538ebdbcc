"""Work tables and memory-mapped arrays in the folder that driver and executors share.

The folder is ``spark.checkpoint.dir``. Where that is unset a local session uses
``/tmp/checkpoints``; a cluster session is refused, as its executors would not
see each other's files. Written tables cut lineage, so a lost executor costs a
re-read and not a recomputation.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The shared folder with its file system's scheme, as a path without one means the cluster's own default."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file:///tmp/checkpoints"
    path = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def local_path(uri: str) -> str | None:
    """The path under which any machine that mounts the shared folder sees it, or None for an object store."""
    got = urlparse(uri)
    return got.path if got.scheme == "file" else None


def _output(uri: str):
    if path := local_path(uri):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_output_stream(path)


def write_array(uri: str, *arrays: np.ndarray) -> None:
    """Write arrays one after another; a repeated or speculative task leaves the same file."""
    path = local_path(uri)
    to = f"{uri}.{uuid.uuid4().hex}" if path else uri
    with _output(to) as f:
        for a in arrays:
            f.write(memoryview(np.ascontiguousarray(a)).cast("B"))
    if path:
        os.replace(local_path(to), path)


def narrow(values: np.ndarray) -> list[np.ndarray]:
    """Counts as one byte each, with places and values of those that take more."""
    big = np.flatnonzero(values >= 255)
    return [np.minimum(values, 255).astype(np.uint8), big.astype(np.int64), values[big].astype(np.int64)]


class Narrow:
    """Counts written by :func:`narrow`."""

    def __init__(self, low: np.ndarray, places: np.ndarray, values: np.ndarray):
        self.low, self.places, self.values = low, places, values

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        out = self.low[at].astype(np.int64)
        big = np.flatnonzero(out == 255)
        out[big] = self.values[np.searchsorted(self.places, at[big])]
        return out


def write_columns(uri: str, *columns: np.ndarray | list[np.ndarray]) -> None:
    """Arrays and narrow counts in one file, which begins with the bytes of each array."""
    arrays = [np.ascontiguousarray(a) for c in columns for a in (c if isinstance(c, list) else [c])]
    write_array(uri, np.array([a.nbytes for a in arrays], np.int64), *(x for a in arrays for x in (a, np.zeros(-a.nbytes % 8, np.uint8))))


def columns(uri: str, types: list) -> list:
    """Memory-mapped columns of write_columns; the type of narrow counts is None."""
    flat = [t for x in types for t in ((np.uint8, np.int64, np.int64) if x is None else (x,))]
    whole, at, arrays = np.asarray(mapped(uri, np.uint8)), 8 * len(flat), []
    for t, n in zip(flat, whole[:at].view(np.int64).tolist(), strict=True):
        arrays.append(whole[at : at + n].view(t))
        at += n + -n % 8
    left = iter(arrays)
    return [Narrow(next(left), next(left), next(left)) if x is None else next(left) for x in types]


#: Bytes of a table's values that are broadcast at most; as a hash table they take some five times that.
MOST_BROADCAST = 1 << 24
#: Shuffle files go when the action that made them ends: the table it wrote is what is read again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """df, to be broadcast if its counted rows take no more than MOST_BROADCAST bytes; else joined by a shuffle."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows * row_bytes <= MOST_BROADCAST else df


def fresh(taken: list[str], *wanted: str) -> list[str]:
    """Column names that do not clash with those taken."""
    used = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def give_back() -> None:
    """Let the system have the memory that this process has freed; workers outlive the tasks of a stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def tidy(work: Callable[[Iterator], Iterator], *held: list | dict) -> Callable[[Iterator], Iterator]:
    """An Arrow function that, when its task ends, empties what it held and gives memory back."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            for x in held:
                x.clear()
            give_back()

    return run


class Scratch:
    """One operator call's folder of work tables."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.uri = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.uri}/{name}"

    def save(self, df: DataFrame, name: str, compression: str = "zstd", dictionary: bool = True) -> DataFrame:
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", compression).option("parquet.enable.dictionary", dictionary).parquet(self.path(name))
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str = "") -> None:
        where = self.path(name) if name else self.uri
        path = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def only(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and drop all others of the folder."""
        out = self.save(df, name)
        top = self.spark._jvm.org.apache.hadoop.fs.Path(self.uri)
        system = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for x in system.listStatus(top):
            if x.getPath().getName() != name:
                system.delete(x.getPath(), True)
        return out

    def finish(self, df: DataFrame, *names: str) -> DataFrame:
        """Write the result, drop the named work tables, and read the result again."""
        out = self.save(df, "result")
        for name in names:
            self.drop(name)
        self.leave()
        return out

    def leave(self) -> None:
        """What is still in the folder goes when this process ends."""
        atexit.register(self._end)

    def _end(self) -> None:
        if path := local_path(self.uri):
            shutil.rmtree(path, ignore_errors=True)
        elif self.spark.sparkContext._jsc is not None and not self.spark.sparkContext._jsc.sc().isStopped():
            self.drop()

    def publish(self, names: list[str]) -> None:
        """Let executors fetch files of a store that can't be mounted; they then map their own copy."""
        if local_path(self.uri) is None:
            for name in names:
                self.spark.sparkContext.addFile(self.path(name))


_maps: dict[str, np.ndarray] = {}
_folder = [""]


def mapped(uri: str, dtype, offset: int = 0, count: int | None = None) -> np.ndarray:
    """Memory-map a published file in a worker."""
    key, folder = f"{uri}:{dtype}:{offset}:{count}", uri.rsplit("/", 2)[0]
    if folder != _folder[0]:  # another operator call: let go of the last one's files
        _maps.clear()
        _folder[0] = folder
    if key not in _maps:
        path = local_path(uri)
        if path is None:
            from pyspark import SparkFiles

            path = SparkFiles.get(os.path.basename(uri))
        if len(_maps) > 8192:
            _maps.clear()
        empty = count == 0 or os.path.getsize(path) <= offset
        _maps[key] = np.zeros(0, dtype) if empty else np.memmap(path, dtype, "r", offset, None if count is None else (count,))
    return _maps[key]


class SortedTable:
    """Sorted arrays of 64-bit hashes with values, one file a shard of the hash's top bits.

    Build it with :meth:`build`; :meth:`find` looks hashes up in a worker. The
    files hold the hashes, then each value column.
    """

    def __init__(self, uri: str, bits: int, sizes: dict[int, int], values: list[tuple[str, str]]):
        self.uri, self.bits, self.sizes, self.values = uri, bits, sizes, values

    @staticmethod
    def shard(h: np.ndarray, bits: int) -> np.ndarray:
        return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)

    def _column(self, shard: int, name: str) -> np.ndarray:
        n, at = self.sizes[shard], 0
        for column, dtype in [("h", "uint64"), *self.values]:
            if column == name:
                return mapped(f"{self.uri}-{shard}.bin", dtype, at, n)
            at += n * np.dtype(dtype).itemsize
        raise KeyError(name)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Whether each hash is there, and its values (0 where not)."""
        there = np.zeros(len(h), bool)
        out = {name: np.zeros(len(h), dtype) for name, dtype in self.values}
        if not len(h):
            return there, out
        order = np.argsort(h)
        h = h[order]
        shards = self.shard(h, self.bits)
        cuts = np.flatnonzero(np.diff(shards)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(h)], strict=True):
            shard = int(shards[a])
            if not self.sizes.get(shard):
                continue
            keys, want = self._column(shard, "h"), h[a:b]
            at = np.searchsorted(keys, want)
            at[at == len(keys)] = 0
            hit = keys[at] == want
            where = order[a:b][hit]
            there[where] = True
            for name, _ in self.values:
                out[name][where] = self._column(shard, name)[at[hit]]
        return there, out

    def holds(self, h: Column) -> Column:
        """Whether a long is among the hashes; only h goes to Python."""

        def look(column: pa.Array) -> pa.Array:
            return pa.array(self.find(column.to_numpy(zero_copy_only=False).view(np.uint64))[0])

        look.__annotations__ = {"column": pa.Array, "return": pa.Array}
        return F.arrow_udf(look, "boolean")(h)

    @classmethod
    def build(cls, scratch: Scratch, name: str, df: DataFrame, bits: int, values: list[tuple[str, str]]) -> SortedTable:
        """df: column h (long, unique) and the value columns, any order. A shard is one group: bits must grow with the rows."""
        uri, columns = scratch.path(name), [n for n, _ in values]

        def write(group: pa.Table) -> pa.Table:
            shard = group["shard"][0].as_py()
            h = group["h"].to_numpy().view(np.uint64)
            order = np.argsort(h)
            write_array(f"{uri}-{shard}.bin", h[order], *(group[n].to_numpy().astype(t)[order] for n, t in values))
            return pa.table({"shard": pa.array([shard], pa.int64()), "n": pa.array([len(h)], pa.int64())})

        shard = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")
        made = df.select(shard.alias("shard"), "h", *columns).groupBy("shard").applyInArrow(write, "shard long, n long").collect()
        sizes = {r["shard"]: r["n"] for r in made}
        scratch.publish([f"{name}-{s}.bin" for s in sizes])
        return cls(uri, bits, sizes, values)
