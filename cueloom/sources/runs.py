"""The log of finished runs below an output folder.

A run writes partitions of its own (run=<name>) in any number of tables and is finished by one small
file, commits/<number>.json, that holds its name. Numbers count up and a file is put only where there is
none, so writers that finish at the same time get different ones: the log says which runs are whole and in which order
they ended, whatever they are called. A run that died before its commit is no part of the output, and is
overwritten when it is done again; one that has a commit is not done again.

Every COMPACT-th writer also puts what the log says so far into one file, so a reader opens a bounded number
of files. The put is that of FileContext.rename without overwriting (a hard link on a local file system).
"""

from __future__ import annotations

import json
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPACT = 50
SHAPE = "run string, seq long, at double"


def work_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local session without one has /tmp/checkpoints."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file:///tmp/checkpoints"
    return root.rstrip("/")


class RunLog:
    def __init__(self, spark: SparkSession, out: str):
        self.spark = spark
        jvm = spark._jvm.org.apache.hadoop.fs
        top = jvm.Path(f"{out}/commits")
        self.system = top.getFileSystem(spark._jsc.hadoopConfiguration())
        self.top = self.system.makeQualified(top)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.top, name)

    def _names(self) -> list[str]:
        """Files that make up the log: the last compact one and the single ones behind it."""
        if not self.system.exists(self.top):
            return []
        names = sorted(x.getPath().getName() for x in self.system.listStatus(self.top))
        compact = max((n for n in names if n.endswith(".all.json")), default="")
        return [compact] * bool(compact) + [n for n in names if n[0] != "." and not n.endswith(".all.json") and n.split(".")[0] > compact.split(".")[0]]

    def _read(self, names: list[str]) -> list[dict]:
        out = []
        for n in names:
            stream = self.system.open(self._path(n))
            try:
                text = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
            out += [json.loads(x) for x in text.splitlines()]
        return out

    def entries(self) -> list[dict]:
        """(run, seq, at) of every finished run, in order."""
        return self._read(self._names())

    def finished(self) -> DataFrame:
        """The log as a table (run, seq, at)."""
        names = self._names()
        if not names:
            return self.spark.createDataFrame([], SHAPE)
        return self.spark.read.schema(SHAPE).json([self._path(n).toString() for n in names])

    def __contains__(self, run: str) -> bool:
        return any(x["run"] == run for x in self.entries())

    def _put(self, name: str, text: str) -> bool:
        """Whether the file was put; one that is there stays as it is."""
        to, own = self._path(name), self._path(f".{name}.{uuid.uuid4().hex}")
        stream = self.system.create(own, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            if to.toUri().getScheme() == "file":
                try:
                    os.link(own.toUri().getPath(), to.toUri().getPath())
                    return True
                except FileExistsError:
                    return False
            jvm = self.spark._jvm
            keep = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
            keep[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
            try:
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), self.spark._jsc.hadoopConfiguration()).rename(own, to, keep)
                return True
            except Exception as e:
                if "FileAlreadyExists" in str(e):
                    return False
                raise
        finally:
            if self.system.exists(own):
                self.system.delete(own, False)

    def commit(self, run: str) -> int:
        """Finish a run and return its number; a run that is finished already keeps the one it has."""
        while True:
            names = self._names()
            entries = self._read(names)
            if own := next((x for x in entries if x["run"] == run), None):
                return own["seq"]
            seq = max((x["seq"] for x in entries), default=0) + 1
            entry = {"run": run, "seq": seq, "at": time.time()}
            if self._put(f"{seq:012d}.json", json.dumps(entry) + "\n"):
                if seq % COMPACT == 0:
                    # what lies below a number never changes, so it does not matter who writes this, or how often
                    self._put(f"{seq:012d}.all.json", "".join(json.dumps(x) + "\n" for x in [*entries, entry]))
                return seq

    def whole(self, table: DataFrame) -> DataFrame:
        """Rows of a table with a column run that belong to finished runs, with their number seq."""
        return table.join(self.finished().select("run", "seq"), "run") if self._names() else table.limit(0).withColumn("seq", F.lit(0).cast("long"))
