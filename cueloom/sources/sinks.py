"""Text files as a data source to write to: nothing is seen under its name before the whole job has ended.

``df.write.format("text_files").option("path", folder).mode("append").save()`` takes rows
(name, document) and leaves each document as ``folder/<name>``, byte for byte. A task stages its
files in a folder of its own below ``folder/.staged-<job>``; the commit moves those of the tasks that Spark took,
and an abort, or what a failed task left, goes with the staging folder. Moves replace what is there, so a job that is
done again leaves the same files.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

SHAPE = "name string, document string"
MOVERS = 32


@dataclass
class Staged(WriterCommitMessage):
    folder: str | None
    n_files: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        from pyarrow import fs

        self.uri = re.sub("^file:/+", "file:///", path)
        _, self.root = fs.FileSystem.from_uri(self.uri)
        self.staging = f"{self.root}/.staged-{uuid.uuid4().hex}"

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.uri)[0]

    def write(self, batches) -> Staged:
        system, own, n, made = self._system(), f"{self.staging}/{uuid.uuid4().hex}", 0, set()
        for batch in batches:
            rows = {c.lower(): batch.column(i) for i, c in enumerate(batch.schema.names)}
            for name, text in zip(*(rows[c].to_pylist() for c in ("name", "document")), strict=True):
                if ".." in name.split("/"):
                    raise ValueError(f"a name may not leave the folder: {name}")
                to = f"{own}/{name}"
                if (parent := to.rpartition("/")[0]) not in made:
                    system.create_dir(parent)
                    made.add(parent)
                with system.open_output_stream(to) as f:
                    f.write(text.encode())
                n += 1
        return Staged(own if n else None, n)

    def commit(self, messages: list[Staged]) -> None:
        from pyarrow import fs

        system, folders = self._system(), set()

        def move(staged: str, folder: str) -> None:
            system.move(staged, f"{self.root}/{staged[len(folder) + 1 :]}")

        with ThreadPoolExecutor(MOVERS) as pool:
            for m in messages:
                if m is None or m.folder is None:
                    continue
                found = [x.path for x in system.get_file_info(fs.FileSelector(m.folder, recursive=True)) if x.type == fs.FileType.File]
                for parent in {x[len(m.folder) + 1 :].rpartition("/")[0] for x in found} - folders:
                    system.create_dir(f"{self.root}/{parent}" if parent else self.root)
                    folders.add(parent)
                list(pool.map(lambda x, folder=m.folder: move(x, folder), found))
        self._clear(system)

    def abort(self, messages: list[Staged]) -> None:
        self._clear(self._system())

    def _clear(self, system) -> None:
        from pyarrow import fs

        if system.get_file_info(self.staging).type == fs.FileType.Directory:
            system.delete_dir(self.staging)


class TextFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "text_files"

    def schema(self) -> str:
        return SHAPE

    def writer(self, schema, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("text_files adds files and replaces those of the same name: use mode append")
        return _Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    """Let the session write to the data source by its name."""
    spark.dataSource.register(TextFiles)


def write_text_files(documents: DataFrame, path: str) -> None:
    """Write documents (name, document) as files below path."""
    spark = documents.sparkSession
    register(spark)
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    top = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toString()
    documents.select("name", "document").write.format("text_files").option("path", top).mode("append").save()
