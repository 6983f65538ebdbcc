"""A training-corpus pipeline: each stage applies one operator to all that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cueloom.llm.decontaminate import drop_contaminated
from cueloom.llm.language_id import keep_identified
from cueloom.llm.line_dedup import dedup_lines
from cueloom.llm.ngram_join import ngram_components
from cueloom.llm.packing import pack_documents
from cueloom.llm.scratch import Scratch, SortedTable

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
#: A worker of this pipeline keeps what other stages loaded, so the stages go in small steps.
SKETCHED = 1 << 19
CACHED = 100_000
BATCH_ROWS = 1000
BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of fewer rows for the jobs that run inside."""
    before = spark.conf.get(BATCHES)
    spark.conf.set(BATCHES, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCHES, before)


def stay_small(spark: SparkSession) -> None:
    """Small batches from now on, as the caller runs the frame that a stage returns. run() sets back what was there before."""
    if not 0 < int(spark.conf.get(BATCHES)) <= BATCH_ROWS:
        spark.conf.set(BATCHES, str(BATCH_ROWS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those with narrow margins, no letter or no text go."""
    stay_small(spark)
    return keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat earlier ones; documents that lose every line go."""
    return dedup_lines(docs, SIMILAR_PERCENT, drop_emptied=True, counts=False)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of smallest doc_id. Wordless texts and null ids stay."""
    with small_batches(spark):
        groups = ngram_components(docs, SHINGLE_WORDS, SIMILAR_PERCENT, flush=SKETCHED)
    # the ids that go, as mapped arrays: texts stay where they are read, however many ids there are
    scratch = Scratch(spark, "late")
    late = scratch.save(groups.where("component_id <> doc_id").select(F.xxhash64("doc_id").alias("h")).distinct(), "ids")
    table = SortedTable.build(scratch, "late/l", late, max(0, late.count().bit_length() - 19), [])
    scratch.leave()
    return docs.where(F.col("doc_id").isNull() | ~table.holds(F.xxhash64(F.col("doc_id").cast("long"))))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    stay_small(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, with their places in sequences."""
    import public_tokenizers

    with small_batches(spark):
        return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), cached=CACHED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: No stage of compression, similarity joins or tokenizers can be said in SQL as a whole; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    with small_batches(spark):
        for name, stage in STAGES:
            docs = scratch.only(stage(spark, docs, sf_dir), name)
    scratch.leave()
    return docs
