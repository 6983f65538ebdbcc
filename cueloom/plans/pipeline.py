"""The whole transcript pipeline as one lazy plan, in batch or per streaming batch."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..operators.captions import render_json, render_srt, render_vtt
from ..operators.jobs import new_keys
from ..operators.normalization import normalize_segments
from ..operators.refinement import Client, refine
from ..operators.replacement import apply_replacements
from ..operators.suggestions import apply_suggestions
from ..schema import EVENTS, SEGMENTS
from ..sources.documents import output_manifest, refined_documents, set_aside, to_segments, write_table
from ..sources.runs import RunLog
from ..sources.sinks import write_text_files


@dataclass
class Result:
    segments: DataFrame
    documents: dict[str, DataFrame]
    stats: dict[str, DataFrame]


def process(
    segments: DataFrame, config: PipelineConfig, updates: DataFrame | None = None, names: DataFrame | None = None, make_client: Callable[[], Client] | None = None, memo: str = ""
) -> Result:
    """Replacement, suggestions, normalization, captions: each where the configuration asks for it.

    Suggestions are given as tables, or come from a client, whose answers are kept below memo.
    """
    stats: dict[str, DataFrame] = {}
    if config.replacement_rules is not None:
        segments, stats["replacement"] = apply_replacements(segments, config.replacement_rules)
    if config.refinement is not None and config.refinement.profile_id:
        if updates is not None and names is not None:
            segments, applied, ignored, counts = apply_suggestions(segments, updates, names, config.refinement.suggestion_validation)
            stats |= {"refinement": counts, "applied": applied, "ignored": ignored}
        elif make_client is not None:
            got = refine(segments, config.refinement, make_client, memo)
            segments = got.segments
            stats |= {"refinement": got.stats, "applied": got.applied, "ignored": got.ignored, "unanswered": got.failed}
    if config.normalization.normalize:
        segments, stats["normalization"] = normalize_segments(segments, config.normalization)
    return Result(segments, captions(segments, config), stats)


REFINED = "_refined_transcript.json"
#: Documents of a transcript without segments; the others are joined to these by what transcripts there are.
EMPTY = {"vtt": "WEBVTT\n", "srt": "", "json": '{\n  "speakers": {\n    "spk_0": "SPEAKER_00"\n  },\n  "segments": []\n}'}


def captions(segments: DataFrame, config: PipelineConfig, transcripts: DataFrame | None = None) -> dict[str, DataFrame]:
    """(transcript_id, document) of each format that is asked for; with transcripts (transcript_id) also for those without segments."""
    documents = {}
    if config.captions.generate_vtt:
        documents["vtt"] = render_vtt(segments, config.captions)
    if config.captions.generate_srt:
        documents["srt"] = render_srt(segments, config.captions)
    if config.captions.generate_simplified_json:
        documents["json"] = render_json(segments)
    if transcripts is not None:
        ids = transcripts.select("transcript_id")
        documents = {k: ids.join(d, "transcript_id", "left").withColumn("document", F.coalesce("document", F.lit(EMPTY[k]))) for k, d in documents.items()}
    return documents


def _events(names: DataFrame, kinds: list[str], config: PipelineConfig, started: float) -> DataFrame:
    """A completion event for each transcript: its outputs and how long the run took."""
    at = lambda t: datetime.fromtimestamp(t, timezone.utc).isoformat(timespec="milliseconds")
    ended = time.time()
    outputs = F.create_map(*(x for k in kinds for x in (F.lit(k), F.concat("output_base", F.lit(f"_caption.{k}"))))) if kinds else F.create_map().cast("map<string,string>")
    timing = F.struct(F.lit(at(started)).alias("startedAt"), F.lit(at(ended)).alias("completedAt"), F.lit(int((ended - started) * 1000)).alias("durationMs"))
    detail = F.to_json(F.struct(F.col("key").alias("inputKey"), F.struct(F.concat("output_base", F.lit(REFINED)).alias("refinedTranscript"), outputs.alias("captions")).alias("outputKeys"), timing.alias("timing")))
    n = config.notification
    return names.select("key", F.lit("success").alias("status"), F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("error"), *(F.lit(v).alias(c) for c, v in (("bus", n.event_bus), ("source", n.source), ("detail_type", n.detail_type))), detail.alias("detail"))


def _failures(failed: DataFrame, config: PipelineConfig) -> DataFrame:
    """An event for each document that could not be read."""
    n = config.notification
    what = F.when(F.coalesce("extra", F.lit("")).rlike(r"^\s*$"), F.lit("empty document")).when(F.try_parse_json("extra").isNull(), F.lit("no JSON")).otherwise(F.lit("no segments"))
    detail = F.to_json(F.struct(F.col("key").alias("inputKey"), F.struct(F.lit("DocumentError").alias("ErrorType"), what.alias("ErrorMessage")).alias("Error")))
    return failed.select("key", F.lit("failure").alias("status"), F.lit("DocumentError").alias("error_type"), what.alias("error"), *(F.lit(v).alias(c) for c, v in (("bus", n.event_bus), ("source", n.source), ("detail_type", n.detail_type))), detail.alias("detail"))


def outbox(spark: SparkSession, out: str, after: int = 0) -> DataFrame:
    """Events of finished runs behind number `after` of the log, with their number seq: each document's event once, however often its run was tried."""
    return RunLog(spark, out).whole(spark.read.schema(EVENTS).parquet(f"{out}/events")).where(F.col("seq") > after)


def run_batch(
    transcripts: DataFrame, out: str, config: PipelineConfig, skip_existing: bool | None = None, run: str | None = None, failed: DataFrame | None = None,
    make_client: Callable[[], Client] | None = None,
) -> Result:
    """Process transcripts (key, output_base, extra, segments) and write segments, statistics, events, refined transcripts and caption files under out.

    A run adds partitions of its own (run=...) and overwrites nothing of other runs; it is finished by its
    entry in the log, which comes last. A run that is in the log is not done again: what it wrote is
    returned. One that died before is done anew, and what it left counts as not there, also for
    skip_existing. Captions are rendered from the written segments.
    """
    spark, log, started = transcripts.sparkSession, RunLog(transcripts.sparkSession, out), time.time()
    run = run or f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    if run not in log:
        if config.transcription.skip_if_output_exists if skip_existing is None else skip_existing:
            transcripts = new_keys(transcripts, output_manifest(spark, out))
        ids = F.xxhash64("key").alias("transcript_id")
        names = transcripts.select("output_base", ids, "key")
        write_table(names, f"{out}/manifest/run={run}")
        result = process(to_segments(transcripts), config, make_client=make_client, memo=f"{out}/answers")
        write_table(result.segments.select(*SEGMENTS.fieldNames()), f"{out}/segments/run={run}")
        for kind, df in result.stats.items():
            write_table(df, f"{out}/stats/{kind}/run={run}")
        names = spark.read.schema(names.schema).parquet(f"{out}/manifest/run={run}")
        segments = _segments(spark, out, run)
        documents = captions(segments, config, names)
        named = lambda df, end: df.join(names, "transcript_id").select(F.concat("output_base", F.lit(end)).alias("name"), "document")
        files = named(refined_documents(transcripts.select(ids, "extra"), segments, not config.normalization.normalize), REFINED)
        for kind, df in documents.items():
            files = files.union(named(df, f"_caption.{kind}"))
        write_text_files(files, f"{out}/output")
        if config.notification.enabled:
            events = _events(names, list(documents), config, started)
            write_table(events if failed is None else events.union(_failures(failed, config)), f"{out}/events/run={run}")
        if failed is not None:
            write_table(failed, f"{out}/failed/run={run}")
        log.commit(run)
    segments = _segments(spark, out, run)
    ids = spark.read.schema("transcript_id long").parquet(f"{out}/manifest/run={run}")
    stats = {k: spark.read.parquet(f"{out}/stats/{k}/run={run}") for k in _kinds(spark, f"{out}/stats", run)}
    return Result(segments, captions(segments, config, ids), stats)


def _segments(spark: SparkSession, out: str, run: str) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(f"{out}/segments/run={run}")


def _kinds(spark: SparkSession, path: str, run: str) -> list[str]:
    """The tables below path that have a partition of the run."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(top):
        return []
    found = [x.getPath() for x in system.listStatus(top)]
    return sorted(x.getName() for x in found if system.exists(spark._jvm.org.apache.hadoop.fs.Path(x, f"run={run}")))


def handle_batch(out: str, config: PipelineConfig, stream: str | None = None, make_client: Callable[[], Client] | None = None):
    """A foreachBatch handler of arriving documents (key, extra). A batch is a run named by its stream (by default the
    query's id, which its checkpoint keeps) and its number, so that streams into one folder don't meet and a repeated batch is known; documents that can't be read go to failed/."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        name = stream or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        transcripts, failed = set_aside(batch)
        run_batch(transcripts, out, config, run=f"{name}-{batch_id:012d}", failed=failed, make_client=make_client)

    return handle
