"""Refinement by a language model as one call: prompts, answers, parsing, application.

The model is a client: a function that makes, in a worker, a function from prompt to answer. Answers are kept in a
table by the hash of their prompt and of the client's settings, so a prompt is sent once, whichever transcripts,
runs or retries it comes up in, and a transcript whose prompt could not be answered costs itself only: it goes on
unrefined and is asked about again next time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Refinement
from ..functions.text import fill_template
from .suggestions import apply_suggestions, parse_responses, prompt_lines

TEMPLATE = "Correct the transcript below. Answer with JSON: identifiedSpeakers (label to name) and updates (idx, text).\n{{additionalContext}}\n{{transcript}}\n"
ANSWERS = "prompt_id string, response string"

Client = Callable[[str], str]


@dataclass(frozen=True)
class Calls:
    """How prompts are sent: by so many tasks, each with so many calls at a time; a call that raises is tried again, with doubled waits."""

    tasks: int = 8
    at_a_time: int = 4
    tries: int = 3
    wait_s: float = 1.0


@dataclass
class Refined:
    segments: DataFrame
    applied: DataFrame
    ignored: DataFrame
    stats: DataFrame
    #: (transcript_id, error) of transcripts whose prompt was not answered.
    failed: DataFrame


def prompts(segments: DataFrame, config: Refinement = Refinement(), template: str = TEMPLATE) -> DataFrame:
    """(transcript_id, prompt_id, prompt) of every transcript with segments."""
    made = prompt_lines(segments).select("transcript_id", fill_template(template, "transcript", config.additional_context).alias("prompt"))
    settings = json.dumps({"profile": config.profile_id, **{k: config.model_config.get(k) for k in ("max_tokens", "temperature")}}, sort_keys=True)
    return made.select("transcript_id", F.sha2(F.concat(F.lit(settings), F.lit("\n"), "prompt"), 256).alias("prompt_id"), "prompt")


def _call(client: Client, prompt: str, calls: Calls) -> tuple[str | None, str | None]:
    for k in range(calls.tries):
        try:
            return client(prompt), None
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
            if k + 1 < calls.tries:
                time.sleep(calls.wait_s * 2**k)
    return None, error


def _sender(make_client: Callable[[], Client], calls: Calls):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = None
        with ThreadPoolExecutor(calls.at_a_time) as pool:
            for batch in batches:
                client = client or make_client()
                running: deque = deque()
                for i in range(batch.num_rows):
                    running.append((batch.column(0)[i].as_py(), pool.submit(_call, client, batch.column(1)[i].as_py(), calls)))
                    if len(running) >= calls.at_a_time:
                        yield _answer(*running.popleft())
                while running:
                    yield _answer(*running.popleft())

    return send


def _answer(prompt_id: str, future) -> pa.RecordBatch:
    response, error = future.result()
    return pa.record_batch([pa.array([x], pa.string()) for x in (prompt_id, response, error)], ["prompt_id", "response", "error"])


def _kept(spark: SparkSession, memo: str) -> DataFrame:
    """(prompt_id, response) of all that has been answered."""
    p = spark._jvm.org.apache.hadoop.fs.Path(memo)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], ANSWERS)
    return spark.read.schema(f"{ANSWERS}, error string").parquet(memo).where("error IS NULL").select("prompt_id", "response")


def answered(asked: DataFrame, memo: str, make_client: Callable[[], Client], calls: Calls = Calls()) -> DataFrame:
    """(transcript_id, prompt_id, response, error) of prompts (transcript_id, prompt_id, prompt): from the table memo, or from the client, whose answers are added to it.

    Each call of this function writes a partition of its own: what is read from it is what the client said, even
    if a task was repeated. Errors are not taken from it the next time.
    """
    spark, own = asked.sparkSession, f"{memo}/call={uuid.uuid4().hex}"
    misses = asked.dropDuplicates(["prompt_id"]).join(_kept(spark, memo), "prompt_id", "left_anti").select("prompt_id", "prompt")
    sent = misses.repartition(calls.tasks, "prompt_id").mapInArrow(_sender(make_client, calls), f"{ANSWERS}, error string")
    sent.write.parquet(own)
    lost = spark.read.schema(f"{ANSWERS}, error string").parquet(own).where("error IS NOT NULL")
    every = _kept(spark, memo).withColumn("error", F.lit(None).cast("string")).union(lost)
    # two calls at a time may both have asked
    return asked.select("transcript_id", "prompt_id").join(every, "prompt_id").dropDuplicates(["transcript_id"])


def refine(
    segments: DataFrame, config: Refinement, make_client: Callable[[], Client], memo: str, template: str = TEMPLATE, calls: Calls = Calls(), most_rounds: int | None = None
) -> Refined:
    """Segments with the speaker names and the accepted edits that the client suggests.

    An answer that can't be parsed suggests nothing. Without a profile nothing is asked.
    """
    spark = segments.sparkSession
    if not config.profile_id:
        made, none = segments.groupBy("transcript_id").agg(F.count("*").alias("segments_processed")), F.lit(0).cast("long")
        nothing = spark.createDataFrame([], "transcript_id long, ord long, idx long, original string, corrected string, ratio double, run int, ignore_reason string")
        return Refined(segments, nothing, nothing, made.withColumns({"segments_updated": none, "speakers_identified": none}), spark.createDataFrame([], "transcript_id long, error string"))
    asked = prompts(segments, config, template)
    answers = answered(asked, memo, make_client, calls)
    updates, names = parse_responses(answers.where("error IS NULL"))
    out, applied, ignored, stats = apply_suggestions(segments, updates, names, config.suggestion_validation, most_rounds)
    return Refined(out, applied, ignored, stats, answers.where("error IS NOT NULL").select("transcript_id", "error"))
