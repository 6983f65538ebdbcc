"""Streaming forms: arrivals, job messages, warm-up state, callbacks, idle stop."""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from ..sources.documents import key_below

MESSAGE = "type string, until string, s3_key string, callback_id string, worker string"


def arrivals(spark: SparkSession, path: str, glob: str = "*.json", most_files: int = 100, prefix: str = "") -> DataFrame:
    """A stream of new documents under a folder: key (the path below it) and text, at most so many files a batch; with a prefix, such as `input/`, only of keys that begin with it. Spark's file sources pass over files of no bytes."""
    source = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", glob).option("maxFilesPerTrigger", most_files).option("recursiveFileLookup", "true")
    made = source.load(path).select(key_below(spark, path).alias("key"), F.col("value").alias("extra"))
    return made.where(F.col("key").startswith(prefix)) if prefix else made


def messages(raw: DataFrame) -> DataFrame:
    """Rows of JSON text as job and warm-up messages."""
    return raw.select(F.from_json("value", MESSAGE).alias("m")).select("m.*")


class _Warmup(StatefulProcessor):
    """The latest expiry of each worker, in epoch seconds; it never goes back."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.until = handle.getValueState("until", "until double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        old = self.until.get()[0] if self.until.exists() else None
        new = max((float(f["until"].max()) for f in rows if len(f)), default=None)
        if new is not None and (old is None or new > old):
            self.until.update((new,))
            old = new
        yield pd.DataFrame({"worker": [key[0]], "until": [old]})

    def close(self) -> None:
        pass


def warmup_state(stream: DataFrame) -> DataFrame:
    """stream (worker, until as epoch seconds) to each worker's expiry after each batch. Needs the RocksDB state store."""
    return stream.groupBy("worker").transformWithStateInPandas(_Warmup(), "worker string, until double", "Update", "None")


def await_callbacks(jobs: DataFrame, callbacks: DataFrame, timeout: str = "60 minutes", late: str = "5 minutes") -> DataFrame:
    """Jobs (callback_id, job_time) with their callbacks (callback_id, done_time, status); a job without one in time comes with nulls."""
    j = jobs.withWatermark("job_time", late)
    c = callbacks.withWatermark("done_time", late).withColumnRenamed("callback_id", "_callback")
    within = F.expr(f"callback_id = _callback AND done_time >= job_time AND done_time <= job_time + INTERVAL {timeout}")
    joined = j.join(c, within, "leftOuter").drop("_callback")
    return joined.withColumn("status", F.coalesce("status", F.lit("timeout")))


class _Callbacks(StatefulProcessor):
    """The open job of a callback id, with a timer; a callback that comes first waits for its job."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", "job_time timestamp, due long")
        self.done = handle.getValueState("done", "status string, error string", self.timeout_ms)
        self.closed = handle.getValueState("closed", "status string", self.timeout_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        job = self.job.get() if self.job.exists() else None
        done = self.done.get() if self.done.exists() else None
        for frame in rows:
            for r in frame.sort_values("time", kind="stable").itertuples():
                if r.kind == "job":
                    job = job or (r.time.to_pydatetime(), timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms)
                else:
                    done = done or (r.status, r.error)
        if self.closed.exists():  # said once already, by a callback or by the timer
            return
        if job and done:
            yield self._close(key, job, *done)
        elif job and not self.job.exists():
            self.job.update(job)
            self.handle.registerTimer(job[1])
        elif done and not job:
            self.done.update(done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.job.exists():
            yield self._close(key, self.job.get(), "timeout", None)

    def _close(self, key, job: tuple, status: str, error: str | None) -> pd.DataFrame:
        if self.job.exists():
            self.handle.deleteTimer(self.job.get()[1])
        self.job.clear()
        self.done.clear()
        self.closed.update((status,))
        return pd.DataFrame({"callback_id": [key[0]], "job_time": [job[0]], "status": [status], "error": [error]})

    def close(self) -> None:
        pass


def callback_states(events: DataFrame, timeout_s: float = 3600.0) -> DataFrame:
    """events (callback_id, kind: job or callback, time, status, error) to one row (callback_id, job_time, status, error) a job: its callback's, or a timeout.

    A job times out by the clock, whether or not anything else arrives; what comes for it later is ignored. Jobs and
    their timers are state of the query and outlive a restart. Needs the RocksDB state store and a processing-time trigger.
    """
    timeout_ms = int(timeout_s * 1000)
    rows = events.select("callback_id", "kind", F.col("time").cast("timestamp").alias("time"), "status", "error")
    return rows.groupBy("callback_id").transformWithStateInPandas(_Callbacks(timeout_ms), "callback_id string, job_time timestamp, status string, error string", "Append", "ProcessingTime")


class IdleStop(StreamingQueryListener):
    """Counts idle triggers in a row; tells when a query should stop."""

    def __init__(self, most_idle: int = 3, warm: Callable[[], bool] = lambda: False):
        self.most_idle, self.warm, self.idle, self.due = most_idle, warm, 0, False
        self.query: str | None = None  # the one that is watched; others of the session are not counted

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.query in (None, str(event.progress.id)):
            self.see(event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        if self.query in (None, str(event.id)):
            self.see(0)

    def onQueryTerminated(self, event) -> None:
        pass

    def see(self, n: int) -> None:
        """One poll: the count goes on while warm, so that the end of a warm-up stops the worker at its next empty poll."""
        self.idle = 0 if n else self.idle + 1
        self.due = self.idle >= self.most_idle and not self.warm()


#: How often Spark tells of triggers without data.
IDLE_EVENTS = "spark.sql.streaming.noDataProgressEventInterval"


class Worker:
    """A query that ends by itself: after so many triggers in a row without data, unless kept warm, or when it is told to.

    It is watched from this thread, not from the listener, and stopped between batches: a batch that is running gets
    grace_s seconds to end.
    """

    def __init__(self, start: Callable[[], StreamingQuery], spark: SparkSession, most_idle: int = 3, warm: Callable[[], bool] = lambda: False, trigger_s: float = 1.0, grace_s: float = 5.0):
        self.start, self.spark, self.grace_s, self.trigger_s = start, spark, grace_s, trigger_s
        self.idle = IdleStop(most_idle, warm)
        self.told = threading.Event()

    def stop(self, *_) -> None:
        """End as soon as the batch that is running has ended; also a signal's handler."""
        self.told.set()

    def handle_signals(self, signals=(signal.SIGTERM, signal.SIGINT)) -> None:
        for s in signals:
            signal.signal(s, self.stop)

    def run(self) -> str:
        """Run to the end: idle, told, or ended by itself. An error of the query is raised."""
        before = self.spark.conf.get(IDLE_EVENTS)
        self.spark.conf.set(IDLE_EVENTS, str(int(self.trigger_s * 1000)))
        try:
            query = self.start()
        finally:
            self.spark.conf.set(IDLE_EVENTS, before)
        self.idle.query = str(query.id)
        self.spark.streams.addListener(self.idle)
        try:
            while query.isActive:
                if why := "told" if self.told.is_set() else "idle" if self.idle.due else "":
                    self._between_batches(query)
                    query.stop()
                    return why
                query.awaitTermination(0.1)
            if query.exception():
                raise query.exception()
            return "ended"
        finally:
            self.spark.streams.removeListener(self.idle)

    def _between_batches(self, query: StreamingQuery) -> None:
        until = time.monotonic() + self.grace_s
        while query.status["isTriggerActive"] and time.monotonic() < until:
            time.sleep(0.02)


def run_stream(source: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, done: str | None = None):
    """Start a query that hands each batch to handle(batch, batch_id) at least once; with done, a batch recorded there is not handled again."""

    def once(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if done:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{done}/{batch_id}")
            system = path.getFileSystem(spark._jsc.hadoopConfiguration())
            if system.exists(path):
                return
        handle(batch, batch_id)
        if done:
            system.mkdirs(path)

    return source.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
