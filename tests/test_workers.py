"""Queries that end by themselves, and jobs that time out while nothing happens."""

import os
import signal
import threading
import time

import pytest

from cueloom.streaming.jobs import Worker, callback_states

EVENTS = "callback_id string, kind string, time timestamp, status string, error string"


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def add(spark, folder, *rows):
    spark.createDataFrame([(k, kind, None, status, error) for k, kind, status, error in rows], EVENTS).selectExpr("callback_id", "kind", "current_timestamp() AS time", "status", "error").coalesce(1).write.mode("append").parquet(str(folder))


def test_a_job_times_out_while_nothing_arrives(spark, tmp_path, rocks):
    add(spark, tmp_path / "in", ("a", "job", None, None), ("b", "job", None, None), ("c", "callback", "success", None), ("d", "job", None, None), ("d", "callback", "failure", "no audio"))
    got = []

    def start():
        stream = spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in"))
        out = callback_states(stream, timeout_s=8.0).writeStream.option("checkpointLocation", str(tmp_path / "check"))
        return out.trigger(processingTime="1 second").foreachBatch(lambda b, k: got.extend((r.callback_id, r.status, r.error) for r in b.collect())).start()

    query = start()
    until = time.time() + 90
    while not got and time.time() < until:
        time.sleep(0.2)
    assert got == [("d", "failure", "no audio")]
    query.stop()
    add(spark, tmp_path / "in", ("c", "job", None, None), ("b", "callback", "success", None))
    query = start()  # the open jobs and the callback that came first are known again
    while len(got) < 4 and query.isActive and time.time() < until + 60:
        time.sleep(0.2)  # nothing more arrives for a
    query.stop()
    answers = {k: (status, error) for k, status, error in got}
    assert len(got) == len(answers) == 4 and answers["a"] == ("timeout", None) and answers["d"] == ("failure", "no audio")
    assert answers["c"][0] in ("success", "timeout") and answers["b"][0] in ("success", "timeout")  # by how long the restart took


def worker_of(spark, tmp_path, handled, **options):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("one")

    def start():
        stream = spark.readStream.text(str(tmp_path / "in"))
        return stream.writeStream.option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="300 milliseconds").foreachBatch(lambda b, k: handled(b, k)).start()

    return Worker(start, spark, trigger_s=0.3, **options)


def test_a_worker_ends_after_idle_triggers_but_not_while_warm(spark, tmp_path):
    rows, warm_until = [], time.time() + 12
    worker = worker_of(spark, tmp_path, lambda b, k: rows.extend(r.value for r in b.collect()), most_idle=3, warm=lambda: time.time() < warm_until)
    assert worker.run() == "idle" and time.time() >= warm_until
    assert rows == ["one"] and worker.idle.idle >= 3 and not spark.streams.active


def test_a_worker_that_is_told_ends_its_batch_first(spark, tmp_path):
    ended, begun = [], threading.Event()

    def handled(b, k):
        begun.set()
        time.sleep(1.5)
        ended.append(b.count())

    worker = worker_of(spark, tmp_path, handled, grace_s=60)
    before = signal.getsignal(signal.SIGTERM)
    try:
        worker.handle_signals((signal.SIGTERM,))
        threading.Thread(target=lambda: (begun.wait(60), os.kill(os.getpid(), signal.SIGTERM)), daemon=True).start()
        assert worker.run() == "told"
    finally:
        signal.signal(signal.SIGTERM, before)
    assert ended == [1]


def test_a_failing_batch_ends_the_worker_with_its_error(spark, tmp_path):
    with pytest.raises(Exception, match="division"):
        worker_of(spark, tmp_path, lambda b, k: 1 / 0).run()
