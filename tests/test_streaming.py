import json

import pandas as pd
from pyspark.sql import functions as F

from cueloom.config import load_config
from cueloom.plans.pipeline import handle_batch, run_batch
from cueloom.sources.documents import current, read_transcripts, to_segments, to_transcripts
from cueloom.streaming.jobs import IdleStop, arrivals, await_callbacks, run_stream, warmup_state

DOC = {"segments": [{"start": 0, "end": 2.5, "text": " the end", "speaker": "A", "words": [{"word": "the", "start": 0, "end": 1}, {"word": "end", "start": 1, "end": 2.5}]}], "more": 1}


def test_documents_round_trip_and_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/ep.json").write_text(json.dumps(DOC))
    got = read_transcripts(spark, str(tmp_path / "in"))
    row = got.first()
    assert row.output_base == "ep" and json.loads(row.extra)["more"] == 1
    back = json.loads(to_transcripts(to_segments(got)).first()["json"])
    assert back["segments"][0]["words"][1]["end"] == 2.5
    config = load_config({"replacementRules": [{"type": "literal", "search": "end", "replacement": "END"}]})
    result = run_batch(got, str(tmp_path / "out"), config)
    assert result.segments.first().text == "the END"
    assert sorted(p.name for p in (tmp_path / "out/output").iterdir() if p.suffix != ".crc") == ["ep_caption.json", "ep_caption.srt", "ep_caption.vtt", "ep_refined_transcript.json"]
    assert json.loads((tmp_path / "out/output/ep_refined_transcript.json").read_text())["more"] == 1
    assert (tmp_path / "out/output/ep_caption.vtt").read_bytes().decode() == result.documents["vtt"].first().document


def test_batches_skip_what_is_done_and_keep_equal_names_apart(spark, tmp_path):
    for name, text in (("a/ep 1+x.json", "one"), ("b/ep 1+x.json", "two")):
        (tmp_path / "in" / name).parent.mkdir(parents=True)
        (tmp_path / "in" / name).write_text(json.dumps({"segments": [{"start": 0, "end": 1, "text": text}]}))
    config, out = load_config({"transcription": {"skipIfOutputExists": True}}), str(tmp_path / "out")
    assert run_batch(read_transcripts(spark, str(tmp_path / "in")), out, config).segments.count() == 2
    first = (tmp_path / "out/output/a/ep 1+x_caption.vtt").read_text()
    assert "one" in first and "two" in (tmp_path / "out/output/b/ep 1+x_caption.vtt").read_text()
    (tmp_path / "in/c.json").write_text(json.dumps({"segments": [{"start": 0, "end": 1, "text": "three"}]}))
    assert [r.text for r in run_batch(read_transcripts(spark, str(tmp_path / "in")), out, config).segments.collect()] == ["three"]
    assert sorted(r.text for r in current(spark, out, "segments").collect()) == ["one", "three", "two"]
    assert (tmp_path / "out/output/a/ep 1+x_caption.vtt").read_text() == first
    again = run_batch(read_transcripts(spark, str(tmp_path / "in")), out, config, skip_existing=False)
    assert again.segments.count() == 3 and current(spark, out, "segments").count() == 3


def test_arrivals_stream(spark, tmp_path):
    for folder, name, text in (("input", "a", json.dumps(DOC)), ("input", "bad", "{no json"), ("input", "odd", '{"segments": 3}'), ("output", "a", json.dumps(DOC))):
        (tmp_path / "in" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / f"in/{folder}/{name}.json").write_text(text)
    source = arrivals(spark, str(tmp_path / "in"), prefix="input/")
    for _ in range(2):  # the second run finds nothing new
        run_stream(source, handle_batch(str(tmp_path / "out"), load_config()), str(tmp_path / "check"), str(tmp_path / "done")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out/segments")).count() == 1
    assert sorted(r.key for r in spark.read.parquet(str(tmp_path / "out/failed")).collect()) == ["input/bad.json", "input/odd.json"]
    assert [p.name.endswith("-000000000000") for p in (tmp_path / "out/segments").iterdir()] == [True]


def test_warmup_state_only_extends(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    for i, rows in enumerate([[("w", 10.0), ("v", 5.0)], [("w", 7.0)], [("w", 12.0)]]):
        spark.createDataFrame(rows, "worker string, until double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("worker string, until double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        out = []
        query = warmup_state(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True)
        query.foreachBatch(lambda b, k, out=out: out.extend(b.collect())).start().awaitTermination(120)
        assert {r.worker: r.until for r in out}["w"] == [10.0, 10.0, 12.0][i]


def test_callbacks_join(spark):
    jobs = spark.createDataFrame(pd.DataFrame({"callback_id": ["a", "b"], "job_time": pd.to_datetime(["2024-01-01 00:00", "2024-01-01 00:00"])}))
    done = spark.createDataFrame(pd.DataFrame({"callback_id": ["a", "b"], "done_time": pd.to_datetime(["2024-01-01 00:30", "2024-01-01 02:30"]), "status": ["success", "success"]}))
    got = {r.callback_id: r.status for r in await_callbacks(jobs, done).collect()}
    assert got == {"a": "success", "b": "timeout"}


def test_idle_stop():
    warm = [True]
    stop = IdleStop(3, lambda: warm[0])
    for n in (0, 0, 0):
        stop.see(n)
    assert not stop.due
    warm[0] = False
    stop.see(0)
    assert stop.due
    stop.see(4)
    assert not stop.due and stop.idle == 0
