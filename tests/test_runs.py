"""Runs that die, are repeated or meet in one folder; what the sinks leave."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from cueloom.config import load_config
from cueloom.plans.pipeline import handle_batch, outbox, run_batch
from cueloom.sources.documents import current, output_manifest, read_transcripts
from cueloom.sources.runs import RunLog
from cueloom.sources.sinks import write_text_files
from cueloom.streaming.jobs import arrivals, run_stream

SKIP = {"transcription": {"skipIfOutputExists": True}}


def put(folder, name, *texts):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps({"segments": [{"start": i, "end": i + 1, "text": t} for i, t in enumerate(texts)]}))


def files(folder):
    return {str(p.relative_to(folder)): (p.read_bytes(), p.stat().st_mtime_ns) for p in folder.rglob("*") if p.is_file() and p.suffix != ".crc"}


def test_a_finished_run_is_not_done_again(spark, tmp_path):
    put(tmp_path / "in", "a.json", "one")
    config, out = load_config(SKIP), tmp_path / "out"
    docs = read_transcripts(spark, str(tmp_path / "in"))
    first = run_batch(docs, str(out), config, run="s-0")
    assert first.segments.count() == 1
    before = files(out)
    again = run_batch(docs, str(out), config, run="s-0")
    assert again.segments.count() == 1 and set(again.stats) == set(first.stats) and files(out) == before
    assert output_manifest(spark, str(out)).count() == 1 and outbox(spark, str(out)).count() == 1


def test_a_run_that_dies_before_its_commit_is_done_anew(spark, tmp_path, monkeypatch):
    put(tmp_path / "in", "a.json", "one")
    config, out = load_config(SKIP), str(tmp_path / "out")
    docs = read_transcripts(spark, str(tmp_path / "in"))
    with monkeypatch.context() as m:
        m.setattr(RunLog, "commit", lambda self, run: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_batch(docs, out, config, run="s-0")
    assert (tmp_path / "out/manifest/run=s-0").exists() and output_manifest(spark, out).count() == 0
    assert outbox(spark, out).count() == 0 and current(spark, out, "segments").count() == 0
    assert run_batch(docs, out, config, run="s-0").segments.count() == 1
    assert [r.text for r in current(spark, out, "segments").collect()] == ["one"]
    assert [(r.key, r.status) for r in outbox(spark, out).collect()] == [("a.json", "success")]
    assert json.loads(outbox(spark, out).first().detail)["outputKeys"]["captions"]["vtt"] == "a_caption.vtt"
    assert run_batch(docs, out, config).segments.count() == 0  # another run finds it done


def test_streams_and_a_batch_into_one_folder(spark, tmp_path):
    put(tmp_path / "x", "a.json", "of x")
    put(tmp_path / "y", "b.json", "of y")
    (tmp_path / "y/bad.json").write_text("{")
    (tmp_path / "y/none.json").write_text(" \n")
    out = str(tmp_path / "out")
    for k in ("x", "y"):
        run_stream(arrivals(spark, str(tmp_path / k)), handle_batch(out, load_config()), str(tmp_path / f"check-{k}")).awaitTermination(120)
    assert sorted(r.text for r in current(spark, out, "segments").collect()) == ["of x", "of y"]
    names = [x["run"] for x in RunLog(spark, out).entries()]
    assert len(names) == 2 and all(n.endswith("-000000000000") for n in names) and names[0][:36] != names[1][:36]
    put(tmp_path / "x", "a.json", "of x, once more")
    run_batch(read_transcripts(spark, str(tmp_path / "x")), out, load_config(), run="a-name-that-sorts-first")
    assert sorted(r.text for r in current(spark, out, "segments").collect()) == ["of x, once more", "of y"]
    events = outbox(spark, out)
    assert sorted((r.key, r.status, r.error) for r in events.where("key NOT LIKE 'a%'").collect()) == [("b.json", "success", None), ("bad.json", "failure", "no JSON"), ("none.json", "failure", "empty document")]
    assert sorted(r.seq for r in events.where("key = 'a.json'").collect()) == [1, 3]
    assert [r.key for r in outbox(spark, out, after=2).collect()] == ["a.json"]
    # the mark of a batch is lost after its run has ended: the stream does it again
    before = files(tmp_path / "out")
    for p in (tmp_path / "check-x/commits").iterdir():
        p.unlink()
    run_stream(arrivals(spark, str(tmp_path / "x")), handle_batch(out, load_config(SKIP)), str(tmp_path / "check-x")).awaitTermination(120)
    assert files(tmp_path / "out") == before


def test_numbers_of_runs_that_end_at_once(spark, tmp_path):
    out, seqs = str(tmp_path / "out"), {}

    def finish(k):
        for i in range(15):
            seqs[f"{k}-{i}"] = RunLog(spark, out).commit(f"{k}-{i}")

    threads = [threading.Thread(target=finish, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    log = RunLog(spark, out)
    assert sorted(seqs.values()) == list(range(1, 61)) and {x["run"]: x["seq"] for x in log.entries()} == seqs
    assert len(log._names()) == 11  # one of fifty and ten single ones
    assert log.commit("2-7") == seqs["2-7"] and "2-7" in log and "9-9" not in log
    assert log.finished().count() == 60


def test_the_log_on_another_file_system(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.cueloom.link./x", tmp_path.as_uri())
    log = RunLog(spark, "viewfs://cueloom/x/out")
    assert [log.commit(r) for r in ("b", "a", "b")] == [1, 2, 1]
    assert log._put("000000000002.json", "other") is False and [x["run"] for x in log.entries()] == ["b", "a"]
    assert sorted(p.name for p in (tmp_path / "out/commits").iterdir() if p.name[0] != ".") == ["000000000001.json", "000000000002.json"]


def test_transcripts_without_segments_have_documents(spark, tmp_path):
    put(tmp_path / "in", "empty.json")
    put(tmp_path / "in", "full.json", "x")
    got = run_batch(read_transcripts(spark, str(tmp_path / "in")), str(tmp_path / "out"), load_config())
    read = lambda kind: (tmp_path / f"out/output/empty_caption.{kind}").read_text()
    assert read("vtt") == "WEBVTT\n" and read("srt") == ""
    assert json.loads(read("json")) == {"speakers": {"spk_0": "SPEAKER_00"}, "segments": []}
    assert sorted(p.name for p in (tmp_path / "out/output").iterdir()) == sorted(f"{n}_{k}" for n in ("empty", "full") for k in ("caption.vtt", "caption.srt", "caption.json", "refined_transcript.json"))
    assert json.loads((tmp_path / "out/output/empty_refined_transcript.json").read_text()) == {"segments": []}
    assert got.documents["vtt"].count() == 2 and outbox(spark, str(tmp_path / "out")).count() == 2


def test_failed_tasks_leave_no_files(spark, tmp_path):
    rows = spark.range(40, numPartitions=4).select(F.concat(F.lit("d/k"), F.col("id").cast("string"), F.lit("_caption.vtt")).alias("name"), F.lit("text").alias("document"))
    broken = rows.withColumn("document", F.when(F.col("name") == "d/k39_caption.vtt", F.raise_error(F.lit("lost"))).otherwise(F.col("document")))
    with pytest.raises(Exception, match="lost"):
        write_text_files(broken, str(tmp_path / "out"))
    assert [p for p in (tmp_path / "out").rglob("*") if p.is_file()] == [] if (tmp_path / "out").exists() else True
    for _ in range(2):  # again: the same files
        write_text_files(rows, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out/d").iterdir()) == sorted(f"k{i}_caption.vtt" for i in range(40))
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["d"]
    with pytest.raises(Exception, match="may not leave"):
        write_text_files(rows.withColumn("name", F.lit("../x")), str(tmp_path / "out"))


@pytest.mark.parametrize("normalize", [True, False])
def test_fields_that_are_not_known_survive(spark, tmp_path, normalize):
    doc = {"language": "en", "stats": {"n": 1, "deep": [1, {"a": None}]}, "segments": [{"start": 0, "end": 1, "text": "the end", "id": 7, "tokens": [1, 2]}, {"start": 1, "end": 2, "text": "x", "speaker": "A"}], "text": "the end"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps(doc))
    config = load_config({"replacementRules": [{"type": "literal", "search": "end", "replacement": "END"}], "normalization": {"normalize": normalize}})
    run_batch(read_transcripts(spark, str(tmp_path / "in")), str(tmp_path / "out"), config)
    got = json.loads((tmp_path / "out/output/a_refined_transcript.json").read_text())
    assert {k: v for k, v in got.items() if k != "segments"} == {k: v for k, v in doc.items() if k != "segments"}
    first, second = got["segments"]
    assert first["text"] == "the END" and first["start"] == 0 and second == {"start": 1.0, "end": 2.0, "text": "x", "speaker": "A"}
    assert ({"id": 7, "tokens": [1, 2]}.items() <= first.items()) is not normalize
