"""Refinement through a client: what is asked, kept, tried again and lost."""

import json

import pytest
from pyspark.sql import functions as F

from cueloom.config import Refinement, load_config
from cueloom.operators.refinement import Calls, answered, prompts, refine
from cueloom.plans.pipeline import run_batch
from cueloom.schema import SEGMENTS
from cueloom.sources.documents import current, read_transcripts

ASK = Refinement(profile_id="eu.some-model")
FAST = Calls(tasks=3, at_a_time=2, tries=3, wait_s=0.0)


def client_of(log):
    """A client that notes its calls in a file; BOOM always raises, SHAKY the first two times, NOISE is no JSON."""

    def make():
        def answer(prompt):
            key = next((w for w in ("BOOM", "SHAKY", "NOISE") if w in prompt), "FINE")
            with open(log, "a") as f:
                f.write(key + "\n")
            if key == "BOOM" or (key == "SHAKY" and open(log).read().count("SHAKY") < 3):
                raise RuntimeError("no answer")
            if key == "NOISE":
                return "I can't {do that"
            return "So: " + json.dumps({"identifiedSpeakers": {"A": "Ann"}, "updates": [{"idx": 0, "text": "one two three four five sixth"}, {"idx": 9, "text": "x"}, {"idx": 0, "text": "something else altogether now"}]})

        return answer

    return make


def transcripts(spark, *texts):
    rows = [(i, 0, 0.0, 6.0, f"one two three four five six {t}".strip(), "A", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SEGMENTS)


def test_each_prompt_is_asked_once(spark, tmp_path):
    log, memo = str(tmp_path / "log"), str(tmp_path / "memo")
    made = transcripts(spark, "", "", "")  # one prompt for all three
    for _ in range(2):
        got = refine(made, ASK, client_of(log), memo, calls=FAST)
        assert {(r.text, r.speaker) for r in got.segments.collect()} == {("one two three four five sixth", "Ann")}
        assert {r.ignore_reason for r in got.ignored.collect()} == {"word-change-ratio"} and got.applied.count() == 3
        assert {(r.segments_processed, r.segments_updated, r.speakers_identified) for r in got.stats.collect()} == {(1, 1, 1)}
        assert open(log).read().split() == ["FINE"]
    # other settings are other prompts
    refine(made, Refinement(profile_id="us.other"), client_of(log), memo, calls=FAST)
    assert open(log).read().split() == ["FINE"] * 2


def test_a_client_that_raises_costs_its_transcript_only(spark, tmp_path):
    log, memo = str(tmp_path / "log"), str(tmp_path / "memo")
    got = refine(transcripts(spark, "", "BOOM", "SHAKY", "NOISE"), ASK, client_of(log), memo, calls=FAST)
    texts = {r.transcript_id: r.text for r in got.segments.collect()}
    assert texts[0] == texts[2] == "one two three four five sixth" and texts[1].endswith("BOOM") and texts[3].endswith("NOISE")
    assert [(r.transcript_id, r.error) for r in got.failed.collect()] == [(1, "RuntimeError: no answer")]
    assert sorted((r.transcript_id, r.segments_updated) for r in got.stats.collect()) == [(0, 1), (1, 0), (2, 1), (3, 0)]
    calls = open(log).read().split()
    assert {k: calls.count(k) for k in ("FINE", "BOOM", "SHAKY", "NOISE")} == {"FINE": 1, "BOOM": 3, "SHAKY": 3, "NOISE": 1}
    # the next time only what was not answered is asked
    refine(transcripts(spark, "", "BOOM", "SHAKY", "NOISE"), ASK, client_of(log), memo, calls=FAST)
    assert open(log).read().split()[len(calls) :] == ["BOOM"] * 3


def test_nothing_is_asked_without_a_profile_or_segments(spark, tmp_path):
    log = str(tmp_path / "log")
    got = refine(transcripts(spark, "BOOM"), Refinement(), client_of(log), str(tmp_path / "memo"), calls=FAST)
    assert got.segments.first().text.endswith("BOOM") and got.stats.first().segments_updated == 0
    none = answered(prompts(spark.createDataFrame([], SEGMENTS), ASK), str(tmp_path / "memo"), client_of(log), FAST)
    assert none.collect() == [] and not (tmp_path / "log").exists()


def test_the_whole_plan_with_a_client(spark, tmp_path):
    (tmp_path / "in").mkdir()
    words = [{"word": w, "start": i, "end": i + 1, "speaker": "A"} for i, w in enumerate("one two three four five six".split())]
    (tmp_path / "in/a.json").write_text(json.dumps({"segments": [{"start": 0, "end": 6, "text": "one two three four five six", "speaker": "A", "words": words}]}))
    config = load_config({"llmRefinement": {"bedrockInferenceProfileId": "eu.some-model"}})
    got = run_batch(read_transcripts(spark, str(tmp_path / "in")), str(tmp_path / "out"), config, make_client=client_of(str(tmp_path / "log")))
    assert got.segments.first().text == "one two three four five sixth" and got.stats["refinement"].first().segments_updated == 1
    assert got.stats["unanswered"].count() == 0
    assert "Ann" in (tmp_path / "out/output/a_caption.vtt").read_text()
    assert current(spark, str(tmp_path / "out"), "segments").select(F.col("words")[5]["word"]).first()[0] == "sixth"
    with pytest.raises(Exception, match="profile"):
        load_config({"llmRefinement": {}})
