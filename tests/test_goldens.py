"""Hand-computed cases of the transcript operators."""

import json
import random

import pytest
from pyspark.sql import functions as F

from cueloom.config import Captions, ConfigError, Normalization, PipelineConfig, Rule, Validation, load_config
from cueloom.functions import alignment as al
from cueloom.functions import text as tx
from cueloom.functions import timing as tm
from cueloom.operators import captions as cap
from cueloom.operators.jobs import StepTimer, idle_shutdowns
from cueloom.operators.normalization import normalize_segments
from cueloom.operators.replacement import apply_replacements
from cueloom.operators.suggestions import apply_suggestions, parse_responses, validated
from cueloom.schema import SEGMENTS


def word(w, a=None, b=None, who=None, score=0.9):
    return {"word": w, "start": a, "end": b, "speaker": who, "score": score}


def words_of(text, step=0.3, who=None):
    return [word(w, round(i * step, 6), round((i + 1) * step, 6), who) for i, w in enumerate(text.split())]


def segment_rows(spark, *rows):
    return spark.createDataFrame([(1, i, a, b, t, who, w) for i, (a, b, t, who, w) in enumerate(rows)], SEGMENTS)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_timestamps(spark):
    assert one(spark, tm.vtt_timestamp(F.lit(3661.123))) == "01:01:01.123"
    assert one(spark, tm.srt_timestamp(F.lit(0.2514))) == "00:00:00,251"
    assert one(spark, tm.srt_timestamp(F.lit(0.2516))) == "00:00:00,252"
    assert one(spark, tm.vtt_timestamp(F.lit(59.9996))) == "00:00:59.1000"
    assert one(spark, tm.vtt_timestamp(F.lit(59.9996), carry=True)) == "00:01:00.000"
    assert one(spark, tm.vtt_timestamp(F.lit(360000.0))) == "100:00:00.000"


def test_text_columns(spark):
    assert one(spark, tx.escape_html(F.lit("<a & 'b'>"))) == "&lt;a &amp; 'b'&gt;"
    assert one(spark, tx.text_to_words(F.lit("  a b c\n"))) == ["a", "b", "c"]
    assert one(spark, tx.trim(F.lit("  x ﻿"))) == "x"
    assert one(spark, tx.byte_size(F.lit(1536))) == "1.5KiB" and one(spark, tx.byte_size(F.lit(0))) == "0.0B"
    assert one(spark, tx.output_base(F.lit("input/a/b.tar.mp3"))) == "a/b.tar" and one(spark, tx.worker_base(F.lit("input/a/b.tar.mp3"))) == "b.tar"
    assert one(spark, tx.decoded_key(F.lit("a+b%2Fc"))) == "a b/c"
    assert one(spark, tx.bracketed_json(F.lit('ok {"a": {"b": 1}} bye'))) == '{"a": {"b": 1}}'
    assert one(spark, tx.utf16_length(F.lit("a😀"))) == 3
    assert [one(spark, tx.json_number(F.lit(x))) for x in (5.0, 2.5, 0.0, 1e-7, 12345678.25)] == ["5", "2.5", "0", "0.0000001", "12345678.25"]
    assert tx.rule_key(Rule("regex", "a+", "b")) == "r'a+'->b" and tx.rule_key(Rule("literal", "a", "b")) == "a->b"


def test_regex_rules_follow_the_script_dialect(spark):
    def run(rule, text):
        return one(spark, tx.replace_all(F.lit(text), rule)), one(spark, tx.count_matches(F.lit(text), rule))

    assert run(Rule("regex", r"\bec2\b", "EC2"), "éec2 ec2.") == ("éEC2 EC2.", 2)
    assert run(Rule("regex", r"(\w+)@(\w+)", "$2 at $1 $$ $& $3"), "a@b") == ("b at a $ a@b $3", 1)
    assert run(Rule("literal", "a.b", "[$&$$]"), "a.b axb a.b") == ("[a.b$] axb [a.b$]", 2)
    assert run(Rule("regex", r"a\sb", "x"), "a b a b") == ("x x", 2)


CASES = [
    # two words become one: the kept word before lasts to their end and is halved
    ("we met data lake", "we met DataLake", 0.25, [("we", 0.0, 0.25, 0.9), ("met", 0.25, 0.625, None), ("DataLake", 0.625, 1.0, None)]),
    # one word becomes two at the front: the first takes its span, the second half of that
    ("into it now", "in to it now", 0.5, [("in", 0.0, 0.25, None), ("to", 0.25, 0.5, None), ("it", 0.5, 1.0, 0.9), ("now", 1.0, 1.5, 0.9)]),
    ("well then go", "then go", 1.0, [("then", 0.0, 2.0, None), ("go", 2.0, 3.0, 0.9)]),
    ("p q r s t", "p t", 1.0, [("p", 0.0, 4.0, None), ("t", 4.0, 5.0, 0.9)]),
    ("alpha omega", "alpha b c d omega", 1.0, [("alpha", 0.0, 0.5, None), ("b", 0.5, 0.75, None), ("c", 0.75, 0.875, None), ("d", 0.875, 1.0, None), ("omega", 1.0, 2.0, 0.9)]),
    ("left right", "", 1.0, []),
]


@pytest.mark.parametrize("original,patched,step,want", CASES)
def test_reconciled_timings(original, patched, step, want):
    got = al.reconciled(words_of(original, step), patched.split(), 0.0)
    assert [(w["word"], w["start"], w["end"], w["score"]) for w in got] == [(w, pytest.approx(x), pytest.approx(y), score) for w, x, y, score in want]


def test_reconcile_unknown_times():
    words = [word("ah", None, None, "A"), word("oh", 0.5, None, ""), word("yes", None, 2.0, "")]
    assert al.reconciled(words, ["yes"], 7.0) == [word("yes", None, 2.0, "", None)]
    got = al.reconciled(words, ["ah", "oh", "now", "yes"], 7.0)
    assert got[2] == word("now", None, None, "", None) and got[1] == words[1]
    assert al.reconciled(words, ["so", "well", "fine", "then"], 7.0)[:2] == [word("so", None, 2.0, "A", None), word("well", None, None, "A", None)]


def test_reconcile_edges():
    assert al.reconciled(words_of("blue sky"), ["so", "blue", "sky"], 0.0)[0] == word("so", 0.0, 0.0, None, None)
    same = al.reconciled(words_of("a b"), ["x", "y"], 0.0)
    assert [w["word"] for w in same] == ["x", "y"] and same[0]["score"] == 0.9
    assert al.reconciled(words_of("a b"), [], 0.0) == []
    assert [o for o, *_ in al.edit_script(["blue", "sky"], ["blue", "sea"])] == ["keep", "remove", "add"]


def test_alignment_against_a_plain_table():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        pairs, i, j = [], len(a), len(b)
        while i and j:
            if a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
                pairs.insert(0, (i, j))
            elif best[i - 1][j] > best[i][j - 1]:
                i -= 1
            else:
                j -= 1
        assert al.common(a, b) == pairs
        runs = "".join("k" if o == "keep" else "x" for o, *_ in al.edit_script(a, b)).split("k")
        assert al.changes(a, b) == (len(pairs), max(map(len, runs)))
        script = al.edit_script(a, b)
        assert [w for o, _, _, w in script if o != "add"] == a and [w for o, _, _, w in script if o != "remove"] == b


def test_validation_ladder(spark):
    rows = [
        ("they keep it in data lake", "they keep it in DataLake"),
        ("one two three four five six", "uno dos tres cuatro cinco seis"),
        ("same text", "same text"),
        ("um yes", ""),
        ("a b c d", "w x y z"),
        ("alpha beta gamma delta epsilon zeta eta theta iota kappa", "alpha beta gamma delta epsilon zeta eta X Y Z Q"),
    ]
    pairs = spark.createDataFrame(rows, "original string, corrected string")
    got = {r.original: r for r in validated(pairs).collect()}
    assert [got[o].ignore_reason for o, _ in rows] == [None, "word-change-ratio", "no-change", None, "consecutive-changes", "consecutive-changes"]
    assert got[rows[1][0]].ratio == 1.0 and got[rows[5][0]].run == 7
    off = {r.original: r.ignore_reason for r in validated(pairs, Validation(enabled=False)).collect()}
    assert set(off.values()) == {None}


def test_replacement(spark):
    rows = segment_rows(spark, (0.0, 1.2, "we fill data lake", None, words_of("we fill data lake")), (2.0, 3.0, " ec2  here", None, None), (3.0, 4.0, "plain", None, []))
    rules = [Rule("literal", "data lake", "DataLake"), Rule("regex", r"\bec2\b", "EC2"), Rule("literal", "zzz", "y"), Rule("literal", "DataLake", "DataLake")]
    out, stats = apply_replacements(rows, rules)
    got = {r.seg_idx: r for r in out.collect()}
    assert got[0].text == "we fill DataLake" and got[0].words[2].start == pytest.approx(0.75) and got[0].end == 1.2
    assert got[1].text == "EC2 here" and got[1].words is None and got[2].text == "plain"
    s = stats.first()
    assert (s.segments_modified, s.word_changes) == (2, 2)
    assert s.replacement_counts == {"data lake->DataLake": 1, r"r'\bec2\b'->EC2": 1, "DataLake->DataLake": 1}
    untouched, none = apply_replacements(rows, [])
    assert [r.text for r in untouched.orderBy("seg_idx").collect()] == ["we fill data lake", " ec2  here", "plain"] and none.first().segments_modified == 0


def test_normalization_splits(spark):
    thirteen = " ".join("abcdefghijklm")
    rows = segment_rows(spark, (0.0, 9.0, thirteen, "A", [word(w, round(i * 0.3, 1), round(i * 0.3 + 0.2, 1)) for i, w in enumerate(thirteen.split())]))
    out, stats = normalize_segments(rows)
    got = out.orderBy("seg_idx").collect()
    assert [len(r.words) for r in got] == [10, 3] and got[1].speaker == "A" and got[1].text == "k l m"
    assert stats.first().splits == 1 and stats.first().normalized_segments == 2
    comma = "a b c d e f g, h i"
    out, _ = normalize_segments(segment_rows(spark, (0.0, 9.0, comma, None, words_of(comma))))
    assert [r.text for r in out.orderBy("seg_idx").collect()] == ["a b c d e f g,", "h i"]
    two = words_of("a b", who="A") + words_of("c", who="B") + [word("d")]
    out, _ = normalize_segments(segment_rows(spark, (0.0, 9.0, "x", "A", two), (1.0, 2.0, " kept ", None, None)))
    got = out.orderBy("seg_idx").collect()
    assert [(r.text, r.speaker, r.end) for r in got] == [("a b", "A", 0.6), ("c d", "B", 0.0), (" kept ", None, 2.0)]
    long_word = "x" * 60
    out, _ = normalize_segments(segment_rows(spark, (0.0, 1.0, "", None, words_of(f"a {long_word} b"))), Normalization(punctuation_chars=("?!",)))
    assert [r.text for r in out.orderBy("seg_idx").collect()] == ["a", long_word, "b"]


def test_caption_documents(spark):
    w = [word("Hi", 0.251, 0.712), word("<you>", 1.0, 1.5)]
    rows = segment_rows(spark, (0.0, 2.5, " Hi & <you>", "Ann", w), (3.0, 4.0, "Bye", None, [word("Bye", 3.0, 3.5, "Bob")]), (4.0, 5.0, "x", "Bob", []))
    vtt = cap.render_vtt(rows).first().document
    assert vtt == "WEBVTT\n\n00:00:00.000 --> 00:00:02.500\nAnn: Hi &amp; &lt;you&gt;\n\n00:00:03.000 --> 00:00:04.000\nBob: Bye\n\n00:00:04.000 --> 00:00:05.000\nx\n"
    srt = cap.render_srt(rows, Captions(include_speaker_names="never")).first().document
    assert srt.split("\n")[:4] == ["1", "00:00:00,000 --> 00:00:02,500", "Hi &amp; &lt;you&gt;", ""] and srt.endswith("x\n")
    lit = cap.cues(rows, Captions(highlight_words=True, highlight_with="bold")).orderBy("seg_idx", "cue_idx").collect()
    assert [(r.start, r.end) for r in lit[:4]] == [(0.251, 0.712), (0.712, 1.0), (1.0, 1.5), (1.5, 2.5)]
    assert [r.text for r in lit[:3]] == ["Ann: <b>Hi</b> &lt;you&gt;", "Ann: Hi &lt;you&gt;", "Ann: Hi <b>&lt;you&gt;</b>"]
    doc = json.loads(cap.render_json(rows).first().document)
    assert doc["speakers"] == {"spk_0": "Ann", "spk_1": "Bob"} and doc["segments"][0] == {"speakerLabel": "spk_0", "start": 0, "end": 2.5, "text": "Hi & <you>"}
    silent = segment_rows(spark, (0.0, 1.0, "q", None, [word("q")]), (1.0, 0.0, "r", "Z", [word("r")]))
    assert cap.cues(silent.where("seg_idx = 1"), Captions(highlight_words=True)).count() == 0
    assert cap.render_vtt(silent.where("seg_idx = 1"), Captions(highlight_words=True)).first().document == "WEBVTT\n"


def test_suggestions_in_order(spark):
    rows = segment_rows(spark, (0.0, 1.0, "we fill data lake a lot these days ok", "S0", words_of("we fill data lake a lot these days ok", who="S0")), (1.0, 2.0, "fine", "S1", words_of("fine", who="S1")))
    response = 'Sure: {"identifiedSpeakers": {"S0": "Ann", "S1": ""}, "updates": [{"idx": 0, "text": "we fill DataLake a lot these days ok"}, {"idx": 0, "text": "we fill DataLake a lot these days okay"}, {"idx": 1, "text": "fine"}, {"idx": 9, "text": "z"}, {"idx": 0.5, "text": "z"}]} end'
    updates, names = parse_responses(spark.createDataFrame([(1, response)], "transcript_id long, response string"))
    out, applied, ignored, stats = apply_suggestions(rows, updates, names)
    got = {r.seg_idx: r for r in out.collect()}
    assert got[0].text == "we fill DataLake a lot these days okay" and got[0].speaker == "Ann" and got[0].words[0].speaker == "Ann" and got[1].speaker == "S1"
    assert applied.count() == 2 and [r.ignore_reason for r in ignored.collect()] == ["no-change"]
    s = stats.first()
    assert (s.segments_processed, s.segments_updated, s.speakers_identified) == (2, 2, 2)
    bad, none = parse_responses(spark.createDataFrame([(1, "no json")], "transcript_id long, response string"))
    assert bad.count() == 0 and none.count() == 0
    assert apply_suggestions(rows, bad, none)[0].count() == 2


def test_config():
    c = load_config()
    assert c == PipelineConfig() and c.replacement_rules is None
    c = load_config({"captions": {"highlightWords": True, "other": 1}, "replacementRules": [{"type": "literal", "search": "a", "replacement": "b"}], "llmRefinement": {"profileId": "eu.x", "suggestionValidation": {"maxConsecutiveChanges": 9}}})
    assert c.captions.highlight_words and c.captions.generate_vtt and c.replacement_rules == (Rule("literal", "a", "b"),)
    assert c.refinement.suggestion_validation.max_consecutive_changes == 9 and c.refinement.model_config["max_tokens"] == 64000
    for bad in ({"captions": {"highlightWith": "blink"}}, {"transcription": {"jobTimeoutMinutes": 721}}, {"replacementRules": [{"type": "glob", "search": "a", "replacement": ""}]}, {"captions": {"highlightWords": "yes"}}, {"replacementRules": [{"type": "literal", "search": "", "replacement": "x"}]}, {"llmRefinement": {}}):
        with pytest.raises(ConfigError):
            load_config(bad)


def test_jobs(spark):
    timer = StepTimer()
    with timer.step("transcription"):
        pass
    with pytest.raises(RuntimeError), timer.step("alignment"):
        raise RuntimeError("x")
    timer.skip("diarization")
    assert [(r.step, r.status) for r in timer.frame(spark).collect()] == [("transcription", "success"), ("alignment", "error"), ("diarization", "skipped")]
    polls = spark.createDataFrame([(1, i, n, warm) for i, (n, warm) in enumerate([(0, False), (0, False), (1, False), (0, True), (0, True), (0, True), (0, False)])], "k int, i int, n_messages int, warm boolean")
    got = idle_shutdowns(polls, "k", "i").orderBy("i").collect()
    assert [r.empty_run for r in got] == [1, 2, 0, 1, 2, 3, 4] and [r.stops for r in got] == [False] * 6 + [True]
