"""Registered queries of the transcript engine, each with its SQL counterpart where SQL has one."""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Captions, Normalization, Refinement, Validation
from ..functions.alignment import reconcile_words, word_change_ratio, word_changes, word_diff
from ..functions.distance import edit_distance, norm_edit_distance
from ..functions.text import byte_size, decoded_key, effective_speaker, escape_html, labelled_line, model_of, output_base, region_of, words_text, worker_base
from ..functions.timing import srt_timestamp, vtt_timestamp
from ..operators import captions as cap
from ..operators.jobs import idle_shutdowns, new_keys, step_durations, warmup_expiry
from ..operators.normalization import normalization_stats, normalize_segments, split_parts
from ..operators.refinement import refine
from ..operators.replacement import apply_replacements, patched_text, rule_counts
from ..operators.speakers import apply_speaker_names, speaker_labels
from ..operators.suggestions import apply_suggestions, prompt_lines, validated
from ..sources.runs import work_folder
from .fixtures import BASE_SQL, RULES, aligned_sql, deterministic_client, names, segments, updates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
HIGHLIGHT = Captions(highlight_words=True)
KEY = ["transcript_id", "seg_idx"]


def query(sql: str | None = None, base: bool = True):
    """Register a query, with SQL over the fixture's rows (base) or over the plain tables."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = BASE_SQL + sql if base else sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _stamp(x: str, mark: str) -> str:
    whole = f"CAST(floor({x} / 3600) AS BIGINT), CAST(floor(({x} % 3600) / 60) AS BIGINT), CAST(floor({x} % 60) AS BIGINT)"
    return f"printf('%02d:%02d:%02d{mark}%03d', {whole}, CAST(floor(({x} - floor({x})) * 1000 + 0.5) AS BIGINT))"


def _escaped(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


WHO = "COALESCE(NULLIF(speaker, ''), (SELECT NULLIF(w.speaker, '') FROM w WHERE w.t = seg.t AND w.s = seg.s AND w.pos = 0), 'SPEAKER_00')"
WITH_WHO = f", who AS (SELECT *, {WHO} AS who FROM seg), pre AS (SELECT *, lag(who) OVER (PARTITION BY t ORDER BY s) AS previous FROM who), px AS (SELECT *, CASE WHEN who IS NOT DISTINCT FROM previous THEN '' ELSE who || ': ' END AS prefix FROM pre)"
TRIMMED = r"regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '')"
BASIC = f', cue AS (SELECT t, s, "start", "end", prefix || {_escaped(TRIMMED)} AS text FROM px)'


@query(' SELECT t AS transcript_id, s AS seg_idx, pos::BIGINT AS pos, word, "start", "end", speaker FROM w')
def words_explode(spark, sf_dir):
    made = segments(spark, sf_dir).select(*KEY, F.posexplode("words").alias("pos", "w"))
    return made.select(*KEY, F.col("pos").cast("long").alias("pos"), "w.word", "w.start", "w.end", "w.speaker")


@query(" SELECT t AS transcript_id, s AS seg_idx, array_to_string(toks, ' ') AS words_text, n::BIGINT AS n_words, length(array_to_string(toks, ' '))::BIGINT AS n_chars FROM seg")
def words_text_join(spark, sf_dir):
    joined = words_text()
    return segments(spark, sf_dir).select(*KEY, joined.alias("words_text"), F.size("words").cast("long").alias("n_words"), F.length(joined).cast("long").alias("n_chars"))


@query(WITH_WHO + " SELECT t AS transcript_id, s AS seg_idx, who AS speaker FROM who")
def effective_speakers(spark, sf_dir):
    return segments(spark, sf_dir).select(*KEY, effective_speaker().alias("speaker"))


@query(WITH_WHO + " SELECT t AS transcript_id, s AS seg_idx, who, previous, prefix FROM px")
def speaker_prefix_when_changes(spark, sf_dir):
    return cap.with_prefix(segments(spark, sf_dir)).select(*KEY, "who", "previous", "prefix")


@query(WITH_WHO + " SELECT t AS transcript_id, s AS seg_idx, who || ': ' AS prefix FROM px")
def speaker_prefix_always(spark, sf_dir):
    return cap.with_prefix(segments(spark, sf_dir), "always").select(*KEY, "prefix")


@query(" SELECT t AS transcript_id, s AS seg_idx, pos::BIGINT AS pos, " + _stamp('w."start"', ".") + " AS vtt, " + _stamp("(w.\"end\" * 7.03125::DOUBLE)", ",") + ' AS srt FROM w WHERE "start" IS NOT NULL')
def timestamps(spark, sf_dir):
    w = words_explode(spark, sf_dir).where("start IS NOT NULL")
    return w.select(*KEY, "pos", vtt_timestamp("start").alias("vtt"), srt_timestamp(F.col("end") * 7.03125).alias("srt"))


@query(f" SELECT t AS transcript_id, s AS seg_idx, {_escaped('text')} AS escaped FROM seg")
def escape_html_text(spark, sf_dir):
    return segments(spark, sf_dir).select(*KEY, escape_html("text").alias("escaped"))


@query(" SELECT t AS transcript_id, s AS seg_idx, '[' || s || '] [' || COALESCE(speaker, 'SPEAKER_00') || '] ' || array_to_string(toks, ' ') AS line FROM seg")
def labelled_lines(spark, sf_dir):
    return segments(spark, sf_dir).select(*KEY, labelled_line("seg_idx", "speaker", words_text()).alias("line"))


@query(" SELECT t AS transcript_id, string_agg('[' || s || '] [' || COALESCE(speaker, 'SPEAKER_00') || '] ' || array_to_string(toks, ' '), chr(10) ORDER BY s) AS transcript FROM seg GROUP BY t")
def prompt_transcripts(spark, sf_dir):
    return prompt_lines(segments(spark, sf_dir))


@query(WITH_WHO + BASIC + " SELECT t AS transcript_id, s AS seg_idx, row_number() OVER (PARTITION BY t ORDER BY s) AS n, " + _stamp('"start"', ",") + " || ' --> ' || " + _stamp('"end"', ",") + " AS times, text FROM cue")
def basic_cues_srt(spark, sf_dir):
    made = cap.numbered(cap.cues(segments(spark, sf_dir)))
    return made.select(*KEY, F.col("n").cast("long").alias("n"), F.concat(srt_timestamp("start"), F.lit(" --> "), srt_timestamp("end")).alias("times"), "text")


@query(WITH_WHO + BASIC + ' SELECT t AS transcript_id, s AS seg_idx, "start", "end", text FROM cue')
def basic_cues_vtt(spark, sf_dir):
    return cap.cues(segments(spark, sf_dir)).select(*KEY, "start", "end", "text")


EVEN = """, ev AS (
  SELECT w.*, seg_end > 0 AND seg_end > seg_start AS good,
    CASE WHEN seg_end > 0 AND seg_end > seg_start THEN COALESCE(w."start", seg_start + pos * ((seg_end - seg_start) / n)) ELSE w."start" END AS ws,
    CASE WHEN seg_end > 0 AND seg_end > seg_start THEN COALESCE(w."end", seg_start + (pos + 1) * ((seg_end - seg_start) / n)) ELSE w."end" END AS we
  FROM w
), valid AS (
  SELECT *, lag(we) OVER (PARTITION BY t, s ORDER BY pos) AS before, row_number() OVER (PARTITION BY t, s ORDER BY pos DESC) AS from_end
  FROM ev WHERE ws >= 0 AND we > ws
)"""
LIT = f"""{EVEN}, full_text AS (SELECT t, s, array_to_string(list_transform(toks, lambda x: {_escaped('x')}), ' ') AS plain, prefix, toks FROM px), hc AS (
  SELECT v.t, v.s, pos * 3 AS o, before AS "start", ws AS "end", prefix || plain AS text FROM valid v JOIN full_text f ON v.t = f.t AND v.s = f.s WHERE ws > before
  UNION ALL SELECT v.t, v.s, pos * 3 + 1, ws, we, prefix || array_to_string(list_transform(toks, lambda x, i: CASE WHEN i = v.pos + 1 THEN '<u>' || {_escaped('x')} || '</u>' ELSE {_escaped('x')} END), ' ') FROM valid v JOIN full_text f ON v.t = f.t AND v.s = f.s
  UNION ALL SELECT v.t, v.s, pos * 3 + 2, we, seg_end, prefix || plain FROM valid v JOIN full_text f ON v.t = f.t AND v.s = f.s WHERE from_end = 1 AND good AND seg_end > we
), hn AS (SELECT *, row_number() OVER (PARTITION BY t, s ORDER BY o) - 1 AS k, row_number() OVER (PARTITION BY t ORDER BY s, o) AS num FROM hc)"""


@query(WITH_WHO + EVEN + " SELECT t AS transcript_id, s AS seg_idx, pos::BIGINT AS pos, ws AS \"start\", we AS \"end\" FROM ev")
def distribute_timing(spark, sf_dir):
    made = segments(spark, sf_dir).select(*KEY, F.posexplode(cap.evenly_timed("words", "start", "end")).alias("pos", "w"))
    return made.select(*KEY, F.col("pos").cast("long").alias("pos"), "w.start", "w.end")


@query(WITH_WHO + LIT + ' SELECT t AS transcript_id, s AS seg_idx, k::BIGINT AS cue_idx, num AS n, "start", "end", text FROM hn')
def highlight_cues(spark, sf_dir):
    made = cap.numbered(cap.cues(segments(spark, sf_dir), HIGHLIGHT))
    return made.select(*KEY, F.col("cue_idx").cast("long").alias("cue_idx"), F.col("n").cast("long").alias("n"), "start", "end", "text")


@query(WITH_WHO + LIT + " SELECT t AS transcript_id, s AS seg_idx, count(*) AS n_cues, count_if(o % 3 <> 1)::BIGINT AS n_fillers, min(\"start\") AS first_start, max(\"end\") AS last_end FROM hn GROUP BY t, s")
def filler_cues(spark, sf_dir):
    filler = ~F.col("text").contains("<u>")
    made = cap.cues(segments(spark, sf_dir), HIGHLIGHT)
    return made.groupBy(*KEY).agg(F.count("*").alias("n_cues"), F.count_if(filler).alias("n_fillers"), F.min("start").alias("first_start"), F.max("end").alias("last_end"))


LABELS = """, sp AS (SELECT t, speaker FROM seg UNION SELECT t, speaker FROM w), lab AS (SELECT t, speaker, 'spk_' || (dense_rank() OVER (PARTITION BY t ORDER BY speaker) - 1) AS label FROM sp WHERE speaker <> '')"""


@query(LABELS + " SELECT t AS transcript_id, speaker, label FROM lab")
def speaker_label_ranks(spark, sf_dir):
    return speaker_labels(segments(spark, sf_dir))


@query(WITH_WHO + LABELS + f' SELECT who.t AS transcript_id, s AS seg_idx, COALESCE(label, \'spk_0\') AS speaker_label, "start", "end", {TRIMMED} AS text FROM who LEFT JOIN lab ON lab.t = who.t AND lab.speaker = who.who')
def caption_json_segments(spark, sf_dir):
    return cap.json_segments(segments(spark, sf_dir))


@query(WITH_WHO + BASIC + " SELECT t AS transcript_id, 'WEBVTT' || chr(10) || string_agg(chr(10) || " + _stamp('"start"', ".") + " || ' --> ' || " + _stamp('"end"', ".") + " || chr(10) || text || chr(10), '' ORDER BY s) AS document FROM cue GROUP BY t")
def render_vtt_document(spark, sf_dir):
    return cap.render_vtt(segments(spark, sf_dir))


@query(WITH_WHO + LIT + " SELECT t AS transcript_id, string_agg(num || chr(10) || " + _stamp('"start"', ",") + " || ' --> ' || " + _stamp('"end"', ",") + " || chr(10) || text || chr(10), chr(10) ORDER BY num) AS document FROM hn GROUP BY t")
def render_srt_highlighted(spark, sf_dir):
    return cap.render_srt(segments(spark, sf_dir), HIGHLIGHT)


def _number(x: str) -> str:
    return f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"


@query(
    WITH_WHO + LABELS + ", js AS (SELECT who.t, s, string_agg('x', '') AS x, ANY_VALUE('    {' || chr(10) || '      \"speakerLabel\": \"' || COALESCE(label, 'spk_0') || '\",' || chr(10) || '      \"start\": ' || "
    + _number('"start"') + " || ',' || chr(10) || '      \"end\": ' || " + _number('"end"') + " || ',' || chr(10) || '      \"text\": ' || CAST(to_json(" + TRIMMED
    + ") AS VARCHAR) || chr(10) || '    }') AS b FROM who LEFT JOIN lab ON lab.t = who.t AND lab.speaker = who.who GROUP BY who.t, s), sj AS (SELECT t, string_agg('    \"' || label || '\": \"' || speaker || '\"', ',' || chr(10) ORDER BY label) AS b FROM lab GROUP BY t) "
    "SELECT js.t AS transcript_id, '{' || chr(10) || '  \"speakers\": {' || chr(10) || ANY_VALUE(sj.b) || chr(10) || '  },' || chr(10) || '  \"segments\": [' || chr(10) || string_agg(js.b, ',' || chr(10) ORDER BY s) || chr(10) || '  ]' || chr(10) || '}' AS document FROM js JOIN sj ON sj.t = js.t GROUP BY js.t"
)
def render_json_document(spark, sf_dir):
    return cap.render_json(segments(spark, sf_dir))


RULED = r""", r0 AS (SELECT t, s, n, array_to_string(toks, ' ') AS x0 FROM seg),
r1 AS (SELECT *, replace(x0, 'the ', 'THE ') AS x1 FROM r0),
r2 AS (SELECT *, regexp_replace(x1, '\b([a-z]+)tion\b', '\1tion/\1', 'g') AS x2 FROM r1),
r3 AS (SELECT *, replace(x2, 'and', 'and so') AS x3 FROM r2),
r5 AS (SELECT *, regexp_replace(x3, '(\w)\. ', '\1! ', 'g') AS x5 FROM r3),
r6 AS (SELECT *, replace(x5, 'the ', 'THE ') AS x6, (length(x0) - length(replace(x0, 'the ', ''))) // 4 AS n1, len(regexp_extract_all(x1, '\b([a-z]+)tion\b')) AS n2,
  (length(x2) - length(replace(x2, 'and', ''))) // 3 AS n3, len(regexp_extract_all(x3, '(\w)\. ')) AS n5, (length(x5) - length(replace(x5, 'the ', ''))) // 4 AS n6 FROM r5),
m AS (SELECT *, len(list_filter(string_split_regex(x6, '\s+'), lambda v: v <> '')) AS n_new FROM r6)"""


@query(RULED + " SELECT t AS transcript_id, s AS seg_idx, x0 AS original_text, x6 AS patched_text FROM r6")
def rule_replace(spark, sf_dir):
    return patched_text(segments(spark, sf_dir), RULES).select(*KEY, "original_text", "patched_text")


@query(
    RULED + r""", c AS (SELECT t, 'the ->THE ' AS rule, n1 + n6 AS n FROM r6 UNION ALL SELECT t, 'r''\b([a-z]+)tion\b''->$1tion/$1', n2 FROM r6
UNION ALL SELECT t, 'and->and so', n3 FROM r6 UNION ALL SELECT t, 'r''(\w)\. ''->$1! ', n5 FROM r6) SELECT t AS transcript_id, rule, sum(n)::BIGINT AS n FROM c GROUP BY t, rule HAVING sum(n) > 0"""
)
def rule_count_stats(spark, sf_dir):
    return rule_counts(patched_text(segments(spark, sf_dir), RULES))


@query(RULED + " SELECT t AS transcript_id, count_if(x6 <> x0)::BIGINT AS segments_modified, COALESCE(sum(CASE WHEN x6 <> x0 THEN greatest(abs(n_new - n), 1) END), 0)::BIGINT AS word_changes FROM m GROUP BY t")
def replacement_stats(spark, sf_dir):
    _, stats = apply_replacements(segments(spark, sf_dir), RULES)
    return stats.select("transcript_id", "segments_modified", F.col("word_changes").cast("long").alias("word_changes"))


@query(RULED + " SELECT m.t AS transcript_id, m.s AS seg_idx, CASE WHEN x6 <> x0 THEN array_to_string(list_filter(string_split_regex(x6, '\\s+'), lambda v: v <> ''), ' ') ELSE seg.text END AS text, n_new::BIGINT AS n_words, \"start\", \"end\" FROM m JOIN seg ON m.t = seg.t AND m.s = seg.s")
def replaced_segments(spark, sf_dir):
    out, _ = apply_replacements(segments(spark, sf_dir), RULES)
    return out.select(*KEY, "text", F.size("words").cast("long").alias("n_words"), "start", "end")


@query()
def replaced_word_timings(spark, sf_dir):
    """Timings by alignment: beyond SQL; tests compare them with a plain model."""
    out, _ = apply_replacements(segments(spark, sf_dir), RULES)
    return out.select(*KEY, F.posexplode("words").alias("pos", "w")).select(*KEY, "pos", "w.*")


RENAME = "CASE {x} WHEN 'SPEAKER_00' THEN 'Alice' WHEN 'SPEAKER_01' THEN 'Bob' ELSE {x} END"


@query(" SELECT t AS transcript_id, s AS seg_idx, pos::BIGINT AS pos, " + RENAME.format(x="seg_speaker") + " AS speaker, " + RENAME.format(x="speaker") + " AS word_speaker FROM w")
def speaker_mapping(spark, sf_dir):
    made = segments(spark, sf_dir)
    named = apply_speaker_names(made, names(made))
    return named.select(*KEY, "speaker", F.posexplode("words").alias("pos", "w")).select(*KEY, F.col("pos").cast("long").alias("pos"), "speaker", F.col("w.speaker").alias("word_speaker"))


SUGGESTED = """, sug AS (SELECT t, s AS ord, s AS idx, CASE s % 4 WHEN 0 THEN array_to_string(toks, ' ') WHEN 1 THEN array_to_string(list_filter(toks, lambda x, i: (i - 1) % 7 <> 3), ' ')
  WHEN 2 THEN array_to_string(list_concat([toks[1], toks[1] || 'x'], toks[2:]), ' ') ELSE array_to_string(list_reverse(toks), ' ') END AS text FROM seg
  UNION ALL SELECT t, 1000000, 1000000, text FROM seg WHERE s = 0)"""


@query(SUGGESTED + " SELECT sug.t AS transcript_id, sug.idx AS seg_idx, sug.text AS corrected FROM sug JOIN seg ON seg.t = sug.t AND seg.s = sug.idx")
def suggestion_range_filter(spark, sf_dir):
    made = segments(spark, sf_dir)
    own = updates(made).select("transcript_id", F.col("idx").alias("seg_idx"), F.col("text").alias("corrected"))
    return made.select(*KEY).join(own, KEY).select(*KEY, "corrected")


def _pairs(spark, sf_dir) -> DataFrame:
    made = segments(spark, sf_dir)
    own = updates(made).select("transcript_id", F.col("idx").alias("seg_idx"), F.col("text").alias("corrected"))
    return made.join(own, KEY).select(*KEY, words_text().alias("original"), "corrected")


@query(SUGGESTED + " SELECT seg.t AS transcript_id, count(*) AS n, count_if(sug.text = array_to_string(toks, ' '))::BIGINT AS n_unchanged FROM sug JOIN seg ON seg.t = sug.t AND seg.s = sug.idx GROUP BY seg.t")
def no_change_filter(spark, sf_dir):
    return _pairs(spark, sf_dir).groupBy("transcript_id").agg(F.count("*").alias("n"), F.count_if(F.col("original") == F.col("corrected")).alias("n_unchanged"))


def _recursive_sql(sql: str) -> str:
    return (BASE_SQL + sql).replace("WITH tok", "WITH RECURSIVE tok", 1)


# the SQL engine's edit distance counts bytes: each letter beyond ASCII of the tables becomes one byte that they don't have
BYTES = "translate({x}, 'ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü', " + " || ".join(f"chr({i})" for i in (*range(1, 9), *range(14, 27))) + ")"
JUDGED = (
    SUGGESTED
    + """, met AS MATERIALIZED (SELECT seg.t, seg.s, array_to_string(toks, ' ') AS original, toks, sug.text AS corrected, list_filter(string_split_regex(sug.text, '\\s+'), lambda x: x <> '') AS patched FROM sug JOIN seg ON seg.t = sug.t AND seg.s = sug.idx)"""
    + aligned_sql("SELECT t, s, list_transform(toks, lambda x: lower(x)) AS a, list_transform(patched, lambda x: lower(x)) AS b FROM met WHERE original <> corrected", "low")
    + """, measured AS (SELECT met.*, len(toks) AS n, len(patched) AS m, original = corrected AS same, COALESCE(lcs, 0) AS lcs, COALESCE(run, 0) AS run FROM met
    LEFT JOIN (SELECT t, s, count(*) - 1 AS lcs, max(until_p - p - 1 + until_q - q - 1) AS run FROM low_gap GROUP BY t, s) USING (t, s))
, rated AS (SELECT *, CASE WHEN same OR greatest(n, m) = 0 THEN 0 WHEN least(n, m) = 0 THEN 1 ELSE (greatest(n, m) - lcs)::DOUBLE / greatest(n, m) END AS ratio,
    CASE WHEN same THEN 0 WHEN original = '' OR corrected = '' THEN 1 ELSE levenshtein(LETTERS_o, LETTERS_c)::DOUBLE / greatest(length(original), length(corrected)) END AS distance FROM measured)
, judged AS (SELECT *, CASE WHEN same THEN 'no-change' WHEN n >= 5 AND ratio > 0.4 THEN 'word-change-ratio' WHEN n >= 5 AND distance > 0.5 THEN 'edit-distance' WHEN run > 3 THEN 'consecutive-changes' END AS reason FROM rated)"""
).replace("LETTERS_o", BYTES.format(x="original")).replace("LETTERS_c", BYTES.format(x="corrected"))


@query(_recursive_sql(JUDGED + " SELECT t AS transcript_id, s AS seg_idx, ratio::DOUBLE AS ratio, distance::DOUBLE AS distance, run::INT AS run, reason AS ignore_reason FROM judged"), base=False)
def validate_correction(spark, sf_dir):
    return validated(_pairs(spark, sf_dir), Validation()).select(*KEY, "ratio", "distance", "run", "ignore_reason")


REFINED = (
    JUDGED
    + aligned_sql("SELECT t, s, toks AS a, patched AS b FROM judged WHERE reason IS NULL AND len(toks) <> len(patched)", "own")
    + """, firsts AS (SELECT t, s, until_p AS p, until_q AS q FROM own_gap WHERE g = 0)
, word0 AS (SELECT t, s, pos, "start" FROM w)
, done AS (SELECT seg.t, seg.s, """
    + RENAME.format(x="seg.speaker")
    + """ AS speaker, CASE WHEN reason IS NULL AND j.t IS NOT NULL THEN array_to_string(patched, ' ') ELSE seg.text END AS text, CASE WHEN reason IS NULL AND j.t IS NOT NULL THEN len(patched) ELSE seg.n END AS n_words,
    CASE WHEN f.t IS NULL OR f.p = 0 AND f.q = 0 THEN a."start" WHEN f.q = 0 THEN COALESCE(a."start", b."start") WHEN f.p > 0 THEN a."start" ELSE seg."start" END AS first_start
  FROM seg LEFT JOIN judged j ON j.t = seg.t AND j.s = seg.s LEFT JOIN firsts f ON f.t = seg.t AND f.s = seg.s
  LEFT JOIN word0 a ON a.t = seg.t AND a.s = seg.s AND a.pos = 0 LEFT JOIN word0 b ON b.t = seg.t AND b.s = seg.s AND b.pos = f.p)"""
)


@query(_recursive_sql(REFINED + " SELECT t AS transcript_id, s AS seg_idx, speaker, text, n_words::INT AS n_words, first_start FROM done"), base=False)
def refined_segments(spark, sf_dir):
    made = segments(spark, sf_dir)
    out, *_ = apply_suggestions(made, updates(made), names(made), most_rounds=1)
    return out.select(*KEY, "speaker", "text", F.size("words").alias("n_words"), F.get("words", F.lit(0))["start"].alias("first_start"))


@query(
    _recursive_sql(JUDGED + " SELECT seg.t AS transcript_id, count(*)::BIGINT AS segments_processed, count_if(j.t IS NOT NULL AND reason IS NULL)::BIGINT AS segments_updated, 3::BIGINT AS speakers_identified FROM seg LEFT JOIN judged j ON j.t = seg.t AND j.s = seg.s GROUP BY seg.t"),
    base=False,
)
def refinement_stats(spark, sf_dir):
    made = segments(spark, sf_dir)
    return apply_suggestions(made, updates(made), names(made), most_rounds=1)[3]


def _refined(spark, sf_dir):
    """The fixture refined by its client, answers kept in a new folder of the work folder."""
    memo = f"{work_folder(spark)}/answers-{uuid.uuid4().hex}"
    if (at := urlparse(memo)).scheme in ("", "file"):
        atexit.register(shutil.rmtree, at.path, ignore_errors=True)
    return refine(segments(spark, sf_dir), Refinement(profile_id="eu.fixture"), deterministic_client, memo, most_rounds=1)


@query(" SELECT t AS transcript_id, s AS seg_idx, CASE WHEN speaker = 'SPEAKER_00' THEN 'Alice' ELSE speaker END AS speaker, CASE WHEN s % 3 = 1 AND n >= 5 THEN array_to_string(toks, ' ') || 'x' ELSE text END AS text, n::INT AS n_words FROM seg")
def client_refined_segments(spark, sf_dir):
    return _refined(spark, sf_dir).segments.select(*KEY, "speaker", "text", F.size("words").alias("n_words"))


@query(" SELECT t AS transcript_id, count(*)::BIGINT AS segments_processed, count_if(s % 3 = 1 AND n >= 5)::BIGINT AS segments_updated, 1::BIGINT AS speakers_identified FROM seg GROUP BY t")
def client_refinement_stats(spark, sf_dir):
    return _refined(spark, sf_dir).stats


@query(
    """, d AS (SELECT t, s, toks, n, list_filter(toks, lambda x, i: (i - 1) % 7 <> 3) AS dropped FROM seg)
SELECT t AS transcript_id, s AS seg_idx, len(dropped)::BIGINT AS lcs_dropped, n::BIGINT AS lcs_doubled,
  CASE WHEN n = 0 THEN 0 ELSE (n - len(dropped))::DOUBLE / n END AS ratio_dropped, CASE WHEN n = 0 THEN 1 ELSE 1::DOUBLE / (n + 1) END AS ratio_doubled FROM d"""
)
def lcs_and_ratio(spark, sf_dir):
    """A list against itself without some words (those left are a common subsequence), and against itself with one more."""
    toks = F.transform("words", lambda w: w["word"])
    made = segments(spark, sf_dir).select(*KEY, toks.alias("a")).withColumn("b", F.filter("a", lambda w, i: i % 7 != 3))
    first = F.get("a", F.lit(0))
    made = made.withColumn("c", F.concat(F.array(first, F.concat(first, F.lit("x"))), F.slice("a", 2, F.greatest(F.size("a") - 1, F.lit(0)))))
    made = made.withColumns({"x": word_changes("a", "b")["lcs"], "y": word_changes("a", "c")["lcs"]})
    return made.select(
        *KEY, F.col("x").cast("long").alias("lcs_dropped"), F.col("y").cast("long").alias("lcs_doubled"),
        word_change_ratio("x", F.size("a"), F.size("b")).alias("ratio_dropped"), word_change_ratio("y", F.size("a"), F.size("c")).alias("ratio_doubled"),
    )


DIFF = (
    SUGGESTED
    + aligned_sql("SELECT seg.t, seg.s, toks AS a, string_split(sug.text, ' ') AS b FROM sug JOIN seg ON seg.t = sug.t AND seg.s = sug.idx", "d")
    + """, steps AS (
  SELECT t, s, g, 0 AS r, 'remove' AS op, x - 1 AS original_index, NULL AS patched_index FROM d_gap, UNNEST(range(p + 2, until_p + 1)) AS u(x)
  UNION ALL SELECT t, s, g, 1, 'add', NULL, x - 1 FROM d_gap, UNNEST(range(q + 2, until_q + 1)) AS u(x)
  UNION ALL SELECT t, s, g, 2, 'keep', until_p, until_q FROM d_gap JOIN d_pair USING (t, s) WHERE until_p < n AND until_q < m)
SELECT t AS transcript_id, s AS seg_idx, (row_number() OVER (PARTITION BY t, s ORDER BY g, r, original_index, patched_index) - 1)::INT AS k, op, original_index::INT AS original_index, patched_index::INT AS patched_index,
  CASE WHEN op = 'add' THEN b[patched_index + 1] ELSE a[original_index + 1] END AS word FROM steps JOIN d_pair USING (t, s)"""
)


@query(_recursive_sql(DIFF), base=False)
def word_diff_ops(spark, sf_dir):
    made = _pairs(spark, sf_dir).select(*KEY, F.posexplode(word_diff(F.split("original", " "), F.split("corrected", " "))).alias("k", "op"))
    return made.select(*KEY, "k", "op.*")


@query(r""", a AS (SELECT t, s, regexp_replace(array_to_string(toks, ' '), '[^ -~]', '', 'g') AS x, regexp_replace(array_to_string(list_filter(toks, lambda v, i: (i - 1) % 7 <> 3), ' '), '[^ -~]', '', 'g') AS y FROM seg)
SELECT t AS transcript_id, s AS seg_idx, levenshtein(x, y)::BIGINT AS distance, CASE WHEN x = y THEN 0 WHEN length(x) = 0 OR length(y) = 0 THEN 1 ELSE levenshtein(x, y)::DOUBLE / greatest(length(x), length(y)) END AS normalized FROM a""")
def edit_distances(spark, sf_dir):
    """Over the printable ASCII characters of every text: the SQL engine counts bytes."""
    toks = F.transform("words", lambda w: w["word"])
    plain = [F.regexp_replace(F.array_join(x, " "), "[^ -~]", "") for x in (toks, F.filter(toks, lambda w, i: i % 7 != 3))]
    made = segments(spark, sf_dir).select(*KEY, plain[0].alias("x"), plain[1].alias("y"))
    return made.select(*KEY, edit_distance("x", "y").cast("long").alias("distance"), norm_edit_distance("x", "y").alias("normalized"))


SPLIT = r""", nw AS (SELECT t, s, pos, word, speaker, length(word) AS len, n AS total, "start", "end" FROM w), RECURSIVE_st AS (
  SELECT t, s, -1::BIGINT AS pos, 0::BIGINT AS cnt, 0::BIGINT AS chars, speaker AS who, 0::BIGINT AS g, 0::BIGINT AS grp FROM seg
  UNION ALL
  SELECT t, s, pos, CASE WHEN c3 THEN 0 ELSE cnt2 END, CASE WHEN c3 THEN 0 ELSE chars2 END, who2, grp + c3::BIGINT, grp FROM (
    SELECT *, pos < total - 1 AND greatest(chars2 / 48.0::DOUBLE, cnt2 / 10.0::DOUBLE) >= 0.7::DOUBLE AND regexp_matches(word, '[.,?!;:]$') AS c3 FROM (
      SELECT *, CASE WHEN c2 THEN 1 ELSE cnt1 + 1 END AS cnt2, CASE WHEN c2 THEN len ELSE chars1 + (cnt1 > 0)::BIGINT + len END AS chars2, COALESCE(speaker, who1) AS who2, g + c1::BIGINT + c2::BIGINT AS grp FROM (
        SELECT *, cnt1 > 0 AND (cnt1 + 1 > 10 OR chars1 + 1 + len > 48) AS c2 FROM (
          SELECT *, CASE WHEN c1 THEN 0 ELSE cnt END AS cnt1, CASE WHEN c1 THEN 0 ELSE chars END AS chars1, CASE WHEN c1 THEN speaker ELSE who END AS who1 FROM (
            SELECT st.t, st.s, nw.pos, nw.word, nw.speaker, nw.len, nw.total, st.cnt, st.chars, st.who, st.g,
              COALESCE(nw.speaker, '') <> '' AND COALESCE(st.who, '') <> '' AND nw.speaker <> st.who AND st.cnt > 0 AS c1
            FROM st JOIN nw ON nw.t = st.t AND nw.s = st.s AND nw.pos = st.pos + 1)))))
), parts AS (
  SELECT st.t, st.s, st.grp, string_agg(word, ' ' ORDER BY st.pos) AS text, count(*) AS n_words, COALESCE(arg_min("start", st.pos) FILTER (TRUE), 0) AS x, arg_max(st.who, st.pos) AS speaker, min(st.pos) AS first_pos, max(st.pos) AS last_pos
  FROM st JOIN nw ON nw.t = st.t AND nw.s = st.s AND nw.pos = st.pos GROUP BY st.t, st.s, st.grp
), part AS (
  SELECT p.t, p.s, p.grp, p.text, p.n_words, p.speaker, COALESCE(a."start", 0) AS "start", COALESCE(b."end", 0) AS "end", row_number() OVER (PARTITION BY p.t ORDER BY p.s, p.grp) - 1 AS k
  FROM parts p JOIN nw a ON a.t = p.t AND a.s = p.s AND a.pos = p.first_pos JOIN nw b ON b.t = p.t AND b.s = p.s AND b.pos = p.last_pos
)""".replace("RECURSIVE_st", "st")


def _recursive(sql: str) -> str:
    return (BASE_SQL + SPLIT + sql).replace("WITH tok", "WITH RECURSIVE tok", 1)


@query(_recursive(' SELECT t AS transcript_id, k AS seg_idx, "start", "end", text, speaker, n_words FROM part'), base=False)
def normalized_segments(spark, sf_dir):
    out, _ = normalize_segments(segments(spark, sf_dir))
    return out.select(*KEY, "start", "end", "text", "speaker", F.size("words").cast("long").alias("n_words"))


@query(
    _recursive(""", own AS (SELECT t, count(*) AS original_segments FROM seg GROUP BY t), sp AS (SELECT t, sum(c - 1)::BIGINT AS splits FROM (SELECT t, s, count(*) AS c FROM part GROUP BY t, s) GROUP BY t)
SELECT part.t AS transcript_id, ANY_VALUE(original_segments) AS original_segments, count(*) AS normalized_segments, ANY_VALUE(splits) AS splits,
  min(n_words) AS words_min, max(n_words) AS words_max, floor(avg(n_words) * 100 + 0.5) / 100 AS words_avg, quantile_disc(n_words, 0.95) AS words_p95,
  min(length(text)) AS chars_min, max(length(text)) AS chars_max, floor(avg(length(text)) * 100 + 0.5) / 100 AS chars_avg, quantile_disc(length(text), 0.95) AS chars_p95
FROM part JOIN own ON own.t = part.t JOIN sp ON sp.t = part.t GROUP BY part.t"""),
    base=False,
)
def normalization_distribution(spark, sf_dir):
    made = normalization_stats(split_parts(segments(spark, sf_dir), Normalization()))
    return made.select([F.col(c).cast("double" if c.endswith("avg") else "long").alias(c) for c in made.columns])


@query(
    r"""WITH k AS (SELECT page_id, 'input/' || replace(regexp_replace(url, '^[a-z]+://', ''), '/', '%2F') || '+v1.2.mp3' AS raw FROM pages), d AS (SELECT page_id, raw, url_decode(replace(raw, '+', ' ')) AS key FROM k)
SELECT page_id, key, regexp_replace(regexp_replace(key, '^input/', ''), '\.[^.]+$', '') AS output_base, regexp_replace(regexp_extract(key, '([^/]*)$', 1), '\.[^.]*$', '') AS worker_base FROM d""",
    base=False,
)
def key_derivation(spark, sf_dir):
    raw = F.concat(F.lit("input/"), F.replace(F.regexp_replace("url", "^[a-z]+://", ""), F.lit("/"), F.lit("%2F")), F.lit("+v1.2.mp3"))
    made = _table(spark, sf_dir, "pages").select("page_id", decoded_key(raw).alias("key"))
    return made.select("page_id", "key", output_base("key").alias("output_base"), worker_base("key").alias("worker_base"))


@query("SELECT conv_id, turn FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = c.conv_id)", base=False)
def skip_existing_anti_join(spark, sf_dir):
    done = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("conv_id"))
    return new_keys(_table(spark, sf_dir, "conversations"), done, "conv_id").select("conv_id", "turn")


@query(
    """SELECT event_id, event_type AS step, CASE user_id % 7 WHEN 0 THEN 'skipped' WHEN 1 THEN 'error' ELSE 'success' END AS status,
CASE WHEN user_id % 7 = 0 THEN 0 ELSE CAST(trunc((epoch_us(ts) / 1e6 + value - epoch_us(ts) / 1e6) * 1000) AS BIGINT) END AS duration_ms FROM events""",
    base=False,
)
def step_timing(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    status = F.when(F.col("user_id") % 7 == 0, "skipped").when(F.col("user_id") % 7 == 1, "error").otherwise("success")
    made = e.select("event_id", F.col("event_type").alias("step"), status.alias("status"), at.alias("start_s"), (at + F.col("value")).alias("end_s"))
    return step_durations(made).select("event_id", "step", "status", F.col("duration_ms").cast("long").alias("duration_ms"))


@query("SELECT user_id, max(CASE WHEN event_id % 4 = 0 THEN epoch_us(ts) + 1800000000 ELSE epoch_us(ts) END)::BIGINT AS until_us FROM events WHERE event_type <> 'click' GROUP BY user_id", base=False)
def warmup_extend_only(spark, sf_dir):
    """Messages without a time of their own count half an hour from when they came."""
    e = _table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    until = F.when(F.col("event_id") % 4 != 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    made = e.select("user_id", F.when(F.col("event_type") != "click", "warmup").otherwise("job").alias("type"), until.alias("until"), at.alias("at"))
    return warmup_expiry(made, "user_id", F.col("at")).select("user_id", F.unix_micros("until").alias("until_us"))


@query(
    """WITH p AS (SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS m, event_type = 'purchase' AS warm FROM events), r AS (SELECT *, sum(m) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM p),
q AS (SELECT *, sum(1 - m) OVER (PARTITION BY user_id, run ORDER BY event_id) AS empty_run FROM r) SELECT event_id, user_id, empty_run::BIGINT AS empty_run, empty_run >= 3 AND m = 0 AND NOT warm AS stops FROM q""",
    base=False,
)
def idle_shutdown_runs(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    polls = e.select("event_id", "user_id", F.when(F.col("event_type") == "click", 1).otherwise(0).alias("n_messages"), (F.col("event_type") == "purchase").alias("warm"))
    return idle_shutdowns(polls, "user_id", "event_id").select("event_id", "user_id", "empty_run", "stops")


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'eu-west-1' WHEN p_partkey % 5 = 2 THEN 'ap-northeast-1' ELSE 'us-east-1' END AS region, 'vendor.' || p_brand AS model FROM part""",
    base=False,
)
def profile_regions(spark, sf_dir):
    prefix = F.element_at(F.array(*(F.lit(x) for x in ("eu.", "us.", "apac.", "global.", ""))), (F.col("p_partkey") % 5 + 1).cast("int"))
    made = _table(spark, sf_dir, "part").select("p_partkey", F.concat(prefix, F.lit("vendor."), "p_brand").alias("profile"))
    return made.select("p_partkey", region_of("profile").alias("region"), model_of("profile").alias("model"))


@query("SELECT doc_id, CASE WHEN b < 1024 THEN printf('%.1fB', b) WHEN b < 1048576 THEN printf('%.1fKiB', b / 1024) ELSE printf('%.1fMiB', b / 1048576) END AS size FROM (SELECT doc_id, n_chars * 100.0::DOUBLE AS b FROM documents)", base=False)
def byte_sizes(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", byte_size(F.col("n_chars") * 100).alias("size"))


# Relational operators that the engine has from Spark.


@query("SELECT c_mktsegment, n_name, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL", base=False)
def join_aggregate(spark, sf_dir):
    o, c, n = (_table(spark, sf_dir, x) for x in ("orders", "customer", "nation"))
    made = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return made.groupBy("c_mktsegment", "n_name").agg(F.count("*").alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query("SELECT c_custkey, NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS idle FROM customer", base=False)
def semi_and_anti_join(spark, sf_dir):
    c, o = _table(spark, sf_dir, "customer").select("c_custkey"), _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(o, "c_custkey", "left_semi").withColumn("idle", F.lit(False)).union(c.join(o, "c_custkey", "left_anti").withColumn("idle", F.lit(True)))


@query("SELECT k, 'union' AS op FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT k, 'both' FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT k, 'less' FROM (SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier)", base=False)
def set_operations(spark, sf_dir):
    c, s, n = (_table(spark, sf_dir, t).select(F.col(k).alias("k")) for t, k in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey")))
    return c.union(s).distinct().withColumn("op", F.lit("union")).union(c.intersect(s).withColumn("op", F.lit("both"))).union(n.subtract(s).withColumn("op", F.lit("less")))


@query("SELECT l_returnflag, l_linestatus, grouping_id(l_returnflag, l_linestatus) AS level, count(*) AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)", base=False)
def cube_totals(spark, sf_dir):
    made = _table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus")
    return made.agg(F.grouping_id().alias("level"), F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")).select("l_returnflag", "l_linestatus", "level", "n", "quantity")


@query("SELECT event_id, user_id, row_number() OVER w AS rn, lag(event_id) OVER w AS before, max(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS highest FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)", base=False)
def window_frames(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = _table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", F.row_number().over(w).cast("long").alias("rn"), F.lag("event_id").over(w).alias("before"), F.max("event_id").over(w.rowsBetween(-3, 0)).alias("highest"))


@query(
    """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS fresh FROM events), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
SELECT user_id, count(*) AS n, epoch_us(min(ts))::BIGINT AS first_us, epoch_us(max(ts))::BIGINT AS last_us FROM s GROUP BY user_id, session""",
    base=False,
)
def session_windows(spark, sf_dir):
    e = _table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    made = e.groupBy("user_id", F.session_window("at", "6 hours")).agg(F.count("*").alias("n"), F.min("at").alias("a"), F.max("at").alias("b"))
    return made.select("user_id", "n", F.unix_micros("a").alias("first_us"), F.unix_micros("b").alias("last_us"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100", base=False)
def top_orders(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
