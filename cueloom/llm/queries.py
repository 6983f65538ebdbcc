"""The operators of this subpackage as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import license_scan

    return license_scan(_documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import substring_dedup

    return substring_dedup(_documents(spark, sf_dir), k=13)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contained_items

    return contained_items(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify, learn

    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    got = identify(docs.select("doc_id", "text"), learn(docs, ~held_out))
    return got.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    got = dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return got.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .kneser_ney import score_documents

    return score_documents(_documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 10 == 0, order=3)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import ngram_components

    return ngram_components(_documents(spark, sf_dir), k=4, percent=85)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_personal_data

    return find_personal_data(_documents(spark, sf_dir))


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .progressive_jpeg import media_columns

    return media_columns(_documents(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import audit

    return audit(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import prefix_trie

    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .kd_sharding import placed

    return placed(_documents(spark, sf_dir), dims=("source", "lang", "n_chars"), shards=24)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_license_scan,
        op2_substring_dedup,
        op3_decontamination,
        op4_language_id,
        op5_line_dedup,
        op6_kneser_ney,
        op7_packing,
        op8_ngram_join,
        op9_pii,
        op10_media_columns,
        op11_filter_audit,
        op12_prefix_trie,
        op13_kd_sharding,
        pipeline,
    )
    return {f.__name__: f for f in every}


ORACLES = {
    "op12_prefix_trie": r"""
WITH t AS (SELECT conv_id AS c, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS l FROM t GROUP BY c),
h AS (SELECT c, l, xor(list_reduce(list_transform(range(1, len(c::VARCHAR) + 1), lambda i: ascii((c::VARCHAR)[i])), lambda a, x: list_reduce(range(0, 8), lambda v, j: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(a, x)), 4294967295), 4294967295) % 4 AS h FROM o),
r AS (SELECT a.c, list_concat(COALESCE(b.l[1:a.h], []), a.l[a.h + 1:]) AS l FROM h a LEFT JOIN o b ON b.c = a.c - a.c % 20),
p AS (SELECT c, d, md5(to_json(l[1:d])::VARCHAR) AS k, md5(to_json(l[1:d - 1])::VARCHAR) AS up, len(l) = d AS ended, CASE WHEN d > 0 THEN len(regexp_extract_all(l[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS w FROM r, UNNEST(range(0, len(l) + 1)) AS u(d)),
x AS (SELECT d, k, any_value(up) AS up, min(c) AS conv, count(*) AS n, any_value(w) AS w, sha256(COALESCE(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ended), '')) AS ends FROM p GROUP BY d, k),
below AS (SELECT d - 1 AS d, up AS k, count(*) AS m FROM x WHERE d > 0 GROUP BY ALL),
y AS (SELECT x.*, COALESCE(m, 0) AS m FROM x LEFT JOIN below USING (d, k)),
sums AS (SELECT p.d, p.k, count(*) FILTER (y.m = 0) AS leaves, sum((y.n - 1) * y.w) AS saved FROM y JOIN p ON p.c = y.conv AND p.d <= y.d GROUP BY ALL)
SELECT y.conv AS conv_id, y.d AS depth, top.conv AS parent_conv_id, y.n AS n_convs, y.m AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, y.ends AS ends_sha256
FROM y JOIN sums USING (d, k) LEFT JOIN x AS top ON top.d = y.d - 1 AND top.k = y.up""",
    "op11_filter_audit": r"""
WITH RECURSIVE d AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS text, COALESCE(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
f AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS m, part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text), regexp_matches(text, '[#$%&*|]')] AS abcd FROM d),
said AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
x AS (SELECT part, list_append(abcd, m < f.doc_id) AS fails, COALESCE(good, 0) AS good, COALESCE(toxic, 0) AS toxic FROM f LEFT JOIN said USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM x GROUP BY ALL),
o AS (SELECT '' AS p UNION ALL SELECT p || l FROM o, (SELECT UNNEST(['A', 'B', 'C', 'D', 'E']) AS l) AS ls WHERE NOT contains(p, l)),
s AS (SELECT p, step, ascii(p[step]) - 64 AS own, list_transform(range(1, step), lambda i: ascii(p[i]) - 64) AS earlier FROM o, (SELECT UNNEST(range(1, 6)) AS step) AS steps WHERE len(p) = 5),
r AS (SELECT part, p, step, own, n, good, toxic, fails[own] AS now, len(list_filter(earlier, lambda i: fails[i])) > 0 AS gone, len(list_filter(fails, lambda y: y)) = 1 AS alone FROM c, s),
t AS (SELECT part, p, step, own, sum(n) FILTER (NOT now AND NOT gone) AS kept, sum(n) FILTER (now AND NOT gone) AS removed, sum(n) FILTER (now AND gone) AS redundant, sum(n) FILTER (now AND alone) AS unique_fails,
  sum(good) FILTER (now AND NOT gone) AS good_lost, sum(toxic) FILTER (now AND NOT gone) AS toxic_lost FROM r GROUP BY ALL)
SELECT part, p AS filter_order, step::INT AS step, COALESCE(kept, 0)::BIGINT AS kept, COALESCE(removed, 0)::BIGINT AS removed, COALESCE(redundant, 0)::BIGINT AS redundant, COALESCE(unique_fails, 0)::BIGINT AS unique_fails,
  COALESCE(good_lost, 0)::BIGINT AS good_lost, COALESCE(toxic_lost, 0)::BIGINT AS toxic_lost, COALESCE(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley FROM t""",
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, COALESCE(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
e AS (SELECT doc_id, list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i+12], ' ')) AS ks FROM d),
win AS (SELECT doc_id, UNNEST(ks) AS k, UNNEST(range(1, len(ks) + 1)) AS i FROM e),
f AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT win.doc_id, i + j AS p FROM win JOIN f USING (k), range(0, 13) AS t(j) WHERE m < win.doc_id),
words AS (SELECT doc_id, UNNEST(w) AS word, UNNEST(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - COALESCE(n, 0))::BIGINT AS n_removed, sha256(COALESCE(kept.text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
    "op8_ngram_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, COALESCE(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
e AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS ks FROM d),
s AS (SELECT doc_id, UNNEST(ks) AS k FROM e),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM shared JOIN e x ON x.doc_id = a JOIN e y ON y.doc_id = b WHERE 100 * c >= 85 * (len(x.ks) + len(y.ks) - c)),
ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM e UNION SELECT reach.a, ways.b FROM reach JOIN ways ON ways.a = reach.b)
SELECT e.doc_id, len(ks)::BIGINT AS n_shingles, min(b)::BIGINT AS component_id FROM e JOIN reach ON reach.a = e.doc_id GROUP BY e.doc_id, ks""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
