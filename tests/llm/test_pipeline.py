"""Each stage of the pipeline against a brute-force version of its decision, on a small corpus."""

import random
from collections import defaultdict

import public_tokenizers

import corpus_pipeline
from tests.llm.test_native import brute_lines
from tests.llm.test_text_dedup import brute_components


def corpus():
    rng = random.Random(11)
    lexicon = {k: ["".join(rng.choice("bdfgklmn") + rng.choice(v) for _ in range(rng.randint(2, 4))) for _ in range(120)] for k, v in {"aa": "aeo", "bb": "iuy"}.items()}
    rows = []
    for i in range(80):
        lang = rng.choice(["aa", "bb"])
        rows.append((i, "\n".join(" ".join(rng.choices(lexicon[lang], k=rng.randint(8, 25))) for _ in range(rng.randint(1, 4))), lang, "s", 0))
    bench = [(0, " ".join(rng.choices(lexicon["aa"], k=30)))]
    near = " ".join(rng.choices(lexicon["bb"], k=120)).split()
    for i in range(80, 86):
        w = list(near)
        w[i - 40] = "changed"
        rows.append((i, "\n".join(" ".join(w[(k + i) % 8 :: 8] if False else w[k * 15 : k * 15 + 15]) for k in range(8)), "bb", "s", 0))
    rows += [(86, rows[3][1] + "\n" + bench[0][1], "aa", "s", 0), (87, None, "aa", "s", 0), (88, "12 ; 34", "aa", None, 0), (89, rows[5][1], rows[5][2], "s", 0)]
    return rows, bench


def test_stages(spark, tmp_path):
    rows, bench = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got, frames = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        frames[name], got[name] = docs, docs.collect()
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(frames[n].columns == columns for n in ("language_id", "line_dedup", "ngram_join", "decontamination"))
    texts = {n: {r.doc_id: r.text for r in got[n]} for n in ("language_id", "line_dedup", "ngram_join", "decontamination")}
    assert {87, 88} & set(texts["language_id"]) == set() and len(texts["language_id"]) >= 86
    before = list(texts["language_id"].items())
    want = {d: v[0] for d, v in brute_lines(before, 80).items() if v[1] > v[2]}
    assert texts["line_dedup"] == want and 89 not in want
    found = brute_components(list(want.items()), 5, 80)
    kept = {d for d, _, c in found if c == d}
    assert set(texts["ngram_join"]) == kept
    assert set(texts["ngram_join"]) - set(texts["decontamination"]) == {86}
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = defaultdict(int)
    for r in got["packing"]:
        lengths[r.doc_id] += r.length
    assert lengths == {d: len(t.encode(x, add_special_tokens=False).ids) + 1 for d, x in texts["decontamination"].items()}


def test_near_duplicates_leave_texts_where_they_are_read(spark, tmp_path):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words), (2, words), (2, words), (3, words + " more"), (4, "other words"), (5, None), (None, words), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = corpus_pipeline.near_duplicates(spark, spark.read.parquet(str(tmp_path / "docs")), str(tmp_path))
        plan = got._jdf.queryExecution().executedPlan().toString()
        kept = sorted(((r.doc_id or 0), r.text or "") for r in got.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan
    assert kept == [(0, ""), (0, words), (1, words), (4, "other words"), (5, "")]
