import hashlib
import re
from collections import defaultdict

from cueloom.llm.ngram_join import ngram_components
from cueloom.llm.scratch import Scratch
from cueloom.llm.substring_dedup import substring_dedup


def brute_substring(rows, k):
    words = {d: (t or "").encode().split() for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - k + 1):
            first.setdefault(tuple(words[d][i : i + k]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < d:
                gone[i : i + k] = [True] * k
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_substring_dedup_equals_brute_force(docs, texts):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(docs).collect()}
    assert got == brute_substring(texts, 13)
    assert sum(x[1] for x in got.values()) > 100


def test_substring_dedup_edges(spark, empty):
    assert substring_dedup(empty).count() == 0
    text = " ".join(map(str, range(20)))
    rows = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    got = sorted(((r.doc_id or -1), r.n_removed) for r in substring_dedup(rows).collect())
    assert got == [(-1, 20), (1, 0), (1, 0), (2, 20)]


def brute_components(rows, k, percent):
    sets = defaultdict(list)
    for d, t in rows:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode().split()
        s = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets[d].append(s)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= percent * len(x | y):
                        p, q = find(a), find(b)
                        parent[max(p, q)] = min(p, q)
    return {(d, len(s), find(d)) for d in ids for s in sets[d]}


def test_ngram_components_equal_brute_force(docs, texts):
    for k, percent in ((4, 85), (5, 80), (2, 50)):
        got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_components(docs, k, percent).collect()}
        assert got == brute_components(texts, k, percent)


def test_ngram_components_shuffle_no_text(spark, docs, monkeypatch):
    plans, save = {}, Scratch.save

    def look(self, df, name, *rest):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return save(self, df, name, *rest)

    monkeypatch.setattr(Scratch, "save", look)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on tables too large to broadcast
    try:
        ngram_components(docs, 4, 85).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the texts of docs come by one exchange, their repartition
    assert "MapInArrow" in plans["sets"] and plans["sets"].count("Exchange") <= 1 and "Join" not in plans["sets"]


def test_ngram_components_edges(spark, empty):
    assert ngram_components(empty).count() == 0
    rows = [(5, "a b c d e f"), (5, "q r s t u v"), (7, "Q r s t u v"), (9, "a b c d e f"), (None, "a b c d e f"), (3, None)]
    got = {(r.doc_id, r.component_id) for r in ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, 5), (7, 5), (9, 5), (None, None), (3, 3)}
