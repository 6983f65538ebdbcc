import math
import random
import time
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cueloom.llm.kneser_ney import _discounts, score_documents
from cueloom.llm.language_id import Classifier, identify, keep_identified, learn
from cueloom.llm.packing import pack_documents, plan

VOWELS = {"aa": "aeo", "bb": "uiy", "cc": "öäü"}


@pytest.fixture(scope="module")
def labelled(spark):
    rng, rows = random.Random(3), []
    lexicon = {lang: ["".join(rng.choice("bdfgklmnprst") + rng.choice(v) for _ in range(rng.randint(2, 4))) for _ in range(150)] for lang, v in VOWELS.items()}
    for i in range(300):
        lang = rng.choice(sorted(VOWELS))
        words = rng.choices(lexicon[lang], k=rng.randint(20, 80))
        rows.append((i, " ".join(words), lang if i % 10 else None, "s", 0))
    rows += [(1000, None, "aa", "s", 0), (1001, "", "aa", "s", 0), (1002, "12 34 !", "bb", None, 0), (None, "bada fele", "aa", "s", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_language_id_on_held_out_rows(labelled):
    train = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    got = identify(labelled, learn(labelled, train)).where(~train & F.col("lang").isNotNull() & (F.length("text") > 20))
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95


def test_language_id_edges(labelled, empty):
    got = {r.doc_id: r for r in identify(labelled, learn(labelled, F.lit(True))).where("doc_id >= 1000").collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and not got[i].accepted for i in (1000, 1001, 1002))
    assert identify(empty, learn(empty, F.lit(True))).count() == 0
    kept = keep_identified(labelled)
    assert kept.columns == labelled.columns and kept.where("doc_id < 1000").count() == 300


def test_language_samples_are_distinct_texts_at_their_own_size(spark):
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("abcdefghiklmnoprstu") for _ in range(5)) for _ in range(60)) for _ in range(300)]
    first = spark.createDataFrame([(t,) for t in texts], "t string").orderBy(F.xxhash64("t")).first().t
    rows = [(t, "aa") for t in texts] + [(first, "aa")] * 400 + [("uno dos", "zz")]
    made = learn(spark.createDataFrame(rows, "text string, lang string").repartition(3), F.lit(True))
    parts = made["aa"].decode().split("\n")
    assert len(set(parts)) == len(parts) > 150 and len(made["aa"]) > 50_000
    # a text whose only like lies beyond the first 4 KiB, where the rare language's size would cut
    got = Classifier(made)
    assert got.sizes(parts[-2])[0] < got.sizes(parts[-2])[1] / 2


def test_language_id_margin_and_short_texts(spark):
    rng = random.Random(4)
    lexicon = {lang: ["".join(rng.choice("bdfgklmnprst") + rng.choice(v) for _ in range(2)) for _ in range(60)] for lang, v in VOWELS.items()}
    rows = [(" ".join(rng.choices(words, k=40)), lang) for lang, words in lexicon.items() for _ in range(40)]
    made = learn(spark.createDataFrame(rows, "text string, lang string"), F.lit(True))
    short = [(w, lang) for lang, words in lexicon.items() for w in words[:15]]
    got = identify(spark.createDataFrame(short, "text string, want string"), made)
    assert got.where("accepted AND lang_pred = want").count() == len(short)
    # two languages that nothing tells apart: no text is accepted
    twins = identify(spark.createDataFrame([("bada",), (rows[0][0],), (rows[0][0] * 20,)], "text string"), {"aa": made["aa"], "ab": made["aa"]})
    assert [(r.lang_pred, r.score, r.accepted) for r in twins.collect()] == [("aa", 0.0, False)] * 3


def words_of(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()


def test_kneser_ney_equals_brute_force(docs, texts):
    held = {d for d, _ in texts if zlib.crc32(str(d).encode()) % 10 == 0}
    raw, pairs = Counter(), Counter()
    for d, t in texts:
        if d not in held:
            s = [0, *words_of(t), 1]
            raw.update(s[1:])
            pairs.update(zip(s, s[1:], strict=False))
    total, kinds = sum(raw.values()), len(raw)
    context, follow, before = Counter(), defaultdict(Counter), Counter()
    for (a, b), n in pairs.items():
        context[a] += n
        follow[a][min(n, 3)] += 1
        before[b] += 1
    d = (0, *_discounts([sum(n == k for n in pairs.values()) for k in (1, 2, 3, 4)]))
    e = (0, *_discounts([sum(n == k for n in before.values()) for k in (1, 2, 3, 4)]))
    spread = sum(e[min(n, 3)] for n in before.values()) / len(pairs)

    def lower(w):
        return max(before[w] - e[min(before[w], 3)], 0) / len(pairs) + spread / (kinds + 1)

    def p(a, w):
        if not context[a]:
            return lower(w)
        n = pairs[a, w]
        return max(n - d[min(n, 3)], 0) / context[a] + sum(d[k] * follow[a][k] for k in (1, 2, 3)) / context[a] * lower(w)

    assert sum(map(lower, raw)) + lower("unknown") == pytest.approx(1)
    for a in (0, b"the", b"river"):
        assert sum(p(a, w) for w in raw) + p(a, "unknown") == pytest.approx(1)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    got = {r.doc_id: r for r in score_documents(docs, held_out).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        s = [0, *words_of(t), 1]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(s) - 1, sum(raw[w] > 0 for w in s[1:]), total)
        assert r.base_score == pytest.approx(sum(math.log10((raw[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in s[1:]), rel=1e-9)
        assert r.score == pytest.approx(sum(math.log10(p(a, w)) for a, w in zip(s, s[1:], strict=False)), rel=1e-9)


@pytest.mark.parametrize(("order", "shard"), [(3, 22), (3, 12), (4, 13)])
def test_kneser_ney_of_higher_order_equals_brute_force(docs, texts, order, shard, monkeypatch):
    monkeypatch.setattr("cueloom.llm.kneser_ney.SHARD", shard)  # several shards
    held = {d for d, _ in texts if zlib.crc32(str(d).encode()) % 10 == 0}
    counts = [Counter() for _ in range(order + 1)]
    for d, t in texts:
        if d not in held:
            s = [0, *words_of(t), 1]
            counts[1].update((w,) for w in s[1:])
            for k in range(2, order + 1):
                grams = [tuple(s[i : i + k]) for i in range(len(s) - k + 1)]
                counts[k].update(grams if k == order else grams[:1])
    raw, total, kinds = counts[1], sum(counts[1].values()), len(counts[1])
    for k in range(order - 1, 1, -1):
        counts[k].update(g[1:] for g in counts[k + 1])
    counts[1] = Counter(g[1:] for g in counts[2])
    d = [(0, *_discounts([sum(n == i for n in c.values()) for i in (1, 2, 3, 4)])) for c in counts]
    spread = sum(d[1][min(n, 3)] for n in counts[1].values()) / len(counts[2])
    follow = defaultdict(list)
    for c in counts[2:]:
        for g, n in c.items():
            follow[g[:-1]].append(n)

    def p(context, w):
        if not context:
            n = counts[1][w,]
            return max(n - d[1][min(n, 3)], 0) / len(counts[2]) + spread / (kinds + 1)
        below, after, own = p(context[1:], w), follow.get(context), d[len(context) + 1]
        if not after:
            return below
        n = counts[len(context) + 1][(*context, w)]
        return (max(n - own[min(n, 3)], 0) + sum(own[min(x, 3)] for x in after) * below) / sum(after)

    some = max(counts[order], key=counts[order].get)[:-1]
    assert sum(p(some, w) for (w,) in raw) + p(some, "unknown") == pytest.approx(1)
    got = {r.doc_id: r for r in score_documents(docs, F.crc32(F.col("doc_id").cast("string")) % 10 == 0, order).collect()}
    for i, t in texts:
        s = [0, *words_of(t), 1]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(s) - 1, sum(raw[w,] > 0 for w in s[1:]), total)
        assert r.score == pytest.approx(sum(math.log10(p(tuple(s[max(0, j - order + 1) : j]), s[j])) for j in range(1, len(s))), rel=1e-9)


def test_kneser_ney_of_higher_order_edges(spark, empty):
    assert score_documents(empty, F.lit(False), 3).count() == 0
    rows = spark.createDataFrame([(1, None), (1, None), (None, "x")], "doc_id long, text string")
    for held_out in (True, False):
        assert {r.n_tokens for r in score_documents(rows, F.lit(held_out), 3).collect()} == {1, 2}


def test_kneser_ney_edges(spark, empty):
    assert score_documents(empty, F.lit(False)).count() == 0
    rows = spark.createDataFrame([(1, None), (1, None), (None, "x")], "doc_id long, text string")
    assert {r.n_tokens for r in score_documents(rows, F.lit(True)).collect()} == {1, 2}


def test_packing(docs, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rows = texts
    ids = {d: [*t.encode(x or "", add_special_tokens=False).ids, 0] for d, x in rows}
    for capacity in (2048, 100):
        got = pack_documents(docs, path, capacity).collect()
        by_doc, by_bin = defaultdict(list), defaultdict(list)
        for r in got:
            by_doc[r.doc_id].append(r)
            by_bin[r.sequence_id].append((r.offset, r.length))
        assert set(by_doc) == set(ids)
        for i, parts in by_doc.items():
            parts.sort(key=lambda r: r.piece)
            at = 0
            for k, r in enumerate(parts):
                assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == capacity)
                data = b"".join(x.to_bytes(4, "little") for x in ids[i][at : at + r.length])
                assert r.ids_crc32 == zlib.crc32(data)
                at += r.length
            assert at == len(ids[i])
        for parts in by_bin.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(by_bin) <= 1.05 * -(-sum(map(len, ids.values())) // capacity) + 1


def test_packing_special_texts(spark, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    hard = ["a  b", " x ", " ", "", "a\n b", "a \nb", "é\x1c ü", "x<|endoftext|> y", "it's don't\t t", "a  b", "b 　c", "1 22 333 4444", "日本 語", "😀 a 😀"]
    rows = spark.createDataFrame(list(enumerate(hard)) + [(0, hard[0])], "doc_id long, text string")
    got = pack_documents(rows, path).collect()
    assert len(got) == len(hard) + 1
    for r in got:
        ids = [*t.encode(hard[r.doc_id], add_special_tokens=False).ids, 0]
        assert (r.length, r.ids_crc32) == (len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))
    assert pack_documents(empty, path).count() == 0


def brute_plan(counts, capacity):
    """Piece by piece: the open gap of the least change in the sum of squares, the smallest of equals."""
    gaps, bins, done = Counter(), defaultdict(list), Counter()
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            room = [g for g in sorted(gaps) if g >= size and gaps[g]]
            g = min(room, key=lambda g: (2 * (gaps[g - size] - gaps[g]) + 2 if g > size else 1 - 2 * gaps[g], g), default=capacity)
            what = bins[g].pop() if room else ()
            gaps[g] -= bool(room)
            if g > size:
                gaps[g - size] += 1
                bins[g - size].append((*what, size))
            else:
                done[(*what, size)] += 1
    return sum(done.values()) + sum(map(len, bins.values()))


def test_plan_follows_the_rule_piece_by_piece():
    rng = random.Random(8)
    for _ in range(150):
        capacity = rng.randint(10, 60)
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 900)))
        exact = brute_plan(counts, capacity)
        assert sum(n for _, n in plan(dict(counts), capacity)) == exact
    counts = {3: 2320, 5: 2645, 6: 2122, 16: 1366}
    assert sum(n for _, n in plan(counts, 29)) == brute_plan(counts, 29)


def left_open(counts, capacity):
    """How many bins of each gap the rule leaves, piece by piece."""
    gaps = [0] * (capacity + 1)
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            best, g = None, capacity
            for h in range(size, capacity):
                if gaps[h]:
                    change = 2 * (gaps[h - size] - gaps[h]) + 2 if h > size else 1 - 2 * gaps[h]
                    if best is None or change < best:
                        best, g = change, h
            gaps[g] -= best is not None
            gaps[g - size] += g > size
    return gaps


def test_plan_keeps_to_the_rule_at_any_size():
    rng = random.Random(5)
    some = [Counter({rng.randint(1, 40): rng.choice([rng.randint(1, 30), rng.randint(1, 1500)]) for _ in range(rng.randint(1, 12))}) for _ in range(60)]
    # the last takes more than 2**18 runs of equal choices
    for counts, capacity in [*((c, 41) for c in some), ({3: 2320 * 80, 5: 2645 * 80, 6: 2122 * 80, 16: 1366 * 80}, 29)]:
        gaps = [0] * (capacity + 1)
        for lengths, n in plan(dict(counts), capacity):
            gaps[capacity - sum(lengths)] += n
        assert gaps[1:] == left_open(counts, capacity)[1:]
    # and the work does not grow with the pieces
    began = time.process_time()
    plan({3: 2320 * 10**6, 5: 2645 * 10**6, 6: 2122 * 10**6, 16: 1366 * 10**6}, 29)
    assert time.process_time() - began < 5


def test_plan_is_tight_and_complete():
    rng = random.Random(1)
    for draw in (lambda: rng.randint(1, 2048), lambda: rng.randint(1, 300), lambda: rng.choice([700, 1348, 1024])):
        counts = Counter(draw() for _ in range(5000))
        made = plan(dict(counts), 2048)
        placed = Counter()
        for lengths, n in made:
            assert sum(lengths) <= 2048
            for x in lengths:
                placed[x] += n
        assert placed == counts
        assert sum(n for _, n in made) <= 1.02 * -(-sum(k * v for k, v in counts.items()) // 2048) + 1
    million = plan({k: 10**6 for k in range(1, 2049)}, 2048)
    assert sum(n for _, n in million) <= 1.01 * sum(range(1, 2049)) * 10**6 / 2048


def test_kept_rows_keep_columns_of_any_name(spark, docs):
    from cueloom.llm.language_id import keep_identified

    named = docs.select("doc_id", "text", "lang", docs.n.alias("score"), docs.h.alias("accepted"), docs.source.alias("lang_pred"), docs.h.alias("prediction"), docs.h.alias("_lid"))
    got = keep_identified(named, margin=0.0)
    assert got.columns == named.columns and {(r.score, r.accepted, r.lang_pred, r._lid) for r in got.collect()} == {(2, 1, "src", 1)}
