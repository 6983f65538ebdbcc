import random
import re
from collections import Counter
from itertools import permutations

import pytest

from cueloom.llm.filter_audit import audit

KINDS = "doc_id long, text string, source string, mask int, k long, t string"


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    first = {}
    for i, t, *_ in rows:
        key = float("inf") if i is None else i
        first[t or ""] = min(first.get(t or "", key), key)
    cells, parts = Counter(), set()
    for i, t, source, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "".join(
            x for x, y in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), re.search("[#$%&*|]", t), first[t] < (float("inf") if i is None else i)), strict=True) if y
        )
        cells[source or "", fails, i in good, i in toxic] += 1
        parts.add(source or "")
    out, share = [], Counter()
    for p in parts:
        for order in map("".join, permutations("ABCDE")):
            for k, own in enumerate(order):
                row = Counter()
                for (part, fails, g, x), n in cells.items():
                    if part != p:
                        continue
                    gone = any(y in fails for y in order[:k])
                    row["kept"] += n * (not gone and own not in fails)
                    row["removed"] += n * (not gone and own in fails)
                    row["redundant"] += n * (gone and own in fails)
                    row["unique"] += n * (fails == own)
                    row["good"] += n * (not gone and own in fails and g)
                    row["toxic"] += n * (not gone and own in fails and x)
                share[p, own] += row["removed"]
                out.append([p, order, k + 1, *(row[x] for x in ("kept", "removed", "redundant", "unique", "good", "toxic"))])
    return {(*r, share[r[0], r[1][r[2] - 1]]) for r in out}


def corpus():
    rng = random.Random(3)
    words = "alpha beta gamma delta eps zeta eta theta iota kappa".split()
    base = [" ".join(f"{rng.choice(words)}{rng.randrange(40)}" for _ in range(n)) for n in (5, 49, 50, 51, 80, 400)]
    rows = [(i, rng.choice(base), rng.choice(["a", "b", None, ""]), 1, 2, "x") for i in range(90)]
    rows += [(100, None, "a", 1, 2, "x"), (101, "", "a", 1, 2, "x"), (None, "", "b", 1, 2, "x"), (None, base[4], None, 1, 2, "x")]
    rows += [(102, " " + base[4] + "\n", "a", 1, 2, "x"), (103, base[4].upper(), "a", 1, 2, "x"), (104, base[4] + " 50%", "b", 1, 2, "x"), (105, "é " * 60, "b", 1, 2, "x")]
    # the same length and the same beginning, apart in a late block only
    long = "word " * 60000
    rows += [(110, long + "a", "c", 1, 2, "x"), (111, long + "b", "c", 1, 2, "x"), (112, long + "b", "c", 1, 2, "x")]
    rows += [(113, "twice", "c", 1, 2, "x"), (113, "twice", "c", 1, 2, "x"), (114, "twice", "c", 1, 2, "x"), (113, "other", "c", 1, 2, "x")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 120, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1), (101, None, 1)]
    return rows, [(i, q, None if x is None else int(x)) for i, q, x in labels]


@pytest.mark.parametrize("bits", [64, 2])
def test_equals_brute_force(spark, bits):
    """With hashes of 2 bits most classes hold several texts, which are then told apart whole."""
    rows, labels = corpus()
    got = audit(spark.createDataFrame(rows, KINDS).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), hash_bits=bits).collect()
    assert len(got) == 600 * 4
    assert {tuple(r) for r in got} == brute(rows, labels)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(spark.createDataFrame([], KINDS), none).collect() == []
    got = audit(spark.createDataFrame([(1, "a b", "s", 1, 2, "x")], KINDS), none).collect()
    assert len(got) == 600 and {r["good_lost"] for r in got} == {0}
