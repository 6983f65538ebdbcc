import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from cueloom.llm.prefix_trie import prefix_trie

KINDS = "conv_id long, turn long, role string, text string, depth long, c string"


def brute(rows, group=20, heads=4):
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        whole[c] = tuple(own.get(c - (abs(c) % group) * (1 if c >= 0 else -1), [])[:h] + mine[h:])
    nodes = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    children, saved, leaves = defaultdict(set), {}, {}
    for path in nodes:
        if path:
            children[path[:-1]].add(path)
    for path in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved[path] = (len(nodes[path]) - 1) * words + sum(saved[x] for x in children[path])
        leaves[path] = sum(leaves[x] for x in children[path]) or 1
    out = set()
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(whole[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        out.add((min(members), len(path), parent, len(members), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check(spark, rows, parts=3):
    got = prefix_trie(spark.createDataFrame(rows, KINDS).repartition(parts)).collect()
    assert len(got) == len({(r["conv_id"], r["depth"]) for r in got})
    assert {tuple(r) for r in got} == brute(rows)


def test_shared_prefixes_copies_and_odd_rows(spark):
    rng, rows = random.Random(5), []
    for c in range(130):
        n = rng.randrange(6)
        rows += [(c, t, "user" if t % 2 else None, rng.choice(["yes please", "no", "", None, "a  b\tc"]), 9, "x") for t in range(n)]
    rows += [(c, t, "user", f"copied {t}", 9, "x") for c in range(3000, 5200, 20) for t in range(5)]  # a third of all are one sequence
    rows += [(c, None, "user", x, 9, "x") for c in (200, 221, 222) for x in ("b", "a", "a")]  # ties, repeated rows, no turn
    rows += [(-41, t, "user", "negative", 9, "x") for t in (5, 3, 3)] + [(-40, 0, "user", "head", 9, "x")]
    rows += [(None, 0, "user", "of no conversation", 9, "x")]
    rng.shuffle(rows)
    check(spark, rows)


def test_very_long_conversations(spark):
    long = [(400, t, "user", f"turn {t}", 0, "") for t in range(9000)]
    long += [(440, t, "user", f"turn {t}", 0, "") for t in range(9000)]  # a copy as long
    long += [(480, t * 10**12, "user", f"turn {t}" if t < 3 else f"own {t}", 0, "") for t in range(50)]  # turns far apart
    check(spark, long, parts=5)


def test_no_turns_left_and_no_conversations(spark):
    # conversations that lose all of their own turns and have no head end at the root
    single = [(c, 0, "user", "x", 0, "") for c in range(21, 39)]
    check(spark, single)
    assert prefix_trie(spark.createDataFrame([], KINDS)).collect() == []


@pytest.mark.parametrize("seed", [1])
def test_random_small_tries(spark, seed):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(90), 60):
        rows += [(c, t, "u", rng.choice("pq"), 0, "") for t in range(rng.randrange(9))]
    check(spark, rows)
