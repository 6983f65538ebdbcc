import random

import pytest

WORDS = "the of and in to a is river stone cloud green seven walks under lamp paper quiet north engine table".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ed", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): copies, near copies, shared passages, repeated lines, nulls, blanks, one long text."""
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.randint(1, 120))) for i in range(60)]
    passage = prose(rng, 30)
    for i in range(60, 80):
        rows.append((i, prose(rng, rng.randint(0, 40)) + " " + passage + "\n" + prose(rng, 20)))
    base = prose(rng, 90).split()
    for i in range(80, 100):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        rows.append((i, " ".join(w)))
    rows += [(100, rows[5][1]), (101, rows[5][1].upper()), (102, None), (103, ""), (104, " \n\t "), (105, "one two"), (106, "one two"), (107, "één\x0btwée\x1cx  ü")]
    rows += [(108, prose(rng, 20000)), (109, "a" * 5000), (110, "\n".join([passage] * 3))]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en", "src", 0, "x", 1, 2) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component_id string, h int, n int").repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
