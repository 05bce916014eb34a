import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _tag string, kept boolean"


def made_texts():
    """Copies, near copies, shared lines and passages, and odd cases."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghiklmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage, boiler = say(160), say(60), say(12)
    texts = [base, base, base.upper()]
    for _ in range(14):
        w = base.split()
        for _ in range(rng.randint(1, 7)):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts.append(" ".join(w))
    texts += [f"{say(70)}\n{passage}\n{say(40)}" for _ in range(5)]
    texts += [f"{say(30)} {passage} {say(30)}" for _ in range(3)]
    texts += [f"{boiler}\n{say(80)}" for _ in range(14)]
    texts += [f"{boiler}\n{say(2)}\n{say(50)}\n{boiler}", "und " * 300, "a b", "a b", "x", "", None, "\n \t\n",
              "äöü   \U0001f600 " * 40, "ab" * 400, "ab" * 400, say(4000), say(55)]
    return texts


def made_rows():
    return [(i, t, "en", ["s1", "s2", None][i % 3] if i % 4 else "s1", len(t or ""), "x", i % 2 == 0)
            for i, t in enumerate(made_texts())]


@pytest.fixture(scope="session")
def rows():
    return [(r[0], r[1]) for r in made_rows()]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(made_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def repeated(spark):
    """Null ids, an id used twice, rows that repeat in full."""
    long = " ".join(f"w{k}" for k in range(120))
    return spark.createDataFrame(
        [(None, long, None, None, None, "x", None), (None, None, None, None, None, None, None),
         (3, long, "en", "s", 1, "x", True), (3, long, "en", "s", 1, "x", True), (3, "other text", "en", "s", 1, "x", True),
         (4, long + " more", "en", "s", 1, "x", True)], SCHEMA)
