import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, fingerprint int, segment string, part string, score int"


@pytest.fixture
def documents(spark):
    """Frame of (doc_id, text) pairs with other columns, some of whose names operators use themselves."""

    def make(rows, lang="en", source="s"):
        return spark.createDataFrame([(i, t, lang, source, 1, "no", 2, "no", "no", 3) for i, t in rows], SCHEMA)

    return make


@pytest.fixture
def prose():
    """Seeded texts over a small vocabulary."""

    def make(n, most=60, words=40, seed=5):
        rng = random.Random(seed)
        known = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(words)]
        return [" ".join(rng.choice(known) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(rng.randint(0, most))) for _ in range(n)]

    return make
