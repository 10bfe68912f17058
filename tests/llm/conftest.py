import random

import pytest

SYLLABLES = "an be con da er fi gro ha in jo ka lu me no op per qua ri so tu un ver wi xa yo ze".split()


@pytest.fixture(scope="session")
def prose():
    """``prose(rng, n)``: n invented words."""

    def make(rng: random.Random, n: int) -> str:
        return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def collide(spark):
    """Two different words that keep equal 32-bit hashes of texts as long as the same follows both."""
    pair = ("ihgihaoncleppbal", "lgfgckmjghpnmeaj")
    for rest in ("", "\nsame text"):
        hashes = [r[0] for r in spark.createDataFrame([(x + rest,) for x in pair], "text string").selectExpr("hash(text)").collect()]
        assert hashes[0] == hashes[1]
    return pair


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of (doc_id, text) pairs, with columns whose names clash with internal ones."""

    def make(pairs, lang=None):
        rows = [
            (i, t, lang[k] if lang else "en", "src", None if t is None else len(t), "extra", 7, "x")
            for k, (i, t) in enumerate(pairs)
        ]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, key string, id int, twin string"
        )

    return make
