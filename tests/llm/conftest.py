import random

import pytest
from pyspark.sql import functions as F

from tenantlens.llm.common import on_workers

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
# columns of other tables and of the operators' own results
CLASHING = ["n_words", "rank", "text_key", "token", "size", "key", "keys", "label", "score", "node", "shard", "a", "b"]


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    on_workers(spark)


def clashing(df):
    """The rows with extra columns whose names the operators use themselves."""
    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang[, source]]) with clashing columns beside them."""

    def build(*rows):
        full = [(*r, *(None,) * (4 - len(r)), None) for r in rows]
        return clashing(spark.createDataFrame(full, DOCS).repartition(3))

    return build


@pytest.fixture(scope="session")
def prose():
    """Texts of a seeded generator: words of few letters, lines, copies with edits."""

    def build(seed, count, size=120, vocabulary=400):
        rng = random.Random(seed)
        words = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randint(1, 6))) for _ in range(vocabulary)]

        def text(n):
            return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in range(n))

        texts = [text(rng.randint(0, size)) for _ in range(count)]
        for _ in range(count // 2):  # copies, edited copies, passages of others
            base = rng.choice(texts).split(" ")
            kind = rng.random()
            if kind < 0.3:
                texts.append(" ".join(base))
            elif kind < 0.7 and len(base) > 3:
                for _ in range(max(1, len(base) // 40)):
                    base[rng.randrange(len(base))] = rng.choice(words)
                texts.append(" ".join(base))
            else:
                texts.append(text(20) + " ".join(base[: len(base) // 2]) + text(20))
        return texts

    return build
