from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
CLASHING = ("key", "h", "fp", "t", "words", "at", "score")


def sentence(rng: random.Random, n: int, letters: str = "aeioustrn") -> list[str]:
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="session")
def corpus() -> list[tuple]:
    """Ordinary, odd, repeated, copied and very long texts, with nulls in every column."""
    rng = random.Random(7)
    shared = "All rights are shared by the makers of this page"
    passage = " ".join(sentence(rng, 30))
    texts: list[str | None] = [None, "", " \t\n ", "a", "one two", "Ünï cödé É é", "\n\n\n", "x" * 50_000, "same " * 300]
    texts += [" ".join(sentence(rng, rng.randint(5, 120))) for _ in range(40)]
    texts += ["\n".join([" ".join(sentence(rng, 40)), shared, " ".join(sentence(rng, 30))]) for _ in range(14)]
    texts += [" ".join(sentence(rng, 20)) + " " + passage.upper() + ". " + " ".join(sentence(rng, 12)) for _ in range(4)]
    base = sentence(rng, 400)
    texts += [" ".join(base)] * 3 + [" ".join(base[:200] + ["edit"] + base[201:]), " ".join(base[:-1])]
    texts += [" ".join(sentence(rng, 60)) * 40, " ".join(sentence(rng, 8)) * 2]
    rows = [(i, t, ("en", "de", None)[i % 3], None if i % 11 == 5 else f"site{i % 13}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, "a row without an id " + " ".join(sentence(rng, 30)), None, None, None), (None, None, None, None, None)]
    rows += [rows[9], rows[9], rows[50]]  # repeated rows
    return rows


@pytest.fixture(scope="session")
def passage(corpus) -> str:
    text = next(t for _, t, *_ in corpus if t and t.count(". ") == 1)
    return " ".join(text.split(". ")[0].split()[20:])


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus over several partitions, with extra columns of names that operators use inside."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(corpus, DOCS).repartition(4)
    for name in CLASHING:
        df = df.withColumn(name, F.lit("extra"))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
