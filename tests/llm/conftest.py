from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def words(seed: int, n: int, vocabulary: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary):x}" for _ in range(n)]


def cases() -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empty and very long texts, repeated rows and ids."""
    rng = random.Random(5)
    texts: list[str | None] = [None, "", "   ", "one", "Two  words", "ÄÖ ü x ퟿ end", "a" * 3000, "ab " * 900]
    passage = " ".join(words(99, 90))
    for k in range(40):
        own = words(k, rng.randrange(1, 220))
        if k % 4 == 0:
            own[len(own) // 2 : len(own) // 2] = passage.split()
        texts.append(" ".join(own))
    base = words(1000, 400)
    for k in range(12):
        near = list(base)
        for _ in range(k):
            near[rng.randrange(400)] = f"edit{rng.randrange(10**6)}"
        texts.append(" ".join(near))
    texts += [" ".join(base)] * 8 + [" ".join(words(7, 200)).replace(" ", "\n ", 3)] * 3
    texts.append(" ".join(words(3, 12_000)))
    rows = [(i * 7, t, "en", None if i % 9 == 0 else "hot" if i % 3 else f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[20], (None, texts[25], None, None, None), (None, None, None, None, None), (rows[30][0], "other text", "en", "hot", 10)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def case_rows():
    return cases()


@pytest.fixture(scope="session")
def documents_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(cases(), DOCUMENTS).repartition(5).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def documents(spark, documents_path):
    """Read anew for each module: a DataFrame that was once collected keeps how its scan was split then."""
    return spark.read.parquet(documents_path)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], DOCUMENTS).write.parquet(path)
    return spark.read.parquet(path)
