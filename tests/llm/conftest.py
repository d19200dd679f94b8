import random

import pytest

WORDS = "the of and river stone green walk light house seven under cold morning paper sound winter".split()


def prose(seed: int, n: int) -> str:
    chosen = random.Random(seed)
    return " ".join(chosen.choice(WORDS) + str(chosen.randrange(40)) for _ in range(n))


CLASHING = "key turn times size tie u id kind part position rank text_key cuts p group block start end k1 k2 fp root row matches shard_path"

ODD_ROWS = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \t\n ", None, None, 4),
    (4, "...!!! 123", "en", "b", 10),
    (None, "a row without an id", "en", "b", 19),
    (None, None, None, None, None),
    (5, prose(1, 300), "en", "a", 1),
    (6, prose(1, 300), "en", "c", 1),
    (6, prose(1, 300), "en", "c", 1),
    (7, prose(2, 300), "fr", "c", 1),
    (7, "same id, another text", "fr", "c", 1),
    (8, "é😀 password=hunter2x é😀 TOKEN: 'abcdef' secret=ab", "fr", "c", 1),
    (9, "x" * 20000, "fr", "a", 20000),
    (10, prose(3, 20000), "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, blank and long texts, repeated rows, clashing extra columns."""
    docs = spark.createDataFrame(ODD_ROWS, SCHEMA)
    for name in CLASHING.split():
        docs = docs.withColumn(name, docs["text"])
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
