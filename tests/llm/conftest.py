import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [f"w{i}" for i in range(400)]


def make_text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, copies, repeated rows and ids."""
    rng = random.Random(7)
    long = make_text(rng, 30_000)
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n ", None, None, None), (None, "no id here", "en", "b", 10),
        (None, None, None, None, None), (4, long, "de", "b", len(long)), (5, long.upper(), "de", None, 1),
        (6, "One", "en", "c", 3), (6, "One", "en", "c", 3), (7, "oNE", "en", "c", 3), (8, "ÉCOLE école", "fr", "a", 11),
        (9, "École école", "fr", "a", 11), (10, "a\x85b\xa0c d", "fr", "b", 7), (11, "two words", "en", "a", 9),
        (11, "other text", "en", "b", 9)]
    rows += [(100 + i, make_text(rng, rng.randint(1, 120)), "en", rng.choice("abcd"), 5) for i in range(60)]
    rows += [(200 + i, rows[20][1], "en", "a", 5) for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "docs")
    spark.createDataFrame(odd_rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


CLASHING = ["sha", "doc", "id", "hash", "fp", "maybe", "size", "key", "source_key", "copies", "rate", "row", "stratum",
            "severity", "s", "piece", "shard", "slot", "n", "best", "label", "toxic", "kept", "__cell", "__batch"]


@pytest.fixture(scope="session")
def clashing_docs(odd_docs):
    from pyspark.sql import functions as F

    return odd_docs.select("*", *[F.lit(f"x-{c}").alias(c) for c in CLASHING])
