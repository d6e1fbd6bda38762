import random

import pytest

from demandcast.sources.storage import Storage

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, kept string, score string, tile int"


def words(n, seed=0):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["th", "er", "an", "in", "ou", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


AWKWARD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "One"), (5, "two words"), (6, "a b c d e"), (7, "é È ß 漢字 \U0001f600 x"),
    (8, words(300, 1)), (9, words(300, 1)), (10, words(300, 1) + " more"), (11, words(30_000, 2)), (12, words(300, 3)),
    (12, words(300, 3)), (12, "other text of the same id"), (None, "no id"), (None, "no id"), (None, words(300, 1)),
    (13, "x" * 50_000), (14, "it's  a   test\r\n\r\nwith <|endoftext|> runs   of  space\x1c and\x0bcontrol "),
    (15, "tail space "), (16, " lead space"), (17, "dots... (and) \"marks\"!!"), (-5, "below zero"),
]


@pytest.fixture(scope="session")
def make_docs(spark, tmp_path_factory):
    """A stored table of (doc_id, text), with more columns whose names the operators use themselves."""

    def build(rows):
        full = [(i, t, None if n % 7 == 6 else "en" if n % 2 else "fr", None if n % 5 == 4 else f"s{n % 3}", 1, n, "k", "s", 1)
                for n, (i, t) in enumerate(rows)]
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return build


@pytest.fixture(scope="session")
def awkward(make_docs):
    return make_docs(AWKWARD)


@pytest.fixture(scope="session")
def no_docs(make_docs, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


@pytest.fixture
def store(spark):
    return Storage(spark)
