import random

import pytest


@pytest.fixture
def run(spark):
    from drayline.session import RunFolder

    folder = RunFolder(spark, "test")
    yield folder
    folder.close()


def phrases(seed: int, alphabet: list[str], low: int, high: int, count: int = 6) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(low, high))) for _ in range(count)]


@pytest.fixture
def messy(spark):
    """Documents with nulls in every column, empty, blank, repeated and long texts, equal ids and clashing column names."""
    rows = [
        (1, None, "a", 0),
        (2, "", None, None),
        (3, " \n\t ", "c", 1),
        (None, "Some words of a text without an id. They go on for a while.", "d", 2),
        (5, "the same row twice", "e", 3),
        (5, "the same row twice", "e", 3),
        (6, "long " * 5000, "f", 4),
        (7, "é漢字 😀 ends oddly", "g", 5),
        (8, "x" * 3000, "h", 6),
        (9, "12345 !!", "i", 7),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, block string, n_bytes long").repartition(3)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, block string, n_bytes long")
