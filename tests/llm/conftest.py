import random

import pytest

WORDS = "alder birch cedar dogwood elder fir gorse hazel iris juniper knapweed larch maple nettle oak pine".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "wood", "berry", "leaf and bark", "."]) for _ in range(n))


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, length string, key int"


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and ids, columns named as operators name theirs."""
    long_text = "\n".join(prose(i, 60) for i in range(60))
    shared = "\n".join(prose(900 + i, 30) for i in range(4))
    texts = [
        (1, prose(1, 80)),
        (2, prose(1, 80)),
        (3, prose(1, 80).upper()),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, long_text),
        (8, long_text + "\nEnd."),
        (9, prose(9, 50) + "\n" + shared),
        (10, shared + "\n" + prose(10, 50)),
        (11, "é" * 300 + "日本語テスト" * 40),
        (12, "a" * 700),
        (13, "!!! 123 ́"),
        (14, "one"),
        (14, "one"),
        (14, "another text under the same id"),
        (None, prose(77, 40)),
        (None, None),
    ]
    rows = [(i, t, "en" if (i or 0) % 2 else None, None, None, 0.5, "x", 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
