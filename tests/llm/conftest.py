import random

import pytest

COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, row_key string, cls string, n string, "
           "token int, score string, block int, `set` int, value int, `__size` int")
EXTRA = ("row", "c", "1", 1, "x", 2, 3, 4, 5)


def words(rng, n, letters="abcdefghij"):
    return [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))][0]


def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    rng = random.Random(3)
    long, near = words(rng, 30_000), words(rng, 300)
    rows = [(1, None), (2, ""), (3, " \n\t\x0b "), (4, "one two"), (5, long), (6, "Same Text here 1"), (6, "Same Text here 1"),
            (None, "no id at all"), (None, None), (7, near), (8, near + " end"), (9, near), (7, near), (10, "été über 中文 ÀÉ"), (11, "K token=" + "a1B2" * 8)]
    return [(i, t, None if i in (2, None) else "en", None if i == 4 else "s", None) for i, t in rows]


@pytest.fixture(scope="session")
def table(spark):
    def make(rows):
        return spark.createDataFrame([(*r, *(None, None, None)[: 5 - len(r)], *EXTRA) for r in rows], COLUMNS)

    return make


@pytest.fixture(scope="session")
def edges(table):
    return table(edge_rows())


@pytest.fixture(scope="session")
def nothing(table):
    return table([])


HELPERS = ("row", "row_key", "_row_key", "__row_key", "cut", "_cut", "__cut", "stays", "__stays", "copy", "__copy", "__key", "__tie", "__size",
           "__piece", "__offset", "piece", "key", "n", "s", "value", "Row_Key", "spans", "root", "comp", "cls", "block", "owner")


@pytest.fixture(scope="session")
def clashing(edges):
    """The edge rows beside columns with every helper's name."""
    from pyspark.sql import functions as F

    names = list(dict.fromkeys(n for n in HELPERS if n.lower() not in {c.lower() for c in edges.columns} or n in edges.columns))
    return edges.select("doc_id", "text", "lang", "source", *[F.lit(f"x{i}").alias(n) for i, n in enumerate(names) if n != "Row_Key"])
