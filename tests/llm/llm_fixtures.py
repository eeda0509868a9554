import pytest

WORDS = "amber birch cedar delta ember fjord grove haven inlet jolly karst lumen mango noble ocean pearl quartz raven sable tulip umber vivid willow xenon yonder zephyr".split()


def prose(seed: int, n: int) -> str:
    """Made-up text: n words, sentences and lines, the same for the same seed."""
    import random

    draw = random.Random(seed)
    words = ["".join(draw.choice(WORDS)[: draw.randint(3, 6)] for _ in range(draw.randint(1, 2))) for _ in range(n)]
    return " ".join(w + (".\n" if i % 17 == 16 else "." if i % 9 == 8 else "") for i, w in enumerate(words))


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows, schema=SCHEMA):
    """Documents from (doc_id, text) or whole rows."""
    full = [r if len(r) > 2 else (*r, "en", "src0", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, schema)


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, "x"), (6, "日本語 текст ß É 😀"), (None, "no id here at all"), (None, None),
    (7, prose(1, 300)), (7, prose(1, 300)), (8, "a" * 3_000), (9, "the " * 2_000), (10, "!!! ### $$$ 12.5"), (11, prose(2, 5_000)),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    names = "score double, kept boolean, spans string, ids string, leaks string, rid bigint, copy string, band bigint, place int, n_words int"
    rows = [(i, t, None if n % 3 == 0 else "en", None if n % 4 == 0 else "s", None, 0.5, True, "s", "i", "l", 1, "c", 2, 3, 4) for n, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, SCHEMA + ", " + names)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def table(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def texts(table):
    return {r["doc_id"]: r["text"] for r in table.select("doc_id", "text").collect()}
