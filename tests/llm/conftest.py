import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, n int, h string, body int"


def prose(rng, n, vocab=400):
    return " ".join(f"w{int(rng.random() ** 2 * vocab)}" for _ in range(n))


def corpus():
    """Small corpus with copies, near copies, shared passages, junk, nulls, empty
    and long texts, repeated rows, and columns whose names operators use inside."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(40, 160)) for _ in range(60)]
    passage = prose(rng, 50, 5000)
    texts += [texts[0]] * 3 + [t.replace("w7 ", "w8 ", 1) for t in texts[:6]] + [texts[1].upper()]
    texts += [f"{prose(rng, 20)} {passage} {prose(rng, 20)}" for _ in range(4)]
    texts += [None, "", " \n\t ", "one", "ONE", "a b", prose(rng, 6000, 9000), "x " * 300, "é ß 中文 " * 20,
              "#a %b $c " * 60, "line one here\nline one here\n\nline two", "z" * 9000]
    rows = [(i, t, "en" if i % 3 else None, "s" if i % 2 else "t", None if t is None else len(t), "x", 1, "y", 2)
            for i, t in enumerate(texts)]
    return rows + [rows[5], (None, texts[9], None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
