import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, block int, ids string"


def words(rnd, n, letters="abcdefgh"):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 5))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty and long texts, copies, near copies, shared passages, repeated rows, null ids, and columns whose names clash with the operators'."""
    rnd = random.Random(4)
    base, passage = words(rnd, 120), words(rnd, 60)
    texts = [None, "", " \n\t ", "one", "Two Words", base, base, base.upper(), base + " tail", "Ünïcödé 日本 🙂 " * 40, words(rnd, 6000),
             "same " * 300, "a | b # c $ " * 50, "line one\n" * 30 + words(rnd, 80)]
    texts += [f"{words(rnd, 40)} {passage} {words(rnd, 30)}" for _ in range(6)]
    texts += [" ".join(w if rnd.random() > 0.03 else words(rnd, 1) for w in base.split()) for _ in range(8)]
    texts += [words(rnd, rnd.randint(1, 200)) + rnd.choice(["\x1c", "\x0b", " \r\n", "<|endoftext|>", "  ", "'s"]) for _ in range(30)]
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", "s10", None]), len(t or ""), "k", i % 3, "x") for i, t in enumerate(texts)]
    rows += [rows[5], rows[20], rows[20]]  # repeated rows
    rows += [(None, base, "en", "s1", 1, None, None, None), (None, None, None, None, None, None, None, None), (None, base, "en", "s1", 1, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
