"""One small table with every awkward case: nulls, empty texts, copies, near copies, a shared passage, repeated rows, clashing columns."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, score string"


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def make_rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abdeghilmnorst") for _ in range(rng.randint(2, 7))) for _ in range(900)]
    passage = words(rng, 30, vocabulary)
    rows, texts = [], []
    for i in range(60):
        texts.append(words(rng, rng.choice([3, 12, 40, 150]), vocabulary))
    texts += [texts[2]] * 5 + [None, "", " ", "one two", "Ünïcödé 中文 wörter", "\n\tspaced   out \n"]
    base = words(rng, 150, vocabulary).split()
    for i in range(12):  # near copies of one base
        own = list(base)
        for k in rng.sample(range(150), i % 5):
            own[k] = f"edit{i}x{k}"
        texts.append(" ".join(own))
    for i in range(10):  # one passage in many texts
        texts.append(f"{words(rng, 20, vocabulary)} {passage} {words(rng, 15, vocabulary)}")
    texts.append(words(rng, 6000, vocabulary))  # very long
    texts += ["Mail a.b+c@mail.example.com or +1 (386) 555-3733, card 4111 1111 1111 1111, host 10.0.0.255 and 300.1.1.1", "Licensed under CC BY-NC 4.0. All rights reserved.", "x SPDX-License-Identifier: (MIT OR GPL-2.0) AND Apache-2.0\ngeneral public license"]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(10 * i + 3, texts[k], ("aa", "bb", None)[k % 3], "s", 1, "x", "y") for i, k in enumerate(order)]
    rows.append((None, "a null id has words too", None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def repeated(spark, rows):
    """The same with some rows twice."""
    return spark.createDataFrame(rows + rows[:7], SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
