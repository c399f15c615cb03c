import random

import pytest

WORDS = "alder birch cedar elm fir hazel larch maple oak pine rowan willow yew ash beech lime".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


#: Rows that every operator must take: nulls in any column, empty and blank texts, ties, repeated rows, odd characters.
ODD = [
    (900, None, None, None, None), (901, "", "en", None, 0), (902, " \t\n ", "en", "a", 4), (903, "ß É 漢字 🙂 x", None, "b", 9), (904, "one", "en", "b", 3),
    (904, "one", "en", "b", 3), (905, "a\r\nb\x0bc", "en", "b", 6), (906, "\n\n", "en", "b", 2),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rows():
    """Some hundred small documents: unique ones, exact and near copies, shared passages, a very long one, odd rows."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    texts = list(base)
    for i in range(12):
        words = base[i].split()
        if len(words) > 20:
            words[rng.randrange(len(words))] = "changed"
        texts += [base[i], " ".join(words)]
    passage = prose(rng, 60)
    texts += [prose(rng, 30) + "\n" + passage + "\n" + prose(rng, rng.randint(0, 20)) for _ in range(8)]
    texts.append("\n".join(prose(rng, 50) for _ in range(300)))
    texts += ["same word " * 300, "x" * 3000]
    return [(i, x, "en", f"s{i % 3}", len(x)) for i, x in enumerate(texts)] + ODD


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
