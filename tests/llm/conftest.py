import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, h1 long, key string, row long, score double"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(["ba", "ko", "ri", "tu", "né"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def corpus() -> list[tuple]:
    """Rows with near and exact copies, a shared passage, ties, nulls, empty and very long texts, repeated rows."""
    rng = random.Random(3)
    texts: list = []
    for _ in range(30):
        texts.append("\n".join(" ".join(words(rng, rng.randint(5, 60))) for _ in range(3)))
    passage = " ".join(words(rng, 60))
    texts += [f"{' '.join(words(rng, 40))} {passage} {' '.join(words(rng, 40))}" for _ in range(3)]
    base = words(rng, 300)
    for k in range(12):
        near = list(base)
        near[25 * k] = "edited"
        texts.append(" ".join(near))
    texts += [texts[0], texts[0], texts[1], texts[1].encode().upper().decode()]
    texts += [None, None, "", "   \n\t ", "one", "Two words", "123 ### !!", " ".join(words(rng, 20_000)), "a b 　 \U0001f600 ▁ x", "ab " * 4000]
    rows = [(i, t, ["en", "fr", None][i % 3], f"s{i % 4}" if i % 5 else None, None, 7, 8, "k", i, 0.5) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[2], None, None, None, 7, 8, "k", 1, 0.5), (None, None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
