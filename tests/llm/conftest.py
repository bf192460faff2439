import random

import pytest

from shopsight.llm.common import ship


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    ship(spark)


def prose(seed: int, n: int, vocabulary: int = 900) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" + ("." if r.random() < 0.1 else "") for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source): clean documents, copies, near copies,
    shared passages, repeated and null rows, empty and very long texts."""
    rows = [(i, " ".join(prose(i, 60 + 7 * i)), "en", f"s{i % 3}") for i in range(24)]
    base = prose(100, 300)
    rows += [(100 + k, " ".join(base), "en", "s0") for k in range(4)]  # copies
    for k in range(6):  # near copies
        w = list(base)
        for j in range(k):
            w[40 * j + 20] = f"edit{k}{j}"
        rows.append((110 + k, " ".join(w), "en", "hot"))
    passage = prose(200, 60)
    rows += [(120 + k, " ".join(prose(300 + k, 80) + passage + prose(400 + k, 40)), "de", "hot") for k in range(5)]
    rows += [(130, None, None, None), (131, "", "en", None), (132, " \t\n ", "xx", "s0"), (133, "one two", "en", "s1"),
             (133, "one two", "en", "s1"), (134, "Ärger über\x0bÖl x y", "de", "s1"),
             (135, " ".join(prose(500, 30_000)), "en", "long"), (None, " ".join(base), "en", "s0"), (None, None, None, None),
             (136, "ab " * 400, "en", "s2"), (137, "z" * 50_000, "en", "s2")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns whose names operators use themselves."""
    rows = [(*r, 7, "x", [1], 0.5) for r in corpus]
    schema = ("doc_id long, text string, lang string, source string, n_words int, `kept` string, "
              "quality array<int>, `a.b` double")
    return spark.createDataFrame(rows, schema).repartition(5)
