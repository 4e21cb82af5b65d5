import random

import pytest

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sigma tau ups phi chi psi omega été naïve 日本 x1 y2".split()


def prose(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 30)) for _ in range(n))


def corpus() -> list[tuple]:
    """(doc_id, text, source): copies, near copies, shared passages, nulls, empty, blank and long texts, a hot source."""
    rnd = random.Random(4)
    passage = prose(rnd, 45)
    texts = [prose(rnd, rnd.randint(1, 150)) for _ in range(30)]
    for base in texts[:4]:
        words = base.split()
        for _ in range(6):
            new = list(words)
            for _ in range(rnd.randint(0, 1 + len(new) // 15)):
                new[rnd.randrange(len(new))] = "edit" + str(rnd.randint(0, 99))
            texts.append(" ".join(new))
    texts += [texts[5]] * 5 + [prose(rnd, 20) + " " + passage + " " + prose(rnd, 20) for _ in range(6)]
    texts += ["", "", None, None, "   \n\t ", "one", "ONE", "one ", "two words", "He " * 300, prose(rnd, 4000), "étéé́ ﬁ <|endoftext|>'s don't 'll"]
    return [(i * 3 + 1, t, None if i % 17 == 0 else "hot" if i % 3 else f"s{i % 5}") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The corpus with columns whose names operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], "doc_id bigint, text string, source string, kept string, score int, row string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def twice(docs):
    """Every row repeated, ids too, and a row of nulls."""
    return docs.unionByName(docs).unionByName(docs.sparkSession.createDataFrame([(None,) * 6], docs.schema))
