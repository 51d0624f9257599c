import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, h1 long, key string, n long"


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): nulls, blanks, a long text, copies, near copies, repeated lines, ties."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghiéü") for _ in range(rng.randint(1, 8)))
    line = lambda n: " ".join(word() for _ in range(n))
    out = [(1, None), (2, ""), (3, " \t\n \x0b"), (4, "One"), (5, "Two words"), (6, "a a a a a a a a a a a a"), (7, "tie"), (8, "tie")]
    common = line(60)
    for i in range(10, 60):
        body = [line(rng.randint(1, 30)) for _ in range(rng.randint(1, 8))]
        if i % 7 == 0:
            body.insert(0, common)
        if i % 5 == 0:
            body.append(body[0])
        if i % 11 == 0:
            body.append("All rights reserved.")
        out.append((i, "\n".join(body)))
    for i in range(60, 90):
        source = dict(out)[rng.randint(10, 59)]
        words = source.split(" ")
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = word()
        out.append((i, " ".join(words)))
    out.append((90, "\n".join(line(40) for _ in range(150))))
    out.append((91, dict(out)[90]))
    out.append((92, "x" * 30_000))
    out.append((93, "***### $$$ bad%%% &&& " * 20))
    return out


@pytest.fixture(scope="session")
def documents(spark, texts):
    rows = [(i, t, "en" if i % 3 else None, None if i % 9 == 0 else f"src{i % 4}", None, i, "x", 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
