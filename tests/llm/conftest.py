from __future__ import annotations

import pytest

from tallyhall.llm.common import ship

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def documents(spark):
    """Edge cases: nulls, empty and very long text, repeated rows, extra columns with odd names."""
    import random

    pick = random.Random(3)
    vocabulary = [f"w{n}" for n in range(400)]
    prose = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    base, line = prose(300), prose(30)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base.replace(" ", "  ", 1) + " tail", "en", "b"),
        (4, None, "en", None), (5, "", None, "a"), (6, " \t\n", "en", "a"), (7, "one", "de", "a"),
        (8, "two words", "de", "b"), (9, prose(30000), "en", "a"), (9, base, "en", "a"), (None, "x y z", "en", "a"),
        (10, "\n".join([line] * 5 + [prose(20)]), "en", "c"), (11, line + "\n" + prose(200), "en", "c"),
        (12, "ÄÖ äö ÀB àb   x\x1cy", "de", "a"), (13, "a b a b a b a b", "en", "a"),
        *[(20 + n, prose(60 + n), "en", "a") for n in range(40)],
    ]
    rows = [(i, t, l, s, len(t or ""), -1, "x") for i, t, l, s in rows]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n int, `words` string"
    )
