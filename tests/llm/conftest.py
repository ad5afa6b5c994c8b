"""Documents with every awkward case the operators define a result for, and the plain table beside them."""

from __future__ import annotations

import random

import pytest

#: Names that operators use inside: extra columns of a caller must not disturb them.
EXTRA = "hash normal row key size u quality slice n set_id component component_id length piece toxic lang_pred place draw weight target taken".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in EXTRA)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = [rng.choice("ab cd efg hijk lm nop qrs tuv wx yz".split()) + str(rng.randrange(400)) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words))


def edge_rows() -> list[tuple]:
    long = prose(1, 30_000)
    base = prose(2, 200)
    near = base.replace(base.split()[100], "changed", 1)
    rows = [
        (1, base, "en", "a", 5), (2, base, "en", "a", 5), (3, near, "en", "b", None), (3, near, "en", "b", None), (4, near.upper(), "de", "b", 1),
        (5, None, None, None, None), (6, "", "en", None, 0), (7, " \n\t ", None, "a", 4), (None, "without an id. it is here", "en", "c", 9),
        (None, base, "en", "a", 5), (8, long, "en", "a", 3), (9, long + " end.", "en", "c", 3), (10, "one", "de", "c", 3), (11, "one  two", "de", "c", 3),
        (12, "one two", "de", "c", 3), (13, "日本語 текст ελληνικά", None, "d", 3), (14, "12 34 56 78 90 ++ -- %%", None, "d", 3),
        (15, "x" * 50_000, "en", "d", 3), (16, "a b c d e f g h i j " * 40, "en", "e", 2), (17, "é ü\x1cq z z", "fr", "e", 2),
        (18, "line one is here.\nline one is here.\nclick here\n\n", "en", "e", 2),
    ]
    return [(*r, *["z"] * len(EXTRA)) for r in rows]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
