from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import tuples

from tripmill.llm import jaccard, shingles
from tripmill.llm.catalogue import QUERIES
from tripmill.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_sets(rows):
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(LOWER))
        yield frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def expected(rows):
    """Every pair is compared."""
    sets = list(shingle_sets(rows))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = Counter((i, j) for ids in holders.values() for i in ids for j in ids if i < j)
    for (i, j), n in shared.items():
        if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[root(i)].append(r["doc_id"])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return Counter((r["doc_id"], len(sets[i]), least[root(i)] if sets[i] else r["doc_id"]) for i, r in enumerate(rows))


def found(docs):
    return Counter(tuple(r) for r in jaccard.classes(docs).select("doc_id", "n_shingles", "component_id").collect())


def test_awkward_rows(edges, nothing):
    assert found(edges) == expected(edges.collect())
    assert jaccard.classes(nothing).count() == 0 and jaccard.keep(nothing).count() == 0


def families(seed, sizes, edits):
    """Copies of texts of several sizes with words replaced: many pairs near the threshold."""
    rng, rows = random.Random(seed), []
    passage = [f"p{i}" for i in range(60)]
    for size in sizes:
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for k in range(12):
            words = list(base)
            for _ in range(rng.randrange(edits + 1)):
                words[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
            if k % 4 == 3:
                words = words[: max(1, int(size * rng.uniform(0.7, 1)))]
            if k % 5 == 4:
                words += passage
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_families_near_the_threshold(spark, seed):
    docs = spark.createDataFrame(families(seed, [3, 5, 6, 8, 9, 12, 15, 20, 30, 60, 150, 400], 4), "doc_id bigint, text string").repartition(4)
    want = expected(docs.collect())
    assert found(docs) == want
    assert 3 < len({k[2] for k in want}) < sum(want.values())


@pytest.mark.parametrize("bound", [0, 10, 10**6])
def test_any_boundary_gives_the_same_links(spark, monkeypatch, bound):
    docs = spark.createDataFrame(families(3, [6, 9, 14, 40], 3), "doc_id bigint, text string")
    monkeypatch.setattr(jaccard, "boundary", lambda sets: bound)
    assert found(docs) == expected(docs.collect())


def test_hot_shingles_and_split_groups(spark, monkeypatch):
    rows = families(4, [30, 80, 80], 3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    want = expected(docs.collect())
    monkeypatch.setattr(jaccard, "HOT_LEAST", 5)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    assert len(jaccard.hot_shingles(docs, 40)[0]) > 0
    assert found(docs) == want


def test_one_document_of_each_group_stays(edges):
    rows = jaccard.keep(edges)
    assert rows.columns == edges.columns
    want = {k[0] for k in expected(edges.collect()) if k[0] == k[2]}
    assert {r["doc_id"] for r in rows.collect()} == want


def test_rows_with_repeated_and_null_ids(spark):
    base = [f"w{i}" for i in range(60)]
    one, near, other, lone = " ".join(base), " ".join(["x", *base]), " ".join(f"o{i}" for i in range(40)), " ".join(f"l{i}" for i in range(30))
    rows = [
        (1, one), (2, near), (2, lone), (None, near), (None, other), (None, other + " z"), (7, None), (7, None), (None, " "), (5, "ab"), (5, "ab"), (6, "ab"),
        (9, " ".join(f"t{i}" for i in range(50))), (9, " ".join(f"t{i}" for i in range(51))),
    ]
    names = ["_kept", "row", "digest", "b_id", "b_digest", "n", "best", "component", "doc", "set_id", "alike"]
    docs = spark.createDataFrame([(*r, *["m"] * len(names)) for r in rows], "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in names)).repartition(3)
    kept = jaccard.keep(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    free = {k: n for k, n in got.items() if k[0] != 9 and not (k[0] is None and (k[1] or "").startswith("o0"))}
    assert free == {(1, one): 1, (2, lone): 1, (7, None): 2, (None, " "): 1, (5, "ab"): 1}
    assert sum(got.values()) == sum(free.values()) + 2  # one of each pair of near copies that share an id, or have none
    assert all(r["_kept"] == r["n"] == "m" for r in kept.collect())


def test_shingles_are_the_contract_s():
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice(["a", "B", "é", "日", " ", "\n", "\x0b", "\x1c", " ", ".", "Z"]) for _ in range(rng.randrange(60)))
        want = next(shingle_sets([{"text": text}]))
        assert len(shingles.shingle_set(text)) == len(want), repr(text)
    assert np.array_equal(shingles.shingle_set("A b C d e F"), shingles.shingle_set("a  B c\td E f "))


def test_packed_numbers_come_back():
    values = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000, dtype=np.uint64))
    assert np.array_equal(shingles.from_sorted_planes(shingles.sorted_planes(values)), values)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (50, 60), (60, 55)]
    got = dict(tuples(components(spark.createDataFrame(chain, "a bigint, b bigint")), "node", "component"))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 50: 50, 55: 50, 60: 50}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = Counter(tuple(r) for r in QUERIES["op3_jaccard_join"](spark, sf).select("doc_id", "n_shingles", "component_id").collect())
    assert got == expected(docs.collect())
