from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import check
import pyarrow as pa
from conftest import SF

from tripmill.llm import vector_codes

SCHEMA = "vec_id bigint, embedding array<double>, label int, code string, error int, `of` string, n int"


def expected(rows, parts=8, entries=16, rounds=6):
    """The contract, vector by vector, in Python's integers."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, ",".join(map(str, r[1]))))
    width = len(order[0][1])
    size = width // parts
    used = [r for r in order if len(r[1]) == width]
    books = [[r[1][p * size : (p + 1) * size] for r in used[:entries]] for p in range(parts)]

    def nearest(book, part):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for r in used:
                part = r[1][p * size : (p + 1) * size]
                members[nearest(book, part)[1]].append(part)
            books[p] = [[sum(c) // len(members[k]) for c in zip(*members[k], strict=True)] if k in members else e for k, e in enumerate(book)]
    out, totals = [], defaultdict(int)
    for i, v, label in kept:
        if len(v) == width:
            found = [nearest(books[p], v[p * size : (p + 1) * size]) for p in range(parts)]
            code, error = "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)
            totals[label] += error
            out.append((i, code, error, label))
        else:
            out.append((i, None, None, label))
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e if e is None or e < 2**63 else None, totals.get(x), sha) for i, c, e, x in out), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z", 1, "z", 1) for r in rows], SCHEMA).repartition(3)


def got(spark, rows, **options):
    return sorted((tuple(r) for r in vector_codes.compress(frame(spark, rows), **options).collect()), key=repr)


def some(n, width=16, seed=0, scale=1.0):
    rng = random.Random(seed)
    return [(i * 3 % 101 if i % 7 else i, [rng.gauss(0, scale) for _ in range(width)], rng.choice([None, 1, 2])) for i in range(n)]


def test_awkward_vectors(spark):
    rows = some(120)
    nan, inf = float("nan"), float("inf")
    rows += [(500, None, 1), (-5, [nan] * 16, 1), (-6, [None] * 16, None), (-7, [inf] * 16, 1), (-8, [-inf, *[0.0] * 15], 2), (9, [0.1] * 15, 1), (10, [], 2)]
    rows += [(None, [0.25] * 16, 2), (3, rows[0][1], 1), rows[5], rows[5], (77, [-0.00001] * 16, None)]
    assert got(spark, rows) == expected(rows)


def test_small_blocks_few_vectors_and_ties(spark, monkeypatch):
    rows = [(i, [float(i % 3)] * 8, i % 2) for i in range(40)]
    assert got(spark, rows) == expected(rows)
    assert got(spark, rows[:5]) == expected(rows[:5])
    assert got(spark, [(1, None, 1)]) == [] and got(spark, []) == []
    assert [r[1:3] for r in got(spark, [(1, [1.0] * 9, 1)])] == [(None, None)]


def test_more_vectors_than_a_block(spark, monkeypatch):
    rows = [(i, [float(i % 5), 0.5], None) for i in range(25)]
    kinds = pa.schema([("width", pa.int32()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("vals", pa.list_(pa.string()))])
    batch = pa.table({"vec_id": [r[0] for r in rows], "embedding": [r[1] for r in rows], "label": pa.array([None] * 25, pa.int32())}).to_batches()
    monkeypatch.setattr(vector_codes, "BLOCK", 10)
    blocks = [b for out in vector_codes._blocks(kinds)(iter(batch)) for b in out.to_pylist()]
    assert [len(b["ids"]) for b in blocks] == [10, 10, 5] and [b["sizes"] for b in blocks] == [[5, 1]] * 3
    assert blocks[0]["vals"] == ["0,4096,8192,12288,16384", "2048"]


def test_integers_past_64_bits(spark):
    rows = [(i, [x * 1e18 for x in v], label) for i, v, label in some(30, width=8, seed=2)]
    want, have = expected(rows, rounds=2), got(spark, rows, rounds=2)
    assert [r[:3] for r in have] == [r[:3] for r in want] and [r[4] for r in have] == [r[4] for r in want]
    assert all(r[2] is None for r in have)


def test_query_and_sql(spark):
    ok, note = check.compare(spark, check.connect(SF), "op11_vector_codes", SF)
    assert ok, note
