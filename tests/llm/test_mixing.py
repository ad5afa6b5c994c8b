from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tripmill.llm import mixing


def filled(sizes: dict) -> dict:
    """Targets by resharing the excess round after round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, full, left = dict.fromkeys(order, 0.0), set(), 1.5 * sum(sizes.values())
    while left > 1e-9 and len(full) < len(order):
        unit = left / sum(weight[s] for s in order if s not in full)
        left = 0.0
        for s in order:
            if s not in full:
                target[s] += unit * weight[s]
                if target[s] >= 2 * sizes[s]:
                    left += target[s] - 2 * sizes[s]
                    target[s] = 2.0 * sizes[s]
                    full.add(s)
    return target


def brute(rows):
    """How often each row is taken: keys sorted within the source, words summed one by one."""
    sized = [len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows]
    sizes = defaultdict(int)
    for r, n in zip(rows, sized, strict=True):
        sizes[r["source"]] += n
    target, by_source, taken = filled(sizes), defaultdict(list), [0] * len(rows)
    for i, (r, n) in enumerate(zip(rows, sized, strict=True)):
        text = r["text"] or ""
        name = "" if r["doc_id"] is None else str(r["doc_id"])
        digest = hashlib.md5(f"{name}:{hashlib.md5(text.encode()).hexdigest()}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 0.5) / 2**52
        good = max(0.05, 1 - sum(text.count(c) for c in "#*$%&|<>") / max(n, 1))
        by_source[r["source"]].append((-math.log(u) / good, r["doc_id"] is None, r["doc_id"] or 0, i))
    for source, keys in by_source.items():
        whole = int(target[source] // sizes[source]) if sizes[source] else 0
        left, past = target[source] - whole * sizes[source], 0
        for *_, i in sorted(keys):
            past += sized[i]
            taken[i] = whole + (sized[i] > 0 and past - sized[i] / 2 < left)
    return taken


def test_takes_by_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    want = Counter((r["doc_id"], n) for r, n in zip(rows, brute(rows), strict=True))
    assert Counter((r["doc_id"], r["epochs"]) for r in mixing.mix(docs).collect()) == want


def test_targets_and_takes(edges, nothing):
    rows = mixing.mix(edges).collect()
    sizes = defaultdict(int)
    for r in edges.collect():
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    assert len(rows) == edges.count()
    want, taken, largest = filled(sizes), Counter(), defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * (1 + r["target"])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["epochs"] * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in sizes)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def test_reruns_and_layouts_agree(edges):
    one = Counter(tuple(r) for r in mixing.mix(edges).select("doc_id", "size", "taken").collect())
    assert one == Counter(tuple(r) for r in mixing.mix(edges.repartition(7)).select("doc_id", "size", "taken").collect())


def test_slices_do_not_change_the_sample(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = Counter(tuple(r) for r in mixing.mix(docs).select("doc_id", "taken").collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    assert one == Counter(tuple(r) for r in mixing.mix(docs).select("doc_id", "taken").collect())


def test_rows_of_the_mix(edges):
    plan = Counter()
    for r in mixing.mix(edges).collect():
        plan[r["doc_id"], r["source"]] += r["epochs"]
    rows = mixing.mixed(edges)
    assert rows.columns == edges.columns
    assert Counter((r["doc_id"], r["source"]) for r in rows.collect()) == +plan


def test_quality_moves_chances(spark):
    docs = spark.createDataFrame([(i, ("a b c d e f g h" if i % 2 else "a# b# c# d# e# f# g# h#"), "s" if i else "t") for i in range(2001)], "doc_id bigint, text string, source string")
    docs = docs.unionByName(docs.selectExpr("doc_id + 5000 AS doc_id", "text", "'u' AS source"))
    taken = mixing.mix(docs).where("source = 'u'").groupBy("doc_id").sum("epochs").collect()
    good = sum(r[1] for r in taken if r[0] % 2)
    assert good > 1.2 * sum(r[1] for r in taken if r[0] % 2 == 0)


def test_names_inside_disturb_nothing(spark, edges):
    names = ["_size", "_key", "_epochs", "_alike", "_p_id", "_copy", "cell", "cells", "copy", "row", "key", "size", "u", "p_id", "p_source", "p_key", "epochs", "alike", "s", "b", "slice"]
    docs = edges.selectExpr("doc_id", "text", "source", *[f"777 AS {c}" for c in names])
    rows = mixing.mixed(docs)
    assert rows.columns == docs.columns
    got = rows.collect()
    assert all(r[c] == 777 for r in got for c in names)
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r["doc_id"], r["text"]) for r in mixing.mixed(edges).collect())


@pytest.mark.parametrize("symbols", ["", "##########", None])
def test_slices_are_even_at_any_quality(spark, monkeypatch, symbols):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 200)
    tail = F.lit(symbols) if symbols is not None else F.expr("repeat('#', int(id % 11))")
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c d e f g h i j"), tail).alias("text"), F.lit("s").alias("source"))
    rows = mixing.weighed(docs)
    cells = F.array_sort(F.collect_list(F.struct("cell", "rows")))
    cells = rows.groupBy("cell").agg(F.count("*").alias("rows")).agg(cells.alias("cells"))
    slices = rows.crossJoin(F.broadcast(cells)).select(F.floor(mixing.share_below(F.col("cells"), F.col("key")) * 100).alias("slice"))
    assert slices.groupBy("slice").count().agg(F.max("count")).first()[0] < 3 * 200
