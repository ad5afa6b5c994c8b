from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tripmill.llm import exact_dedup


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r["text"])].append(r["doc_id"])
    out, first = Counter(), set()
    for r in rows:
        text = normal(r["text"])
        ids = groups[text]
        keep = min((i for i in ids if i is not None), default=None)
        kept = r["doc_id"] == keep and (keep, text) not in first
        first |= {(keep, text)} if kept else set()
        out[r["doc_id"], keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def test_groups_of_awkward_rows(edges):
    got = Counter(tuple(r) for r in exact_dedup.report(edges).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert got == expected(edges.collect())


def test_a_hash_that_collides_changes_nothing(edges):
    weak = exact_dedup.report(edges, hashed=lambda normal: F.substring(F.md5(normal.cast("binary")), 1, 1))
    got = Counter(tuple(r) for r in weak.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert got == expected(edges.collect())


def test_documents_that_stay(edges, nothing):
    stays = exact_dedup.keep(edges)
    assert stays.columns == edges.columns
    rows, want = stays.collect(), {(k[0], k[4]) for k in expected(edges.collect()) if k[3]}
    assert len(rows) == len(want)
    assert {(r["doc_id"], hashlib.sha256(normal(r["text"]).encode()).hexdigest()) for r in rows} == want
    assert {r["text"] for r in rows} <= {r["text"] for r in edges.collect()}
    assert exact_dedup.keep(nothing).count() == 0 and exact_dedup.report(nothing).count() == 0


def test_null_text_and_other_columns_come_back_as_they_were(spark):
    docs = spark.createDataFrame([(2, "", 1), (1, None, 2)], "doc_id bigint, text string, extra int")
    assert [tuple(r) for r in exact_dedup.keep(docs).collect()] == [(1, None, 2)]
