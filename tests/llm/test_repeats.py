from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import check
import numpy as np
from conftest import SF

from tripmill.llm import repeats
from tripmill.llm.catalogue import ORACLES, QUERIES


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected(rows, width):
    """By definition: for each window, the smallest id it starts in."""
    least, out = {}, Counter()
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - width + 1):
            seq = tuple(w[k : k + width])
            least.setdefault(seq, []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    for i, text in rows:
        w = words(text)
        gone = set()
        for k in range(len(w) - width + 1):
            m = least[tuple(w[k : k + width])]
            if m is not None and (i is None or m < i):
                gone |= set(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def digest(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def test_awkward_rows(edges, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    for width in (50, 12):
        assert digest(repeats.report(edges, width)) == expected(rows, width)
    assert repeats.report(nothing).count() == 0 and repeats.clean(nothing).columns == nothing.columns


def test_every_window_of_repetitive_texts(spark):
    """Few words, many shared runs, lengths 2, 4, 7 and 13; ids repeat and are null."""
    rng = random.Random(5)
    base = ["ab"[rng.random() < 0.5] + "xyz"[rng.randrange(3)] for _ in range(150)]
    rows = []
    for n in range(40):
        a, b = sorted(rng.sample(range(len(base)), 2))
        text = base[a:b] + [rng.choice("pqr")] * rng.randrange(30) + base[: rng.randrange(30)]
        rows.append((rng.choice([None, *range(15)]), " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert repeats.lengths(13, 2) == [2, 4, 7, 13]
    for shortest in (2, 5, 20):
        assert digest(repeats.report(df, 13, shortest)) == expected(rows, 13)


def test_equal_windows_have_equal_names():
    rng = np.random.default_rng(0)
    inner = rng.integers(0, 2**63, 50).astype(np.uint64)
    for length in repeats.lengths():
        found = {int(repeats.names(np.concatenate([rng.integers(0, 2**63, k).astype(np.uint64), inner]), length, 50)[k]) for k in range(20)}
        assert len(found) == 1


def test_case_and_spacing(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (2, text.replace(" ", "\n\t")), (3, text.upper()), (4, "x " + text)]
    got = {r["doc_id"]: (r["n_removed"], [tuple(c) for c in r["cuts"]]) for r in repeats.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: (0, []), 2: (60, [(0, 60)]), 3: (0, []), 4: (60, [(1, 61)])}


def test_cleaned_documents_keep_their_columns(edges):
    rows, out = edges.collect(), repeats.clean(edges, 12)
    assert out.columns == edges.columns and out.count() == len(rows)
    kept = Counter((r["doc_id"], hashlib.sha256(" ".join(words(r["text"])).encode()).hexdigest()) for r in out.collect())
    want = Counter()
    for (i, _, _, sha), n in expected([(r["doc_id"], r["text"]) for r in rows], 12).items():
        want[i, sha] += n
    assert kept == want


def test_query_and_sql(spark):
    ok, note = check.compare(spark, check.connect(SF), "op13_substring_dedup", SF)
    assert ok, note
    assert "op13_substring_dedup" in ORACLES and QUERIES["op13_substring_dedup"](spark, SF).where("n_removed > 0").count() > 0
