from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections import Counter, defaultdict

import check
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import collocations
from tripmill.llm.collocations import Counts


def grams(texts, longest=3):
    out = Counter()
    for text in texts:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = [x.encode() for x in re.findall(r"[^\x20\x09]+", piece)]
            for k in range(1, longest + 1):
                out.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return out


def expected(rows, least):
    """The contract, word by word."""
    by_lang = defaultdict(list)
    for lang, text in rows:
        by_lang[lang if lang is not None else "und"].append(text)
    out = set()
    for lang, texts in by_lang.items():
        f = grams(texts)
        n = sum(v for k, v in f.items() if len(k) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in found.items():
            longer = [q for q in found if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * found[q] >= 50 * a for q in longer):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            out.add((lang, b" ".join(p).decode(), a, f[p[:k]], f[p[k:]], n, score))
    return out


def some_texts(seed, n):
    rng = random.Random(seed)
    vocabulary = "the of cat sat mat É ß New york a'b x-y 日本 ( ) \x1c".split(" ")
    return [" ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", "\n", "\t", "  ", ","]) for _ in range(rng.randrange(60))) for _ in range(n)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB c.\n\t\x1cé!", max_size=40), max_size=6))
def test_transducers_of_any_texts(texts):
    counts, want = Counts.of(texts), grams(texts)
    assert dict(counts.phrases()) == want
    assert dict(Counts.from_bytes(counts.to_bytes()).phrases()) == want


def test_union_cut_and_pruning():
    texts = some_texts(1, 30)
    want, rng = grams(texts), random.Random(2)
    both = Counts.union([Counts.of(texts[:10]), Counts.of(texts[10:]), Counts.of([])])
    assert dict(both.phrases()) == want
    assert dict(both.frequent(3).phrases()) == {p: n for p, n in want.items() if n >= 3}
    pool = [*sorted(want), (b"a",), (b"zzz", b"cat"), (b"the", b"of", b"zz")]
    for _ in range(200):
        bounds, got = sorted(rng.sample(pool, 4)), {}
        for number, part in both.cut(bounds):
            phrases = dict(Counts.from_bytes(part.to_bytes()).phrases())
            assert all(bisect_right(bounds, p) == number for p in phrases)
            got |= phrases
        assert got == want


def test_states_with_the_same_arcs_are_one():
    """Hundred first words with the same rest: the automaton does not grow with them as the paths do."""
    texts = [f"{w} and so" for w in range(100)]
    counts = Counts.of(texts)
    assert counts.size() == 102 + 101 + 100
    assert len(counts.to_bytes()) < len(Counts.of([f"{w} and{w} so{w}" for w in range(100)]).to_bytes())


def test_a_range_decoded_in_parts(monkeypatch):
    texts = some_texts(3, 40)
    blobs = [Counts.of(texts[k::4]) for k in range(4)]
    monkeypatch.setattr(collocations, "DECODED", 200)
    counts, words = collocations._united([b.to_bytes() for b in blobs], [b.size() for b in blobs], 2)
    want = grams(texts)
    assert dict(counts.phrases()) == {p: n for p, n in want.items() if n >= 2}
    assert words == sum(n for p, n in want.items() if len(p) == 1)


def test_candidates_of_awkward_rows(spark, edges, nothing):
    rows = [(random.Random(k).choice(["en", "en", None, "und", ""]), t) for k, t in enumerate([*some_texts(4, 300), None, "", "\n", "x" * 100_000])]
    extra = "lang string, text string, phrase string, `range` int, data string, n int, score int"
    df = spark.createDataFrame([(*r, "p", 1, "d", 2, 3) for r in rows], extra).repartition(7)
    for flush in (2_000, 10**6):
        got = {tuple(r) for r in collocations.mine(df, least=5, flush=flush).collect()}
        assert got == expected(rows, 5) and got
    rows = [(r["lang"], r["text"]) for r in edges.collect()]
    assert {tuple(r) for r in collocations.mine(edges).collect()} == expected(rows, 10)
    assert collocations.top(collocations.mine(nothing)).count() == 0


def test_ranks(spark):
    rng = random.Random(0)
    rows = [(rng.choice("ab"), f"p{i:04d}", rng.randrange(3), 1, 1, 9, rng.randrange(4)) for i in range(3000)]
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long").repartition(4)
    got = {(r["lang"], r["rank"]): r["phrase"] for r in collocations.top(df, 100).collect()}
    for lang in "ab":
        order = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1]))
        assert [got[lang, k + 1] for k in range(100)] == [r[1] for r in order[:100]]
    assert len(got) == 200


def test_products_past_64_bits():
    f = {"a b": 10**12, "a": 10**13, "b": 10**12 + 1}
    assert collocations.scored(("a", "b"), f) == (10**6 * 10**24 // (10**13 * (10**12 + 1)), 10**13, 10**12 + 1)


def test_query_and_sql(spark):
    ok, note = check.compare(spark, check.connect(SF), "op12_collocations", SF)
    assert ok, note
