from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripmill.llm import packing
from tripmill.llm.catalogue import PATTERN, QUERIES, TOKENIZER


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def pieces_of(ids, capacity=1024):
    first = len(ids) % capacity
    cuts = sorted({0, *range(first, len(ids) + 1, capacity)})
    return [(a, ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def check_places(rows, capacity=1024):
    """Every sequence is gapless from 0 and within the capacity."""
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


def best_fit(lengths, capacity):
    """One piece after the other, longest first, into the fullest sequence that holds it."""
    gaps: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_ids_are_the_tokenizer_s(edges, reference):
    want = Counter()
    for r in edges.collect():
        for k, (start, ids) in enumerate(pieces_of(reference(r["text"]))):
            want[r["doc_id"], k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    rows = packing.pack_documents(edges, TOKENIZER, PATTERN).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    check_places(rows)


def test_strange_texts_have_the_same_ids(reference):
    encode = packing.encoder(TOKENIZER, PATTERN).encode_ordinary
    rng = random.Random(1)
    for text in ["<|endoftext|>", "    x", "\U0001f600‍", "a" * 3000, *("".join(chr(rng.choice([32, 10, 65, 97, 0x301, 0x4E00, 0x1F600, 39, 48])) for _ in range(50)) for _ in range(100))]:
        assert [*encode(text), 2] == reference(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=120))
def test_sweeps_pack_as_best_fit_does(lengths):
    placed = packing.sweeps(dict(Counter(lengths)), 32)
    rows = [{"length": n, "sequence_id": first + k, "offset": offset} for n, _, count, first, offset in placed for k in range(count)]
    assert Counter(r["length"] for r in rows) == Counter(lengths)
    ranks = defaultdict(list)
    for n, rank, count, _, _ in placed:
        ranks[n] += range(rank, rank + count)
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values())
    assert check_places(rows, 32) <= best_fit(lengths, 32) + 1


def test_runs_do_not_grow_with_the_rows():
    rng = random.Random(2)
    counts = Counter(min(1024, int(rng.expovariate(1 / 300)) + 1) for _ in range(50_000))
    few, many = packing.sweeps(counts, 1024), packing.sweeps({k: 1000 * n for k, n in counts.items()}, 1024)
    assert len(many) < 4 * len(few) < 200_000
    packed = max(first + n for _, _, n, first, _ in many)
    assert packed * 1024 < 1.005 * sum(k * n * 1000 for k, n in counts.items()) + 1024


def test_slices_and_empty_tables(spark, sf, nothing, monkeypatch):
    assert packing.pack_documents(nothing, TOKENIZER, PATTERN).count() == 0
    one = QUERIES["op4_best_fit_packing"](spark, sf).collect()
    monkeypatch.setattr(packing, "SLICE_ROWS", 20)
    rows = QUERIES["op4_best_fit_packing"](spark, sf).collect()
    assert check_places(rows) == check_places(one)
    assert len(rows) == len(one) == len({(r["doc_id"], r["piece"]) for r in rows})


def test_pieces_with_their_ids(spark, reference):
    docs = spark.createDataFrame([(1, "some words " * 900)], "doc_id bigint, text string")
    rows = packing.pieces(docs, TOKENIZER, PATTERN, ids=True).orderBy("piece").collect()
    assert [i for r in rows for i in r["ids"]] == reference("some words " * 900) and len(rows) == 2


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>\n x", "x  <|endoftext|>  y", "<|endoftext", "é<|endoftext|>日"]


def test_added_tokens_are_the_tokenizer_s(spark):
    own = Tokenizer.from_file(TOKENIZER)
    want = {i: [*own.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(ADDED)}
    assert 50256 in want[0]
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id bigint, text string")
    assert {r["doc_id"]: r["ids"] for r in packing.pieces(docs, TOKENIZER, PATTERN, ids=True).collect()} == want


def test_long_runs_of_blanks_are_encoded():
    encode, slow = packing.whole_encoder(TOKENIZER, PATTERN), Tokenizer.from_file(TOKENIZER)
    for text in (" " * 2_000_000, "a b " + "\n" * 1_200_000 + "<|endoftext|> c", "x" + " \t" * 700_000 + "y"):
        assert encode(text) == slow.encode(text, add_special_tokens=False).ids
