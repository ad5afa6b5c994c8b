from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripmill.llm import packing, token_counts
from tripmill.llm.catalogue import PATTERN, QUERIES, TOKENIZER

REFERENCE = Tokenizer.from_file(TOKENIZER)
REFERENCE.encode_special_tokens = True
ENCODE = packing.encoder(TOKENIZER, PATTERN).encode_ordinary
SIZES = {i: len(w) for w, i in packing.vocabulary(TOKENIZER).items()}


def expected(text, ends, rule="first"):
    """Byte by byte: which section each byte of a token lies in. Sections are given by their ends in characters."""
    home, section = [], 0
    for i, c in enumerate(text):
        while ends[section] <= i:
            section += 1
        home += [section] * len(c.encode())
    counts, crossing, at = [0] * len(ends), [0] * len(ends), 0
    for i in ENCODE(text):
        held = Counter(home[at : at + SIZES[i]])
        at += SIZES[i]
        own = min(held) if rule == "first" else min(held, key=lambda s: (-held[s], s))
        counts[own] += 1
        crossing[own] += len(held) > 1
    return counts, crossing


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\té日😀.", max_size=60), st.data())
def test_any_cut_of_any_text(text, data):
    ends = np.array(sorted({len(text), *data.draw(st.lists(st.integers(1, max(1, len(text))), max_size=6))} - ({0} if text else set())))
    ends = ends[ends <= len(text)]
    sizes = np.array([SIZES[i] for i in ENCODE(text)], dtype=np.int64)
    for rule in token_counts.RULES:
        got = token_counts.attribute(sizes, text.encode(), ends, rule)
        assert tuple(x.tolist() for x in got) == expected(text, ends.tolist(), rule)


def test_offsets_are_the_tokenizer_s():
    text = "A first line.\n\n  Second line, é and 日本.\n\nThird\n"
    ends = token_counts.lines(text)
    counts, _ = token_counts.attribute(np.array([SIZES[i] for i in ENCODE(text)]), text.encode(), ends)
    want = np.bincount([int(np.searchsorted(ends, a, side="right")) for a, _ in REFERENCE.encode(text, add_special_tokens=False).offsets], minlength=len(ends))
    assert counts.tolist() == want.tolist()


def test_lines():
    assert [token_counts.lines(t).tolist() for t in ("", "a", "a\n", "a\nb", "\n\n")] == [[0], [1], [2], [2, 3], [1, 2]]


def test_awkward_rows(edges, nothing):
    rows = token_counts.count(edges, TOKENIZER, PATTERN).collect()
    totals = Counter()
    for r in rows:
        totals[r["doc_id"]] += r["n_tokens"]
    want = Counter()
    for r in edges.collect():
        want[r["doc_id"]] += len(ENCODE(r["text"] or ""))
    assert totals == want and {r["doc_id"] for r in rows} == {r["doc_id"] for r in edges.collect()}
    assert token_counts.count(nothing, TOKENIZER, PATTERN).count() == 0
    with pytest.raises(ValueError, match="rule"):
        token_counts.attribute(np.array([1]), b"a", np.array([1]), "other")


def test_query_by_brute_force(spark, sf):
    rows = QUERIES["op10_token_counts"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], {})[r["section"]] = (r["start"], r["n_chars"], r["n_tokens"], r["n_crossing"])
    assert got.keys() == texts.keys()
    for key, text in texts.items():
        parts = [x + "\n" for x in text.split("\n")]
        parts[-1] = parts[-1][:-1]
        parts = parts if parts[-1] or len(parts) == 1 else parts[:-1]
        ends = np.cumsum([len(p) for p in parts]).tolist()
        if not text:
            assert got[key] == {0: (0, 0, 0, 0)}
            continue
        counts, crossing = expected(text, ends)
        assert [got[key][k] for k in range(len(parts))] == list(zip([0, *ends[:-1]], map(len, parts), counts, crossing, strict=True))


def test_added_tokens_count_as_the_tokenizer_s(spark):
    own = Tokenizer.from_file(TOKENIZER)
    texts = ["a <|endoftext|> b\nc", "<|endoftext|>", "é<|endoftext|>\n<|endoftext|> x\n"]
    rows = token_counts.count(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), TOKENIZER, PATTERN).collect()
    for i, text in enumerate(texts):
        ends = token_counts.lines(text)
        found = own.encode(text, add_special_tokens=False)
        want = np.bincount([int(np.searchsorted(ends, a, side="right")) for a, _ in found.offsets], minlength=len(ends))
        got = sorted((r["section"], r["n_tokens"]) for r in rows if r["doc_id"] == i)
        assert got == list(enumerate(want.tolist())) and sum(n for _, n in got) == len(found.ids)
