from __future__ import annotations

import re

import check
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import quality
from tripmill.llm.catalogue import ORACLES, QUERIES


def base(text):
    """The contract's numbers, by definition."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    copies = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(inside)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab c\n\t\x0b\x1c é#|!.", max_size=80))
def test_numbers_of_any_text(text):
    assert quality.clean(text)[:5] == base(text)


def test_rules_of_lines():
    good = "a fine line of plain words that ends as it should."
    assert quality.line_fault(good) is None
    assert quality.line_fault("home | news | sport | contact") == "navigation"
    assert quality.line_fault("a%%% b### c*** d$$$") == "punctuation"
    assert quality.line_fault("AA!! BB!! CC!!") == "punctuation"
    assert quality.line_fault("one two three four five six seven eight nine ten eleven twelve") == "punctuation"
    assert quality.line_fault("so so so it it is is.") == "stutter"
    assert quality.line_fault("Released under the MIT License.") == "boilerplate"


def test_lines_go_and_documents_that_lose_too_much():
    good = ["the first line has nothing wrong with it.", "and neither has the second one of them."]
    *_, lost, failed, kept, text = quality.clean("\n".join(["no, no.", *good, "All rights reserved.", "no, no."]))
    assert text == "\n".join(["no, no.", *good]) and lost == len("Allrightsreserved.") + len("no,no.")
    assert kept and not failed
    *_, failed, kept, text = quality.clean(good[0] + "\n" + "home | news | sport | weather | travel | money | music | food\n")
    assert not failed and not kept


def test_awkward_rows(edges, nothing):
    rows = quality.judge(edges, texts=True).collect()
    assert len(rows) == edges.count() and quality.judge(nothing).count() == 0
    texts = {(r["doc_id"], len(r["text"] or "")): r["text"] for r in edges.collect()}
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 3)}
    for (key, _), text in texts.items():
        if key in by_id and len(text or "") < 5000:
            r = by_id[key]
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base(text)
    assert not by_id[5]["kept"] and not by_id[6]["kept"] and by_id[5]["base_failed"] and by_id[16]["base_failed"]


def test_query_has_its_sql(spark):
    assert set(QUERIES) >= set(ORACLES)
    for name in ORACLES:
        ok, note = check.compare(spark, check.connect(SF), name, SF)
        assert ok, note
