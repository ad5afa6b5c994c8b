from __future__ import annotations

import itertools
import random

import numpy as np

from tripmill.llm import language
from tripmill.llm.catalogue import QUERIES


def test_spans_are_the_best_of_all_labellings():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 4, 6, 6])
    scores = np.zeros((6, 4, 3))
    for k, n in enumerate(lengths):
        scores[:n, k] = -rng.random((n, 3)) * 4
    labels = language.viterbi(scores, lengths, switch=1.5)

    def value(path, k):
        return sum(scores[t, k, x] for t, x in enumerate(path)) - 1.5 * sum(a != b for a, b in itertools.pairwise(path))

    for k, n in enumerate(lengths):
        best = max(value(p, k) for p in itertools.product(range(3), repeat=int(n)))
        assert abs(value(labels[:n, k].tolist(), k) - best) < 1e-9


def test_scripts():
    assert [language.script(c) for c in "aéжαא字あ한नกЀ"] == ["Latin", "Latin", "Cyrillic", "Greek", "Hebrew", "Han", "Kana", "Hangul", "Devanagari", "Thai", "Cyrillic"]


ROWS = [("en", "the house and the garden with this thing"), ("de", "das haus und der garten mit dem ding"), ("ru", "дом и сад это вещь"), ("el", "το σπίτι και ο κήπος")]


def test_mixed_text_has_spans_and_scripts_narrow():
    words = language.Words(language.learn(ROWS * 5))
    text = "the house and the garden with this thing. das haus und der garten. сад"
    [(found, labels, _)] = language.spans([text], words)
    named = [words.langs[k] for k in labels]
    assert named[:8] == ["en"] * 8 and named[8:13] == ["de"] * 5 and named[13] == "ru"
    assert language.predict([text], words, [0.25] * 4)[0][0] == "en"
    assert [p for p, _ in language.predict(["сад дом ξένος", None, "", "12 _ 3 ²", "字字"], words, [0.1, 0.2, 0.4, 0.3])] == ["ru", "und", "und", "und", "en"]


def test_long_and_short_texts_together():
    words = language.Words(language.learn(ROWS * 5), most=3)
    rng = random.Random(0)
    texts = [" ".join(rng.choice(ROWS)[1] for _ in range(rng.randrange(40))) for _ in range(200)]
    assert language.predict(texts, words, [0.25] * 4) == [language.predict([t], words, [0.25] * 4)[0] for t in texts]


def test_awkward_rows(edges, nothing, spark):
    model = language.train(edges)
    rows = language.identify(edges, model).collect()
    assert len(rows) == edges.count() and language.identify(nothing, model).count() == 0
    by_id = {r["doc_id"]: r for r in rows}
    assert all((by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0) for i in (5, 6, 7, 14))
    assert {r["lang_pred"] for r in rows} <= {*model["langs"], "und"} and all(0 <= r["score"] <= 1 for r in rows)
    empty = language.train(nothing)
    assert {r["lang_pred"] for r in language.identify(edges, empty).collect()} == {"und"}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op8_language_id"](spark, sf).join(docs, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.97 * len(rows) > 200
