from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from tripmill.llm import lm_scoring as lm
from tripmill.llm.catalogue import QUERIES
from tripmill.llm.shingles import word_hashes


def network(seed=0):
    rng = np.random.default_rng(seed)
    return {name: rng.normal(0, 0.3, shape).astype(np.float32) for name, shape in lm._SHAPES}


def test_words_are_predicted_from_both_sides_and_not_from_themselves():
    classes = np.arange(10)
    around = lm.windows(classes, np.array([0, 5]))
    assert around.tolist() == [[lm.EDGE] * 3 + [1, 2, 3], [2, 3, 4, 6, 7, 8]]


def test_probabilities_by_definition():
    net, classes = network(), np.array([3, 7, 1, 90, 4])
    got = lm.log_probabilities(net, lm.windows(classes, np.arange(5)), classes)
    for i in range(5):
        padded = [lm.EDGE] * 3 + classes.tolist() + [lm.EDGE] * 3
        sides = padded[i : i + 3] + padded[i + 4 : i + 7]
        hidden = np.tanh(sum(net["table"][k][c] for k, c in enumerate(sides)) + net["bias"])
        logits = hidden @ net["out"] + net["prior"]
        assert abs(got[i] - (logits[classes[i]] - np.log(np.exp(logits).sum()))) < 1e-4


def test_steps_follow_the_slope():
    net, rng = network(1), np.random.default_rng(2)
    classes = rng.integers(0, 5, 400)
    around, centres = lm.windows(classes, np.arange(400)), classes
    sums = {name: np.zeros(shape, dtype=np.float32) for name, shape in lm._SHAPES}
    before = lm.log_probabilities(net, around, centres).mean()
    for _ in range(30):
        lm.step(net, sums, around, centres)
    assert lm.log_probabilities(net, around, centres).mean() > before + 0.5
    assert np.array_equal(lm.flat(lm.shaped(lm.flat(net))), lm.flat(net))


def corpus(spark):
    rng, rows = random.Random(3), []
    for i in range(240):
        words = "the cat sat on a mat and the dog ran to the old house by a lake".split()
        text = " ".join(words[(i + k) % len(words)] for k in range(60))
        if i % 8 == 7:
            text = text.split()
            rng.shuffle(text)
            text = " ".join(text)
        rows.append((i, text))
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def test_order_scores_above_disorder(spark):
    docs = corpus(spark).cache()
    counts = lm.word_counts(docs)
    want = Counter(int(h) for r in docs.collect() for h in word_hashes(r["text"]).view(np.int64))
    assert {r["word"]: r["n"] for r in counts.collect()} == want
    words = lm.vocabulary(counts.cache())
    net = lm.train(docs, words, rounds=6)
    rows = lm.score(docs, words, net).collect()
    good, bad = (np.mean([r["mean_ll"] for r in rows if (r["doc_id"] % 8 == 7) is b]) for b in (False, True))
    assert good > bad + 0.3
    untrained = lm.score(docs, words, lm.initial(words.sizes)).agg({"pseudo_ll": "sum"}).first()[0]
    assert sum(r["pseudo_ll"] for r in rows) > untrained


def test_awkward_rows(edges, nothing):
    rows = lm.score_corpus(edges).collect()
    assert len(rows) == edges.count() and lm.score_corpus(nothing).count() == 0
    sizes = Counter((r["doc_id"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in edges.collect())
    assert Counter((r["doc_id"], r["n_words"]) for r in rows) == sizes
    for r in rows:
        assert (r["pseudo_ll"], r["mean_ll"]) == (0.0, None) if r["n_words"] == 0 else r["mean_ll"] < 0


def test_query_scores_whole_texts(spark, sf):
    rows = {r["doc_id"]: r["n_words"] for r in QUERIES["op2_lm_scoring"](spark, sf).collect()}
    want = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert rows == want


def text_rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)


def test_shares_of_each_class_sum_to_one(spark):
    texts = [" ".join(f"w{i}" for i in range(k, k + 1000)) for k in range(0, 4000, 500)]
    words = lm.vocabulary(lm.word_counts(text_rows(spark, texts)).cache())
    hashes = word_hashes(" ".join(f"w{i}" for i in range(4500)))
    places = words.places(hashes)
    classes = words.classes(places, lm.word_lengths(" ".join(f"w{i}" for i in range(4500))))
    shares = np.bincount(classes, weights=np.exp(words.within(places, classes)), minlength=lm.CLASSES)
    assert np.allclose(shares[np.unique(classes)], 1)


def test_words_of_the_tail_take_their_exact_counts(spark, monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(lm, "TAIL", 500)
    texts = [" ".join(rng.choice(["a", "b", f"r{rng.randrange(400)}", f"once{i}x{k}"]) for k in range(40)) for i in range(60)]
    docs, n = text_rows(spark, [*texts, "", "a b"]), Counter(w for t in [*texts, "a b"] for w in t.split())
    counts = lm.word_counts(docs).cache()
    words = lm.vocabulary(counts)
    assert 0 < len(words.head) < len(n)
    net = lm.initial(words.sizes)
    got = {r["doc_id"]: r["pseudo_ll"] for r in lm.score(docs, words, net, counts).collect()}
    for i, text in enumerate([*texts, "", "a b"]):
        _, _, classes = words.of(text)
        want = lm.log_probabilities(net, lm.windows(classes, np.arange(len(classes))), classes).sum() if text else 0.0
        want += sum(np.log(n[w] / words.sizes[c]) for w, c in zip(text.split(), classes, strict=True) if c >= lm.FREQUENT)
        assert abs(got[i] - want) < 1e-3


def test_every_word_is_a_target_once():
    for n in (0, 1, 2, 15, 16, 17, 100):
        for rounds in (1, lm.ROUNDS, 6):
            assert sorted(np.concatenate([lm.targets(n, turn, rounds) for turn in range(rounds)]).tolist()) == list(range(n))


def test_order_scores_above_disorder_as_in_production(spark):
    docs = corpus(spark).cache()
    words = lm.vocabulary(lm.word_counts(docs).cache())
    rows = lm.score(docs, words, lm.train(docs, words)).collect()
    good, bad = (np.mean([r["mean_ll"] for r in rows if (r["doc_id"] % 8 == 7) is b]) for b in (False, True))
    assert good > bad + 0.3


def test_texts_laid_out_together():
    texts = [bytes([1, 2, 3, 4, 5]), b"", bytes([9]), bytes(range(10, 30))]
    around, centre, place, owner = lm.laid_out(texts)
    want = [lm.windows(np.frombuffer(t, np.uint8).astype(np.int64), np.arange(len(t))) for t in texts if t]
    assert np.array_equal(around.T, np.concatenate(want)) and bytes(centre) == b"".join(texts)
    assert place.tolist() == [i for t in texts for i in range(len(t))] and owner.tolist() == [k for k, t in enumerate(texts) for _ in t]
    assert [len(x) for x in lm.laid_out([b"", b""])] == [6, 0, 0, 0]
