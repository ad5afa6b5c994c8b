"""Language identification: scripts narrow the candidates, Viterbi labels spans of mixed-language text.

The letters of a word belong to a script by code point ranges; only languages learned with that script
are candidates for the word. Each candidate has a score by the word's character n-grams and the word
itself. Viterbi finds the labels of all words that are best together, where every change of language
costs SWITCH. The document's language is the one whose spans hold the most letters.

Learning counts n-grams in at most SAMPLE documents of each language, in the order of a digest of their
id, and never in held-out ones. One row per language and the sample's ids are sent to every task; labels
name languages, so both are small.

Defined results: null texts, and texts without a letter, are ``und`` with score 0. Words whose script no
language was learned with take any language; if that is all there is, the languages' shares among the
learned rows decide. Null ids are never learned from. Without a row to learn from, all is ``und``.
"""

from __future__ import annotations

import json
import math
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import held_out

#: Bounds of learning: documents of a language, n-grams kept of a language.
SAMPLE, NGRAMS = 400, 60_000
#: Cost of a change of language, and the least log-probability of a word in a candidate language, and in others.
SWITCH, LEAST, CLOSED = 6.0, -6.0, -30.0
#: A language is a candidate for scripts with this share of its letters.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"

#: First code points of ranges, in ascending order, and the script of each.
RANGES = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0B80, "Tamil"), (0x0C00, "Telugu"),
    (0x0E00, "Thai"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2C60, "Latin"), (0x3040, "Kana"), (0x3100, "Han"), (0xAC00, "Hangul"), (0xF900, "Han"),
    (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0x10000, "Han"),
)
_STARTS = [a for a, _ in RANGES]
_WORD = re.compile(r"[^\W\d_]+")


def script(letter: str) -> str:
    return RANGES[bisect_right(_STARTS, ord(letter)) - 1][1]


def ngrams(word: str) -> list[str]:
    """The word in spaces, cut in twos and threes, and the word itself."""
    w = f" {word} "
    return [w[i : i + 2] for i in range(len(w) - 1)] + [w[i : i + 3] for i in range(len(w) - 2)] + [f"={word}"]


def learn(rows: list[tuple[str, str]]) -> dict:
    """Log-probabilities of n-grams by language, scripts and shares, from (language, text)."""
    langs = sorted({lang for lang, _ in rows})
    counts = {lang: Counter() for lang in langs}
    scripts = {lang: Counter() for lang in langs}
    for lang, text in rows:
        for word, n in Counter(_WORD.findall(text.lower())).items():
            scripts[lang][script(word[0])] += n
            for gram in ngrams(word):
                counts[lang][gram] += n
    known = sorted({g for lang in langs for g, n in sorted(counts[lang].items(), key=lambda x: (-x[1], x[0]))[:NGRAMS] if n > 1})
    kinds = {g: len(g) if g[0] != "=" else 0 for g in known}
    totals = {lang: Counter() for lang in langs}
    for lang in langs:
        for g in known:
            totals[lang][kinds[g]] += counts[lang][g]
    # What a word of the list is worth beside its n-grams counts once; unseen words lose nothing by it.
    table = {
        g: [round(math.log((counts[lang][g] + 0.1) / (totals[lang][kinds[g]] + 0.1 * len(known))), 3) for lang in langs] for g in known
    }
    return {
        "langs": langs,
        "table": table,
        "scripts": [[s for s, n in scripts[lang].items() if n >= SCRIPT_SHARE * scripts[lang].total()] for lang in langs],
        "shares": [sum(x == lang for x, _ in rows) / len(rows) for lang in langs],
    }


class Words:
    """Scores of words, one row of ``matrix`` each; forgotten when there are too many."""

    def __init__(self, model: dict, most: int = 400_000):
        self.langs, self.most = model["langs"], most
        self.grams = {g: i for i, g in enumerate(model["table"])}
        none = len(self.grams)
        # The last row is for n-grams that are not in the table.
        self.values = np.array([*model["table"].values(), [0.0] * len(self.langs)]).reshape(none + 1, len(self.langs))
        known = sorted({x for own in model["scripts"] for x in own})
        self.open = {x: np.array([x in own for own in model["scripts"]]) for x in known}
        self.clear()

    def clear(self):
        self.ids: dict[str, int] = {}
        self.matrix = np.zeros((0, len(self.langs)))

    def scores(self, words: list[str]) -> np.ndarray:
        """Log-probabilities of each word's candidate languages; zeros if no language has its script."""
        get, none = self.grams.get, len(self.grams)
        grams = [[get(g, none) for g in ngrams(w)] for w in words]
        starts = np.cumsum([0, *map(len, grams)])[:-1]
        flat = np.fromiter((i for own in grams for i in own), dtype=np.int64)
        total = np.add.reduceat(self.values[flat], starts, axis=0)
        every = np.zeros(len(self.langs), dtype=bool)
        is_open = np.array([self.open.get(script(w[0]), every) for w in words])
        closed = ~is_open.any(axis=1)
        total = np.where(is_open, total, -np.inf)
        total[closed] = 0.0
        total -= total.max(axis=1, keepdims=True)
        total = np.maximum(total - np.log(np.exp(total).sum(axis=1, keepdims=True)), LEAST)
        total[~is_open] = CLOSED
        total[closed] = 0.0
        return total

    def of(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Rows of ``matrix`` of the words of each text."""
        if len(self.ids) > self.most:
            self.clear()
        ids = self.ids
        new = sorted(set().union(*texts).difference(ids))
        if new and self.langs:
            ids.update(zip(new, range(len(ids), len(ids) + len(new)), strict=True))
            self.matrix = np.concatenate([self.matrix, self.scores(new)])
        return [np.fromiter(map(ids.__getitem__, t), dtype=np.int64, count=len(t)) for t in texts]


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best labels of several texts at once: scores is (words, texts, languages), padded with zeros."""
    steps, texts, langs = scores.shape
    best = scores[0].copy()
    stays = np.empty((steps, texts, langs), dtype=bool)
    tops = np.empty((steps, texts), dtype=np.int64)
    final = best.copy()
    for t in range(1, steps):
        top = best.argmax(axis=1)
        changed = best[np.arange(texts), top][:, None] - switch
        stays[t] = best >= changed
        tops[t] = top
        best = np.maximum(best, changed) + scores[t]
        ended = lengths == t + 1
        final[ended] = best[ended]
    labels = np.zeros((steps, texts), dtype=np.int64)
    now = final.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        inside = lengths > t
        labels[t, inside] = now[inside]
        if t:
            stay = stays[t, np.arange(texts), now]
            now = np.where(inside & (lengths > t) & ~stay, tops[t], now)
    return labels


def spans(texts: list[str | None], words: Words) -> list:
    """Per text, its words, the place of each word's language, and the words' scores; None without a word."""
    found = [_WORD.findall((t or "").lower()) for t in texts]
    # Signs such as a raised 2 count as word characters, but a text of them alone has no letter.
    found = [w if any(c.isalpha() for x in w for c in x) else [] for w in found]
    out: list = [None] * len(texts)
    if not words.langs:
        return out
    ids = words.of(found)
    order = sorted((i for i in range(len(texts)) if found[i]), key=lambda i: len(found[i]))
    at = 0
    while at < len(order):
        # Texts of like length together, and no more than fit in a bounded array.
        end, least = at + 1, len(found[order[at]])
        while end < len(order) and end - at < 512 and len(found[order[end]]) <= 1.3 * least + 8 and (end - at) * len(found[order[end]]) < 500_000:
            end += 1
        group = order[at:end]
        lengths = np.array([len(found[i]) for i in group])
        scores = np.zeros((lengths.max(), len(group), len(words.langs)))
        for k, i in enumerate(group):
            scores[: lengths[k], k] = words.matrix[ids[i]]
        labels = viterbi(scores, lengths)
        for k, i in enumerate(group):
            out[i] = found[i], labels[: lengths[k], k], scores[: lengths[k], k]
        at = end
    return out


def predict(texts: list[str | None], words: Words, shares: list[float]) -> list[tuple[str, float]]:
    """Language and score: the share of letters in the language's spans."""
    out = []
    for got in spans(texts, words):
        if got is None:
            out.append((UNKNOWN, 0.0))
            continue
        found, labels, scores = got
        if not scores.any():
            best = int(np.argmax(shares))
            out.append((words.langs[best], float(shares[best])))
            continue
        letters = np.bincount(labels, weights=np.fromiter(map(len, found), dtype=float, count=len(found)), minlength=len(words.langs))
        best = int(letters.argmax())
        out.append((words.langs[best], float(letters[best] / letters.sum())))
    return out


def train(docs: DataFrame) -> dict:
    """The model, learned in one task from a bounded sample; the driver gets the n-gram table."""
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    digest = F.md5(F.col("doc_id").cast("string").cast("binary"))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)
    # The sample is drawn among ids; texts do not move but for those of the sample.
    known = known.select("doc_id", "lang", draw.alias("draw"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).select(F.col("lang").alias("l"), "n")
    # A share of each language that leaves about twice SAMPLE, then exactly SAMPLE in order of the draw.
    near = known.join(F.broadcast(sizes), F.col("l") == F.col("lang")).where(F.col("draw") * F.col("n") < 2 * SAMPLE)
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")
    drawn = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE)
    drawn = drawn.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct()
    texts = docs.select("doc_id", "lang", "text").where(F.col("text").isNotNull())
    rows = texts.join(F.broadcast(drawn), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang"))).select("lang", "text")

    def batches(parts):
        got = [(x, t) for part in parts for x, t in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True)]
        model = learn(sorted(got)) if got else {"langs": [], "table": {}, "scripts": [], "shares": []}
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(model)])], names=["model"])

    found = rows.repartition(1).mapInArrow(batches, "model string").first()
    return json.loads(found["model"]) if found else {"langs": [], "table": {}, "scripts": [], "shares": []}


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(parts):
        words = Words(shared.value)
        for part in parts:
            for at in range(0, part.num_rows, 2000):
                rows = part.slice(at, 2000)
                found = predict(rows.column("text").to_pylist(), words, shared.value["shares"])
                langs, scores = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(langs), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    rows = docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text").mapInArrow(batches, "doc_id bigint, lang_pred string, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
