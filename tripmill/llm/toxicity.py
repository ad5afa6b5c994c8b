"""Toxicity by a weighted finite-state grammar over clauses, its word list and weights learned from labels.

A text is cut into clauses at sentence marks, line ends and semicolons. The words of a clause pass a
cascade of small transducers:

- the lexicon turns words to classes: INSULT (a learned word or stem), VERB and MODAL (of threats),
  TARGET, NOT, SAY, QUOTE or OTHER;
- the scope transducer marks what follows a negation, and what follows a verb of saying or stands in
  quotation marks;
- the threat transducer reads MODAL .. VERB .. TARGET as one threat, the target transducer tells whether
  a clause is aimed at someone.

A clause with an insult or a threat gets that weight in one of the contexts plain, aimed, negated or
reported; isolated words have no weight of their own. A logistic model of the contexts' sums gives the
score. Its coefficients are fitted like the word list, and kept near PRIOR, by which negation and reported
speech take weight away.

Learning reads at most SAMPLE labelled rows of each class, in the order of a digest of their id, and
never held-out rows. Only documents without a hit skip the grammar: their sums are 0.

Defined results: null and empty texts score as texts without a hit. Null ids are never learned from.
Rows with several labels count as toxic if one is. Null labels are no labels. Without labels of both
classes the word list is SEED and the coefficients are PRIOR.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import held_out, per_text

#: Bounds of learning: labelled rows of each class, words and stems in the list.
SAMPLE = 2500
LEXICON = 300
THRESHOLD = 0.7
#: A stem must show in this many toxic rows, and in this share of toxic rows per clean row.
SUPPORT, SUPPORT_SHARE, IMPURITY = 3, 0.004, 0.2
#: What a clean row with the entry takes from its gain, in toxic rows.
PENALTY = 10
STEMS = range(4, 11)
CELLS = 1 << 23
SEED = {"idiot": 4.0, "moron": 4.0, "scum": 4.0, "worthless": 3.0, "stupid": 3.0}

#: Word classes besides the insults, in four languages.
TARGETS = "you your u him her them du dich dir euch sie ihn ihr tu toi te vous lui elle usted ustedes vosotros él ella"
MODALS = "will ll gonna shall must werde werden wird vais va allons voy vamos va"
VERBS = "kill hurt destroy beat shoot stab burn strangle töten schlagen vernichten tuer frapper détruire matar golpear destruir"
NEGATIONS = "not never no without isn aren wasn don nicht nie kein keine ohne pas jamais sans ni nunca sin"
SAYINGS = "said says wrote called claimed quoted sagte sagt schrieb nannte dit disait écrit dijo dice escribió llamó"
CLASSES = {w: c for c, ws in (("TARGET", TARGETS), ("MODAL", MODALS), ("VERB", VERBS), ("NOT", NEGATIONS), ("SAY", SAYINGS)) for w in ws.split()}

CONTEXTS = ("plain", "aimed", "negated", "reported")
#: Coefficients before any label is seen: intercept and contexts.
PRIOR = np.array([-3.0, 6.0, 7.0, 2.0, 2.0])
THREAT = 3.0
#: A negation holds for so many words.
NEGATED_WORDS = 3

_WORD = re.compile(r'[^\W\d_]+|["“”«»„]')
_CLAUSE = re.compile(r"[.!?;\n]")


class Transducer:
    """States and arcs; a symbol without an arc stays in its state and gives its own name."""

    def __init__(self, start: str, arcs: dict[tuple[str, str], tuple[str, str | None]]):
        self.start, self.arcs = start, arcs

    def run(self, symbols: list[str]) -> list[str]:
        state, out = self.start, []
        for x in symbols:
            state, y = self.arcs.get((state, x)) or self.arcs.get((state, "*")) or (state, None)
            out.append(y or x)
        return out


def _scope() -> Transducer:
    """Marks symbols under a negation NOT: and in reported speech SAID:."""
    seen = ("INSULT", "VERB")
    arcs: dict = {("free", "NOT"): (f"not{NEGATED_WORDS}", None), ("free", "SAY"): ("said", None), ("free", "QUOTE"): ("quote", None)}
    for left in range(NEGATED_WORDS, 0, -1):
        here, after = f"not{left}", f"not{left - 1}" if left > 1 else "free"
        arcs |= {(here, "*"): (after, None), (here, "SAY"): ("said", None), (here, "QUOTE"): ("quote", None), (here, "NOT"): (f"not{NEGATED_WORDS}", None)}
        arcs |= {(here, x): (after, f"NOT:{x}") for x in seen}
    for x in seen:
        arcs[("said", x)], arcs[("quote", x)] = ("said", f"SAID:{x}"), ("quote", f"SAID:{x}")
    arcs[("quote", "QUOTE")] = ("free", None)
    return Transducer("free", arcs)


SCOPE = _scope()
THREATS = Transducer("0", {
    ("0", "MODAL"): ("modal", None), ("modal", "VERB"): ("verb", None), ("modal", "SAID:VERB"): ("said", None),
    ("modal", "NOT:VERB"): ("0", None), ("verb", "TARGET"): ("0", "THREAT"), ("said", "TARGET"): ("0", "SAID:THREAT"),
})
AIM = Transducer("0", {("0", "TARGET"): ("aimed", None), ("aimed", "INSULT"): ("aimed", "AIMED:INSULT"), ("aimed", "THREAT"): ("aimed", "AIMED:THREAT")})
_CONTEXT = {"": 0, "AIMED": 1, "NOT": 2, "SAID": 3}


def insult(word: str, lexicon: dict[str, float]) -> float:
    """Weight of the longest entry the word starts with; an entry ending in $ must be the whole word."""
    if word + "$" in lexicon:
        return lexicon[word + "$"]
    return next((lexicon[word[:k]] for k in range(len(word), 2, -1) if word[:k] in lexicon), 0.0)


def clause_weights(clause: str, lexicon: dict[str, float]) -> np.ndarray:
    """The clause's weight by context."""
    words = _WORD.findall(clause)
    weights = [insult(w, lexicon) for w in words]
    symbols = ["INSULT" if x else CLASSES.get(w) or ("OTHER" if w[0].isalpha() else "QUOTE") for w, x in zip(words, weights, strict=True)]
    out = np.zeros(len(CONTEXTS))
    for symbol, weight in zip(AIM.run(THREATS.run(SCOPE.run(symbols))), weights, strict=True):
        context, _, kind = symbol.rpartition(":")
        if kind in ("INSULT", "THREAT"):
            out[_CONTEXT[context]] += weight if kind == "INSULT" else THREAT
    return out


def finder(lexicon: dict[str, float]):
    """Automaton of the entries and of the verbs of threats: what a clause must hold to have a weight."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for entry in {x.rstrip("$") for x in lexicon} | set(VERBS.split()):
        machine.add_word(entry, len(entry))
    machine.make_automaton()
    return machine


def features(text: str | None, lexicon: dict[str, float], machine) -> np.ndarray:
    """Sums of the clauses' weights by context, from 0 towards 1."""
    text, sums, done = (text or "").lower(), np.zeros(len(CONTEXTS)), 0
    for end, length in machine.iter(text):
        at = end - length + 1
        if at < done or at and text[at - 1].isalpha():
            continue
        start = max((text.rfind(m, 0, at) for m in ".!?;\n"), default=-1) + 1
        stop = _CLAUSE.search(text, end + 1)
        done = stop.start() if stop else len(text)
        sums += clause_weights(text[start:done], lexicon)
    return 1 - np.exp(-sums)


def probability(x: np.ndarray, coefficients: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(coefficients[0] + x @ coefficients[1:])))


def entries(text: str) -> set[str]:
    """Whole words (with $) and stems of a text."""
    found = set()
    for w in set(re.findall(r"[^\W\d_]{3,}", text.lower())):
        found.add(w + "$")
        found.update(w[:k] for k in STEMS if k <= len(w))
    return found


def learn(rows: list[tuple[int, str]], ratio: float) -> dict:
    """Word list and coefficients from (label, text). ``ratio``: clean labels per toxic label overall.

    Entries are taken greedily, each for the toxic rows that no earlier entry explains: copies of one
    toxic text thus cannot make all its words entries.
    """
    toxic, clean = [t for y, t in rows if y], [t for y, t in rows if not y]
    if not toxic or not clean:
        return {"lexicon": SEED, "coefficients": PRIOR.tolist()}
    least = max(SUPPORT, math.ceil(SUPPORT_SHARE * len(toxic)))
    # Most entries are rare: cells by hash count no less than their entries, so only the others are kept.
    cells = np.zeros(CELLS, dtype=np.int32)
    for t in toxic:
        np.add.at(cells, [hash(e) % CELLS for e in entries(t)], 1)
    counts = Counter(e for t in toxic for e in entries(t) if cells[hash(e) % CELLS] >= least)
    counts = {e: n for e, n in counts.items() if n >= least}
    misses = Counter(e for t in clean for e in entries(t) if e in counts)
    allowed = {e for e, n in counts.items() if misses[e] / len(clean) <= IMPURITY * n / len(toxic)}
    holders: dict[str, set[int]] = {}
    for i, t in enumerate(toxic):
        for e in entries(t) & allowed:
            holders.setdefault(e, set()).add(i)
    lexicon, left, open_entries = {}, set(range(len(toxic))), set(holders)
    while open_entries and len(lexicon) < LEXICON:
        gains = {e: len(holders[e] & left) for e in open_entries}
        open_entries = {e for e, n in gains.items() if n >= least}
        if not open_entries:
            break
        best = max(open_entries, key=lambda e: (gains[e] - PENALTY * misses[e] * len(toxic) / len(clean), not e.endswith("$"), len(e), e))
        lexicon[best] = math.log((counts[best] + 0.5) / len(toxic)) - math.log((misses[best] + 0.5) / len(clean))
        left -= holders[best]
        open_entries.discard(best)
    # Entries that other entries explain already still name toxic rows: the frequent ones join the list.
    taken = set(lexicon)
    for e in sorted(holders, key=lambda e: (-len(holders[e]), -len(e), e)):
        if len(lexicon) >= LEXICON or len(holders[e]) < max(4 * least, 0.05 * len(toxic)):
            break
        if misses[e] == 0 and not any(e.startswith(k.rstrip("$")) or k.startswith(e.rstrip("$")) for k in taken):
            lexicon[e] = math.log((counts[e] + 0.5) / len(toxic)) - math.log(0.5 / len(clean))
            taken.add(e)
    lexicon = lexicon or SEED
    machine = finder(lexicon)
    y = np.array([float(bool(label)) for label, _ in rows])
    x = np.array([features(t, lexicon, machine) for _, t in rows])
    weight = np.where(y > 0, 1.0, ratio * len(toxic) / len(clean))
    return {"lexicon": lexicon, "coefficients": fit(x, y, weight).tolist()}


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, pull: float = 0.5) -> np.ndarray:
    """Weighted logistic regression by Newton steps, drawn to PRIOR."""
    design, c = np.c_[np.ones(len(x)), x], PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ c))
        slope = design.T @ (weight * (p - y)) + pull * (c - PRIOR)
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + pull * np.eye(len(c))
        step = np.linalg.solve(curve, slope)
        c = c - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return c


def sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """Rows (toxic, text) to learn from, at most SAMPLE of each class, and clean labels per toxic label."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") != 0, 1).otherwise(0)).alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(SAMPLE)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = chosen.select(F.col("doc_id").alias("s_id"), "toxic")
    # At most 2 * SAMPLE ids go to every task; the documents do not move.
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), F.col("doc_id") == F.col("s_id"))
    return rows.select("doc_id", "toxic", "text"), sizes.get(0, 0) / max(1, sizes.get(1, 0))


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """The model. One task reads the bounded sample; the driver gets the word list and coefficients."""
    rows, ratio = sample(docs, labels)

    def batches(parts):
        found = {}
        for part in parts:
            for key, label, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "toxic", "text")), strict=True):
                found[key] = (label, text)  # a repeated id is one row to learn from
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(learn([found[k] for k in sorted(found)], ratio))])], names=["model"])

    model = rows.repartition(1).sortWithinPartitions("doc_id", "text").mapInArrow(batches, "model string").first()
    return json.loads(model["model"]) if model else learn([], ratio)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    lexicon, coefficients = model["lexicon"], np.array(model["coefficients"])

    def batches(parts):
        machine = finder(lexicon)
        yield from per_text(lambda t: (float(probability(features(t, lexicon, machine), coefficients)),), ["doc_id"], ["score"])(parts)

    rows = docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text").mapInArrow(batches, "doc_id bigint, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep(docs: DataFrame, model: dict) -> DataFrame:
    """The documents not predicted toxic, with all their columns, in place."""
    lexicon, coefficients = model["lexicon"], np.array(model["coefficients"])

    def batches(parts):
        machine = finder(lexicon)
        for part in parts:
            scores = [float(probability(features(t.as_py(), lexicon, machine), coefficients)) for t in part.column("text")]
            yield part.filter(pa.array([s < THRESHOLD for s in scores], pa.bool_()))

    return docs.mapInArrow(batches, docs.schema)
