"""Masked pseudo-likelihood: a window network predicts every word from both sides; the sum scores a text.

Words are split at white space and lower-cased in A-Z. All words of the corpus are counted. The network
works on classes of words: each of the most frequent words is a class, the others share classes by
frequency and length. Log P(word | sides) is log P(class | sides), from the network, plus log P(word |
class), from the exact counts. Words with more than one TAIL-th of all words are sent to every task (there
are fewer than TAIL of them whatever the corpus). All rarer words are of the lowest band, so their classes
need no counts; theirs are joined to the documents by word.

Every word is hashed and looked up once: texts become one byte a word (its class), stored with what needs no network
(the counted part of the score, words of the tail); both rounds of training and the scoring read those.

The network adds one row of a table per position in the window (SIDE words to the left and right; the
word itself is masked, the text's edges are a class of their own), a tanh layer and a softmax. It is
trained in ROUNDS rounds: every task goes over its own texts, each round at other words, so that every
word of every text is a target once, and the weights of all tasks are averaged by their numbers of windows. What is gathered
(counts of words, windows trained on, weights of tasks) grows with the corpus; what reaches the driver
does not (classes, fewer than TAIL words and one set of weights).

Defined results: null, empty and blank texts have no words, a sum of 0 and a null mean. Null ids and
repeated rows are documents like others. An empty corpus gives an empty result. Reruns over the same
files and splits agree but for the rounding of sums; other splits train other averages.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import per_text, stored
from tripmill.llm.shingles import SPACES, word_hashes

#: Classes: frequent words, then bands of frequency by bands of length, then the edge.
FREQUENT, BANDS, LENGTHS = 96, 6, 5
EDGE = FREQUENT + BANDS * LENGTHS
CLASSES = EDGE + 1
SIDE, HIDDEN = 3, 24
#: The lowest band begins where a word is at most one TAIL-th of all words: see ``bands``.
TAIL = 1 << 3 * (BANDS + 1)
#: Bits of a hash by which words above the tail are found.
BUCKETS = 18
#: Training: rounds over all texts, windows a step, step size.
ROUNDS, STEP_WINDOWS, RATE = 2, 1024, 0.1
#: Words scored at once; words counted before counts are sent on; words laid out at once.
BATCH, COUNTED, LAID = 4096, 2_000_000, 65_536

_SHAPES = [("table", (2 * SIDE, CLASSES, HIDDEN)), ("bias", (HIDDEN,)), ("out", (HIDDEN, CLASSES)), ("prior", (CLASSES,))]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True


def word_lengths(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8)))
    return edges[1::2] - edges[::2]


def bands(n: np.ndarray, total: float) -> np.ndarray:
    return np.clip(np.log2(total / n).astype(np.int64) // 3 - 2, 0, BANDS - 1)


class Words:
    """Classes of words, and log P(word | class)."""

    def __init__(self, frequent: np.ndarray, head: np.ndarray, lengths: np.ndarray, counts: np.ndarray, total: int):
        """``frequent``: hashes of the frequent words; ``head``: hashes of all words that are sent to the tasks."""
        order = np.argsort(head)
        self.head, counts = head[order], counts[order].astype(float)
        self.log_n = np.log(np.maximum(counts, 1.0))
        self.own = self.shared(bands(np.maximum(counts, 1.0), max(1.0, float(total))), lengths[order])
        if len(frequent):
            self.own[np.searchsorted(self.head, frequent)] = np.arange(len(frequent))
        self.total, self.sizes = total, np.ones(CLASSES)
        # Places by the hash's first bits, and how many steps from there at most.
        limits = np.arange((1 << BUCKETS) + 1, dtype=object) << 64 - BUCKETS
        self.starts = np.searchsorted(self.head, limits[:-1].astype(np.uint64)).astype(np.int32)
        self.most = int(np.diff(self.starts, append=len(self.head)).max())
        self.ended = np.append(self.head, np.uint64(2**64 - 1))

    @staticmethod
    def shared(band: np.ndarray | int, lengths: np.ndarray) -> np.ndarray:
        return FREQUENT + band * LENGTHS + np.clip(lengths // 3, 0, LENGTHS - 1)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Places in the head; -1 for words of the tail."""
        if not len(self.head):
            return np.full(len(hashes), -1)
        at = self.starts[hashes >> np.uint64(64 - BUCKETS)].astype(np.int64)
        for _ in range(self.most):
            at += self.ended[at] < hashes
        return np.where((self.ended[at] == hashes) & (at < len(self.head)), at, -1)

    def classes(self, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        tail = self.shared(BANDS - 1, lengths)
        return np.where(places < 0, tail, self.own[places]) if len(self.head) else tail

    def within(self, places: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log P(word | class), for words of the tail without their log n; one word is all of a frequent word's class."""
        log_n = np.where(places < 0, 0.0, self.log_n[places]) if len(self.head) else 0.0
        return np.where(classes < FREQUENT, 0.0, log_n - np.log(self.sizes[classes]))

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, places in the head and classes of a text's words."""
        hashes = word_hashes(text)
        places = self.places(hashes)
        return hashes, places, self.classes(places, word_lengths(text))


def initial(prior: np.ndarray) -> dict[str, np.ndarray]:
    """Small fixed weights; the output starts at the classes' shares."""
    rng = np.random.default_rng(0)
    net = {name: rng.normal(0, 0.1, shape).astype(np.float32) for name, shape in _SHAPES}
    net["prior"] = np.log(np.maximum(prior, 0.5) / max(1.0, prior.sum())).astype(np.float32)
    return net


def flat(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[name].ravel() for name, _ in _SHAPES]).astype(np.float32)


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _SHAPES:
        n = int(np.prod(shape))
        out[name] = values[at : at + n].reshape(shape).copy()
        at += n
    return out


def windows(classes: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Classes around the centres, (centres, 2 * SIDE); the centre itself is not in it."""
    padded = np.concatenate((np.full(SIDE, EDGE), classes, np.full(SIDE, EDGE)))
    steps = [k for k in range(2 * SIDE + 1) if k != SIDE]
    return padded[centres[:, None] + np.array(steps)]


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all words of all texts in order: classes around (one row a side), class, place in the text, number of the text."""
    edge = bytes([EDGE]) * SIDE
    data = np.frombuffer(edge + edge.join(texts) + edge, np.uint8)
    sizes = np.array(list(map(len, texts)), np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = place + np.repeat(np.cumsum(sizes + SIDE) - sizes, sizes)
    return np.stack([data[at + k] for k in range(-SIDE, SIDE + 1) if k]), data[at], place, owner


def _texts(parts, column: str):
    """Texts of a task's batches, so many at a time that they have LAID words or are one text."""
    held, size = [], 0
    for part in parts:
        for text in part.column(column):
            held.append(text.as_py())
            size += len(held[-1])
            if size >= LAID:
                yield held
                held, size = [], 0
    if held:
        yield held


def hidden_of(net: dict[str, np.ndarray], around: np.ndarray) -> np.ndarray:
    total = np.repeat(net["bias"][None], len(around), axis=0)
    for k in range(2 * SIDE):
        total += net["table"][k][around[:, k]]
    return np.tanh(total, out=total)


def outputs(net: dict[str, np.ndarray], hidden: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the hidden layer says of each class, before and without its prior; and the priors, as factors of at most 1."""
    logits = hidden @ net["out"]
    if np.abs(net["out"]).sum(axis=0).max() > 40:  # else no exponential overflows
        logits -= logits.max(axis=1, keepdims=True)
    return logits, np.exp(net["prior"] - net["prior"].max())


def log_probabilities(net: dict[str, np.ndarray], around: np.ndarray, centre: np.ndarray) -> np.ndarray:
    logits, prior = outputs(net, hidden_of(net, around))
    own = logits[np.arange(len(centre)), centre] + (net["prior"] - net["prior"].max())[centre]
    return own - np.log(np.exp(logits, out=logits) @ prior)


_COLUMNS = np.arange(HIDDEN)
_ROWS = np.arange(2 * SIDE) * CLASSES


def step(net: dict[str, np.ndarray], sums: dict[str, np.ndarray], around: np.ndarray, centre: np.ndarray) -> None:
    """One step of gradient descent, each weight at its own rate.

    Probabilities are never written out: with e the exponentials, w the priors and z = e w, they are e w / z, and the
    factors w and 1 / z are put on the small sides of the products.
    """
    hidden = hidden_of(net, around)
    e, prior = outputs(net, hidden)
    z = np.exp(e, out=e) @ prior
    e[np.arange(len(centre)), centre] -= z / prior[centre]
    scale = (1 / (z * len(centre)))[:, None]
    back = (e @ (net["out"] * prior).T) * ((1 - hidden * hidden) * scale)
    hidden *= scale
    # The table's rows take the sums of their windows, all sides and columns at once.
    cells = ((around + _ROWS)[:, :, None] * HIDDEN + _COLUMNS).ravel()
    table = np.bincount(cells, np.broadcast_to(back[:, None, :], (len(back), 2 * SIDE, HIDDEN)).ravel(), net["table"].size)
    slopes = {
        "out": (hidden.T @ e) * prior, "prior": (scale.T @ e)[0] * prior, "bias": back.sum(axis=0),
        "table": table.astype(np.float32).reshape(net["table"].shape),
    }
    for name, slope in slopes.items():
        held = sums[name]
        held += slope * slope
        rate = np.sqrt(held + np.float32(1e-6))
        net[name] -= np.divide(slope, rate, out=rate) * np.float32(RATE)


def word_counts(docs: DataFrame) -> DataFrame:
    """word (hash), length and n for every word of the corpus."""

    def batches(parts):
        def counted(held):
            values, first, n = np.unique(np.concatenate([h for h, _ in held]), return_index=True, return_counts=True)
            lengths = np.concatenate([x for _, x in held])[first]
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(lengths.astype(np.int32)), pa.array(n)], names=["word", "length", "n"])

        held, size = [], 0
        for part in parts:
            for text in part.column("text"):
                text = text.as_py() or ""
                held.append((word_hashes(text), word_lengths(text)))
                size += len(held[-1][0])
                if size >= COUNTED:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)

    rows = docs.select("text").mapInArrow(batches, "word bigint, length int, n bigint")
    return rows.groupBy("word").agg(F.min("length").alias("length"), F.sum("n").alias("n"))


def above_tail(counts: DataFrame, total: int) -> DataFrame:
    return counts.where(F.col("n") * TAIL > total)


def vocabulary(counts: DataFrame) -> Words:
    """From stored counts: the words above the tail and the sizes of classes reach the driver."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = counts.orderBy(F.col("n").desc(), "word").limit(FREQUENT).toArrow()
    head = pa.concat_tables([top, above_tail(counts, total).toArrow()])
    word, first = np.unique(head.column("word").to_numpy().view(np.uint64), return_index=True)
    lengths, n = (head.column(c).to_numpy()[first] for c in ("length", "n"))
    words = Words(top.column("word").to_numpy().view(np.uint64), word, lengths, n, total)
    shared = counts.sparkSession.sparkContext.broadcast(words)

    def batches(parts):
        for part in parts:
            places = shared.value.places(part.column("word").to_numpy().view(np.uint64))
            own = shared.value.classes(places, part.column("length").to_numpy())
            n = np.bincount(own, weights=part.column("n").to_numpy(), minlength=CLASSES).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(n)], names=["class", "n"])

    sizes = counts.mapInArrow(batches, "class bigint, n bigint").groupBy("class").agg(F.sum("n").alias("n")).collect()
    for r in sizes:
        words.sizes[r["class"]] = max(1.0, r["n"])
    return words


def targets(n: int, turn: int, rounds: int) -> np.ndarray:
    """The words of a text that a round trains on: together the rounds have each word once."""
    place = np.arange(n)
    return place[place % rounds == turn]


def encode(docs: DataFrame, words: Words) -> DataFrame:
    """Per document: doc_id, n_words, the class of each word as a byte, ``known`` = the sum of log P(word | class)
    without the log n of words of the tail, and those words."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def batches(parts):
        known = shared.value

        def one(text):
            hashes, places, classes = known.of(text or "")
            return len(classes), classes.astype(np.uint8).tobytes(), float(known.within(places, classes).sum()), hashes[places < 0].view(np.int64)

        yield from per_text(one, ["doc_id"], ["n_words", "classes", "known", "tail"])(parts)

    schema = "doc_id bigint, n_words bigint, classes binary, known double, tail array<bigint>"
    return docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text").mapInArrow(batches, schema)


def train(docs: DataFrame, words: Words, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    return train_encoded(encode(docs, words), words, rounds)


def train_encoded(encoded: DataFrame, words: Words, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Rounds of training in every task, averaged: in groups of groups of tasks first, then the groups' sums on the driver."""
    context, net = encoded.sparkSession.sparkContext, initial(words.sizes)
    for turn in range(rounds):
        shared_net = context.broadcast(flat(net))

        def batches(parts, turn=turn, shared_net=shared_net):
            own = shaped(shared_net.value)
            sums = {name: np.zeros(shape, dtype=np.float32) for name, shape in _SHAPES}
            around, centre, seen = np.empty((2 * SIDE, 0), np.uint8), np.empty(0, np.uint8), 0
            for texts in _texts(parts, "classes"):
                more, own_class, place, _ = laid_out(texts)
                chosen = place % rounds == turn
                around = np.concatenate((around, more[:, chosen]), axis=1)
                centre = np.concatenate((centre, own_class[chosen]))
                whole = len(centre) - len(centre) % STEP_WINDOWS
                for k in range(0, whole, STEP_WINDOWS):
                    step(own, sums, around[:, k : k + STEP_WINDOWS].T, centre[k : k + STEP_WINDOWS])
                around, centre, seen = around[:, whole:], centre[whole:], seen + whole
            if len(centre):
                step(own, sums, around.T, centre)
                seen += len(centre)
            if seen:
                weights = (flat(own).astype(float) * seen).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([weights])], names=["n", "weights"])

        def added(group):
            total = np.zeros(len(flat(initial(np.ones(CLASSES)))))
            for w in group.column("weights"):
                total += np.frombuffer(w.as_py(), np.float64)
            return pa.table({"n": [sum(group.column("n").to_pylist())], "weights": [total.tobytes()]})

        sums = encoded.select("classes").mapInArrow(batches, "n bigint, weights binary")
        for groups in (4096, 16):
            sums = sums.withColumn("part", F.pmod(F.xxhash64("n", "weights"), F.lit(groups)))
            sums = sums.groupBy("part").applyInArrow(added, "n bigint, weights binary")
        found = sums.collect()
        if not found:
            return net
        total = np.sum([np.frombuffer(r["weights"], np.float64) for r in found], axis=0)
        net = shaped((total / sum(r["n"] for r in found)).astype(np.float32))
    return net


def score(docs: DataFrame, words: Words, net: dict[str, np.ndarray], counts: DataFrame | None = None) -> DataFrame:
    return score_encoded(encode(docs, words), words, net, counts)


def score_encoded(encoded: DataFrame, words: Words, net: dict[str, np.ndarray], counts: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, pseudo_ll (sum of log-probabilities), mean_ll.

    ``counts``: the stored counts of words; without them, all words must be in the head of ``words``.
    """
    shared_net = encoded.sparkSession.sparkContext.broadcast(flat(net))

    def batches(parts):
        own = shaped(shared_net.value)
        for part in parts:
            totals = []
            for texts in _texts([part], "classes"):
                around, centre, _, owner = laid_out(texts)
                each = [log_probabilities(own, around[:, at : at + BATCH].T, centre[at : at + BATCH]) for at in range(0, len(centre), BATCH)]
                totals.append(np.bincount(owner, np.concatenate(each) if each else None, len(texts)))
            total = part.column("known").to_numpy() + (np.concatenate(totals) if totals else 0.0)
            columns = [part.column("doc_id"), part.column("n_words"), pa.array(total, pa.float64()), part.column("tail")]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "pseudo_ll", "tail"])

    rows = encoded.mapInArrow(batches, "doc_id bigint, n_words bigint, pseudo_ll double, tail array<bigint>")
    if counts is not None and not counts.where(f"n * {TAIL} <= {int(words.total)}").isEmpty():
        # Documents have no key of their own; the stored one stays as it is. Words seen once have a log n of 0.
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "lm-tail")
        seen = counts.where("n > 1").select("word", F.log("n").alias("log_n"))
        sums = rows.select("row", F.explode("tail").alias("word")).join(seen, "word").groupBy("row").agg(F.sum("log_n").alias("more"))
        rows = rows.join(sums, "row", "left").withColumn("pseudo_ll", F.expr("pseudo_ll + coalesce(more, 0D)"))
    return rows.selectExpr("doc_id", "n_words", "pseudo_ll", "CASE WHEN n_words > 0 THEN pseudo_ll / n_words END AS mean_ll")


def score_corpus(docs: DataFrame) -> DataFrame:
    counts = stored(word_counts(docs), "lm-words")
    words = vocabulary(counts)
    encoded = stored(encode(docs, words), "lm-classes")
    return score_encoded(encoded, words, train_encoded(encoded, words), counts)
