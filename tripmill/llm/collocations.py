"""Phrases that collocate: n-grams counted by weighted acyclic automata, scored by their weakest cut.

Texts are lower-cased in A-Z, split into pieces at ``.,;:!?`` and line breaks, and pieces into words at blanks and
tabs. Everything is per language; a null language is ``und``.

Every task builds count transducers of its texts, one per language and FLUSH characters: the sorted n-grams
are the paths of an automaton, whose arcs carry a word and the count of the phrase that ends there; states with
the same arcs are one state. The transducers are cut at phrases that divide all n-grams into ranges, moved by range,
and united: equal paths add their weights, and only phrases with LEAST occurrences stay. Candidates
are then composed with them: each range asks, once per distinct part, the ranges of the parts of its candidates for
their counts, and gets them back.

Ranges are cut in the order of words, so a frequent first word or pair of words is divided among
ranges like any other phrases. Which phrases cut the ranges comes from a few phrases of every transducer and has no
effect on results. A phrase reaches its range once per transducer, however often it occurs. A range with over
DECODED n-grams is cut again inside its task.

Defined results: null, empty and blank texts have no words. Ids play no part; repeated rows count again. Whole texts
are used, a text of any length being in the memory of one task. Ties in score go to the more frequent phrase, then to the
lesser one in the order of its bytes. Only ``text`` and ``lang`` are read, so other columns cannot clash. An empty
table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import stored

#: Phrases have 2 to LONGEST words and LEAST occurrences; the first TOP of each language are returned.
LONGEST, LEAST, TOP = 3, 10, 2000
#: A candidate inside a longer one goes if the longer one has SHARE percent of its occurrences.
SHARE = 50
#: What ends a piece, and what ends a word.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Characters of one transducer; phrases it names for the cuts; ranges; n-grams a task holds at once.
FLUSH, NAMED, RANGES, DECODED = 6_000_000, 64, 100_000, 8_000_000

_KIND = np.zeros(256, np.int8)
_KIND[list(BLANKS)], _KIND[list(ENDS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """All words in order, and for each the number of its piece."""
    data = _LOWER[np.frombuffer("\n".join(texts).encode(), np.uint8)]
    kind = _KIND[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], kind == 0, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    pieces = np.cumsum(kind == 2)[starts]
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[kind == 0].tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), pieces


def _ranked(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words in the order of their bytes, and the place of each word among them."""
    coded = words.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), rank[coded.indices.to_numpy()] if len(words) else rank


class Counts:
    """The n-grams of a transducer as levels: entry i of level k ends a phrase of k + 1 words.

    ``parents[k][i]`` is the entry of the phrase without its last word, ``labels[k][i]`` that word, ``weights[k][i]`` the
    count; 0 where the phrase only leads to others. Entries are sorted, so those below a parent are consecutive.
    """

    def __init__(self, vocabulary: pa.Array, parents: list, labels: list, weights: list):
        self.vocabulary, self.parents, self.labels, self.weights = vocabulary, parents, labels, weights

    @classmethod
    def of(cls, texts: list[str], longest: int = LONGEST) -> Counts:
        words, pieces = words_of(texts)
        vocabulary, ids = _ranked(words)
        n = len(ids)
        parents, labels, weights = [np.zeros(len(vocabulary), np.int64)], [np.arange(len(vocabulary))], [np.bincount(ids, minlength=len(vocabulary))]
        at, state = np.arange(n), ids
        for k in range(1, longest):
            inside = at + k < n
            at, state = at[inside], state[inside]
            inside = pieces[at] == pieces[at + k]
            at, state = at[inside], state[inside]
            keys, state, count = np.unique(state << 32 | ids[at + k], return_inverse=True, return_counts=True)
            parents.append(keys >> 32)
            labels.append(keys & 0xFFFFFFFF)
            weights.append(count)
        return cls(vocabulary, parents, labels, weights)

    @classmethod
    def union(cls, parts: list[Counts]) -> Counts:
        """All paths of all parts; weights of equal paths are added."""
        words = pa.concat_arrays([p.vocabulary for p in parts])
        vocabulary, rank = _ranked(words)
        starts = np.cumsum([0, *(len(p.vocabulary) for p in parts)])
        ranks = [rank[a:b] for a, b in zip(starts, starts[1:], strict=False)]
        parents, labels, weights, states = [], [], [], [np.zeros(1, np.int64)] * len(parts)
        for k in range(len(parts[0].parents)):
            mine = [s[p.parents[k]] << 32 | r[p.labels[k]] for p, r, s in zip(parts, ranks, states, strict=True)]
            keys, place = np.unique(np.concatenate(mine), return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, place, np.concatenate([p.weights[k] for p in parts]))
            parents.append(keys >> 32)
            labels.append(keys & 0xFFFFFFFF)
            weights.append(total)
            cuts = np.cumsum([0, *(len(m) for m in mine)])
            states = [place[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return cls(vocabulary, parents, labels, weights)

    def size(self) -> int:
        return sum(map(len, self.parents))

    def phrase(self, level: int, entry: int) -> tuple[bytes, ...]:
        out: tuple[bytes, ...] = ()
        for k in range(level, -1, -1):
            out = (self.vocabulary[int(self.labels[k][entry])].as_py(), *out)
            entry = self.parents[k][entry]
        return out

    def before(self, bound: tuple[bytes, ...]) -> list[int]:
        """How many entries of each level are less than the phrase ``bound``."""
        out, lo, hi, exact = [], 0, len(self.parents[0]), True
        vocabulary = _Sorted(self.vocabulary)
        for k in range(len(self.parents)):
            if k:  # entries below those of the level above that are less, then those below the bound's own path
                lo = int(np.searchsorted(self.parents[k], path if exact else out[-1]))  # noqa: F821
                hi = int(np.searchsorted(self.parents[k], path, "right")) if exact else lo  # noqa: F821
            if exact and k < len(bound):
                word = vocabulary.place(bound[k])
                here = lo + int(np.searchsorted(self.labels[k][lo:hi], word))
                path = here
                exact = here < hi and word < len(self.vocabulary) and int(self.labels[k][here]) == word and vocabulary.word(word) == bound[k]
                out.append(here + (1 if exact and k + 1 < len(bound) else 0))
            elif exact:  # the bound ends above this level: what lies below it is not less
                out.append(lo)
                exact = False
            else:
                out.append(lo)
        return out

    def between(self, lo: list[int], hi: list[int]) -> Counts | None:
        """The entries from ``lo`` to ``hi`` of each level, and the paths that lead to them with weight 0."""
        if all(a >= b for a, b in zip(lo, hi, strict=True)):
            return None
        first = list(lo)
        for k in range(len(lo) - 1, 0, -1):
            if first[k] < hi[k]:
                first[k - 1] = min(first[k - 1], int(self.parents[k][first[k]]))
        ends = [max(a, b) for a, b in zip(first, hi, strict=True)]
        parents, labels, weights = [], [], []
        for k, (a, b) in enumerate(zip(first, ends, strict=True)):
            parents.append(self.parents[k][a:b] - (first[k - 1] if k else 0))
            labels.append(self.labels[k][a:b])
            weights.append(np.where(np.arange(a, b) < lo[k], 0, self.weights[k][a:b]))
        used, place = np.unique(np.concatenate(labels), return_inverse=True)
        cuts = np.cumsum([0, *map(len, labels)])
        labels = [place[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return Counts(self.vocabulary.take(pa.array(used)), parents, labels, weights)

    def cut(self, bounds: list[tuple[bytes, ...]]) -> Iterator[tuple[int, Counts]]:
        """The parts between consecutive bounds that are not empty, with their numbers; part 0 is before the first bound."""
        lo = [0] * len(self.parents)
        for number, bound in enumerate([*bounds, None]):
            hi = list(map(len, self.parents)) if bound is None else self.before(bound)
            part = self.between(lo, hi)
            if part is not None:
                yield number, part
            lo = hi

    def frequent(self, least: int) -> Counts:
        """Paths to phrases that occur ``least`` times; other weights become 0, other entries go."""
        keep = [w >= least for w in self.weights]
        for k in range(len(keep) - 1, 0, -1):
            keep[k - 1][self.parents[k][keep[k]]] = True
        parents, labels, weights = [], [], []
        for k, chosen in enumerate(keep):
            up = self.parents[k][chosen]
            parents.append(np.cumsum(keep[k - 1])[up] - 1 if k else up)
            labels.append(self.labels[k][chosen])
            weights.append(np.where(self.weights[k] >= least, self.weights[k], 0)[chosen])
        return Counts(self.vocabulary, parents, labels, weights)

    def phrases(self) -> Iterator[tuple[tuple[bytes, ...], int]]:
        """All phrases with a weight."""
        words, above = self.vocabulary.to_pylist(), [()]
        for k in range(len(self.parents)):
            above = [(*above[p], words[w]) for p, w in zip(self.parents[k].tolist(), self.labels[k].tolist(), strict=True)]
            yield from ((phrase, n) for phrase, n in zip(above, self.weights[k].tolist(), strict=True) if n)

    def sampled(self, n: int) -> list[tuple[bytes, ...]]:
        """Up to ``n`` phrases, evenly spaced among those of the fullest level."""
        level = max(range(len(self.parents)), key=lambda k: len(self.parents[k]))
        held = len(self.parents[level])
        return [self.phrase(level, int(i)) for i in np.unique(np.linspace(0, held - 1, min(n, held)).astype(np.int64))] if held else []

    def to_bytes(self) -> bytes:
        """The automaton: per depth the distinct states' arcs, states with the same arcs being one.

        From the deepest up: an entry's state is its list of arcs (word, weight, state below). Lists of up to
        SHARED arcs are compared whole; longer ones hardly ever repeat and are states of their own.
        """
        below, tables = None, []
        for k in range(len(self.parents) - 1, -1, -1):
            arcs = np.stack([self.labels[k], self.weights[k], below if below is not None else np.zeros(len(self.labels[k]), np.int64)], axis=1)
            n_states = len(self.parents[k - 1]) if k else 1
            starts = np.searchsorted(self.parents[k], np.arange(n_states + 1))
            size = np.diff(starts)
            state, kept, number = np.empty(n_states, np.int64), [], 0
            for held in np.unique(size):
                members = np.flatnonzero(size == held)
                lists = arcs[(starts[members][:, None] + np.arange(held)).ravel()].reshape(len(members), held * 3)
                if held <= SHARED:
                    lists, same = _distinct_rows(lists)
                    state[members] = number + same
                else:
                    state[members] = number + np.arange(len(members))
                kept.append((int(held), lists))
                number += len(lists)
            sizes = np.concatenate([np.full(len(lists), held) for held, lists in kept]) if kept else np.zeros(0)
            tables.append((sizes.astype(np.int64), np.concatenate([lists.reshape(-1, 3) for _, lists in kept]) if kept else np.zeros((0, 3), np.int64)))
            below = state
        out = [np.array([len(self.parents), int(below[0])], np.int64)]
        for sizes, arcs in reversed(tables):
            out += [np.array([len(sizes), len(arcs)], np.int64), sizes, arcs.T.ravel()]
        sink = pa.BufferOutputStream()
        text = self.vocabulary.cast(pa.large_binary())
        with pa.ipc.new_stream(sink, pa.schema([("w", pa.large_binary())])) as stream:
            stream.write_batch(pa.RecordBatch.from_arrays([text], names=["w"]))
        return b"".join([_packed(_bytes_of(out)), _packed(sink.getvalue().to_pybytes())])

    @classmethod
    def from_bytes(cls, data: bytes) -> Counts:
        numbers, rest = _unpacked(data)
        numbers, (text, _) = _numbers(numbers), _unpacked(rest)
        vocabulary = pa.ipc.open_stream(text).read_all().column("w").combine_chunks()
        if isinstance(vocabulary, pa.ChunkedArray):
            vocabulary = pa.concat_arrays(vocabulary.chunks) if vocabulary.chunks else pa.array([], pa.large_binary())
        depth, root, at = int(numbers[0]), int(numbers[1]), 2
        states, parents, labels, weights = np.array([root]), [], [], []
        for _ in range(depth):
            n_sizes, n_arcs = int(numbers[at]), int(numbers[at + 1])
            sizes = numbers[at + 2 : at + 2 + n_sizes]
            arcs = numbers[at + 2 + n_sizes : at + 2 + n_sizes + 3 * n_arcs].reshape(3, n_arcs)
            at += 2 + n_sizes + 3 * n_arcs
            starts = np.concatenate(([0], np.cumsum(sizes)))
            each = sizes[states]
            up = np.repeat(np.arange(len(states)), each)
            where = np.arange(len(up)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(starts[states], each)
            parents.append(up)
            labels.append(arcs[0][where])
            weights.append(arcs[1][where])
            states = arcs[2][where]
        return cls(vocabulary, parents, labels, weights)


#: States with at most so many arcs are compared with all others of their depth.
SHARED = 4


class _Sorted:
    """Places of words in a sorted array of them."""

    def __init__(self, words: pa.Array):
        self.words = words

    def word(self, at: int) -> bytes:
        return self.words[at].as_py()

    def place(self, word: bytes) -> int:
        lo, hi = 0, len(self.words)
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if self.word(mid) < word else (lo, mid)
        return lo


def _distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``np.unique`` by rows, by ranking one column after the other."""
    if not rows.shape[1] or not len(rows):
        return rows[:1], np.zeros(len(rows), np.int64)
    key = np.zeros(len(rows), np.int64)
    for column in rows.T:
        if column.any():
            _, value = np.unique(column, return_inverse=True)
            _, key = np.unique(key << 32 | value, return_inverse=True)
    _, first = np.unique(key, return_index=True)
    return rows[first], key


def _bytes_of(arrays: list[np.ndarray]) -> bytes:
    """Numbers by significance of their bytes, so that small ones compress well."""
    values = np.concatenate(arrays).astype("<i8")
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _packed(data: bytes) -> bytes:
    small = pa.compress(data, codec="zstd", asbytes=True)
    return len(data).to_bytes(8, "little") + len(small).to_bytes(8, "little") + small


def _unpacked(data: bytes) -> tuple[bytes, bytes]:
    n, m = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little")
    return pa.decompress(data[16 : 16 + m], n, codec="zstd", asbytes=True), data[16 + m :]


def _flushes(parts: Iterator[pa.RecordBatch], flush: int) -> Iterator[tuple[str, Counts]]:
    """Transducers of the task's texts: of a language, when the texts held together pass ``flush`` characters, and at the end."""
    held: dict[str, list[str]] = {}
    sizes: dict[str, int] = {}
    for part in parts:
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
            if text:
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sum(sizes.values()) > flush:
                    full = max(sizes, key=lambda x: sizes[x])
                    del sizes[full]
                    yield full, Counts.of(held.pop(full))
    for lang in sorted(held):
        yield lang, Counts.of(held[lang])


def _route(bounds: list[tuple[str, tuple[bytes, ...]]], lang: str, phrase: tuple[bytes, ...]) -> int:
    """The number of the range of a phrase: how many bounds are not above it."""
    return bisect_right(bounds, (lang.encode(), phrase), key=lambda b: (b[0].encode(), b[1]))


def _bounds(docs: DataFrame, flush: int) -> list[tuple[str, tuple[bytes, ...]]]:
    """Phrases that divide all n-grams into ranges, about one range per transducer: at most RANGES numbers of phrases reach the driver."""

    def named(parts):
        for lang, counts in _flushes(parts, flush):
            found = counts.sampled(NAMED)
            columns = [[lang] * len(found), [[w.decode() for w in p] for p in found]]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.list_(pa.string()))], names=["lang", "phrase"])

    found = stored(docs.mapInArrow(named, "lang string, phrase array<string>"), "phrase-samples")
    ranges = max(1, min(RANGES, found.count() // NAMED))
    place = found.repartitionByRange(ranges, "lang", "phrase").withColumn("part", F.spark_partition_id())
    first = place.groupBy("part").agg(F.min(F.struct("lang", "phrase")).alias("b")).collect()
    bounds = [(r["b"]["lang"], tuple(w.encode() for w in r["b"]["phrase"])) for r in first]
    return sorted(bounds, key=lambda b: (b[0].encode(), b[1]))


def _blobs(bounds, flush: int):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, counts in _flushes(parts, flush):
            mine = [(i, b[1]) for i, b in enumerate(bounds) if b[0] == lang]
            before = sum(b[0].encode() < lang.encode() for b in bounds)
            for number, part in counts.cut([b for _, b in mine]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([before + number], pa.int32()), pa.array([lang]), pa.array([part.size()], pa.int64()), pa.array([part.to_bytes()], pa.binary())],
                    names=["range", "lang", "size", "data"],
                )

    return batches


def _united(blobs: list[bytes], sizes: list[int], least: int) -> tuple[Counts, int]:
    """The frequent phrases of all blobs, and how many words they count; decoded in parts if they are many."""
    times = -(-sum(sizes) // DECODED)
    if times <= 1 or len(blobs) < 2:
        whole = Counts.union([Counts.from_bytes(b) for b in blobs])
        return whole.frequent(least), int(whole.weights[0].sum())
    cuts = sorted({p for b in blobs for p in Counts.from_bytes(b).sampled(NAMED)})
    cuts = [cuts[i * len(cuts) // times] for i in range(1, times)]
    pieces: dict[int, list[bytes]] = {}
    for b in blobs:
        for number, piece in Counts.from_bytes(b).cut(cuts):
            pieces.setdefault(number, []).append(piece.to_bytes())
    done, words = [], 0
    for number in sorted(pieces):
        whole = Counts.union([Counts.from_bytes(b) for b in pieces.pop(number)])
        words += int(whole.weights[0].sum())
        done.append(whole.frequent(least))
    return Counts.union(done), words


def _unite(least: int):
    def group(key, rows):
        counts, words = _united(rows.column("data").to_pylist(), rows.column("size").to_pylist(), least)
        arrays = [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()]), pa.array([words], pa.int64()), pa.array([counts.to_bytes()], pa.binary())]
        return pa.Table.from_arrays(arrays, names=["range", "lang", "words", "data"])

    return group


def _parts(phrase: tuple[bytes, ...]) -> set[tuple[bytes, ...]]:
    n = len(phrase)
    return {phrase[i:j] for i in range(n) for j in range(i + 1, n + 1) if j - i < n}


def _joined(phrase: tuple[bytes, ...]) -> str:
    return b" ".join(phrase).decode()


def _ask(bounds):
    """The distinct parts of a range's candidates, with the range that knows each."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                wanted: set[tuple[bytes, ...]] = set()
                for phrase, _ in Counts.from_bytes(row["data"]).phrases():
                    if len(phrase) > 1:
                        wanted |= _parts(phrase)
                lang, asked = row["lang"], sorted(wanted)
                columns = [[_route(bounds, lang, p) for p in asked], [lang] * len(asked), [row["range"]] * len(asked), [_joined(p) for p in asked]]
                kinds = [pa.int32(), pa.string(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["range", "lang", "asks", "part"])

    return batches


def _answer(asked, held):
    """The transducer of a range, composed with the parts that others ask for."""
    known = {_joined(p): n for blob in held.column("data").to_pylist() for p, n in Counts.from_bytes(blob).phrases()}
    f = pa.array([known.get(p, 0) for p in asked.column("part").to_pylist()], pa.int64())
    return pa.Table.from_arrays([asked.column("asks"), asked.column("lang"), asked.column("part"), f], names=["range", "lang", "part", "f"])


def scored(phrase: tuple[str, ...], f: dict[str, int]) -> tuple[int, int, int]:
    """score, l and r of the lowest-scoring cut; of equal ones the first."""
    a = f[" ".join(phrase)]
    cuts = []
    for k in range(1, len(phrase)):
        left, rest = f[" ".join(phrase[:k])], f[" ".join(phrase[k:])]
        cuts.append((1_000_000 * a * a // (left * rest), k, left, rest))
    score, _, left, rest = min(cuts)
    return score, left, rest


def _score(held, answers):
    """Candidates of a range with their scores, and the shorter candidates that each of them stands for."""
    f = dict(zip(answers.column("part").to_pylist(), answers.column("f").to_pylist(), strict=True))
    rows = []
    for lang, blob in zip(held.column("lang").to_pylist(), held.column("data").to_pylist(), strict=True):
        found = [(tuple(w.decode() for w in p), n) for p, n in Counts.from_bytes(blob).phrases() if len(p) > 1]
        f |= {" ".join(p): n for p, n in found}
        for phrase, a in found:
            score, left, rest = scored(phrase, f)
            inner = [" ".join(phrase[i:j]) for i in range(len(phrase)) for j in range(i + 2, len(phrase) + 1) if j - i < len(phrase)]
            rows.append((lang, " ".join(phrase), a, left, rest, score, sorted({p for p in inner if 100 * a >= SHARE * f[p]})))
    kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.list_(pa.string())]
    columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "phrase", "a", "l", "r", "score", "covers"])


def mine(docs: DataFrame, least: int = LEAST, flush: int = FLUSH) -> DataFrame:
    """All candidates that stay: lang, phrase, a, l, r, n, score."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    bounds = _bounds(texts, flush)
    blobs = texts.mapInArrow(_blobs(bounds, flush), "range int, lang string, size long, data binary")
    held = blobs.groupBy("range", "lang").applyInArrow(_unite(least), "range int, lang string, words long, data binary")
    held = stored(held, "phrase-counts")
    asked = held.select("range", "lang", "data").mapInArrow(_ask(bounds), "range int, lang string, asks int, part string")
    data = held.select("range", "lang", "data")
    answers = asked.groupBy("range", "lang").cogroup(data.groupBy("range", "lang")).applyInArrow(_answer, "range int, lang string, part string, f long")
    answers = stored(answers, "phrase-parts")
    schema = "lang string, phrase string, a long, l long, r long, score long, covers array<string>"
    found = stored(data.groupBy("range", "lang").cogroup(answers.groupBy("range", "lang")).applyInArrow(_score, schema), "phrase-scores")
    covered = found.select("lang", F.explode("covers").alias("phrase")).distinct()
    total = held.groupBy("lang").agg(F.sum("words").alias("n"))
    return found.drop("covers").join(covered, ["lang", "phrase"], "left_anti").join(total, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def top(found: DataFrame, first: int = TOP) -> DataFrame:
    """The first of each language, ranked: first within parts of a language, then among what is left of all parts."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(256))).orderBy(*order)
    rows = found.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= first)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return rows.where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, ws[i:i + k - 1] AS parts
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM (SELECT *, unnest([1, 2, 3]) AS k FROM w))),
c AS MATERIALIZED (
  SELECT lang, k, array_to_string(parts, ' ') AS phrase, string_split(array_to_string(parts, ' '), ' ') AS parts, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
k AS MATERIALIZED (
  SELECT lang, phrase, k, f AS a, cut, array_to_string(parts[1:cut], ' ') AS head, array_to_string(parts[cut + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c WHERE k > 1 AND f >= 10)),
s AS MATERIALIZED (
  SELECT k.lang, k.phrase, k.k, k.a, k.cut, x.f AS l, y.f AS r, (1000000::HUGEINT * k.a * k.a // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM k JOIN c AS x ON x.lang = k.lang AND x.phrase = k.head JOIN c AS y ON y.lang = k.lang AND y.phrase = k.rest),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM s) WHERE o = 1),
d AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, array_to_string(parts[i:i + 1], ' ') AS phrase, f FROM (SELECT *, unnest([1, 2]) AS i FROM c WHERE k = 3 AND f >= 10))
  GROUP BY lang, phrase),
t AS (
  SELECT b.* FROM b LEFT JOIN d ON d.lang = b.lang AND d.phrase = b.phrase AND b.k = 2
  WHERE d.longer IS NULL OR 100 * d.longer < 50 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT t.lang, row_number() OVER (PARTITION BY t.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM t JOIN n ON t.lang = n.lang) WHERE rank <= 2000
"""
