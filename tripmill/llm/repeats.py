"""Passages that repeat across documents, found by windows of doubling length, and cut from the later documents.

A window is ``width`` consecutive words. A word goes where a window that covers it also starts in a document
with a smaller id. Windows are judged on the input, not on what is left.

Lengths double up to ``width`` (13, 25, 50 words). A window stands, at each length, for itself through its
sub-window of that length with the smallest hash: equal windows have equal ones, whatever is around
them, so one name per run of windows is enough and no repeated window is missed. Names that two texts hold
survive; only windows with a surviving name go on to the next length, until none is left or the whole width is
reached, where names have 128 bits and every window left is named. Equal texts are one text
with the smallest of their ids: of its copies all goes, if they have a window at all.

Names move, texts do not, but for those that still hold a candidate after the first length. A name that a
large share of all texts hold is counted in the map tasks first and sent to every task (see ``join_groups``).

Defined results: null, empty and blank texts have no words, and the digest of the empty text. Texts of fewer
than ``width`` words lose nothing. A null id is larger than every other; two null ids, and repeated rows
with one id, take nothing from each other. Whole texts are used, whatever their length; a text and its names
are in the memory of one task. Only ``doc_id`` and ``text`` are read, so other columns cannot clash. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import join_groups, stored
from tripmill.llm.shingles import SPACES, mixed

WIDTH = 50
#: No length below this many words is tried: shorter runs repeat by chance.
SHORTEST = 12
#: Odd multipliers of the two polynomial hashes, and the words of the contract.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True
_EMPTY = hashlib.sha256(b"").hexdigest()


def lengths(width: int = WIDTH, shortest: int = SHORTEST) -> list[int]:
    """Ascending, each at most twice the one before, the last is the width."""
    out = [width]
    while (out[0] + 1) // 2 >= shortest:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def word_hashes(text: str) -> np.ndarray:
    """A hash per word, from its bytes unchanged."""
    data = np.frombuffer(text.encode(), np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    base = _BASES[0]
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mixed(data.astype(np.uint64) + np.uint64(1)) * _powers(base, max(0, len(data) - 1))[: len(data)], out=running[1:])
    return mixed((running[ends] - running[starts]) * _powers(pow(base, -1, 2**64), len(data))[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """A hash per run of ``length`` words, from differences of one running sum."""
    n = len(words) - length + 1
    if n < 1:
        return np.empty(0, np.uint64)
    base = _BASES[which]
    running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * _powers(base, len(words) - 1))))
    return mixed((running[length:] - running[:n]) * _powers(pow(base, -1, 2**64), n - 1))


def least_of(values: np.ndarray, run: int) -> np.ndarray:
    """The smallest of each ``run`` consecutive values."""
    n = len(values) - run + 1
    if n < 1:
        return values[:0]
    least, held = values, 1
    while held < run:
        step = min(held, run - held)
        least = np.minimum(least[:-step], least[step:])
        held += step
    return least[:n]


def names(words: np.ndarray, length: int, width: int) -> np.ndarray:
    """For each window of ``width`` words the smallest hash of its sub-windows of ``length`` words."""
    return least_of(window_hashes(words, length), width - length + 1)


def left(words: np.ndarray, length: int, width: int, survivors: np.ndarray) -> np.ndarray:
    """Which windows are candidates, given the names that survived at ``length``."""
    return np.isin(names(words, length, width), survivors)


def spans(flags: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Runs of words (from, to) that flagged windows cover."""
    cover = np.zeros(len(flags) + width, np.int64)
    at = np.flatnonzero(flags)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    inside = np.cumsum(cover) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def without(words: list[str], cuts: list[tuple[int, int]]) -> list[str]:
    kept, at = [], 0
    for a, b in cuts:
        kept += words[at:a]
        at = b
    return kept + words[at:]


def _rows(fn, keep: list[str], given: list[str], made: dict[str, pa.DataType]):
    """For ``mapInArrow``: the columns ``keep`` as they are, and what ``fn`` makes of the columns ``given``."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 200):
                rows = part.slice(at, 200)
                out = [fn(*values) for values in zip(*[rows.column(g).to_pylist() for g in given], strict=True)]
                columns = list(zip(*out, strict=True)) or [[] for _ in made]
                arrays = [pa.array(c, kind) for c, kind in zip(columns, made.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(k) for k in keep] + arrays, names=[*keep, *made])

    return batches


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _survivors(rows: DataFrame) -> DataFrame:
    """From (t, names) the names that two texts hold, per text: (t, names)."""
    rows = rows.select("t", F.explode("names").alias("name"))
    held = F.xxhash64("t")
    counts = rows.groupBy("name").agg(F.count("*").alias("n"), F.min(held).alias("a"), F.max(held).alias("b"))
    counts = stored(counts.where("a <> b").select("name", "n"), "repeat-names")
    return stored(join_groups(rows, counts, "name", "n").groupBy("t").agg(F.collect_set("name").alias("names")), "repeat-survivors")


def _hashed(text: str | None, names_of: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(text or ""), np.array(names_of or [], np.int64).view(np.uint64)


def report(docs: DataFrame, width: int = WIDTH, shortest: int = SHORTEST) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and ``cuts``, the spans of words removed."""
    steps, cut_type = lengths(width, shortest), "array<struct<from:int,to:int>>"

    def first(text):
        words = _WORDS.findall(text or "")
        found = np.unique(names(word_hashes(text or ""), steps[0], width))
        return len(words), hashlib.sha256(" ".join(words).encode()).hexdigest(), _signed(found)

    texts = docs.select("doc_id", "text", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("t"))
    kinds = {"n_words": pa.int64(), "whole": pa.string(), "names": pa.list_(pa.int64())}
    id_type = docs.schema["doc_id"].dataType.simpleString()
    seen = texts.mapInArrow(_rows(first, ["doc_id", "t"], ["text"], kinds), f"doc_id {id_type}, t binary, n_words long, whole string, names array<long>")
    seen = stored(seen, "repeat-texts")
    groups = seen.groupBy("t").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    groups = stored(groups, "repeat-groups")

    # Texts with a candidate move once; copies of a text are left to its first document.
    found = _survivors(seen.select("t", "names"))
    found = found.join(groups.select("t", "first_id"), "t").select(F.col("t").alias("c_t"), F.col("first_id"), "names")
    found = stored(found, "repeat-found")
    held = texts.join(found, (F.col("t") == F.col("c_t")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
    held = stored(held.select("t", "first_id", "text", "names"), "repeat-candidates")
    whole = held.select("t", "first_id", "text")

    for last, length in zip(steps, steps[1:], strict=False):
        if length == width:
            break

        def longer(text, survivors, last=last, length=length):
            words, old = _hashed(text, survivors)
            return (_signed(np.unique(names(words, length, width)[left(words, last, width, old)])),)

        named = held.mapInArrow(_rows(longer, ["t"], ["text", "names"], {"names": pa.list_(pa.int64())}), "t binary, names array<long>")
        named = stored(named, "repeat-longer")
        held = stored(whole.join(_survivors(named), "t"), "repeat-candidates")

    def full(text, survivors):
        words, old = _hashed(text, survivors)
        both = [window_hashes(words, width, which) for which in (0, 1)]
        if len(steps) > 1:
            both = [h[left(words, steps[-2], width, old)] for h in both]
        pairs = np.unique(np.stack(both, axis=1), axis=0)
        return (_signed(np.ascontiguousarray(pairs[:, 0])), _signed(np.ascontiguousarray(pairs[:, 1])))

    kinds = {"x": pa.list_(pa.int64()), "y": pa.list_(pa.int64())}
    rows = held.mapInArrow(_rows(full, ["t", "first_id"], ["text", "names"], kinds), f"t binary, first_id {id_type}, x array<long>, y array<long>")
    rows = stored(rows, "repeat-windows").select("t", "first_id", F.explode(F.arrays_zip("x", "y")).alias("name"))
    starts = rows.groupBy("name").agg(
        F.min("first_id").alias("least"), F.max("first_id").alias("most"), F.count("first_id").alias("ids"), F.count("*").alias("n")
    )
    starts = stored(starts.where("least < most OR (ids > 0 AND ids < n)").select("name", "least", "n"), "repeat-starts")
    later = join_groups(rows, starts, "name", "n").where("first_id > least OR first_id IS NULL")
    later = later.groupBy("t").agg(F.collect_list("name.x").alias("x"), F.collect_list("name.y").alias("y"))

    def cut(text, x, y):
        words = word_hashes(text or "")
        order = np.argsort(np.array(x, np.int64).view(np.uint64))
        x, y = (np.array(v, np.int64).view(np.uint64)[order] for v in (x, y))
        a, b = window_hashes(words, width, 0), window_hashes(words, width, 1)
        at = np.minimum(np.searchsorted(x, a), len(x) - 1)
        cuts = spans((x[at] == a) & (y[at] == b), width)
        kept = without(_WORDS.findall(text or ""), cuts)
        return [{"from": f, "to": t} for f, t in cuts], hashlib.sha256(" ".join(kept).encode()).hexdigest()

    kinds = {"cuts": pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])), "rest": pa.string()}
    parts = whole.dropDuplicates(["t"]).join(later, "t").mapInArrow(_rows(cut, ["t"], ["text", "x", "y"], kinds), f"t binary, cuts {cut_type}, rest string")

    groups = stored(groups.join(parts, "t", "left"), "repeat-cuts")
    rows = join_groups(seen.select("doc_id", "t", "n_words", "whole"), groups, "t", "copies")
    copy = F.expr(f"n_words >= {width} AND first_id IS NOT NULL AND (doc_id IS NULL OR doc_id > first_id)")
    everything = F.array(F.struct(F.lit(0).alias("from"), F.col("n_words").cast("int").alias("to")))
    first_row = F.expr("doc_id <=> first_id")
    cuts = F.when(copy, everything).when(first_row & F.col("cuts").isNotNull(), F.col("cuts")).otherwise(F.array().cast(cut_type))
    removed = F.aggregate(cuts, F.lit(0).cast("long"), lambda n, c: n + c["to"] - c["from"])
    sha = F.when(copy, F.lit(_EMPTY)).when(first_row, F.coalesce("rest", "whole")).otherwise(F.col("whole"))
    return rows.select("doc_id", "n_words", removed.alias("n_removed"), sha.alias("kept_sha256"), cuts.alias("cuts"), "t")


def clean(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents, all their columns as they were, but for the text of those that lose words: its kept words with one space between."""
    columns, text = docs.columns, F.col("text")
    found = report(docs, width).where("n_removed > 0").select("t", "cuts", F.col("doc_id").alias("id")).dropDuplicates(["t", "id"])
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("c_t"), F.col("doc_id").alias("c_id")
    )
    rows = rows.join(found, (F.col("t") == F.col("c_t")) & F.col("id").eqNullSafe(F.col("c_id")), "left")
    words = F.regexp_extract_all(F.col("row.text"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    kept = F.filter(words, lambda w, i: ~F.exists(F.col("cuts"), lambda c: (c["from"] <= i) & (i < c["to"])))
    new = F.when(F.col("cuts").isNull(), F.col("row.text")).otherwise(F.array_join(kept, " "))
    return rows.select(*[new.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in columns])


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM w, unnest(range(1, len(ws) - 48)) AS u(i)),
f AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS m FROM s) WHERE doc_id > m),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM f, unnest(range(50)) AS u(k)),
a AS (SELECT doc_id, i, ws[i] AS word FROM w, unnest(range(1, len(ws) + 1)) AS u(i)),
k AS (
  SELECT a.doc_id, count(*) AS n_kept, string_agg(a.word, ' ' ORDER BY a.i) AS kept
  FROM a LEFT JOIN c ON a.doc_id = c.doc_id AND a.i = c.i WHERE c.i IS NULL GROUP BY a.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""
