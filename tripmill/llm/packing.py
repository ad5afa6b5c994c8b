"""Best-fit packing of tokenised documents into sequences of a fixed length.

A document is its token ids and an end id; only documents longer than a sequence are cut, into whole
sequences after a first piece with the rest. Pieces are sorted by length and packed longest first, each
into the sequence with the smallest gap that still holds it. All pieces of one length move at once:

1. the gaps are swept in ascending order from that length on, and each gap takes one piece;
2. a piece's rank among its length says which of the gaps is its own, so no two want the same;
3. the gaps shrink, and the sweep is repeated until no gap holds the length; the other pieces open
   new sequences.

Lengths are integers up to the capacity, so sorted pieces and sorted gaps are runs of equal values. The
sweep works on the runs: their number follows from the capacity (at most capacity ** 2 / 2), not from the
number of documents, and only counts by length reach the driver. Ranks and places of the pieces are
computed by Spark, in slices of bounded size, as any length may be that of most pieces.

Defined results: null and empty texts are the end id alone. Whole texts are encoded, runs of a million blanks
included; one text and its ids are held at a time. Rows with null or repeated ids are pieces like others; which of
equal pieces goes where is open, their places are not. An empty table gives an empty result. Extra columns of any name are not read.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmill.llm.common import stored

CAPACITY = 1024
END_ID = 2
#: About so many pieces are ranked by one task at a time.
SLICE_ROWS = 20_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def vocabulary(path: str) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level BPE file, whose characters stand for bytes one to one."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)
    special = {t["content"] for t in tokens.get("added_tokens", ())}
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    return {bytes(byte[c] for c in t): i for t, i in tokens["model"]["vocab"].items() if t not in special}


def added_tokens(path: str) -> dict[str, int]:
    """Texts and ids of the file's added tokens, which are found in a text before all else."""
    with open(path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file).get("added_tokens", ())}


def encoder(path: str, pattern: str):
    """The file's tokenizer. Its ids are the ranks of its merges, so tiktoken gives the same, faster."""
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocabulary(path), special_tokens=added_tokens(path))


def whole_encoder(path: str, pattern: str):
    """From a text to the ids that the file's tokenizer gives it, added tokens included.

    tiktoken refuses a text with a run of about a million blanks; such texts go to the slower library.
    """
    quick = encoder(path, pattern)
    slow = cache(partial(Tokenizer.from_file, path))

    def encode(text: str) -> list[int]:
        try:
            return quick.encode(text, allowed_special="all")
        except ValueError:
            return slow().encode(text, add_special_tokens=False).ids

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter than the capacity."""
    first = n % capacity
    bounds = ([0] if first else []) + list(range(first, n + 1, capacity))
    return [(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def pieces(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """The pieces of every document; with ``ids`` also their token ids. ``tokenizer`` is a file's path."""

    def batches(parts):
        encode = whole_encoder(tokenizer, pattern)
        for part in parts:
            for at in range(0, part.num_rows, 500):
                rows = part.slice(at, 500)
                owner, out = [], []
                for i, text in enumerate(rows.column("text")):
                    tokens = np.array([*encode(text.as_py() or ""), END_ID], dtype="<u4")
                    for k, (start, length) in enumerate(cut(len(tokens), capacity)):
                        own = tokens[start : start + length]
                        owner.append(i)
                        out.append((k, start, length, zlib.crc32(own.tobytes())) + ((own.astype("<i4"),) if ids else ()))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=False)]
                if out:
                    yield pa.RecordBatch.from_arrays([rows.column("doc_id").take(pa.array(owner)), *columns], names=schema_names)

    schema = PIECES + (", ids array<int>" if ids else "")
    schema_names = [c.split()[0] for c in schema.split(", ")]
    return docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text").mapInArrow(batches, schema)


def sweeps(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, pieces, first sequence, offset): consecutive ranks go to consecutive sequences."""
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of sequences with that gap
    placed, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left and (fits := sorted(g for g in gaps if g >= length and gaps[g])):
            shrunk: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for gap in fits:
                while left and gaps[gap]:
                    first, n = gaps[gap].pop()
                    took = min(n, left)
                    placed.append((length, rank, took, first, capacity - gap))
                    shrunk[gap - length].append((first, took))
                    if took < n:
                        gaps[gap].append((first + took, n - took))
                    rank, left = rank + took, left - took
            for gap, runs in shrunk.items():
                gaps[gap] += runs
        each = capacity // length
        for n, held in ((left // each, each), (1, left % each)):
            if n and held:
                for k in range(held):
                    placed.append((length, rank, n, opened, k * length))
                    rank += n
                gaps[capacity - held * length].append((opened, n))
                opened += n
    return placed


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` with sequence_id and offset. Its rows must be stored: they are read more than once."""
    spark = parts.sparkSession
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slices = -(-sum(counts.values()) // SLICE_ROWS) or 1
    runs = spark.createDataFrame(sweeps(counts, capacity), "run_length bigint, run_rank bigint, run_pieces bigint, first_sequence bigint, offset bigint")
    rows = parts.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(slices)))
    # Ranks of a slice follow on those of the slices before it.
    held = rows.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("low", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # Each slice of ranks meets the runs that overlap it, then each piece the one run that has its rank.
    overlap = [
        F.col("run_length") == F.col("length"),
        F.col("run_rank") < F.col("low") + F.col("n"),
        F.col("run_rank") + F.col("run_pieces") > F.col("low"),
    ]
    places = held.join(F.broadcast(runs), overlap).drop("n", "run_length")
    places = places.withColumnsRenamed({"length": "p_length", "slice": "p_slice"})
    order = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    rows = rows.withColumn("within", F.row_number().over(order) - 1)
    rank = F.col("low") + F.col("within")
    own = [F.col("length") == F.col("p_length"), F.col("slice") == F.col("p_slice"), rank >= F.col("run_rank"), rank < F.col("run_rank") + F.col("run_pieces")]
    packed = rows.join(places, own).withColumn("sequence_id", F.col("first_sequence") + rank - F.col("run_rank"))
    return packed.select(*parts.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(stored(pieces(docs, tokenizer, pattern, capacity), "pack-pieces"), capacity)
