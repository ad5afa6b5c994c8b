"""Objects of JSON arrays, one large array being read by many tasks.

Spark cuts a text file by byte ranges at any one-byte separator. With ``}`` as separator every range is a
run of chunks, but a range does not know whether it begins in a string, nor how deep. So the files are
scanned twice: first each range says how many quotes it holds and how much deeper it leads, once taken to
begin outside a string and once inside. Running sums over the ranges of a file then give the state in
which each begins. The second scan joins chunks to objects; only what crosses a range is grouped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.session import stored

END = "}"
#: What may stand between two objects, and before the first one.
BETWEEN = re.compile(r"﻿?[\s,]*\[?[\s,]*")
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]]', re.S)

WHOLE, CLOSES, OPEN = 0, 1, 2
# Names no folder of a feed has.
SPLIT, ROW, PATH, BLOCK, TEXT, KIND = "_a_split", "_a_row", "_a_path", "_a_block", "_a_text", "_a_kind"


#: Characters that change the state of a reader, by their bytes.
MARKS = np.zeros(256, bool)
MARKS[[ord(c) for c in '"\\{[]']] = True


def _states(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each chunk: whether it holds an odd number of quotes, and how much deeper it leads with the separator after it.

    The depth is told twice, taken to begin outside a string and inside; what a backslash escapes does not count.
    """
    n, wide = len(texts), pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts = (offsets - offsets[0]).astype(np.int64)
    at = np.flatnonzero(MARKS[data])
    mark, chunk = data[at], np.searchsorted(starts, at, "right") - 1
    slash = np.flatnonzero(mark == ord("\\"))
    if len(slash):
        # Of a run of backslashes each second one is escaped, and after an odd run what follows in the chunk.
        new = np.append(True, (np.diff(at[slash]) != 1) | (np.diff(chunk[slash]) != 0))
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(slash)))
        last = slash[first + length - 1]
        escaped = (at[last] + 1)[(length % 2 == 1) & (at[last] + 1 < starts[chunk[last] + 1])]
        kept = (mark != ord("\\")) & ~np.isin(at, escaped)
        mark, chunk = mark[kept], chunk[kept]
    quote = mark == ord('"')
    quotes = np.bincount(chunk[quote], minlength=n)
    inside = (np.cumsum(quote) - (np.cumsum(quotes) - quotes)[chunk]) % 2 == 1
    step = np.where(quote, 0, np.where(mark == ord("]"), -1, 1))
    nets = [np.bincount(chunk[side], step[side], n).astype(np.int64) for side in (~inside, inside)]
    odd = quotes % 2
    return odd, nets[0] - (odd == 0), nets[1] - (odd == 1)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.text(path, lineSep=END)
    return df.select(
        F.col("_metadata.file_path").alias(PATH),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW),
        F.col("value").alias(TEXT),
        *[c for c in df.columns if c != "value"],
    )


def _splits(chunks: DataFrame) -> DataFrame:
    """The state in which each range begins; ranges of files that are no array, or are cut short, are left out."""
    # Within a range the choice between both nets is itself a running state: it is taken where the chunks are
    # in order, by the map tasks, which hand on four numbers a range.
    names = f"{PATH} string, {BLOCK} long, quotes int, outside long, inside long, first string"
    ranges = chunks.select(PATH, BLOCK, TEXT).mapInArrow(_sum_ranges, names)
    whole = Window.partitionBy(PATH)
    before = whole.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("quote", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
    ranges = ranges.withColumn("net", F.when(F.col("quote") == 0, F.col("outside")).otherwise(F.col("inside")))
    ranges = ranges.withColumn("depth", F.coalesce(F.sum("net").over(before), F.lit(0)))
    good = (F.sum("net").over(whole) == -1) & (F.sum("quotes").over(whole) % 2 == 0) & (F.min_by("first", BLOCK).over(whole) == "[")
    return ranges.withColumn("good", good).where("good").select(PATH, BLOCK, "quote", "depth", F.monotonically_increasing_id().alias(SPLIT))


def _sum_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Quotes and both nets of each range; a range's chunks come one after another."""
    key, sums, first = None, None, None

    def done():
        quotes, outside, inside = sums
        return pa.RecordBatch.from_pydict(
            {PATH: [key[0]], BLOCK: pa.array([key[1]], pa.int64()), "quotes": pa.array([quotes], pa.int32()),
             "outside": pa.array([outside], pa.int64()), "inside": pa.array([inside], pa.int64()), "first": pa.array([first], pa.string())}
        )

    for batch in batches:
        paths, blocks = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        odd, out, ins = _states(batch.column(2))
        for a, b in _runs(blocks, np.array(paths, dtype=object)):
            if key != (paths[a], int(blocks[a])):
                if key is not None:
                    yield done()
                key, sums, first = (paths[a], int(blocks[a])), (0, 0, 0), batch.column(2)[a].as_py().lstrip(" ").lstrip("﻿ \t\r\n")[:1]
            parity = (sums[0] + np.cumsum(odd[a:b]) - odd[a:b]) % 2
            sums = (
                int(sums[0] + odd[a:b].sum()) % 2,
                sums[1] + int(np.where(parity == 0, out[a:b], ins[a:b]).sum()),
                sums[2] + int(np.where(parity == 0, ins[a:b], out[a:b]).sum()),
            )
    if key is not None:
        yield done()


def _runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal keys."""
    n = len(keys[0])
    changes = np.zeros(max(n - 1, 0), bool)
    for key in keys:
        changes |= key[1:] != key[:-1]
    cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), n]
    return list(zip(cuts, cuts[1:])) if n else []


def _object(text: str, depth: int) -> str:
    """The object that ends ``text``, which begins outside strings at a depth of 0 or 1."""
    start = BETWEEN.match(text).end()
    if text[start] == "{" and text.count("[", 0, start) == 1 - depth:
        return text[start:]
    for token in TOKEN.finditer(text):  # other elements stand before it
        if token[0] in "{[":
            depth += 1
            start = token.start() if depth == 2 else start
        elif token[0] in "}]":
            depth -= 1
    return text[start:]


def _assemble(extras: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, pieces, quote, depth, begun, kind, rest = None, [], 0, 0, 0, WHOLE, None
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            splits, texts = cols[SPLIT].to_numpy(), cols[TEXT].to_pylist()
            odd, out, ins = _states(cols[TEXT])
            rows = []
            for a, b in _runs(splits):
                if split != splits[a]:
                    if pieces:
                        rows.append((split, OPEN, begun, END.join(pieces), rest))
                    split, pieces, quote, depth = int(splits[a]), [], cols["quote"][a].as_py(), cols["depth"][a].as_py()
                    begun, kind = depth, WHOLE if quote == 0 and depth <= 1 else CLOSES
                rest = tuple(cols[n][a].as_py() for n in extras)
                parity = (quote + np.cumsum(odd[a:b]) - odd[a:b]) % 2
                deep = depth + np.cumsum(np.where(parity == 0, out[a:b], ins[a:b]))
                closed = np.flatnonzero(((parity + odd[a:b]) % 2 == 0) & (deep == 1))
                quote, depth, at = int(parity[-1] + odd[b - 1]) % 2, int(deep[-1]), a
                for end in (closed + a).tolist():
                    text = END.join([*pieces, *texts[at : end + 1]])
                    text = _object(text + END, begun) if kind == WHOLE else text
                    rows.append((split, kind, begun, text, rest))
                    pieces, at, begun, kind = [], end + 1, 1, WHOLE
                pieces += texts[at:b]
            yield table(rows)
        if pieces:
            yield table([(split, OPEN, begun, END.join(pieces), rest)])

    def table(rows):
        data = {
            SPLIT: pa.array([r[0] for r in rows], pa.int64()),
            KIND: pa.array([r[1] for r in rows], pa.int32()),
            "depth": pa.array([r[2] for r in rows], pa.int64()),
            TEXT: pa.array([r[3] for r in rows], pa.string()),
        }
        return pa.RecordBatch.from_pydict(data | {n: pa.array([r[4][i] for r in rows], pa.string()) for i, n in enumerate(extras)})

    return run


@F.pandas_udf(T.StringType())
def _object_of(text: pd.Series, depth: pd.Series) -> pd.Series:
    return pd.Series([_object(t, d) for t, d in zip(text, depth)], dtype=object)


def object_texts(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """``text`` of every object that is an element of the array in a file, and the columns of its folders.

    UTF-8. Elements that are no objects are skipped; objects inside an element belong to it. A file that
    is empty, is no array, or whose brackets and quotes do not come out even (a response cut short) gives
    no row. The objects are stored once in the shared folder.
    """
    chunks = _chunks(spark, path)
    extras = [c for c in chunks.columns if not c.startswith("_a_")]
    types = dict(chunks.dtypes)
    splits = stored(_splits(chunks), "array-ranges")
    chunks = chunks.join(splits, [PATH, BLOCK]).drop(PATH, BLOCK).withColumns({c: F.col(c).cast("string") for c in extras})
    schema = ", ".join([f"{SPLIT} long, {KIND} int, depth long, {TEXT} string", *[f"`{c}` string" for c in extras]])
    # In order already where the ranges were broadcast, not where they were too many for it.
    found = stored(chunks.sortWithinPartitions(SPLIT, ROW).mapInArrow(_assemble(extras), schema), "array-objects")
    parts = found.where(F.col(KIND) != WHOLE).join(splits.select(SPLIT, PATH, BLOCK), SPLIT)
    before = Window.partitionBy(PATH).orderBy(BLOCK, KIND).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("n", F.coalesce(F.sum((F.col(KIND) == CLOSES).cast("int")).over(before), F.lit(0)))
    parts = parts.groupBy(PATH, "n").agg(
        F.sort_array(F.collect_list(F.struct(BLOCK, KIND, TEXT, "depth", *extras))).alias("p"),
        F.max(F.col(KIND) == CLOSES).alias("closed"),
    )
    text = F.concat(F.array_join(F.col(f"p.{TEXT}"), END), F.lit(END))
    parts = parts.where("closed").select(_object_of(text, F.col("p")[0]["depth"]).alias("text"), *[F.col("p")[0][c].alias(c) for c in extras])
    both = found.where(F.col(KIND) == WHOLE).select(F.col(TEXT).alias("text"), *extras).unionAll(parts)
    return both.select("text", *[F.col(c).cast(types[c]).alias(c) for c in extras]), extras


def land_arrays(records: DataFrame, path: str) -> None:
    """Records as one JSON array a file, an object a line."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "["
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                out.append(lead + text)
                lead = ","
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})
        yield pa.RecordBatch.from_pydict({"value": ["]" if lead == "," else "[]"]})

    records.select(F.to_json(F.struct("*")).alias("value")).mapInArrow(lines, "value string").write.text(path)
