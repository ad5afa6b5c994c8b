"""Vector codes: codebooks per part, by distances over dictionaries of the values of each dimension.

Components become integers floor(SCALE * x). Vectors lie in blocks; a block holds, per dimension, the
distinct integers in it and a code per vector. For a round, the squared differences of every distinct integer to
all entries of the codebook are tabulated; the distance of a part is the sum of the rows its codes
name: gathers and adds, no products per vector. The sums that move an entry come the same way, from how
often each integer is assigned to it.

All arithmetic is exact: 64-bit integers where they suffice, Python's where they do not. Dictionaries are as
large as their block at most, so nothing grows with the table but the number of blocks. What reaches the driver are
the entries that start the codebooks and, each round, one sum per entry and position.

Defined results: vectors that are null or hold a null, NaN or infinite component are dropped. The vectors used
are as long as that of the smallest vec_id, if that length has equal parts; others have null code and error and
take no part. Rows with one vec_id start the codebooks in the order of their integers' text; a null id comes last.
Fewer vectors than entries make fewer entries. Errors beyond 64 bits are null. A null label is a label. Other columns
are not read, whatever their names. No vectors: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tripmill.llm.common import join_groups, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors in a block.
BLOCK = 8192
#: Exact sums travel as this many digits of 30 bits each, the last one signed.
_DIGITS, _BITS = 6, 30


def _integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), exactly: of Python integers where 64 bits are too few."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.ravel()], dtype=object).reshape(scaled.shape)


def _narrow(n: int) -> str:
    return "<u1" if n <= 1 << 8 else "<u2" if n <= 1 << 16 else "<u4"


def _block(ids: list, labels: list, ints: np.ndarray) -> dict:
    """Dictionaries and codes of the vectors ``ints`` (vector, dimension); values as text, so that any integer fits."""
    values, codes, sizes = [], [], []
    for column in ints.T:
        distinct, code = np.unique(column, return_inverse=True)
        values.append(",".join(map(str, distinct)))
        codes.append(code.astype(_narrow(len(distinct))).tobytes())
        sizes.append(len(distinct))
    head = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))[: ENTRIES + 1]
    if len(head) > ENTRIES:  # all that tie with the last of them
        last = ids[head[ENTRIES - 1]]
        head = [i for i in range(len(ids)) if (ids[i] is None, ids[i] or 0) <= (last is None, last or 0)]
        rows = sorted(((ids[i] is None, ids[i] or 0, ",".join(map(str, ints[i])), i) for i in head))[:ENTRIES]
        head = [r[3] for r in rows]
    heads = [{"id": ids[i], "ints": ",".join(map(str, ints[i]))} for i in head]
    return {"width": ints.shape[1], "ids": ids, "labels": labels, "sizes": sizes, "vals": values, "codes": codes, "heads": heads}


def _blocks(kinds: pa.Schema):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, BLOCK):
                rows = part.slice(at, BLOCK)
                vectors, ids, labels = rows.column("embedding"), rows.column("vec_id").to_pylist(), rows.column("label").to_pylist()
                by_width: dict[int, list[int]] = {}
                for i, n in enumerate(vectors.value_lengths().to_pylist()):
                    if n is not None:
                        by_width.setdefault(n, []).append(i)
                out = []
                for width, members in by_width.items():
                    flat = vectors.take(pa.array(members)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(members), width)
                    fine = np.isfinite(flat).all(axis=1)  # a null component has become NaN
                    members = [i for i, ok in zip(members, fine, strict=True) if ok]
                    if members:
                        out.append(_block([ids[i] for i in members], [labels[i] for i in members], _integers(flat[fine])))
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return batches


def _arrays(values: list[str], sizes: list[int], codes: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for text, n, code in zip(values, sizes, codes, strict=True):
        ints = [int(x) for x in text.split(",")]
        wide = max(abs(ints[0]), abs(ints[-1])) >= 1 << 62
        out.append((np.array(ints, dtype=object if wide else np.int64), np.frombuffer(code, _narrow(n))))
    return out


def distances(columns: list[tuple[np.ndarray, np.ndarray]], book: list[list[int]], n: int) -> np.ndarray:
    """Squared distances of ``n`` parts to the entries of ``book``: a table per dimension, gathered by code and added."""
    most = max([abs(int(v)) for values, _ in columns for v in (values[0], values[-1])] + [abs(x) for e in book for x in e] + [1])
    kind = np.int64 if (2 * most) ** 2 * max(1, len(columns)) < 1 << 62 else object
    total = np.zeros((n, len(book)), dtype=kind)
    for at, (values, codes) in enumerate(columns):
        entry = np.array([e[at] for e in book], dtype=kind)
        total += ((values.astype(kind)[:, None] - entry[None, :]) ** 2)[codes]
    return total


def _digits(value: int) -> list[int]:
    out = []
    for _ in range(_DIGITS - 1):
        out.append(value & ((1 << _BITS) - 1))
        value >>= _BITS
    return [*out, value]


def _books(seeds: list[list[int]], parts: int) -> list[list[list[int]]]:
    size = len(seeds[0]) // parts
    return [[s[p * size : (p + 1) * size] for s in seeds] for p in range(parts)]


def _sums(books: list[list[list[int]]]):
    """Per task: how many parts each entry has, and the sums of their components (position -1 is the count)."""
    size = len(books[0][0])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], int] = {}
        for part in parts:
            for row in part.to_pylist():
                columns, n = _arrays(row["vals"], row["sizes"], row["codes"]), len(row["ids"])
                for p, book in enumerate(books):
                    mine = columns[p * size : (p + 1) * size]
                    nearest = distances(mine, book, n).argmin(axis=1)
                    for e, c in enumerate(np.bincount(nearest, minlength=len(book))):
                        total[p, e, -1] = total.get((p, e, -1), 0) + int(c)
                    for at, (values, codes) in enumerate(mine):
                        times = np.bincount(nearest * len(values) + codes, minlength=len(book) * len(values)).reshape(len(book), -1)
                        exact = values.astype(object) if abs(int(values[0])) > 1 << 40 or abs(int(values[-1])) > 1 << 40 else values
                        for e, s in enumerate(times.astype(exact.dtype) @ exact):
                            total[p, e, at] = total.get((p, e, at), 0) + int(s)
        rows = [(*key, *_digits(value)) for key, value in total.items()]
        columns = list(zip(*rows, strict=True)) or [[] for _ in range(3 + _DIGITS)]
        names = ["part", "entry", "position", *[f"d{k}" for k in range(_DIGITS)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return batches


def _codes(books: list[list[list[int]]], kinds: pa.Schema):
    size = len(books[0][0])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in part.to_pylist():
                n = len(row["ids"])
                code, error = [None] * n, [None] * n
                if row["width"] == size * len(books):
                    columns, nearest, total = _arrays(row["vals"], row["sizes"], row["codes"]), [], [0] * n
                    for p, book in enumerate(books):
                        far = distances(columns[p * size : (p + 1) * size], book, n)
                        nearest.append(far.argmin(axis=1))
                        total = [t + d for t, d in zip(total, far[np.arange(n), nearest[-1]].tolist(), strict=True)]
                    code = [bytes(c).hex() for c in np.stack(nearest, axis=1).astype(np.uint8)]
                    error = [t if t < 1 << 63 else None for t in total]
                arrays = [pa.array(x, kinds.field(k).type) for k, x in enumerate((row["ids"], row["labels"], code, error))]
                yield pa.RecordBatch.from_arrays(arrays, schema=kinds)

    return batches


def train(blocks: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[list[list[int]]]:
    """Codebooks, by part and entry, from stored blocks; none if no vector can be cut into equal parts."""
    heads = blocks.select("width", F.explode("heads").alias("h"))
    order = [F.col("h.id").isNull(), F.col("h.id"), F.col("h.ints")]
    first = heads.orderBy(*order).limit(1).collect()
    if not first or first[0]["width"] % parts:
        return []
    width = first[0]["width"]
    seeds = heads.where(F.col("width") == width).orderBy(*order).limit(entries).collect()
    books = _books([[int(x) for x in r["h"]["ints"].split(",") if x] for r in seeds], parts)
    used, digits = blocks.where(F.col("width") == width), [f"d{k}" for k in range(_DIGITS)]
    schema = ", ".join(f"{c} long" for c in ["part", "entry", "position", *digits])
    for _ in range(rounds):
        sums = used.mapInArrow(_sums(books), schema).groupBy("part", "entry", "position").agg(*[F.sum(d).alias(d) for d in digits])
        found = {(r[0], r[1], r[2]): sum(r[3 + k] << _BITS * k for k in range(_DIGITS)) for r in sums.collect()}
        books = [
            [
                [found[p, e, at] // found[p, e, -1] for at in range(len(entry))] if found.get((p, e, -1)) else entry
                for e, entry in enumerate(book)
            ]
            for p, book in enumerate(books)
        ]
    return books


def digest(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def pack(vectors: DataFrame) -> DataFrame:
    """Blocks of vectors as dictionaries and codes, stored."""
    id_type, label_type = (vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    schema = f"width int, ids array<{id_type}>, labels array<{label_type}>, sizes array<int>, vals array<string>, codes array<binary>"
    schema += f", heads array<struct<id:{id_type},ints:string>>"
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    return stored(vectors.select("vec_id", "label", "embedding").mapInArrow(_blocks(kinds), schema), "vector-blocks")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per vector kept: vec_id, code, error, label_error and the digest of the codebooks."""
    blocks = pack(vectors)
    books = train(blocks, parts, entries, rounds)
    id_type, label_type = (vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    schema = f"vec_id {id_type}, label {label_type}, code string, error long"
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    rows = blocks.select("width", "ids", "labels", "sizes", "vals", "codes").mapInArrow(_codes(books or [[[0]]], kinds), schema)
    rows = rows.withColumn("of", F.when(F.col("label").isNull(), F.lit("none")).otherwise(F.concat(F.lit("="), F.col("label").cast("string"))))
    rows = stored(rows.drop("label"), "vector-codes")
    total = rows.groupBy("of").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"), F.count("*").alias("n"))
    total = stored(total.select("of", "n", F.expr("try_cast(total AS bigint)").alias("label_error")), "vector-labels")
    out = join_groups(rows, total, "of", "n")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    """The same rounds as joins of (vector, part, position) with (part, entry, position)."""

    def near(book: str) -> str:
        # The least of distance * ENTRIES + index is the nearest entry, ties to the lower index.
        return f"""
  SELECT vec_id, label, part, min(d * {ENTRIES} + entry) % {ENTRIES} AS entry, min(d * {ENTRIES} + entry) // {ENTRIES} AS d FROM (
    SELECT v.vec_id, any_value(v.label) AS label, v.part, b.entry, sum((v.x - b.x) * (v.x - b.x))::HUGEINT AS d
    FROM v JOIN {book} AS b ON v.part = b.part AND v.pos = b.pos GROUP BY v.vec_id, v.part, b.entry)
  GROUP BY vec_id, label, part"""

    text = f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS ints FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
  SELECT vec_id, label, (i - 1) // (len(ints) // {PARTS}) AS part, (i - 1) % (len(ints) // {PARTS}) AS pos, ints[i] AS x
  FROM k, unnest(range(1, len(ints) + 1)) AS u(i)),
b0 AS MATERIALIZED (
  SELECT part, s.entry, pos, x FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT {ENTRIES}) AS s USING (vec_id))"""
    for r in range(1, ROUNDS + 1):
        text += f""",
a{r} AS MATERIALIZED ({near(f"b{r - 1}")}),
m{r} AS MATERIALIZED (
  SELECT part, entry, pos, sum(x)::HUGEINT AS s, count(*) AS c FROM a{r} JOIN v USING (vec_id, part) GROUP BY part, entry, pos),
b{r} AS MATERIALIZED (
  SELECT part, entry, pos, CASE WHEN c IS NULL THEN x ELSE (s - ((s % c) + c) % c) // c END::BIGINT AS x
  FROM b{r - 1} LEFT JOIN m{r} USING (part, entry, pos))"""
    return text + f""",
z AS MATERIALIZED ({near(f"b{ROUNDS}")}),
e AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM z GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM b{ROUNDS}) AS codebooks_sha256
FROM e
"""


ORACLE = _oracle()
