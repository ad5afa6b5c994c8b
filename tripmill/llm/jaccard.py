"""Near duplicates: a join of shingle sets by Jaccard similarity, size-aware, exact at any size.

Sets of equal content are one set from the start (``set_id``). Then:

1. Frequencies. Every set posts its shingles to buckets of hash ranges, as packed arrays; a bucket
   finds in which sets each shingle occurs and sends on those in two sets or more, all shingles with the
   same holders as one class with a number. Shingles that are frequent in single tasks are counted first:
   the most frequent, at most HOT_PARTS times the mean set size of them, are known to every task and
   are classes of their own without being posted, so no bucket holds a hot key.
2. Survivors. With shingles in the order of frequency, two linked sets share one of the first
   ``n - ceil(0.75 n) + 1`` of each. Shingles of one set alone come first in that order: a set with that
   many of them has no link, and needs no further step. This drops most sets.
3. Keys, by size. Small sets list the subsets of two shingles (as classes) of their prefix, one shingle
   longer, as two linked sets share two of it. Large sets, and the small ones that a large one can reach,
   go to inverted lists of single classes. The boundary has the least cost by a table of sizes: subsets
   listed below it, against list entries above it, whose candidates are looser.
4. Candidates. In each list the members are tied to the smallest member of their size class and of the
   next ones: as many ties as members, and whatever shares a key is connected by ties.
5. Verification. Each connected group meets in one task, or, if large, in one task per two blocks of its
   members, where overlaps are counted exactly and a spanning forest of the links is returned.

No pair is lost: sets with a link share a key, thus a group, thus a task. Nothing is emitted per pair.

Defined results: null, empty and blank texts have an empty set, no link, and their own id as component.
A component's id is the smallest id in it, nulls aside. Repeated rows are returned as often as they come. Long texts are
read whole; ties in size or frequency change no result; an empty table gives an empty result; extra columns of any name are
carried by ``keep`` and not read elsewhere.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripmill.llm import shingles as sh
from tripmill.llm.common import SPACE, join_groups, per_text, stored
from tripmill.llm.components import components

#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A shingle in over 1 / HOT_PARTS of the sets (and HOT_LEAST sets) is known to every task.
HOT_PARTS, HOT_LEAST, LOCAL_LEAST = 4096, 1000, 4
#: Shingles posted at once by a task, and in a bucket on average.
CHUNK, BUCKET = 1_000_000, 1_500_000
#: Cost of a list entry, in subsets: sets that share one class are tied more often without a link.
LOOSE = 2.0
#: Sets in a block of a large group.
BLOCK = 512

#: Kinds of packed rows: shingles of a range, hot shingles of sets, classes of sets.
POSTING, HOT, CLASS = 0, 1, 2
POSTED = "bucket bigint, kind int, data binary, owners binary, sets binary, sizes binary"
ROW = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), *((c, pa.binary()) for c in ("data", "owners", "sets", "sizes"))])


def prefix(n, percent: int = PERCENT):
    """How many of its n shingles a set must show, one of which any linked set has in its own prefix."""
    return n - -(-percent * n // 100) + 1


def documents_sets(docs: DataFrame, carried: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, ``carried`` (long integers or texts), n_shingles, set_id."""
    carried = carried or {}

    def one(text):
        found = sh.shingle_set(text)
        return len(found), sh.set_id(found)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[c.alias(name) for name, c in carried.items()], "text")
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = StructType([*kept, StructField("n_shingles", LongType()), StructField("set_id", LongType())])
    return rows.mapInArrow(per_text(one, [f.name for f in kept], ["n_shingles", "set_id"]), schema)


def _chunks(parts, size: int = CHUNK):
    """Lists of (set id, shingles) of distinct sets, with about ``size`` shingles each."""
    held, seen, n = [], set(), 0
    for part in parts:
        for text in part.column("text"):
            found = sh.shingle_set(text.as_py())
            key = sh.set_id(found)
            if key is None or key in seen:
                continue
            seen.add(key)
            held.append((key, found))
            n += len(found)
            if n >= size:
                yield held
                held, seen, n = [], set(), 0
    if held:
        yield held


def hot_shingles(docs: DataFrame, sets: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, ascending, and their counts."""

    def batches(parts):
        for held in _chunks(parts):
            values, counts = np.unique(np.concatenate([s for _, s in held]), return_counts=True)
            often = counts >= LOCAL_LEAST
            yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often])], names=["shingle", "n"])

    found = docs.select("text").mapInArrow(batches, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    table = found.where(F.col("n") > max(HOT_LEAST, sets // HOT_PARTS)).toArrow()
    values, counts = table.column("shingle").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(values)
    return values[order], counts[order]


def _row(bucket: int, kind: int, data: bytes, owners: np.ndarray, keys: np.ndarray, sizes: np.ndarray) -> tuple:
    """Owners are positions in ``keys``; only the keys in use are sent."""
    used, local = np.unique(owners, return_inverse=True)
    return bucket, kind, data, sh.planes(local.astype("<u4")), keys[used].tobytes(), sh.planes(sizes[used].astype("<u4"))


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(ROW)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ROW.types, strict=True)], schema=ROW)


def _classes(classes, holders, numbers, owners, keys: np.ndarray, sizes: np.ndarray, buckets: int, kind: int):
    """Rows of classes by the bucket of the set. ``holders``: sets with the class; ``numbers``: its shingles."""
    home = (keys.view(np.uint64) % np.uint64(buckets)).astype(np.int64)[owners]
    order = np.argsort(home, kind="stable")
    cuts = np.flatnonzero(np.diff(home[order], prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(home)], strict=True):
        at = order[a:b]
        data = sh.planes(classes[at]) + sh.planes(np.minimum(holders[at], 2**32 - 1).astype("<u4")) + sh.planes(numbers[at].astype("<u4"))
        yield _row(int(home[at[0]]), kind, data, owners[at], keys, sizes)


def posted(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """Packed postings: kind POSTING by hash range of the shingle, kind HOT by set."""
    values, numbers = hot

    def batches(parts):
        for held in _chunks(parts):
            keys = np.array([k for k, _ in held], dtype=np.int64)
            sizes = np.array([len(s) for _, s in held])
            owners = np.repeat(np.arange(len(held)), sizes)
            tokens = np.concatenate([s for _, s in held])
            rows = []
            if len(values):
                at = np.minimum(np.searchsorted(values, tokens), len(values) - 1)
                is_hot = values[at] == tokens
                if is_hot.any():
                    one = np.ones(int(is_hot.sum()), np.int64)
                    rows += _classes(tokens[is_hot], numbers[at[is_hot]], one, owners[is_hot], keys, sizes, buckets, HOT)
                    tokens, owners = tokens[~is_hot], owners[~is_hot]
            order = np.argsort(tokens, kind="stable")
            tokens, owners = tokens[order], owners[order]
            home = bucket_of(tokens, buckets)
            cuts = np.flatnonzero(np.diff(home, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(home)], strict=True):
                rows.append(_row(int(home[a]), POSTING, sh.sorted_planes(tokens[a:b]), owners[a:b], keys, sizes))
            for at in range(0, len(rows), 64):
                yield _table(rows[at : at + 64])

    return docs.select("text").mapInArrow(batches, POSTED)


def bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the hash, of equal width."""
    return ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _read(rows: pa.Table, kind: int):
    """Set ids, set sizes and positions in them of all postings of the rows of a kind, and the data parts."""
    keys, sizes, owners, data, base = [], [], [], [], 0
    for r in rows.to_pylist():
        if r["kind"] != kind:
            continue
        k = np.frombuffer(r["sets"], np.int64)
        keys.append(k)
        sizes.append(sh.from_planes(r["sizes"], "<u4"))
        owners.append(sh.from_planes(r["owners"], "<u4").astype(np.int64) + base)
        data.append(r["data"])
        base += len(k)
    if not data:
        return None
    keys, first, again = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    return keys, np.concatenate(sizes)[first].astype(np.int64), again[np.concatenate(owners)], data


def frequencies(rows: DataFrame, buckets: int) -> DataFrame:
    """Shingles in two sets or more, as classes of equal holders, by the bucket of the set."""

    def bucket(group: pa.Table) -> pa.Table:
        out = []
        if (got := _read(group, POSTING)) is not None:
            keys, sizes, owners, data = got
            tokens = np.concatenate([sh.from_sorted_planes(d) for d in data])
            order = np.lexsort((owners, tokens))
            tokens, owners = tokens[order], owners[order]
            new = np.ones(len(tokens), dtype=bool)
            new[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
            tokens, owners = tokens[new], owners[new]
            starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
            holders = np.diff(starts, append=len(tokens))
            # A class is named by the sum of its holders' mixed ids.
            names = np.add.reduceat(sh.mixed(keys.view(np.uint64))[owners], starts)
            names, holders = np.repeat(sh.mixed(names), holders), np.repeat(holders, holders)
            often = holders > 1
            if often.any():
                owners, names, holders = owners[often], names[often], holders[often]
                order = np.lexsort((names, owners))
                owners, names, holders = owners[order], names[order], holders[order]
                starts = np.flatnonzero(np.concatenate(([True], (names[1:] != names[:-1]) | (owners[1:] != owners[:-1]))))
                numbers = np.diff(starts, append=len(names))
                out += _classes(names[starts], holders[starts], numbers, owners[starts], keys, sizes, buckets, CLASS)
        passed = group.filter(pc.equal(group.column("kind"), HOT)).select(ROW.names).cast(ROW)
        return pa.concat_tables([pa.Table.from_batches([_table(out)]), passed])

    return rows.groupBy("bucket").applyInArrow(bucket, POSTED)


SURVIVOR = "set_id bigint, n bigint, one int, two int, classes array<bigint>, numbers array<bigint>"


def survivors(rows: DataFrame) -> DataFrame:
    """Sets that may have a link: their classes, rare ones first, and the shingles in each.

    ``one`` of the classes, from the first, hold the prefix, and ``two`` the prefix and one shingle more.
    """

    def bucket(group: pa.Table) -> pa.Table:
        parts = []
        for kind in (HOT, CLASS):
            if (got := _read(group, kind)) is None:
                continue
            keys, sizes, owners, data = got
            cut = [(d[: len(d) // 2], d[len(d) // 2 : len(d) // 4 * 3], d[len(d) // 4 * 3 :]) for d in data]
            names = np.concatenate([sh.from_planes(x, np.uint64) for x, _, _ in cut])
            holders = np.concatenate([sh.from_planes(x, "<u4") for _, x, _ in cut]).astype(np.int64)
            numbers = np.concatenate([sh.from_planes(x, "<u4") for _, _, x in cut]).astype(np.int64)
            if kind == HOT:  # tasks repeat the shingles of a set that they both have
                _, first = np.unique(np.stack([owners.astype(np.uint64), names]), axis=1, return_index=True)
                names, holders, numbers, owners = names[first], holders[first], numbers[first], owners[first]
            parts.append((keys[owners], sizes[owners], names, holders, numbers))
        ids, n, names, holders, numbers = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((names, holders, ids))
        ids, n, names, holders, numbers = ids[order], n[order], names[order], holders[order], numbers[order]
        starts = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (names[1:] != names[:-1]))))
        ids, n, names, numbers = ids[starts], n[starts], names[starts].view(np.int64), np.add.reduceat(numbers, starts)
        starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        ends = np.append(starts[1:], len(ids))
        own = n[starts] - np.add.reduceat(numbers, starts)
        reach = prefix(n[starts]) - own
        before = np.cumsum(numbers) - numbers
        before -= np.repeat(before[starts], ends - starts)
        one, two = (np.add.reduceat((before < np.repeat(reach + k, ends - starts)).astype(np.int64), starts) for k in (0, 1))
        stays = np.flatnonzero(reach > 0)
        spans = [slice(starts[i], ends[i]) for i in stays]
        return pa.table({
            "set_id": ids[starts][stays], "n": n[starts][stays], "one": one[stays].astype(np.int32), "two": two[stays].astype(np.int32),
            "classes": pa.array([names[s] for s in spans], pa.list_(pa.int64())),
            "numbers": pa.array([numbers[s] for s in spans], pa.list_(pa.int64())),
        })

    return rows.groupBy("bucket").applyInArrow(bucket, SURVIVOR)


def boundary(sets: DataFrame) -> int:
    """The largest size of a small set: the sum of both costs is least there."""
    # Sizes over 64 share a row with their neighbours up to a sixteenth: the table stays small.
    size = F.when(F.col("n") <= 64, F.col("n")).otherwise(F.ceil(F.lit(2.0) ** (F.ceil(F.log2("n") * 16) / 16))).cast("long")
    costs = sets.groupBy(size.alias("n")).agg(F.sum(F.col("two") * (F.col("two") + 1) / 2).alias("subsets"), (F.sum("one") * LOOSE).alias("entries"))
    table = costs.orderBy("n").collect()
    best, bound, low, high = None, 0, 0.0, sum(r["entries"] for r in table)
    for r in [None, *table]:
        if r is not None:
            low, high = low + r["subsets"], high - r["entries"]
        if best is None or low + high < best:
            best, bound = low + high, r["n"] if r is not None else 0
    return bound


def keys(sets: DataFrame, bound: int) -> DataFrame:
    """key, set_id, n and grade (of the size): subsets of two for small sets, single classes for the others."""
    small = sets.where(F.col("n") <= bound).select("set_id", "n", F.expr("slice(classes, 1, two)").alias("first"), "numbers")
    # Two shingles of one class are a subset, too, where the class has two.
    pairs = F.expr(
        "flatten(transform(sequence(1, size(first)), i -> transform(slice(first, if(numbers[i - 1] > 1, i, i + 1), size(first)), y -> xxhash64(first[i - 1], y))))"
    )
    small = small.select("set_id", "n", F.explode(pairs).alias("key"))
    single = sets.where(F.col("n") * 100 >= (bound + 1) * PERCENT)
    single = single.select("set_id", "n", F.explode(F.expr("slice(classes, 1, one)")).alias("key"))
    # Two sets with a link differ by one grade at most.
    grade = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / PERCENT) + 1e-9)
    both = small.withColumn("key", F.xxhash64(F.lit(2), "key")).unionByName(single.withColumn("key", F.xxhash64(F.lit(1), "key")))
    return both.withColumn("grade", grade)


def ties(keyed: DataFrame) -> DataFrame:
    """Candidates: each member with the smallest member of its own and the next size classes."""
    heads = keyed.groupBy("key", "grade").agg(F.min("set_id").alias("head"), F.count("*").alias("members"))
    several = keyed.groupBy("key").agg(F.count("*").alias("all")).where(F.col("all") > 1)
    heads = heads.join(several, "key").drop("members", "all")
    near = heads.select("key", "head", F.explode(F.array(F.col("grade") - 1, F.col("grade"), F.col("grade") + 1)).alias("grade"))
    tied = keyed.join(near, ["key", "grade"]).where(F.col("head") != F.col("set_id"))
    return tied.select(F.least("head", "set_id").alias("a"), F.greatest("head", "set_id").alias("b")).distinct()


def forest(ids: np.ndarray, sizes: np.ndarray, side: np.ndarray, classes: list[np.ndarray], numbers: list[np.ndarray], percent: int = PERCENT):
    """Links that span what is connected among sets, given all their classes and the shingles in each.

    ``side`` is the block of each set; where there are two, only links between them are looked for.
    """
    lengths = np.array([len(t) for t in classes])
    owner = np.repeat(np.arange(len(ids)), lengths)
    _, token = np.unique(np.concatenate(classes), return_inverse=True)
    weight = np.concatenate(numbers)
    order = np.argsort(token, kind="stable")
    holders = owner[order]
    starts = np.concatenate(([0], np.cumsum(np.bincount(token))))
    label, out, at, two = np.arange(len(ids)), [], 0, side.min() != side.max()
    far = side == side.max()
    for i in range(len(ids)):
        own, each = token[at : at + lengths[i]], weight[at : at + lengths[i]]
        at += lengths[i]
        if two and far[i]:
            continue
        count = starts[own + 1] - starts[own]
        reach = np.repeat(starts[own] - np.cumsum(count) + count, count) + np.arange(count.sum())
        shared = np.bincount(holders[reach], weights=np.repeat(each, count), minlength=len(ids))
        linked = (100 * shared >= percent * (sizes[i] + sizes - shared)) & (label != label[i])
        if two:
            linked &= far
        for j in np.flatnonzero(linked):
            if label[j] != label[i]:
                out.append((int(ids[i]), int(ids[j])))
                label[label == label[j]] = label[i]
    return out


def links(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Links (a, b) that span the components, from sets and their candidate groups (node, component)."""
    sized = groups.groupBy("component").agg(F.count("*").alias("members"))
    plan = join_groups(groups, sized, "component", "members")
    rows = sets.select("set_id", "n", "classes", "numbers").join(plan.withColumnRenamed("node", "set_id"), "set_id")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    # A set of block i meets block j in task (i, j), its own block in task (i, i).
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other)
    rows = rows.select("component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "set_id", "n", "classes", "numbers")

    def group(part: pa.Table) -> pa.Table:
        part = part.sort_by("set_id")
        classes, numbers = ([np.asarray(x.values) for x in part.column(c)] for c in ("classes", "numbers"))
        ids, sizes, side = (part.column(c).to_numpy() for c in ("set_id", "n", "block"))
        found = forest(ids, sizes, side, classes, numbers) if len(ids) > 1 else []
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return rows.groupBy("component", "low", "high").applyInArrow(group, "a bigint, b bigint")


def classes(docs: DataFrame, carried: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, set_id, component_id, component, and what is ``carried`` of it.

    ``component`` names the group also where all ids in it are null; it is null for empty sets.
    """
    rows = stored(documents_sets(docs, carried), "jaccard-sets")
    known = stored(rows.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"), F.count("*").alias("copies")), "jaccard-known")
    total = known.agg(F.count("*").alias("sets"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    buckets = max(8, -(-total["n"] // BUCKET))
    hot = hot_shingles(docs, total["sets"])
    sets = stored(survivors(frequencies(posted(docs, hot, buckets), buckets)), "jaccard-survivors")
    tied = ties(keys(sets, boundary(sets)))
    found = components(links(sets, stored(components(tied), "jaccard-groups")))
    # The component's id: the smallest document id of all its sets.
    known = known.join(found.withColumnRenamed("node", "set_id"), "set_id", "left")
    known = stored(known.withColumn("component", F.coalesce("component", "set_id")), "jaccard-known")
    first = known.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members"))
    known = join_groups(known, first, "component", "members").select("set_id", "copies", "component_id", "component")
    linked = join_groups(rows.where("set_id IS NOT NULL"), known, "set_id", "copies")
    alone = rows.where("set_id IS NULL").withColumn("component_id", F.col("doc_id")).withColumn("component", F.lit(None).cast("bigint"))
    columns = ["doc_id", "n_shingles", "set_id", "component_id", "component", *(carried or {})]
    return linked.select(columns).unionByName(alone.select(columns))


def keep(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns; documents without words all stay.

    The smallest id stays, nulls last; of rows that share it, the one whose text has the smallest digest; of
    rows alike in id and text, the one whose other columns have it.
    """
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    found = classes(docs, {"digest": digest}).where("component IS NOT NULL").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    alike = found.groupBy("component", "doc_id", "digest").agg(F.count("*").alias("n"))
    best = alike.groupBy("component").agg(F.min(F.struct("digest", "doc_id", "n")).alias("best"))
    best = stored(best.select(F.col("best.doc_id").alias("b_id"), F.col("best.digest").alias("b_digest"), F.col("best.n").alias("n")), "jaccard-kept")
    # The caller's columns travel as one, whatever their names.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), digest.alias("digest"), "text")
    wordless = ~F.coalesce(F.col("text").rlike(f"[^{SPACE}]"), F.lit(False))
    same = F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("digest") == F.col("b_digest"))
    worded = rows.where(~wordless).drop("text")
    kept = rows.where(wordless).select("row").unionByName(worded.join(best.where("n = 1"), same, "left_semi").select("row"))
    repeated = best.where("n > 1")
    if not repeated.isEmpty():
        groups = worded.join(repeated, same, "left_semi").groupBy("doc_id", "digest")
        kept = kept.unionByName(groups.agg(F.min_by("row", F.xxhash64(F.col("row").cast("string"))).alias("row")).select("row"))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
