"""The prefix trie of conversations, by way of a Patricia tree.

A conversation becomes the string of its turns' digests (DIGEST bytes a turn).
Equal strings are counted first, so copies cost nothing later; the different ones
are range-partitioned and sorted.  One pass over a partition keeps the points of
the current path on a stack: the common prefix with the next string says which
points close.  Points are only made where strings end or part (branch, end and leaf
points); the edge above a point stands for all its unary nodes, and carries the sums
of words from each of them down to the point.

Nodes that several partitions hold lie on the paths to their neighbours' strings:
prefixes that a partition's first string shares with the string before it, or its
last with the one after.  These are made points in every partition, each gives what
its own strings add (a node is counted as new by the partition that meets it first,
so every sum is linear), and one aggregate by the prefix's digest merges them.

Points then learn their parents' least member from a join on the compressed tree,
and the edges are unrolled to the unary nodes by the sums they carry.  The lists of
members that end at a node are hashed in order as streams of packed ids, so a
conversation that is copied without end is never held as a list.

Defined cases: null roles and texts are empty; turns go by (turn, role, text), null
turns first; repeated rows are turns of their own; rows without a conv_id belong to
no conversation; a conversation may lose all its turns and then ends at the root;
ids below zero take the remainder's sign; very long texts and conversations are
digested like others (a conversation's digests, DIGEST bytes a turn, pass as one
value); extra columns, whatever their names, are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nephos.llm.common import map_arrow, spread, word_count
from nephos.operators.joins import small
from nephos.session import drop_shared, ship_package, write_shared

DIGEST = 16
SHARED_BY, MOST_SHARED = 20, 4
EMPTY_ENDS = hashlib.sha256(b"").hexdigest()
#: Ids that are packed into one value on their way to a digest.
PACKED = 8192
_POINT = pa.schema(
    [
        ("id", pa.binary()), ("trunk", pa.bool_()), ("depth", pa.int64()), ("parent", pa.binary()), ("n", pa.int64()), ("least", pa.int64()),
        ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.list_(pa.int64())), ("ends", pa.bool_()),
    ]
)
_POINT_SQL = "id binary, trunk boolean, depth bigint, parent binary, n bigint, least bigint, children bigint, leaves bigint, saved array<bigint>, ends boolean"


# Sequences


def own_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, own): each conversation's turns in order, as structs with digest and words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST)
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"), role.alias("role"), text.alias("text"), digest.alias("digest"), word_count(text).alias("words")
    )
    slim = write_shared(_gathered(rows, ["has", "turn", "role", "digest", "words"]), "turns")
    # Turns of one number and role are told apart by their whole texts, which only such conversations need.
    same = lambda a, b: (a["has"] == b["has"]) & (a["turn"] == b["turn"]) & (a["role"] == b["role"]) & (a["digest"] != b["digest"])
    pairs = F.zip_with(F.slice("own", 1, F.size("own") - 1), F.slice("own", 2, F.size("own") - 1), same)
    marked = slim.withColumn("tied", F.exists(pairs, lambda p: p))
    tied = marked.where("tied").select("conv_id")
    if tied.isEmpty():
        return slim
    plain = slim.schema["own"].dataType
    again = _gathered(rows.join(small(tied), "conv_id", "left_semi"), ["has", "turn", "role", "text", "digest", "words"])
    trimmed = F.transform("own", lambda t: F.struct(*[t[f] for f in plain.elementType.names])).cast(plain)
    return marked.where(~F.col("tied")).select("conv_id", "own").unionByName(again.select("conv_id", trimmed.alias("own")))


def _gathered(rows: DataFrame, fields: list[str]) -> DataFrame:
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("own"))


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its SHARED_BY."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED).cast("int")


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, words): the rebuilt conversations' digests in one string, and each turn's words."""
    own = own_turns(conversations)
    heads = own.where(F.col("conv_id") % SHARED_BY == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, MOST_SHARED - 1).alias("head"))
    h = shared_turns(F.col("conv_id"))
    met = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % SHARED_BY).join(heads, "base", "left")
    rebuilt = F.concat(F.slice(F.coalesce("head", F.slice("own", 1, 0)), F.lit(1), h), F.slice("own", h + 1, F.size("own")))
    return met.select("conv_id", rebuilt.alias("all")).select(
        "conv_id", F.unhex(F.array_join(F.transform("all", lambda t: t["digest"]), "")).alias("key"), F.transform("all", lambda t: t["words"]).alias("words")
    )


# The compressed tree of one partition


def common_turns(a: bytes, b: bytes) -> int:
    """Turns of the common prefix of two strings."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:  # a prefix is a memory comparison, so halving is as good as a scan
        mid = (low + high + 1) // 2
        if a[: mid * DIGEST] == b[: mid * DIGEST]:
            low = mid
        else:
            high = mid - 1
    return low


def prefix_id(key: bytes, depth: int) -> bytes:
    return hashlib.sha256(key[: depth * DIGEST]).digest()[:DIGEST]


def prefix_ids(key: bytes, depth: int) -> list[bytes]:
    """The ids of the prefixes of 0 to ``depth`` turns."""
    state, out = hashlib.sha256(), []
    for d in range(depth + 1):
        out.append(state.copy().digest()[:DIGEST])
        state.update(key[d * DIGEST : (d + 1) * DIGEST])
    return out


class Point:
    """An open point: its depth, what its closed children gave, and whether this partition met its node first."""

    __slots__ = ("depth", "new", "trunk", "id", "n", "least", "children", "leaves", "saved", "ends")

    def __init__(self, depth: int, new: bool = True, trunk: bool = False, id: bytes | None = None):
        self.depth, self.new, self.trunk, self.id = depth, new, trunk, id
        self.n = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        self.ends = False

    def gain(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


def points(rows: Iterator[tuple[bytes, list[int], int, int]], before: int | None, after: int | None) -> Iterator[tuple]:
    """Points of sorted (key, words, n, least), all different.

    ``before`` and ``after`` are the turns that the first and last strings share with
    their neighbours in other partitions; None where there is no neighbour.
    """
    stack: list[Point] = []
    key, sums = b"", [0]

    def row(t: Point, up: Point | None) -> tuple:
        words = 0 if up is None else sums[t.depth]
        if t.trunk:  # its edge is one node; parts of it may be elsewhere
            saved = [t.saved + (t.n - t.new) * (words - (0 if up is None else sums[up.depth]))]
        else:
            t.leaves = t.leaves if t.children else 1
            saved = [t.saved + (t.n - 1) * (words - s) for s in sums[up.depth : t.depth]]
        if up is not None:
            up.gain(t.n, t.least)
            up.leaves, up.saved, up.children = up.leaves + t.leaves, up.saved + saved[0], up.children + t.new
            up.id = up.id or prefix_id(key, up.depth)
        return t.id or prefix_id(key, t.depth), t.trunk, t.depth, None if up is None else up.id, t.n, t.least, t.children, t.leaves, saved, t.ends

    def close(to: int) -> Iterator[tuple]:
        while stack[-1].depth > to:
            t = stack.pop()
            if stack[-1].depth < to:
                stack.append(Point(to))
            yield row(t, stack[-1])

    for found, words, n, least in rows:
        if not stack:
            held = before or 0
            ids = prefix_ids(found, held)
            stack += [Point(d, before is None, True, ids[d]) for d in range(held + 1)]
        else:
            yield from close(common_turns(key, found))
        key, sums = found, list(accumulate(words, initial=0))
        if stack[-1].depth < len(key) // DIGEST:
            stack.append(Point(len(key) // DIGEST))
        stack[-1].gain(n, least)
        stack[-1].ends = True
    if stack:
        have, ids = {p.depth: p for p in stack}, prefix_ids(key, after or 0)
        for d in range(1, (after or 0) + 1):
            have.setdefault(d, Point(d)).trunk = True
            have[d].id = ids[d]
        stack[:] = [have[d] for d in sorted(have)]
        yield from close(0)
        yield row(stack[0], None)


# The tree of all partitions


def bounds(sorted_parts: DataFrame) -> DataFrame:
    """(part, before, after): one row for each partition, whatever their number of rows."""
    order = Window.orderBy("part")
    edges = sorted_parts.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    met = edges.select("part", "low", "high", F.lag("high").over(order).alias("last"), F.lead("low").over(order).alias("next"))
    out = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("after", pa.int64())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        part, low, high, last, after = (c.to_pylist() for c in batch.columns)
        shared = lambda a, b: None if a is None or b is None else common_turns(a, b)
        columns = [part, [shared(*x) for x in zip(last, low, strict=True)], [shared(*x) for x in zip(high, after, strict=True)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    return map_arrow(met, run, "part int, before bigint, after bigint")


def tree_points(sorted_parts: DataFrame) -> DataFrame:
    """The points of every partition of (part, key, words, n, least)."""
    ship_package(sorted_parts.sparkSession)
    # As many rows as there are partitions, of three numbers.
    known = sorted_parts.join(F.broadcast(bounds(sorted_parts)), "part").select("part", "before", "after", "key", "words", "n", "least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = [pa.array(list(c), f.type) for c, f in zip(zip(*held, strict=True), _POINT, strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_POINT)

        for (_, before, after), group in groupby(rows, lambda r: r[:3]):
            for p in points((r[3:] for r in group), before, after):
                held.append(p)
                if len(held) == 1024:
                    yield batch()
        if held:
            yield batch()

    return known.repartition("part").sortWithinPartitions("part", "key").mapInArrow(run, _POINT_SQL)


def merged(found: DataFrame) -> DataFrame:
    """One row a point: those that several partitions hold are summed."""
    total = [F.sum(c).alias(c) for c in ("n", "children", "leaves")]
    same = [F.max(c).alias(c) for c in ("depth", "parent")]
    saved = F.array(F.sum(F.get("saved", F.lit(0)))).alias("saved")
    trunk = found.where("trunk").groupBy("id").agg(*same, *total, F.min("least").alias("least"), saved, F.max("ends").alias("ends"))
    columns = ["id", "depth", "parent", "n", "least", "children", "leaves", "saved", "ends"]
    leaves = F.when(F.col("children") == 0, F.lit(1).cast("bigint")).otherwise(F.col("leaves"))
    return trunk.select(columns).unionByName(found.where("NOT trunk").select(columns)).withColumn("leaves", leaves)


def end_digests(ended: DataFrame) -> DataFrame:
    """(id, ends_sha256) of (id, conv_id): the ids in order, joined by commas.

    Ids are packed where a range of (id, conv_id) lies, and packs of one node meet in
    one task as a stream, a digest being one pass over its bytes.
    """
    ship_package(ended.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        packs: list[tuple[bytes, int, str]] = []

        def batch() -> pa.RecordBatch:
            columns = zip(*packs, strict=True)
            out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.string()), strict=True)], names=["id", "first", "pack"])
            packs.clear()
            return out

        held = 0
        for node, group in groupby(rows, lambda r: r[0]):
            ids: list[int] = []
            for _, conv_id in group:
                ids.append(conv_id)
                if len(ids) == PACKED:
                    packs.append((node, ids[0], ",".join(map(str, ids))))
                    ids, held = [], held + PACKED
            if ids:
                packs.append((node, ids[0], ",".join(map(str, ids))))
                held += len(ids)
            if held >= PACKED:
                yield batch()
                held = 0
        if packs:
            yield batch()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        done: list[tuple[bytes, str]] = []

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], names=["id", "ends_sha256"])
            done.clear()
            return out

        for node, group in groupby(rows, lambda r: r[0]):
            state = hashlib.sha256()
            for k, (_, _, ids) in enumerate(group):
                state.update(f",{ids}".encode() if k else ids.encode())
            done.append((node, state.hexdigest()))
            if len(done) == 1024:
                yield batch()
        if done:
            yield batch()

    packed = ended.select("id", "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id").mapInArrow(pack, "id binary, first bigint, pack string")
    return packed.repartition("id").sortWithinPartitions("id", "first").mapInArrow(digest, "id binary, ends_sha256 string")


def unrolled(tree: DataFrame) -> DataFrame:
    """Every node of the trie from points with parent_least and ends_sha256: a point's edge, node by node."""
    rows = tree.select("*", F.posexplode("saved").alias("at", "saved_tokens"))
    last = F.col("at") == F.size("saved") - 1
    return rows.select(
        F.col("least").alias("conv_id"),
        (F.col("depth") - F.size("saved") + 1 + F.col("at")).cast("bigint").alias("depth"),
        F.when(F.col("at") > 0, F.col("least")).otherwise(F.col("parent_least")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(F.lit(1)).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        "saved_tokens",
        F.when(last, F.coalesce("ends_sha256", F.lit(EMPTY_ENDS))).otherwise(F.lit(EMPTY_ENDS)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations."""
    rebuilt = write_shared(sequences(conversations), "sequences")
    unique = rebuilt.groupBy("key", "words").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    dealt = unique.repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id())
    sorted_parts = write_shared(dealt, "sorted-sequences")
    found = write_shared(tree_points(sorted_parts), "tree-points")
    drop_shared(sorted_parts)
    node = F.unhex(F.substring(F.sha2(F.col("key"), 256), 1, 2 * DIGEST)).alias("id")
    tree = merged(found).join(end_digests(rebuilt.select(node, "conv_id")), "id", "left")
    known = merged(found).where("children > 0").select(F.col("id").alias("parent"), F.col("least").alias("parent_least"), F.col("children").alias("n"))
    below = spread(tree.where("parent IS NOT NULL").withColumnRenamed("n", "n_convs"), known, "parent", found.count()).drop("n").withColumnRenamed("n_convs", "n")
    top = tree.where("parent IS NULL").withColumn("parent_least", F.lit(None).cast("bigint"))
    return unrolled(top.unionByName(below))
