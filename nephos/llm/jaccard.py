"""N-gram Jaccard join by MinHash banding.

Texts are equal up to their words' order of five-word shingles; two different
texts are linked when the Jaccard similarity of their full shingle sets is at
least the threshold.  The steps, every one a distributed join or aggregate:

1.  one Python pass makes a signature and its band keys for each document;
    equal texts then become one node;
2.  band keys are shuffled; a bucket with two nodes or more gives candidates:
    each member against up to three centres (least, greatest and middle of a
    hash order), never all pairs of the bucket;
3.  candidates are verified on the full shingle sets of their whole texts;
4.  components of the verified links; whatever in a bucket is not yet in its
    centre's component (the rest) is verified as a query set against all members
    of that bucket, block by block, so no bucket keeps an untested pair between
    two components;
5.  components again.  A class is a component; its id is its least doc_id;
6.  the links of each member are counted: linked texts are in one class, so each
    class meets itself block by block, as counts and never as pairs.

Finding the classes costs O(m) candidates for a group of m near copies, as its
members meet in their centre's component; counting their links costs m * m
comparisons in matrix products.  ``n_links`` is the number of different texts in
the class that reach the threshold with a document's text, plus its copies.

Defined cases: a null text counts as empty; texts with no word link to nothing
but their equals; under five words the whole text is one shingle; very long texts
are compared whole; repeated rows and copies get the same class; rows with a null
doc_id are kept, and a class of only such rows has a null id; extra columns,
whatever their names, are ignored by the join and kept by ``keep_one``; an empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephos.llm.common import SPACE_CLASS, map_arrow
from nephos.session import drop_shared, write_shared

SHINGLE = 5
THRESHOLD = 0.8
#: Chance at least that a pair just at the threshold shares a band.
TARGET_RECALL = 0.9999
#: Text of one block of a group, about.
BLOCK_BYTES = 131_072
_SPACES = re.compile(SPACE_CLASS)


def band_plan(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, most_hashes: int = 160) -> tuple[int, int]:
    """(bands, rows): the most rows a band, hence the fewest false candidates, within the hash budget."""
    best = None
    for rows in range(1, most_hashes + 1):
        p = threshold**rows
        bands = 1 if p >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log1p(-p)))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no band plan within the hash budget reaches the target recall")
    return best


def words(text: str | None) -> list[str]:
    return [w for w in _SPACES.split(text or "") if w]


def shingle_set(text: str | None, size: int = SHINGLE) -> set[tuple[str, ...]]:
    """The full set of word n-grams; a shorter text is one shingle, an empty one has none."""
    w = words(text)
    if len(w) <= size:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(size)), strict=False))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: xor-shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Signer:
    """Band keys of a text's shingles."""

    def __init__(self, bands: int, rows: int, size: int = SHINGLE, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda n: rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.bands, self.rows, self.size = bands, rows, size
        self.places, self.a, self.b = draw(size), draw(bands * rows), draw(bands * rows)
        self.mix, self.salt = draw(rows), draw(bands)

    def keys(self, text: str | None) -> list[int]:
        s = shingle_hashes(text, self.places)
        if not len(s):
            return []
        least = np.full(self.bands * self.rows, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(s), 1024):
            np.minimum(least, (s[at : at + 1024, None] * self.a + self.b).min(axis=0), out=least)
        banded = (least.reshape(self.bands, self.rows) * self.mix).sum(axis=1, dtype=np.uint64)
        return _mixed(banded ^ self.salt).view(np.int64).tolist()


def _node(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def signatures(docs: DataFrame, bands: int, rows: int, size: int) -> DataFrame:
    """(doc_id, node, keys) of every document; node identifies the text."""
    schema = "doc_id bigint, node binary, keys array<bigint>"
    out = pa.schema([("doc_id", pa.int64()), ("node", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def sign(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        signer = Signer(bands, rows, size)
        keys = [signer.keys(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.binary()), pa.array(keys, pa.list_(pa.int64()))], schema=out
        )

    return map_arrow(docs.select("doc_id", _node("text").alias("node"), "text"), sign, schema)


def verified(pairs: DataFrame, texts: DataFrame, threshold: float, size: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full shingle sets reach the threshold."""

    def verify(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        last, first = None, set()
        keep = []
        for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if tb != last:
                last, first = tb, shingle_set(tb, size)
            keep.append(similar(first, shingle_set(ta, size), threshold))
        yield batch.select([0, 1]).filter(pa.array(keep))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return map_arrow(joined, verify, "a binary, b binary")


def shingle_hashes(text: str | None, places: np.ndarray) -> np.ndarray:
    """The sorted 64-bit hashes of a text's shingles."""
    w, size = words(text), len(places)
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    n = max(1, len(w) - size + 1)
    s = np.zeros(n, np.uint64)
    for i in range(min(size, len(w))):
        s += h[i : i + n] * places[i]
    return np.unique(_mixed(s))


def overlaps(left: list[np.ndarray], right: list[np.ndarray], tile: int = 2048) -> np.ndarray:
    """Sizes of the intersections of all left sets with all right sets: tiled incidence products."""
    out = np.zeros((len(left), len(right)), np.float32)
    sides = []
    for sets in (left, right):
        rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        sides.append((rows, np.concatenate(sets)))
    common = np.intersect1d(sides[0][1], sides[1][1])
    for at in range(0, len(common), tile):
        part = common[at : at + tile]
        grids = []
        for (rows, tokens), sets in zip(sides, (left, right), strict=True):
            place = np.minimum(np.searchsorted(part, tokens), len(part) - 1)
            hit = part[place] == tokens
            grid = np.zeros((len(sets), len(part)), np.float32)
            grid[rows[hit], place[hit]] = 1
            grids.append(grid)
        out += grids[0] @ grids[1].T
    return out


def block_links(left: list[dict], right: list[dict], threshold: float, size: int, places: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """A verified link from each left member to each component on the right that it reaches."""
    sets = [[shingle_hashes(m["text"], places) for m in side] for side in (left, right)]
    both = overlaps(*sets)
    sizes = [np.array([len(x) for x in side], np.float32) for side in sets]
    near = (both > 0) & (both >= threshold * (sizes[0][:, None] + sizes[1][None, :] - both) - 0.5)
    for i, a in enumerate(left):
        reached = {a["label"]}
        for j in np.flatnonzero(near[i]):
            b = right[j]
            if b["label"] not in reached and similar(shingle_set(a["text"], size), shingle_set(b["text"], size), threshold):
                reached.add(b["label"])
                yield max(a["node"], b["node"]), min(a["node"], b["node"])


def similar(a: set, b: set, threshold: float) -> bool:
    """Whether the Jaccard similarity of two sets reaches the threshold; empty sets are similar to none."""
    both = len(a & b)
    return bool(both) and both >= threshold * (len(a) + len(b) - both)


def block_degrees(left: list[dict], right: list[dict], threshold: float, size: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many of the right texts each left one is similar to, and the other way round; no text counts itself."""
    sets = [[shingle_hashes(m["text"], places) for m in side] for side in (left, right)]
    both = overlaps(*sets).astype(np.float64)
    sizes = [np.array([len(x) for x in side], np.float64) for side in sets]
    near = (both > 0) & (both >= threshold * (sizes[0][:, None] + sizes[1][None, :] - both))
    at = {m["node"]: j for j, m in enumerate(right)}
    for i, m in enumerate(left):
        if m["node"] in at:
            near[i, at[m["node"]]] = False
    return near.sum(axis=1), near.sum(axis=0)


class Scratch:
    """Tables of one run in the shared folder, dropped together once nothing reads them."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def write(self, df: DataFrame, label: str) -> DataFrame:
        self.tables.append(write_shared(df, label))
        return self.tables[-1]

    def drop(self, *tables: DataFrame) -> None:
        """Drop some tables, or all that are left."""
        for df in tables or tuple(self.tables):
            drop_shared(df)
            self.tables = [t for t in self.tables if t is not df]


def blocked(groups: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(main, block, members) of the groups (main, node, label), in blocks of about BLOCK_BYTES of text."""
    sizes = groups.join(texts.select("node", F.octet_length("text").alias("size")), "node")
    shares = scratch.write(sizes.groupBy("main").agg(F.greatest(F.ceil(F.sum("size") / BLOCK_BYTES), F.lit(1)).alias("n_blocks")), "shares")
    return scratch.write(
        groups.join(shares, "main")
        .select("main", "node", "label", F.pmod(F.xxhash64("node"), "n_blocks").alias("block"))
        .join(texts, "node")
        .groupBy("main", "block")
        .agg(F.collect_list(F.struct("node", "label", "text")).alias("members")),
        "blocks",
    )


def link_degrees(classes: DataFrame, texts: DataFrame, threshold: float, size: int, scratch: Scratch) -> DataFrame:
    """(node, degree) of the members of classes (node, label): how many texts of its class each is similar to.

    Every block of a class meets itself and each later one; a block pair yields
    one count for each of its members.
    """
    blocks = blocked(classes.select(F.col("label").alias("main"), "node", "label"), texts, scratch)
    schema = pa.schema([("node", pa.binary()), ("n", pa.int64())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        places = Signer(1, 1, size).places
        found: Counter = Counter()
        for row in range(batch.num_rows):
            left, right = batch.column(1)[row].as_py(), batch.column(2)[row].as_py()
            ahead, back = block_degrees(left, right, threshold, size, places)
            found.update({m["node"]: int(n) for m, n in zip(left, ahead, strict=True)})
            if not batch.column(0)[row].as_py():
                found.update({m["node"]: int(n) for m, n in zip(right, back, strict=True)})
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], schema=schema)

    tasks = 4 * classes.sparkSession.sparkContext.defaultParallelism
    left = blocks.select("main", F.col("block").alias("query"), F.col("members").alias("left"))
    pairs = left.join(blocks, "main").where("query <= block").repartition(tasks, "main", "query", "block")
    counted = map_arrow(pairs.select((F.col("query") == F.col("block")).alias("same"), "left", "members"), run, "node binary, n bigint")
    return counted.groupBy("node").agg(F.sum("n").alias("degree"))


def rest_links(groups: DataFrame, texts: DataFrame, threshold: float, size: int, scratch: Scratch) -> DataFrame:
    """Links between the components of each group (main, node, label).

    The rest, members outside the main component, is the query set; it meets the
    group's members block by block.  Blocks hold about BLOCK_BYTES of text, so a
    hot group becomes many block pairs that any executor may take, and a block
    pair yields at most one link for each query and component.
    """
    blocks = blocked(groups, texts, scratch)
    rest = F.filter("members", lambda m: m["label"] != F.col("main"))
    queries = blocks.select("main", F.col("block").alias("query"), rest.alias("rest")).where("size(rest) > 0")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        places = Signer(1, 1, size).places
        found: set[tuple[bytes, bytes]] = set()
        for row in range(batch.num_rows):
            found.update(block_links(batch.column(0)[row].as_py(), batch.column(1)[row].as_py(), threshold, size, places))
        columns = [pa.array([p[k] for p in sorted(found)], pa.binary()) for k in range(2)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    # A block pair is much work for its bytes, so pairs are dealt by number, not by size.
    tasks = 4 * groups.sparkSession.sparkContext.defaultParallelism
    pairs = queries.join(blocks, "main").repartition(tasks, "main", "query", "block")
    return map_arrow(pairs.select("rest", "members"), run, "a binary, b binary").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b); label is the least node of its component.

    Labels fall to the neighbours' least, then to their label's own label, until
    nothing changes; each round is written to the shared folder.
    """
    both = write_shared(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = write_shared(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        fallen = write_shared(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low")), "fallen")
        upper = fallen.select(F.col("node").alias("low"), F.col("low").alias("top"))
        step = write_shared(fallen.join(upper, "low").select("node", F.col("label").alias("old"), F.least("low", "top").alias("label")), "labels")
        drop_shared(fallen)
        drop_shared(labels)
        labels = step.select("node", "label")
        if step.where(F.col("old") != F.col("label")).isEmpty():
            drop_shared(both)
            return labels


def similarity_classes(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    recall: float = TARGET_RECALL,
) -> DataFrame:
    """doc_id, class_id, n_links and n_copies: one row for each row of ``docs``."""
    signed, classes = _classes(docs, threshold, size, recall, count_links=True)
    return signed.join(classes, "node").select("doc_id", "class_id", "n_links", "n_copies")


def _classes(docs: DataFrame, threshold: float, size: int, recall: float, count_links: bool = False) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row, and the label, least doc_id, class and copies of every node; its links if asked."""
    bands, rows = band_plan(threshold, recall)
    scratch = Scratch()
    signed = write_shared(signatures(docs, bands, rows, size), "signed")
    nodes = scratch.write(
        signed.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n_copies"), F.first("keys").alias("keys")), "nodes"
    )
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    buckets = scratch.write(
        keyed.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("node").alias("low"),
            F.max("node").alias("high"),
            F.min_by("node", F.xxhash64("node")).alias("middle"),
        )
        .where("n > 1")
        .select("key", F.array_distinct(F.array("low", "high", "middle")).alias("centres")),
        "buckets",
    )
    members = scratch.write(keyed.join(buckets, "key"), "members")
    scratch.drop(buckets)
    tested = scratch.write(
        members.select("node", F.explode("centres").alias("centre"))
        .where("node != centre")
        .select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b"))
        .distinct(),
        "tested",
    )
    wanted = members.select("node").distinct().join(nodes.select("node", "least_id"), "node")
    texts = scratch.write(
        docs.select("doc_id", "text", _node("text").alias("own"))
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("least_id")) & (F.col("own") == F.col("node")))
        .select("node", "text")
        .dropDuplicates(["node"]),
        "texts",
    )
    links = scratch.write(verified(tested, texts, threshold, size), "links")
    labels = components(links)
    scratch.tables.append(labels)

    # What a bucket's first centre has not gathered, against the bucket's other components.
    label_of = lambda c: F.coalesce("label", c)
    gathered = scratch.write(
        members.select("node", F.element_at("centres", 1).alias("centre"))
        .distinct()
        .join(labels, "node", "left")
        .select("node", "centre", label_of("node").alias("own"))
        .join(labels.withColumnRenamed("node", "centre"), "centre", "left")
        .select(label_of("centre").alias("main"), "node", F.col("own").alias("label"))
        .distinct(),
        "gathered",
    )
    unfinished = scratch.write(gathered.where("label != main").select("main").distinct(), "unfinished")
    groups = scratch.write(gathered.join(unfinished, "main", "left_semi"), "groups")
    late = scratch.write(rest_links(groups, texts, threshold, size, scratch), "late")
    found = links.union(late).distinct()
    labels = components(found)
    scratch.tables.append(labels)
    scratch.drop(members, tested, gathered, unfinished, groups)

    classed = nodes.select("node", "least_id", "n_copies").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # Written first, so that both sides of the join are dealt anew and a hot class can be split.
    ids = scratch.write(classed.groupBy("label").agg(F.min("least_id").alias("class_id")), "class-ids")
    per_node = classed.join(ids, "label")
    if count_links:
        # The two members of a pair are linked; larger classes are counted.
        sized = scratch.write(labels.join(scratch.write(labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "class-sizes"), "label"), "sized")
        counted = link_degrees(sized.where("n > 2").select("node", "label"), texts, threshold, size, scratch)
        degree = scratch.write(counted.union(sized.where("n = 2").select("node", F.lit(1).cast("long"))), "degrees")
        per_node = per_node.join(degree, "node", "left").withColumn("n_links", F.coalesce("degree", F.lit(0)) + F.col("n_copies") - 1).drop("degree")
    per_node = write_shared(per_node, "classes")
    scratch.drop()
    return signed.select("doc_id", "node"), per_node


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = TARGET_RECALL) -> DataFrame:
    """One row of each similarity class, that of its least doc_id; all columns of ``docs``.

    Rows without a doc_id come after the others, equal ids are told apart by their
    text, and of repeated rows one stays.
    """
    signed, classes = _classes(docs, threshold, size, recall)
    first = classes.groupBy("label").agg(F.min(F.struct(F.col("least_id").isNull().alias("late"), "least_id", "node")).alias("f"))
    firsts = first.select(F.col("f.least_id").alias("_id"), F.col("f.node").alias("_node"))
    equal = signed.groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("_n"))
    same = (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    chosen = write_shared(equal.join(firsts, same).select("_id", "_node", "_n"), "chosen")
    drop_shared(classes)
    drop_shared(signed)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_own"), _node("text").alias("_text_node"))
    kept = whole.join(chosen, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_text_node") == F.col("_node")))
    once, repeated = kept.where("_n = 1"), kept.where("_n > 1").dropDuplicates(["_own", "_text_node"])
    return once.select("_row.*").unionByName(repeated.select("_row.*"))
