"""Best-fit packing of documents into sequences of several permitted lengths.

Pieces are packed in order of falling length.  A piece goes to the open bin that
it leaves least room in; if none holds it, the permitted length of least cost is
opened: the bin's own cost, less what its remaining room is worth at the best
cost per token of any length.  At the end each bin shrinks to the shortest
permitted length that holds its contents.

Rows carry (doc_id, n_tokens) only.  They are dealt by a hash of the id into
shards of about SHARD_ROWS, and each shard is packed by itself in bounded memory,
so no bin waits for another task and a hot source spreads over all shards.

Lengths are those of the tokenizer whose file is given, else words, each with an
end mark.

Defined cases: a document longer than the longest length is cut into full pieces
and a tail; null or empty texts are one token (the end mark); repeated rows are
packed each by itself; pieces of one length go in the order of their ids, a null
doc_id first; extra columns, whatever their names, are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nephos.llm.common import word_count
from nephos.llm.token_store import with_lengths
from nephos.session import ship_package

LENGTHS = (256, 512, 1024, 2048, 4096)
SHARD_ROWS = 32_768


def attention_cost(length: int, linear: float = 1.0, square: float = 1 / 8192, fixed: float = 64.0) -> float:
    """Cost of one sequence: fixed, linear and quadratic parts."""
    return fixed + linear * length + square * length * length


@dataclass
class Bin:
    """An open sequence: permitted length, tokens used, and its (piece, offset) entries."""

    length: int
    used: int
    entries: list[tuple[int, int]]


def pieces_of(n_tokens: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones and a tail."""
    return [(at, min(longest, n_tokens - at)) for at in range(0, n_tokens, longest)]


def pack(lengths: list[int], permitted: tuple[int, ...] = LENGTHS, cost=attention_cost) -> list[Bin]:
    """Bins over the indices of ``lengths``; every length is at most the longest permitted."""
    permitted = tuple(sorted(permitted))
    value = min(cost(c) / c for c in permitted)
    rooms: list[int] = []  # distinct rooms of open bins, ascending
    by_room: dict[int, list[Bin]] = {}
    bins: list[Bin] = []
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        n = lengths[i]
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
        else:
            length = min((c for c in permitted if c >= n), key=lambda c: (cost(c) - value * (c - n), c))
            b = Bin(length, 0, [])
            bins.append(b)
        b.entries.append((i, b.used))
        b.used += n
        if left := b.length - b.used:
            if left not in by_room:
                insort(rooms, left)
            by_room.setdefault(left, []).append(b)
    for b in bins:
        b.length = next(c for c in permitted if c >= b.used)
    return bins


OUT = pa.schema([(n, pa.int64()) for n in ("doc_id", "piece_start", "piece_tokens", "bin_id", "bin_offset", "bin_tokens", "bin_length")])


def _packed(rows: list[tuple[int | None, int]], permitted: tuple[int, ...], first_bin: int) -> tuple[pa.RecordBatch, int]:
    cut = [(doc, start, n) for doc, tokens in rows for start, n in pieces_of(tokens, max(permitted))]
    bins = pack([n for _, _, n in cut], permitted)
    out = [(*cut[i][:2], cut[i][2], first_bin + k, offset, b.used, b.length) for k, b in enumerate(bins) for i, offset in b.entries]
    columns = zip(*out, strict=True) if out else [[] for _ in OUT.names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=OUT), len(bins)


def pack_documents(
    docs: DataFrame,
    permitted: tuple[int, ...] = LENGTHS,
    shard_rows: int = SHARD_ROWS,
    tokenizer: str | None = None,
) -> DataFrame:
    """One row for each piece of each document: its bin, offset there, the bin's contents and length.

    Lengths are the ids of the file ``tokenizer``, or words where there is none.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, int]] = []
        bins = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for batch in batches:
            held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            while len(held) >= 2 * shard_rows:
                out, n = _packed(held[:shard_rows], permitted, bins)
                held, bins = held[shard_rows:], bins + n
                yield out
        if held:
            yield _packed(held, permitted, bins)[0]

    shards = max(1, -(-docs.select("doc_id").count() // shard_rows))
    if tokenizer is None:
        counted = docs.select("doc_id", word_count(F.col("text")).alias("n_tokens"))
    else:
        counted = with_lengths(docs.select("doc_id", "text"), tokenizer, "text", "n_tokens")
    rows = counted.select("doc_id", (F.col("n_tokens") + 1).alias("n_tokens"))
    dealt = rows.repartition(shards, F.xxhash64("doc_id", "n_tokens")).sortWithinPartitions("doc_id", "n_tokens")
    return dealt.mapInArrow(run, ", ".join(f"{n} bigint" for n in OUT.names))
