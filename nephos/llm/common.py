"""Shared pieces of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.session import ship_package

#: White space of the word rules: space and the controls 9 to 13.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for ``body``.

    Inside a higher-order function a column expression is evaluated again for
    every element; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Array of the maximal runs of characters outside SPACE_CLASS."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, without building a filtered array: split, less empty ends."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_CLASS)
    return let(
        parts,
        lambda p: F.size(p)
        - (F.element_at(p, 1) == "").cast("int")
        - ((F.size(p) > 1) & (F.element_at(p, -1) == "")).cast("int"),
    ).cast("long")


#: A key is hot that one row in so many holds; there are at most as many hot keys.
SHARE = 1000


def spread(rows: DataFrame, known: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to ``known``, one row a key with ``n``, the rows that hold it.

    Keys of at least one row in SHARE of ``total``, at most SHARE keys, are broadcast,
    so no task gets a hot key's rows; the others shuffle.
    """
    hot = F.broadcast(known.where(F.col("n") * SHARE >= total))
    cold = rows.join(F.broadcast(known.where(F.col("n") * SHARE >= total).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(cold.join(known.where(F.col("n") * SHARE < total), key))


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over every Arrow batch; batches stay within Spark's batch limits."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


#: Tasks in which the states of all tasks meet before they meet in one.
GROUPS = 16
_STATES = "part int, key string, sums array<double>"


def _states(part: int, held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for key in sorted(held):
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([key]), pa.array([held[key].tolist()], pa.list_(pa.float64()))], names=["part", "key", "sums"])


def gather_states(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, np.ndarray]], rows: int = 512) -> DataFrame:
    """(part, key, sums): for each task the sums by key of what ``fn`` makes of its batches, so many rows at a time."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                for key, sums in fn(batch.slice(first, rows)).items():
                    if key in held:
                        held[key] += sums
                    else:
                        held[key] = np.array(sums, np.float64)
        yield from _states(TaskContext.get().partitionId(), held)

    return df.mapInArrow(run, _STATES)


def summed_states(states: DataFrame) -> dict[str, np.ndarray]:
    """The sums by key of all tasks, added in the order of the partitions; as many vectors as there are keys reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        part = 0
        for batch in batches:
            part = batch.column(0)[0].as_py() if batch.num_rows and not held else part
            for key, sums in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                vector = sums.values.to_numpy()
                if key in held:
                    held[key] += vector
                else:
                    held[key] = vector.copy()
        yield from _states(part, held)

    met = states.repartition(GROUPS, F.col("part") % GROUPS).sortWithinPartitions("part", "key").mapInArrow(run, _STATES)
    last = met.repartition(1).sortWithinPartitions("part", "key").mapInArrow(run, _STATES)
    return {r["key"]: np.array(r["sums"]) for r in last.collect()}


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Row slices of ``batch`` whose ``column`` holds about ``most_bytes``, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)
