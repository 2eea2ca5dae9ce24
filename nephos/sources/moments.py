"""Ensemble moments that grow as members arrive: count, mean and squared deviations of each cell, merged pairwise.

An arrival's members are summed once and written as a part; a commit names the part
and its members (``commits``), so a member that comes again changes nothing, and no
earlier member is read again.  Readers merge the parts of a cell by the pairwise
formula; ``compact`` replaces the parts by one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.operators.ensemble import CELL
from nephos.sources.commits import CommitLog


def pairwise(a: Column, b: Column) -> Column:
    """The state (n, mean, m2) of two states' values together."""
    n = a["n"] + b["n"]
    gap = b["mean"] - a["mean"]
    mean = a["mean"] + gap * b["n"] / n
    m2 = a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n
    return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2")))


class MomentStore:
    """Moments of ``value`` by ``cell`` below ``path``, over the members merged so far."""

    def __init__(self, spark: SparkSession, path: str, cell: Sequence[str] = CELL):
        self.spark, self.path, self.cell = spark, path.rstrip("/"), list(cell)
        self.log = CommitLog(spark, f"{self.path}/log")

    def _state(self) -> dict[str, Any]:
        """Members merged and parts that hold them: every commit has both, so the last one tells."""
        versions = self.log.versions()
        return {"version": 0, "members": [], "parts": []} if not versions else self.log.get(versions[-1]) | {"version": versions[-1]}

    def members(self) -> list[int]:
        return sorted(self._state()["members"])

    def missing(self, expected: Iterable[int]) -> list[int]:
        """The expected members that have not come."""
        return sorted(set(expected) - set(self._state()["members"]))

    def _write(self, summed: DataFrame) -> str:
        part = uuid.uuid4().hex
        summed.write.parquet(f"{self.path}/part/{part}")
        return part

    def merge(self, arrived: DataFrame) -> list[int]:
        """Add members (cell, member, value) that were not there; which ones. Nulls are no values, as in one pass over all."""
        # At most one number a member comes to the driver.
        came = sorted(r[0] for r in arrived.select("member").distinct().collect())
        while True:
            state = self._state()
            new = [m for m in came if m not in set(state["members"])]
            if not new:
                return []
            v = F.col("value").cast("double")
            square = F.coalesce(F.var_pop(v) * F.count(v), F.lit(0.0))
            sums = [F.count(v).alias("n"), F.coalesce(F.avg(v), F.lit(0.0)).alias("mean"), square.alias("m2")]
            part = self._write(arrived.where(F.col("member").isin(new)).groupBy(*self.cell).agg(*sums))
            if self.log.put(state["version"] + 1, {"members": sorted({*state["members"], *new}), "parts": [*state["parts"], part]}):
                return new
            self._drop([part])  # another arrival was first; it may have brought some of these

    def _drop(self, parts: Iterable[str]) -> None:
        for part in parts:
            fs, p = self.log._fs(f"{self.path}/part/{part}")
            fs.delete(p, True)

    def _merged(self, parts: Sequence[str]) -> DataFrame:
        """One state a cell; as many states meet as there are parts."""
        numbers = ", ".join(f"{c} {'string' if c == 'var' else 'int'}" for c in self.cell)
        rows = self.spark.read.parquet(*[f"{self.path}/part/{p}" for p in parts]) if parts else self.spark.createDataFrame([], f"{numbers}, n bigint, mean double, m2 double")
        state = F.struct("n", "mean", "m2")
        none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
        # In order of their values, so a cell's sums do not depend on which part was read first.
        states = rows.groupBy(*self.cell).agg(F.array_sort(F.collect_list(state)).alias("_states"))
        return states.select(*self.cell, F.aggregate("_states", none, pairwise).alias("_s")).select(*self.cell, "_s.*")

    def read(self) -> DataFrame:
        """(cell, n, mean, sd) over all members so far; one value has no deviation, none has no mean either."""
        n = F.col("n")
        rows = self._merged(self._state()["parts"])
        return rows.select(*self.cell, n, F.when(n > 0, F.col("mean")).alias("mean"), F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("sd"))

    def compact(self) -> bool:
        """All parts as one; False if there is nothing to do or an arrival came in between."""
        state = self._state()
        if len(state["parts"]) < 2:
            return False
        part = self._write(self._merged(state["parts"]))
        if self.log.put(state["version"] + 1, {"members": state["members"], "parts": [part]}):
            self._drop(state["parts"])
            return True
        self._drop([part])
        return False
