"""Nearest grid points by a quad-tree that splits where points are dense, and windows of a grid around them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephos.operators.joins import small
from nephos.session import write_shared

#: A cell with more points than this is split; cells each way into which it is split, and splits at most.
LEAF, SIDE_BITS, MOST_DEPTH = 64, 2, 10
ROOT = 0


def _node(level: int, x: Column, y: Column) -> Column:
    """One number for a cell of a level."""
    return F.shiftleft(F.lit(level).cast("bigint"), 56).bitwiseOR(F.shiftleft(x, 28)).bitwiseOR(y)


def _far(p: Column, low: Column, high: Column) -> Column:
    """The greatest distance of ``p`` to a point of an interval."""
    return F.greatest(F.abs(p - low), F.abs(p - high))


def _near(p: Column, low: Column, high: Column) -> Column:
    """The least distance of ``p`` to a point of an interval."""
    return F.greatest(low - p, p - high, F.lit(0.0))


class QuadTree:
    """A tree over ``grid`` (ix, iy, glon, glat): tables of nodes by parent and of points by leaf, in the shared folder."""

    def __init__(self, grid: DataFrame):
        points = grid.where("glon IS NOT NULL AND glat IS NOT NULL AND NOT isnan(glon) AND NOT isnan(glat)").groupBy("glon", "glat").agg(F.min(F.struct("ix", "iy")).alias("at"))
        low_x, high_x, low_y, high_y, self.n = points.agg(F.min("glon"), F.max("glon"), F.min("glat"), F.max("glat"), F.count(F.lit(1))).first()
        if not self.n:
            return
        top = float(1 << (SIDE_BITS * MOST_DEPTH))
        cell = lambda c, low, high: F.least(F.floor((F.col(c) - low) / (high - low or 1.0) * top), F.lit(top - 1)).cast("bigint")
        placed = points.withColumns({"_x": cell("glon", low_x, high_x), "_y": cell("glat", low_y, high_y)})
        at = lambda level: [F.shiftright(c, SIDE_BITS * (MOST_DEPTH - level)) for c in ("_x", "_y")]
        placed = write_shared(placed.withColumn("_leaf", F.lit(None).cast("bigint")), "tree-points")
        self.levels: list[DataFrame] = []
        waiting, leaves = placed, []
        for level in range(1, MOST_DEPTH + 1):
            sides = [F.min("glon").alias("x0"), F.max("glon").alias("x1"), F.min("glat").alias("y0"), F.max("glat").alias("y1")]
            parent = F.lit(ROOT).cast("bigint") if level == 1 else _node(level - 1, *at(level - 1))
            marked = waiting.withColumns({"_node": _node(level, *at(level)), "_parent": parent})
            cells = write_shared(marked.groupBy("_parent", "_node").agg(F.count(F.lit(1)).alias("n"), *sides), "tree-cells")
            whole = F.col("n") <= LEAF if level < MOST_DEPTH else F.lit(True)
            child = F.struct(F.col("_node").alias("node"), whole.alias("leaf"), "x0", "x1", "y0", "y1")
            self.levels.append(cells.groupBy("_parent").agg(F.collect_list(child).alias("children")))
            kept = small(cells.where(whole).select("_node"))
            leaves.append(marked.join(kept, "_node", "left_semi").select(F.col("_node").alias("leaf"), "glon", "glat", "at"))
            if cells.where(~whole).isEmpty():
                break
            split = small(cells.where(~whole).select("_node"))
            waiting = marked.join(split, "_node", "left_semi").drop("_node", "_parent")
        held = reduce(DataFrame.union, leaves).groupBy("leaf").agg(F.collect_list(F.struct("glon", "glat", "at")).alias("spots"))
        self.leaves = write_shared(held, "tree-leaves")

    def nearest(self, places: DataFrame, turns: Sequence[float] = (0.0,)) -> DataFrame:
        """(lon, lat, best): the least (squared distance, ix, iy) of each of the different places (lon, lat), none null, in any of ``turns`` added to lon.

        A place carries the cells, by turn, that may hold its nearest grid point: those
        no further than the least greatest distance to any cell in any turn.  Level by
        level they are exchanged for their children, at last for the grid points in them.
        """
        at, y = ["lon", "lat"], F.col("lat")
        square = lambda dx, dy: dx * dx + dy * dy
        x = lambda c: F.col("lon") + c["turn"]
        least = lambda c: square(_near(x(c), c["x0"], c["x1"]), _near(y, c["y0"], c["y1"]))
        most = lambda c: square(_far(x(c), c["x0"], c["x1"]), _far(y, c["y0"], c["y1"]))
        bounded = lambda c: F.least(F.col("bound"), F.coalesce(F.array_min(F.transform(c, most)), F.lit(math.inf)))
        hopeful = lambda c: F.filter(c, lambda k: least(k) <= F.col("bound"))
        nodes = lambda c, kind: F.transform(c, lambda k: F.struct(k["turn"].alias("turn"), k["node"].alias("node"), *kind(k)))
        roots = F.array(*[F.struct(F.lit(t).alias("turn"), F.lit(ROOT).cast("bigint").alias("node")) for t in turns])
        # All levels keep to this one exchange, which isn't made smaller: few bytes are much work.
        spread = places.repartition(int(places.sparkSession.conf.get("spark.sql.shuffle.partitions")), *at)
        front = spread.withColumns({"open": roots, "done": F.array().cast("array<struct<turn:double,node:bigint,least:double>>"), "bound": F.lit(math.inf)})
        for level in self.levels:
            asked = front.select(*at, "done", "bound", F.explode_outer("open").alias("_o")).select(*at, "done", "bound", F.col("_o.turn").alias("_turn"), F.col("_o.node").alias("_parent"))
            child = lambda c: F.struct(F.col("_turn").alias("turn"), *[c[n].alias(n) for n in ("node", "leaf", "x0", "x1", "y0", "y1")])
            met = asked.join(small(level), "_parent", "left").withColumn("_c", F.transform(F.coalesce("children", F.array().cast(level.schema["children"].dataType)), child))
            own = met.withColumn("bound", bounded("_c")).withColumn("_c", hopeful("_c"))
            met = own.groupBy(*at).agg(F.first("done").alias("done"), F.min("bound").alias("bound"), F.flatten(F.collect_list("_c")).alias("_c")).withColumn("_c", hopeful("_c"))
            done = F.concat("done", nodes(F.filter("_c", lambda c: c["leaf"]), lambda k: [least(k).alias("least")]))
            front = met.select(*at, "bound", done.alias("done"), nodes(F.filter("_c", lambda c: ~c["leaf"]), lambda k: []).alias("open"))
        asked = front.select(*at, F.explode(F.filter("done", lambda d: d["least"] <= F.col("bound"))).alias("_d")).select(*at, F.col("_d.turn").alias("turn"), F.col("_d.node").alias("leaf"))
        best = F.array_min(F.transform("spots", lambda s: F.struct(square(F.col("lon") + F.col("turn") - s["glon"], y - s["glat"]).alias("d2"), s["at"]["ix"].alias("ix"), s["at"]["iy"].alias("iy"))))
        return asked.join(small(self.leaves), "leaf").select(*at, best.alias("_b")).groupBy(*at).agg(F.min("_b").alias("best"))


def nearest_point(points: DataFrame, grid: DataFrame, key: str = "obs_id", wrap: bool = False) -> DataFrame:
    """(key, ix, iy, d2): the grid point of least squared distance in degrees, ties by (ix, iy).

    With ``wrap`` the shorter way round the globe counts.  Points without a place, or
    an empty grid, give nulls.  Each different place goes through the tree once,
    whatever the number of points there, and is met by its points in one join.
    """
    tree = QuadTree(grid)
    placed = F.col("longitude").isNotNull() & F.col("latitude").isNotNull() & ~F.isnan("longitude") & ~F.isnan("latitude")
    kinds = {c: grid.schema[c].dataType for c in ("ix", "iy")}
    nulls = [*[F.lit(None).cast(kinds[c]).alias(c) for c in ("ix", "iy")], F.lit(None).cast("double").alias("d2")]
    if not tree.n:
        return points.select(key, *nulls)
    rows = points.where(placed).select(F.col(key).alias("_key"), F.col("longitude").cast("double").alias("lon"), F.col("latitude").cast("double").alias("lat"))
    best = tree.nearest(rows.select("lon", "lat").distinct(), (0.0, -360.0, 360.0) if wrap else (0.0,))
    found = rows.join(small(write_shared(best, "nearest-places")), ["lon", "lat"]).select(F.col("_key").alias(key), "best.ix", "best.iy", "best.d2")
    return found.unionByName(points.where(~F.coalesce(placed, F.lit(False))).select(key, *nulls))


def index_window(centres: DataFrame, grid: DataFrame, size: int = 15, key: str = "obs_id") -> DataFrame:
    """(key, the grid's columns): the grid points at most ``size`` indices from each centre (key, ix, iy), each way; the grid's edges cut windows off."""
    around = F.sequence(F.lit(-size), F.lit(size))
    asked = centres.select(key, "ix", "iy").withColumn("_dx", F.explode(around)).withColumn("_dy", F.explode(around))
    return asked.select(key, (F.col("ix") + F.col("_dx")).cast(grid.schema["ix"].dataType).alias("ix"), (F.col("iy") + F.col("_dy")).cast(grid.schema["iy"].dataType).alias("iy")).join(grid, ["ix", "iy"])


def seen_in_window(obs: DataFrame, window: DataFrame, pad: float = 0.05) -> DataFrame:
    """Observations within the window's latitudes and longitudes, widened by ``pad`` of their spans."""
    ends = window.agg(*[f(c).alias(f"_{n}_{c}") for c in ("glat", "glon") for n, f in (("low", F.min), ("high", F.max))])
    within = lambda c, g: (F.col(c) >= F.col(f"_low_{g}") - pad * (F.col(f"_high_{g}") - F.col(f"_low_{g}"))) & (F.col(c) <= F.col(f"_high_{g}") + pad * (F.col(f"_high_{g}") - F.col(f"_low_{g}")))
    # One row.
    return obs.join(F.broadcast(ends)).where(within("latitude", "glat") & within("longitude", "glon")).select(obs.columns)
