"""Gridded ensembles: mean and spread, perturbations, smoothing, dilation, arrays."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nephos.functions.columns import edge_taper, standard_normal
from nephos.operators.joins import small

CELL = ("var", "t_idx", "ix", "iy", "iz")


def mean_spread(grid: DataFrame, cell: Sequence[str] = CELL) -> DataFrame:
    """Mean and sample deviation over the members there are; one member has no deviation."""
    return grid.groupBy(*cell).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))


def difference(analysis: DataFrame, forecast: DataFrame, cell: Sequence[str] = CELL) -> DataFrame:
    """Analysis minus forecast, cell by cell."""
    return analysis.select(*cell, F.col("value").alias("_a")).join(forecast.select(*cell, "value"), list(cell)).select(*cell, (F.col("_a") - F.col("value")).alias("value"))


def align_or_last(forecast: DataFrame, analysis: DataFrame) -> DataFrame:
    """The forecast frame of each analysis time, or the last one where it has none."""
    last = forecast.agg(F.max("t").alias("_last"))
    have = forecast.select("t").distinct().withColumn("_hit", F.lit(True))
    return analysis.join(small(have), "t", "left").join(F.broadcast(last)).select("t", F.when(F.col("_hit"), F.col("t")).otherwise(F.col("_last")).alias("frame_t"))


def normalise_members(grid: DataFrame, mean: float, sd: float, low: float | None = None, high: float | None = None) -> DataFrame:
    """Each member's field to a given mean and population deviation, then clamped."""
    stats = grid.groupBy("member").agg(F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"))
    v = (F.col("value") - F.col("_m")) / F.col("_s") * sd + mean
    v = v if low is None else F.greatest(v, F.lit(float(low)))
    v = v if high is None else F.least(v, F.lit(float(high)))
    # One row a member.
    return grid.join(F.broadcast(stats), "member").withColumn("value", v).drop("_m", "_s")


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[float]:
    radius = int(truncate * sigma + 0.5)
    w = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    return [x / sum(w) for x in w]


def reflect(i: Column, n: Column) -> Column:
    """Indices mirrored at the edges, the edge cell repeated: (d c b a | a b c d | d c b a)."""
    r = F.pmod(i, 2 * n)
    return F.when(r < n, r).otherwise(2 * n - 1 - r)


def smooth_axis(grid: DataFrame, axis: str, n: int | None, sigma: float, keys: Sequence[str]) -> DataFrame:
    """Gaussian smoothing along one axis of ``n`` cells, or of as many as each line has: a row of cells becomes an array, each cell a weighted sum."""
    w = gaussian_weights(sigma)
    radius = len(w) // 2
    others = [k for k in keys if k != axis]
    line = grid.groupBy(*others).agg(F.transform(F.array_sort(F.collect_list(F.struct(axis, "value"))), lambda p: p["value"]).alias("_line"))
    weights = F.array(*[F.lit(x) for x in w])
    length = F.size("_line") if n is None else F.lit(n)

    def cell(i: Column) -> Column:
        parts = F.transform(weights, lambda x, k: x * F.get(F.col("_line"), reflect(i + k - radius, length).cast("int")))
        return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)

    cells = F.transform(F.sequence(F.lit(0), length - 1), cell)
    return line.select(*others, F.posexplode(cells).alias(axis, "value"))


def perturbation_fields(
    spark: SparkSession,
    members: int,
    nx: int,
    ny: int,
    mean: float,
    sd: float,
    sigma: float = 2.5,
    boundary: int = 0,
    low: float | None = None,
    high: float | None = None,
    seed: int = 0,
) -> DataFrame:
    """Spatially correlated random fields (member, ix, iy, value) of a given mean and deviation.

    Noise of N(1, 10), 1 in the border, smoothed along both axes with mirrored
    edges, normalised by member.  A cell's noise follows from seed and place alone,
    whatever the partitions.
    """
    n = members * nx * ny
    i = F.col("id")
    noise = spark.range(0, n, 1, max(1, n // 1_000_000 + 1)).select(
        F.floor(i / (nx * ny)).cast("int").alias("member"), F.floor(i / ny % nx).cast("int").alias("ix"), (i % ny).cast("int").alias("iy"), (1 + 10 * standard_normal(i, seed)).alias("value")
    )
    noise = set_boundary(noise, nx, ny, boundary, 1.0)
    keys = ("member", "ix", "iy")
    smooth = smooth_axis(smooth_axis(noise, "ix", nx, sigma, keys), "iy", ny, sigma, keys)
    return normalise_members(smooth, mean, sd, low, high)


def set_boundary(grid: DataFrame, nx: int, ny: int, width: int, value: float) -> DataFrame:
    """A constant in ``width`` border cells of each axis that has twice as many cells."""
    edge = lambda c, n: ((F.col(c) < width) | (F.col(c) >= n - width)) if width and n >= 2 * width else F.lit(False)
    return grid.withColumn("value", F.when(edge("ix", nx) | edge("iy", ny), F.lit(value)).otherwise(F.col("value")))


def perturb(grid: DataFrame, fields: DataFrame, op: str, nx: int, ny: int, taper: int = 0, on: Sequence[str] = ("member", "ix", "iy")) -> DataFrame:
    """Add, multiply or assign a perturbation; a taper leaves it whole in the border and fades it inside."""
    joined = grid.join(fields.select(*on, F.col("value").alias("_p")), list(on))
    weight = edge_taper(F.col("ix"), F.col("iy"), nx, ny, taper) if taper else F.lit(1.0)
    p = F.col("_p")
    new = {"add": F.col("value") + p * weight, "multiply": F.col("value") * (1 + (p - 1) * weight), "assign": F.col("value") * (1 - weight) + p * weight}
    if op not in new:
        raise ValueError(f"unknown operation {op}")
    return joined.withColumn("value", new[op]).drop("_p")


def dilate(df: DataFrame, flag: str, outer: str, inner: str, outer_reach: int, inner_reach: int, keys: Sequence[str] = ()) -> DataFrame:
    """2-D binary dilation of a flag by ranges of two integer axes; separable, so two windows."""
    along = Window.partitionBy(*keys, outer).orderBy(inner).rangeBetween(-inner_reach, inner_reach)
    across = Window.partitionBy(*keys, inner).orderBy(outer).rangeBetween(-outer_reach, outer_reach)
    return df.withColumn("_line", F.max(flag).over(along)).withColumn("dilated", F.max("_line").over(across)).drop("_line")


def drop_empty_slices(df: DataFrame, value: str, dims: Sequence[str]) -> DataFrame:
    """Without the slices of each dimension that hold no value."""
    held = df.where(F.col(value).isNotNull())
    for d in dims:
        df = df.join(held.select(F.col(d).alias("_slice")).distinct(), F.col(d).eqNullSafe(F.col("_slice")), "left_semi")
    return df


def expand_coords(df: DataFrame, dims: Sequence[str], coords: str = "orig_coords") -> DataFrame:
    """One column for each named index of the orig_coords struct; null where a row lacks it."""
    table = F.map_from_arrays(F.col(coords)["names"], F.col(coords)["indices"])
    return df.withColumns({f"coord_{d}": F.try_element_at(table, F.lit(d)) for d in dims})


def check_one_shape(df: DataFrame, coords: str = "orig_coords") -> tuple[list[int], list[str]]:
    """The only shape and names of the rows; several, or none, raise."""
    found = df.select(F.col(coords)["shape"].alias("shape"), F.col(coords)["names"].alias("names")).distinct().limit(2).collect()
    if len(found) != 1:
        raise ValueError("no rows" if not found else "rows of several shapes")
    return list(found[0]["shape"]), list(found[0]["names"])


def dense(df: DataFrame, sizes: dict[str, int], values: Sequence[str], fill: float | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Every cell of the array, in rows: a spine of all index combinations, left-joined to the rows there are."""
    spine = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    for d, n in sizes.items():
        spine = spine.withColumn(d, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    out = spine.join(df.select(*keys, *sizes, *values), [*keys, *sizes], "left")
    return out if fill is None else out.withColumns({v: F.coalesce(v, F.lit(fill)) for v in values})


def at_level(df: DataFrame, level: int, profile: str = "profile", value: str = "value") -> DataFrame:
    """One level of a profile column, null beyond its end."""
    return df.withColumn(value, F.get(profile, F.lit(level))).drop(profile)


def with_member(df: DataFrame, member: int, static: Sequence[str] = ()) -> DataFrame:
    """Rows of one member's variables; those of static variables belong to no member."""
    return df.withColumn("member", F.when(F.col("var").isin(*static), F.lit(None)).otherwise(F.lit(member)).cast("int") if static else F.lit(member))


def native_array(df: DataFrame, index: str, value: str, size: int, keys: Sequence[str]) -> DataFrame:
    """Rows to one array a key, in the order of ``index``; missing places are null."""
    held = F.map_from_entries(F.collect_list(F.struct(index, value)))
    return df.groupBy(*keys).agg(held.alias("_m")).select(*keys, F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.try_element_at("_m", i)).alias(value))


def member_cycles(members: DataFrame, cycles: DataFrame) -> DataFrame:
    """Every member of every cycle: a list of commands to run."""
    # A product by its nature: one row for each pair is what is wanted.
    return members.crossJoin(cycles)


def duplicates(df: DataFrame, coords: Sequence[str]) -> DataFrame:
    """Coordinates that occur more than once, with their counts."""
    return df.groupBy(*coords).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unpivot_values(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "quantity", value: str = "value") -> DataFrame:
    """Wide to long, without nulls."""
    return df.unpivot(list(ids), list(values), name, value).where(F.col(value).isNotNull())


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def completeness(files: DataFrame, flags: Sequence[str], by: str = "cycle") -> DataFrame:
    """For each cycle: files that exist, and whether each variable is anywhere not zero."""
    return files.groupBy(by).agg(F.count_if(F.col("exists")).alias("n_files"), *[F.bool_or(F.coalesce(F.col(v) != 0, F.lit(False))).alias(f"{v}_set") for v in flags])
