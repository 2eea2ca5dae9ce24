"""Range, as-of, overlap, nearest and interpolation joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nephos.functions.columns import micros
from nephos.session import write_shared

#: Calendars, factor tables and frame tables above this many rows, or bytes as JSON, are joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 64 << 20


def small(df: DataFrame, most_rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows and bytes, checked first, are within the bounds."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, held = df.limit(most_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if rows <= most_rows and held <= most_bytes else df


def in_windows(points: DataFrame, windows: DataFrame, at: str, start: str, end: str, slice_us: int = 3_600_000_000) -> DataFrame:
    """Inner join of points to the closed windows that hold them.

    Both sides meet on time slices, an equality that hashes and shuffles; a window
    covers several slices, a point lies in one, so no pair comes twice.
    """
    floor = lambda c: F.floor(micros(F.col(c)) / slice_us)
    wide = small(windows.withColumn("_slice", F.explode(F.sequence(floor(start), floor(end)))))
    return points.withColumn("_slice", floor(at)).join(wide, "_slice").where(F.col(at).between(F.col(start), F.col(end))).drop("_slice")


def overlapping(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str], slice_us: int = 3_600_000_000) -> DataFrame:
    """Inner join of closed intervals that overlap.

    Intervals meet on slices; a pair counts in the slice of the later start only.
    """
    floor = lambda c: F.floor(micros(F.col(c)) / slice_us)
    cut = lambda df, s: df.withColumn("_slice", F.explode(F.sequence(floor(s[0]), floor(s[1]))))
    both = cut(left, left_span).join(small(cut(right, right_span)), "_slice")
    later = F.greatest(F.col(left_span[0]), F.col(right_span[0]))
    meets = (F.col(left_span[0]) <= F.col(right_span[1])) & (F.col(right_span[0]) <= F.col(left_span[1]))
    return both.where(meets & (F.col("_slice") == F.floor(micros(later) / slice_us))).drop("_slice")


def with_factors(df: DataFrame, factors: DataFrame, on: Sequence[str] = ("instrument", "quantity")) -> DataFrame:
    """Left join of error factors; 1.0 where there is none."""
    return df.join(small(factors), list(on), "left").withColumn("factor", F.coalesce("factor", F.lit(1.0)))


def frame_intervals(frames: DataFrame, t: str = "t") -> DataFrame:
    """Each frame with the next: (left_idx, left_us, right_idx, right_us); the last stands by itself."""
    w = Window.orderBy(t)
    us = micros(F.col(t))
    nxt = lambda c: F.lead(c).over(w)
    return frames.select(
        F.col("t_idx").alias("left_idx"),
        us.alias("left_us"),
        F.coalesce(nxt(F.col("t_idx")), F.col("t_idx")).alias("right_idx"),
        F.coalesce(nxt(us), us).alias("right_us"),
        nxt(us).isNull().alias("is_last"),
    )


def _in_spans(points: DataFrame, spans: DataFrame, slice_us: int = 21_600_000_000) -> DataFrame:
    """Inner join of points (_us) to the half-open frame interval that holds them, by time slices."""
    cut = lambda c: F.floor(F.col(c) / slice_us)
    wide = spans.withColumn("_slice", F.explode(F.sequence(cut("left_us"), cut("right_us"))))
    held = (F.col("_us") >= F.col("left_us")) & ((F.col("_us") < F.col("right_us")) | F.col("is_last"))
    return points.withColumn("_slice", cut("_us")).join(small(wide), "_slice").where(held).drop("_slice")


def bracket(points: DataFrame, frames: DataFrame, at: str = "time", tolerance_us: int = 3_600_000_000) -> DataFrame:
    """The frames on both sides of every point: left_idx, right_idx, the right one's weight, and valid.

    Times are clipped to the frames' range; beyond it by more than the tolerance a
    row is kept but not valid.  ``frames`` (t_idx, t) is a small dimension.
    """
    spans = frame_intervals(frames)
    limits = spans.agg(F.min("left_us").alias("_low"), F.max("left_us").alias("_high"))
    us = micros(F.col(at))
    clipped = points.join(F.broadcast(limits)).withColumn("_us", F.least(F.greatest(us, F.col("_low")), F.col("_high")))
    joined = _in_spans(clipped, spans)
    span = F.col("right_us") - F.col("left_us")
    return joined.withColumns(
        {
            "t_weight": F.when(span == 0, F.lit(0.0)).otherwise((F.col("_us") - F.col("left_us")) / span),
            "valid": (us >= F.col("_low") - tolerance_us) & (us <= F.col("_high") + tolerance_us),
        }
    ).drop("_low", "_high", "_us", "left_us", "right_us", "is_last")


def nearest_frame(points: DataFrame, frames: DataFrame, at: str = "time", tolerance_us: int = 3_600_000_000) -> DataFrame:
    """The nearest frame's t_idx, the earlier one in a tie, and whether it is within the tolerance."""
    spans = frame_intervals(frames)
    us = micros(F.col(at))
    limits = spans.agg(F.min("left_us").alias("_low"), F.max("left_us").alias("_high"))
    clipped = points.join(F.broadcast(limits)).withColumn("_us", F.greatest(us, F.col("_low")))
    joined = _in_spans(clipped.withColumn("_us", F.least("_us", "_high")), spans)
    to_right = ~F.col("is_last") & (F.col("right_us") - us < us - F.col("left_us"))
    gap = F.abs(us - F.when(to_right, F.col("right_us")).otherwise(F.col("left_us")))
    return joined.withColumns({"t_idx": F.when(to_right, F.col("right_idx")).otherwise(F.col("left_idx")), "valid": gap <= tolerance_us}).drop(
        "_low", "_high", "_us", "left_us", "right_us", "is_last", "left_idx", "right_idx"
    )


def dedupe_by_lead(frames: DataFrame, keep_longest: bool = False) -> DataFrame:
    """One frame for each valid time ``t``: that of the shortest (or longest) lead, ties by file."""
    lead = F.col("lead").desc() if keep_longest else F.col("lead").asc()
    w = Window.partitionBy("t").orderBy(lead, F.col("file"))
    return frames.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def regular_axis(q: Column, first: float, step: float, n: int) -> tuple[Column, Column]:
    """Lower index and clamped weight on a regular axis; an axis of one point has weight 0."""
    if n == 1:
        return F.lit(0), F.lit(0.0)
    i = F.least(F.greatest(F.floor((q - first) / step), F.lit(0)), F.lit(n - 2)).cast("int")
    return i, F.least(F.greatest((q - first) / step - i, F.lit(0.0)), F.lit(1.0))


def asked_corners(cells: DataFrame, nx: int, ny: int) -> DataFrame:
    """The corners of cells (left_idx, right_idx, ix, iy), with the corner's place as _t, _x, _y and its number: 4 for the later frame, 2 for x, 1 for y."""
    reach = [(dt, dx, dy) for dt in (0, 1) for dx in range(min(nx, 2)) for dy in range(min(ny, 2))]
    places = [F.struct(F.lit(4 * dt + 2 * dx + dy).alias("no"), (F.col("right_idx") if dt else F.col("left_idx")).alias("_t"), (F.col("ix") + dx).alias("_x"), (F.col("iy") + dy).alias("_y")) for dt, dx, dy in reach]
    return cells.select("left_idx", "right_idx", "ix", "iy", F.explode(F.array(*places)).alias("_p")).select("left_idx", "right_idx", "ix", "iy", "_p.*")


def asked_cells(cells: DataFrame, grid: DataFrame, nx: int, ny: int, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(left_idx, right_idx, ix, iy, by, fields): for each asked cell and level of a field its values at the corners, in their order.

    Only grid points that are a corner of an asked cell leave the scan: where the
    corners are few enough to be broadcast, nothing else of the grid is shuffled.  A
    cell without one of its corners has null fields.
    """
    flat = {f.name for f in grid.schema.fields if not f.dataType.simpleString().startswith("array")}
    values = grid.select(F.col("t_idx").alias("_t"), F.col("ix").alias("_x"), F.col("iy").alias("_y"), *by, *[(F.array(f) if f in flat else F.col(f)).alias(f"_f{k}") for k, f in enumerate(fields)])
    corners = small(asked_corners(cells, nx, ny))
    keys = ["left_idx", "right_idx", "ix", "iy", *by]
    n = 2 * min(nx, 2) * min(ny, 2)
    met = values.join(corners, ["_t", "_x", "_y"]).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("no", *[f"_f{k}" for k in range(len(fields))]))).alias("_c"))
    several = F.raise_error(F.concat(F.lit("a grid point comes twice beside cell "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])))
    levels = lambda k: F.transform(F.sequence(F.lit(0), F.size(F.col("_c")[0][f"_f{k}"]) - 1), lambda at: F.transform("_c", lambda c: F.get(c[f"_f{k}"], at)))
    some = lambda k: F.when(F.size("_c") > n, several).when((F.size("_c") == n) & (F.size(F.col("_c")[0][f"_f{k}"]) > 0), levels(k))
    return met.select(*keys, *[some(k).alias(f) for k, f in enumerate(fields)])


def gather_fields(
    points: DataFrame,
    grid: DataFrame,
    x_axis: tuple[float, float, int],
    y_axis: tuple[float, float, int],
    fields: Sequence[str],
    key: str = "obs_id",
    by: Sequence[str] = (),
    keep: Sequence[str] = (),
    wanted: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(key, keep, by, fields): fields of the grid, arrays over levels or single numbers, interpolated to every point in x, y and t.

    ``points`` holds key, x, y, left_idx, right_idx and t_weight.  Each point meets
    its cell once, by (left_idx, ix, iy), for all fields together.  Corners of weight 0
    count too, so a null corner gives a null level, and a missing one a null field.
    ``by`` names columns of the grid, such as the member, that each give a result of
    their own; ``wanted`` says, by kept columns, which rows need a field.
    """
    ix, wx = regular_axis(F.col("x"), *x_axis)
    iy, wy = regular_axis(F.col("y"), *y_axis)
    others = [c for c in keep if c != key]
    place = [F.col("left_idx"), F.col("right_idx"), ix.alias("ix"), iy.alias("iy")]
    cells = write_shared(points.select(*place).where("ix IS NOT NULL AND iy IS NOT NULL").distinct(), "cells")
    asked = points.select(key, *others, *place, wx.alias("_wx"), wy.alias("_wy"), "t_weight")
    nx, ny = x_axis[2], y_axis[2]
    share = lambda w, k: w if k else 1 - w
    weights = [share(F.col("t_weight"), dt) * share(F.col("_wx"), dx) * share(F.col("_wy"), dy) for dt in (0, 1) for dx in range(min(nx, 2)) for dy in range(min(ny, 2))]
    met = asked.withColumn("_w", F.array(*weights)).drop("_wx", "_wy", "t_weight").join(asked_cells(cells, grid, nx, ny, fields, by), ["left_idx", "right_idx", "ix", "iy"], "left")
    at_level = lambda c: reduce(lambda a, b: a + b, [c[i] * F.col("_w")[i] for i in range(len(weights))])
    flat = {f.name for f in grid.schema.fields if not f.dataType.simpleString().startswith("array")}

    def value(f: str) -> Column:
        out = at_level(F.get(f, F.lit(0))) if f in flat else F.transform(f, at_level)
        return (out if wanted is None or f not in wanted else F.when(wanted[f], out)).alias(f)

    return met.select(key, *others, *by, *[value(f) for f in fields])


def gather_corners(
    points: DataFrame,
    grid: DataFrame,
    x_axis: tuple[float, float, int],
    y_axis: tuple[float, float, int],
    field: str = "profile",
    key: str = "obs_id",
    by: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """``gather_fields`` of one field."""
    return gather_fields(points, grid, x_axis, y_axis, [field], key, by, keep)


def latest_complete(cycles: DataFrame, n_files: int, before: int) -> DataFrame:
    """The latest cycle before ``before`` that has all its files."""
    whole = cycles.groupBy("cycle").agg(F.countDistinct("member").alias("n")).where(F.col("n") == n_files)
    return whole.where(F.col("cycle") < before).agg(F.max("cycle").alias("cycle"))


def one_value(updates: DataFrame, key: str = "obs_id") -> DataFrame:
    """(key, value): one row a key; a key that comes with two different values raises."""
    value = F.col("value")
    several = (F.min(value) != F.max(value)) | ((F.count(value) > 0) & (F.count(value) < F.count(F.lit(1))))
    one = F.when(several, F.raise_error(F.concat(F.lit("several values for key "), F.col(key).cast("string")))).otherwise(F.max(value))
    return updates.groupBy(key).agg(one.alias("value"))


def update_values(table: DataFrame, updates: DataFrame, column: str, clear: bool = False, key: str = "obs_id") -> DataFrame:
    """``column`` from ``updates`` (key, value); other rows keep theirs, or with ``clear`` lose it.

    A key that comes twice must bring one value; two different ones raise.
    """
    new = one_value(updates, key).select(key, F.col("value").alias("_new"), F.lit(True).alias("_hit"))
    joined = table.join(new, key, "left")
    keep = F.lit(None) if clear else F.col(column)
    return joined.withColumn(column, F.when(F.col("_hit"), F.col("_new")).otherwise(keep)).drop("_new", "_hit").select(table.columns)


def overlay(base: DataFrame, replacement: DataFrame, variables: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows of ``base`` with the listed variables taken from ``replacement`` where it has them."""
    new = replacement.where(F.col("var").isin(*variables)).select(*keys, F.col("value").alias("_new"))
    return base.join(new, list(keys), "left").withColumn("value", F.coalesce("_new", "value")).drop("_new")


def bin_mean(df: DataFrame, x: str, y: str, x0: float, y0: float, dx: float, dy: float, value: str) -> DataFrame:
    """Bucket-average resampling of scattered values to a regular grid."""
    ix, iy = F.floor((F.col(x) - x0) / dx).cast("int"), F.floor((F.col(y) - y0) / dy).cast("int")
    return df.groupBy(ix.alias("ix"), iy.alias("iy")).agg(F.avg(value).alias(value), F.count(value).alias("n"))


