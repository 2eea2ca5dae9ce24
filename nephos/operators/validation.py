"""First departures (observation minus model): statistics, regimes, maps, series, histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nephos.functions.columns import cut, departure, floor_div, histogram_bin
from nephos.operators.joins import small
from nephos.session import drop_shared, write_shared

PAIR = ("instrument", "quantity")


def statistics_columns() -> list[Column]:
    """Ten aggregates over ``departure``, spread and uncertainty; the quartiles are found apart."""
    d, spread, u = F.col("departure"), F.col("model_forecast_spread"), F.col("value_uncertainty")
    known = d.isNotNull() & spread.isNotNull() & u.isNotNull()
    total = spread * spread + u * u
    valid = known & (total > 0)
    norm = F.when(valid, d / F.sqrt(F.when(valid, total)))
    return [
        F.count("departure").alias("count"),
        F.avg("departure").alias("bias"),
        F.stddev_samp("departure").alias("std"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
        F.min("departure").alias("min"),
        F.max("departure").alias("max"),
        F.avg(norm).alias("norm_bias"),
        F.stddev_samp(norm).alias("norm_std"),
        F.avg(F.when(valid, F.try_divide(spread, u))).alias("spread_to_obserr_ratio"),
        (F.var_samp(F.when(known, d)) - F.avg(F.when(known, spread * spread))).alias("r_est"),
    ]


def with_departure(df: DataFrame) -> DataFrame:
    return df if "departure" in df.columns else df.withColumn("departure", departure())


def first_departures(df: DataFrame, by: Sequence[str] = PAIR) -> DataFrame:
    """The thirteen statistics of all groups: the aggregates and exact quartiles of groups of any size, in two scans."""
    rows = with_departure(df).select(*by, "departure", "model_forecast_spread", "value_uncertainty")
    out = selected_quantiles(rows, {"q25": ("departure", 0.25), "median": ("departure", 0.5), "q75": ("departure", 0.75)}, by, statistics_columns())
    names = ["count", "bias", "std", "rmse", "min", "max", "q25", "median", "q75", "norm_bias", "norm_std", "spread_to_obserr_ratio", "r_est"]
    return out.select(*by, *names)


def by_regime(df: DataFrame, edges: Sequence[float], labels: Sequence[str], by: Sequence[str] = PAIR) -> DataFrame:
    """Statistics in right-closed bins of the mean of model and observation; rows outside have no regime."""
    mean = 0.5 * (F.col("model_forecast") + F.col("value"))
    return first_departures(df.withColumn("regime", cut(mean, edges, labels)).where("regime IS NOT NULL"), [*by, "regime"])


def spatial_bins(df: DataFrame, resolution: float, by: Sequence[str] = PAIR) -> DataFrame:
    """Mean, deviation and count in latitude-longitude boxes of two departures or more."""
    place = lambda c: (floor_div(F.col(c), resolution) * resolution)
    boxed = with_departure(df).withColumns({"lat_bin": place("latitude"), "lon_bin": place("longitude")})
    return boxed.groupBy(*by, "lat_bin", "lon_bin").agg(F.avg("departure").alias("mean"), F.stddev_samp("departure").alias("std"), F.count("departure").alias("count")).where("std IS NOT NULL")


def hourly(df: DataFrame, by: Sequence[str] = PAIR) -> DataFrame:
    """Mean, deviation and count of each hour between a pair's first and last, empty hours too."""
    rows = with_departure(df).withColumn("hour", F.date_trunc("hour", F.col("time")).cast("timestamp_ntz"))
    found = rows.groupBy(*by, "hour").agg(F.avg("departure").alias("mean"), F.stddev_samp("departure").alias("std"), F.count("departure").alias("count"))
    spine = found.groupBy(*by).agg(F.min("hour").alias("_a"), F.max("hour").alias("_b"))
    hours = spine.select(*by, F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    return hours.join(found, [*by, "hour"], "left").withColumn("count", F.coalesce("count", F.lit(0)))


def histogram(df: DataFrame, n: int = 50, by: Sequence[str] = PAIR) -> DataFrame:
    """Density histogram of departures in n equal bins from a pair's least to its greatest."""
    rows = with_departure(df).where("departure IS NOT NULL")
    limits = rows.groupBy(*by).agg(F.min("departure").alias("_low"), F.max("departure").alias("_high"), F.count(F.lit(1)).alias("_n"))
    placed = rows.join(small(limits), list(by)).withColumn("bin", histogram_bin(F.col("departure"), F.col("_low"), F.col("_high"), n))
    width = (F.col("_high") - F.col("_low")) / n
    return placed.groupBy(*by, "bin", "_low", "_high", "_n").agg(F.count(F.lit(1)).alias("count")).select(
        *by, "bin", (F.col("_low") + F.col("bin") * width).alias("left_edge"), "count", F.try_divide(F.col("count"), F.col("_n") * width).alias("density")
    )


def density_curve(df: DataFrame, points: int = 200, by: Sequence[str] = PAIR, per_bandwidth: int = 20, reach: float = 9.0) -> DataFrame:
    """Gaussian kernel density at evenly spaced points, with Scott's bandwidth h.

    Departures are first summed to bins of h / ``per_bandwidth``, which keep count,
    mean and square deviation; a bin enters a point's sum with its second-order
    term, so the error is of third order in 1 / ``per_bandwidth``, whatever the
    range.  Points and bins meet in cells of ``reach`` bandwidths and their
    neighbours; what lies further off adds less than exp(-reach * reach / 2).
    """
    rows = with_departure(df).where("departure IS NOT NULL").select(*by, "departure")
    whole = rows.groupBy(*by).agg(F.min("departure").alias("_low"), F.max("departure").alias("_high"), F.stddev_samp("departure").alias("_sd"), F.count(F.lit(1)).alias("_n"))
    sized = whole.where("_sd > 0").withColumn("_h", F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2)))
    z = (F.col("departure") - F.col("_low")) / F.col("_h")
    fine = rows.join(small(sized), list(by)).withColumn("_bin", F.floor(z * per_bandwidth))
    sums = fine.groupBy(*by, "_bin", "_low", "_h").agg(F.count(F.lit(1)).alias("_c"), F.avg("departure").alias("_at"), F.var_pop("departure").alias("_v"))
    cell = lambda x: F.floor((x - F.col("_low")) / (F.col("_h") * reach))
    near = sums.select(*by, "_c", "_at", "_v", F.explode(F.array(*[cell(F.col("_at")) + k for k in (-1, 0, 1)])).alias("_cell"))
    at = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda k: F.col("_low") + (F.col("_high") - F.col("_low")) * k / (points - 1))
    grid = sized.select(*by, "_n", "_h", "_low", F.explode(at).alias("x")).withColumn("_cell", cell(F.col("x"))).drop("_low")
    u = (F.col("x") - F.col("_at")) / F.col("_h")
    curved = 1 + F.col("_v") / (2 * F.col("_h") * F.col("_h")) * (u * u - 1)
    kernel = F.sum(F.col("_c") * F.exp(-0.5 * u * u) * curved)
    met = grid.join(near, [*by, "_cell"], "left").groupBy(*by, "x", "_n", "_h").agg(F.coalesce(kernel, F.lit(0.0)).alias("_k"))
    return met.select(*by, "x", (F.col("_k") / (F.col("_n") * F.col("_h") * 2.5066282746310002)).alias("density"))


def height_bins(df: DataFrame, n: int = 70, by: Sequence[str] = PAIR) -> DataFrame:
    """Mean departure in n equal, right-closed bins of z."""
    from nephos.functions.columns import equal_width_bin

    rows = with_departure(df)
    limits = rows.groupBy(*by).agg(F.min("z").alias("_low"), F.max("z").alias("_high"))
    placed = rows.join(small(limits), list(by)).withColumn("z_bin", equal_width_bin(F.col("z"), F.col("_low"), F.col("_high"), n))
    return placed.groupBy(*by, "z_bin").agg(F.avg("departure").alias("mean"), F.count("departure").alias("count"))


def value_ranges(df: DataFrame, value: str = "value", by: Sequence[str] = PAIR, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Colour ranges: two percentiles, the percentile of magnitudes, and limits widened by 5 %."""
    v = F.col(value)
    span = F.max(v) - F.min(v)
    limits = [(F.min(v) - 0.05 * span).alias("limit_low"), (F.max(v) + 0.05 * span).alias("limit_high")]
    rows = df.select(*by, v, F.abs(v).alias("_size"))
    asked = {"p_low": (value, low), "p_high": (value, high), "abs_high": ("_size", high)}
    return selected_quantiles(rows, asked, by, limits).select(*by, *asked, "limit_low", "limit_high")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlations in one pass: (a, b, r), both orders and the diagonal."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    out = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs for x, y in ((a, b), (b, a))]
    out += [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in columns]
    return row.select(F.inline(F.array(*out)))


#: Size of a group's sketch, its rank error at 99 % (of either side, from the sketch's published bound), and how many times it is allowed for.
SKETCH_K, SKETCH_ERROR, ALLOWED = 4096, 0.00127, 3


def selected_quantiles(df: DataFrame, asked: Mapping[str, tuple[str, float]], by: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """by, ``extra`` aggregates, and for each name the exact linear quantile of a column: {name: (column, share)}.

    A first scan makes a mergeable sketch of each column and group, beside the extra
    aggregates; the sketch says between which values a wanted rank lies.  A second
    scan counts what is below and keeps the few values inside, which are then
    ordered: no task holds a group, whatever its size.  The counts prove each rank;
    where the sketch was wrong, the second scan is done again with wider limits.
    """
    columns = list(dict.fromkeys(c for c, _ in asked.values()))
    sketches = [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(SKETCH_K)).alias(f"_s{i}") for i, c in enumerate(columns)]
    first = df.groupBy(*by).agg(*extra, *sketches, *[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)])
    known = write_shared(first, "sketches")
    more = [c for c in known.columns if c not in by and not c.startswith(("_s", "_n"))]
    allowed = ALLOWED
    while True:
        bounds = write_shared(known.select(*by, *_limits(asked, columns, allowed * SKETCH_ERROR)), "rank-limits")
        found = write_shared(_inside(df, bounds, asked, by), "ranked-values")
        ranked = _at_ranks(found, bounds, asked, by)
        sure = [(F.col(f"_n_{name}") == 0) | F.col(f"_hit_{name}") for name in asked]
        if ranked.where(~reduce(lambda a, b: a & b, sure)).isEmpty():
            return _same_groups(known, by).join(_same_groups(ranked, by).drop(*by), "_group").select(*by, *more, *asked)
        drop_shared(found)
        allowed *= 4


def _same_groups(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` with a key that nulls in ``by`` share as well."""
    return df.withColumn("_group", F.to_json(F.struct(*[F.col(f"`{c}`") for c in by])))


def _limits(asked: Mapping[str, tuple[str, float]], columns: Sequence[str], error: float) -> list[Column]:
    """For each name the number of values, the two ranks that its quantile lies between, its part of the way, and the values that hold them; null where there is no limit."""
    out: list[Column] = []
    for name, (column, p) in asked.items():
        i = columns.index(column)
        n, sketch = F.col(f"_n{i}"), F.col(f"_s{i}")
        h = F.lit(float(p)) * (n - 1)
        at = lambda share, sketch=sketch, n=n: F.when(n > SKETCH_K, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))
        low = at(p - error) if p - error > 0 else F.lit(None).cast("double")
        high = at(p + error) if p + error < 1 else F.lit(None).cast("double")
        out += [n.alias(f"_n_{name}"), F.floor(h).alias(f"_a_{name}"), F.ceil(h).alias(f"_z_{name}"), (h - F.floor(h)).alias(f"_part_{name}"), low.alias(f"_low_{name}"), high.alias(f"_high_{name}")]
    return out


def _inside(df: DataFrame, bounds: DataFrame, asked: Mapping[str, tuple[str, float]], by: Sequence[str]) -> DataFrame:
    """(_group, _k, _v, _m): how many values of the k-th name there are of each value within its limits, and below them, as a null."""
    columns = list(dict.fromkeys(c for c, _ in asked.values()))
    limits = [c for name in asked for c in (f"_low_{name}", f"_high_{name}")]
    met = _same_groups(df.select(*by, *columns), by).drop(*by).join(small(_same_groups(bounds.select(*by, *limits), by).drop(*by)), "_group")
    marks = []
    for k, (name, (column, _)) in enumerate(asked.items()):
        v, low, high = F.col(column).cast("double"), F.col(f"_low_{name}"), F.col(f"_high_{name}")
        below = F.coalesce(v < low, F.lit(False))
        marks.append(F.when(v.isNotNull() & (below | high.isNull() | (v <= high)), F.struct(F.lit(k).alias("_k"), F.when(~below, v).alias("_v"))))
    return met.select("_group", F.explode(F.array_compact(F.array(*marks))).alias("_e")).groupBy("_group", "_e._k", "_e._v").agg(F.count(F.lit(1)).alias("_m"))


def _at_ranks(found: DataFrame, bounds: DataFrame, asked: Mapping[str, tuple[str, float]], by: Sequence[str]) -> DataFrame:
    """by, the quantiles, and whether both ranks of each were found."""
    upto = F.sum("_m").over(Window.partitionBy("_group", "_k").orderBy(F.col("_v").asc_nulls_first()))
    ordered = found.withColumn("_upto", upto)
    met = _same_groups(bounds, by).join(ordered, "_group", "left")
    out = []
    for k, name in enumerate(asked):
        value = lambda end, k=k, name=name: F.max(F.when((F.col("_k") == k) & F.col("_v").isNotNull() & (F.col(f"_{end}_{name}") < F.col("_upto")) & (F.col(f"_{end}_{name}") >= F.col("_upto") - F.col("_m")), F.col("_v")))
        a, z = value("a"), value("z")
        out += [(a + F.first(f"_part_{name}") * (z - a)).alias(name), (a.isNotNull() & z.isNotNull()).alias(f"_hit_{name}"), F.first(f"_n_{name}").alias(f"_n_{name}")]
    return met.groupBy("_group", *by).agg(*out).drop("_group")


def exact_quantiles(df: DataFrame, value: str, ps: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Linear quantiles of groups of any size: (by, p, quantile)."""
    names = {f"_q{i}": (value, float(p)) for i, p in enumerate(ps)}
    wide = selected_quantiles(df.where(F.col(value).isNotNull()), names, by)
    return wide.select(*by, F.inline(F.array(*[F.struct(F.lit(p).alias("p"), F.col(q).alias("quantile")) for q, (_, p) in names.items()])))


def wide_quantiles(df: DataFrame, value: str, names: Mapping[str, float], by: Sequence[str]) -> DataFrame:
    """``selected_quantiles`` of one column, of the groups that have values."""
    return selected_quantiles(df.where(F.col(value).isNotNull()), {n: (value, p) for n, p in names.items()}, by)
