"""Density reduction: grid superobservations, time bins and stride thinning.

Every operator works within an ingest file, instrument and quantity.  Good rows
(flag 0) are preferred; a bin without any uses all its rows and gets flag 1.
Sizes, widths and strides may be columns, so one pass serves all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nephos.functions.columns import mean_time, micros, time_at
from nephos.operators.joins import small
from nephos.session import write_shared

KEYS = ("ingest_file", "instrument", "quantity")


#: Whether a row has flag 0.
GOOD = "coalesce(qc_flag = 0, false)"


def preferred(make: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """An aggregate over a bin's good rows, or over all of them where it has none.

    ``make`` builds it from a function that hides the rows which don't count; both
    forms are summed side by side, so a bin is read once and partly summed before
    the shuffle.
    """
    good = F.expr(GOOD)
    return F.when(F.max(good), make(lambda c: F.when(good, c))).otherwise(make(lambda c: c))


def _first(column: str, order: Sequence[str], of: Callable[[Column], Column]) -> Column:
    """The value in the first row, nulls included."""
    return F.min_by(F.struct(column), of(F.struct(*order)))[column]


def _bin_columns(order: Sequence[str], instrument_error: Callable[[Callable[[Column], Column]], Column]) -> list[Column]:
    """A bin's aggregates over its preferred rows."""
    col = lambda c, of: of(F.col(c))
    n = lambda of: F.count(of(F.lit(1)))
    return [
        preferred(n).alias("n"),
        F.when(F.max(F.expr(GOOD)), 0).otherwise(1).alias("qc_flag"),
        preferred(lambda of: mean_time(col("time", of))).alias("time"),
        *[preferred(lambda of, c=c: F.avg(col(c, of))).alias(c) for c in ("longitude", "latitude", "x", "y", "z", "value")],
        preferred(instrument_error).alias("instrument_error"),
        preferred(lambda of: F.when(n(of) > 1, F.stddev_samp(col("value", of))).otherwise(_first("value_uncertainty", order, of))).alias("repr_error"),
        *[preferred(lambda of, c=c: _first(c, order, of)).alias(c) for c in ("z_type", "orig_filename", "metadata")],
    ]


def _whole_files(summed: DataFrame) -> DataFrame:
    """One row for each file and pair, written once; with a hint if there are few."""
    return small(write_shared(summed, "file-limits"))


def with_superob_metadata(metadata: Column, n: Column, repr_error: Column, instrument_error: Column) -> Column:
    """The first row's metadata with a ``superob`` object, as JSON text."""
    added = F.to_json(F.struct(n.alias("n_contributing"), repr_error.alias("repr_error"), instrument_error.alias("instrument_error")))
    base = F.coalesce(F.from_json(metadata, "map<string,string>"), F.create_map().cast("map<string,string>"))
    return F.to_json(F.map_concat(F.map_filter(base, lambda k, _: k != "superob"), F.create_map(F.lit("superob"), added)))


def grid_superobs(
    df: DataFrame,
    horizontal: dict[str, int | Column],
    vertical: dict[str, int | Column],
    reduce_instrument_error: bool = True,
    order: Sequence[str] = ("time", "obs_id"),
) -> DataFrame:
    """One row for each bin of the native grid; ``horizontal`` and ``vertical`` map index columns to sizes.

    instrument error: root mean square of the uncertainties, over sqrt(n) if it
    averages out; representativeness: the values' standard deviation, or for one
    row its uncertainty; the total adds both in squares.  A null size leaves its
    dimension out.
    """
    sizes = horizontal | vertical
    names = {d: f"bin_{d}" for d in sizes}
    size = lambda n: n if isinstance(n, Column) else F.lit(n)
    binned = df.withColumns({names[d]: F.floor(F.col(d) / size(n).cast("double")).cast("int") for d, n in sizes.items()})
    keys = [*KEYS, *names.values()]

    def instrument_error(of: Callable[[Column], Column]) -> Column:
        root = F.sqrt(F.avg(of(F.col("value_uncertainty") * F.col("value_uncertainty"))))
        return root / F.sqrt(F.count(of(F.lit(1))).cast("double")) if reduce_instrument_error else root

    groups = binned.groupBy(*keys).agg(*_bin_columns(order, instrument_error))
    total = F.sqrt(F.col("instrument_error") * F.col("instrument_error") + F.col("repr_error") * F.col("repr_error"))
    # Every bin has a row, so its file's shape follows from the index columns alone.
    shape = _whole_files(binned.groupBy(*KEYS).agg(*[(F.max(b) + 1).alias(f"shape_{d}") for d, b in names.items()]))
    return groups.withColumn("value_uncertainty", total).join(shape, list(KEYS))


def grid_orig_coords(df: DataFrame, dimensions: Sequence[str]) -> Column:
    """The orig_coords struct of superobs from their bin and shape columns."""
    return F.struct(
        F.array(*[F.col(f"bin_{d}") for d in dimensions]).alias("indices"),
        F.array(*[F.col(f"shape_{d}") for d in dimensions]).alias("shape"),
        F.array(*[F.lit(f"{d}_bin") for d in dimensions]).alias("names"),
    )


def time_superobs(
    df: DataFrame,
    minutes: int | Column,
    offset_minutes: int | Column = 0,
    reduce_instrument_error: bool = True,
    order: Sequence[str] = ("time", "obs_id"),
) -> DataFrame:
    """One row for each non-empty time bin, counted from the first row's midnight plus the offset.

    Null uncertainties are left out of the root mean square and of its n; an error
    that is missing is left out of the total.
    """
    day = 86_400_000_000
    length = lambda m: (m if isinstance(m, Column) else F.lit(m)).cast("bigint") * 60_000_000
    timed = df.withColumns({"_us": micros(F.col("time")), "_width": length(minutes), "_offset": length(offset_minutes)})
    ends = timed.groupBy(*KEYS).agg((F.floor(F.min("_us") / day) * day + F.max("_offset")).alias("_origin"), F.max("_us").alias("_last"), F.max("_width").alias("_w"), F.max("_offset").alias("_o"))
    start = lambda us, width: F.col("_origin") + F.floor((F.col(us) - F.col("_origin")) / F.col(width)) * F.col(width)
    index = lambda bin, width, offset: F.floor((F.col(bin) - F.col(offset)) / F.col(width)).cast("int")
    limits = ends.withColumn("_last_bin", start("_last", "_w")).select(*KEYS, "_origin", (index("_last_bin", "_w", "_o") + 1).alias("shape_time"))
    binned = timed.join(_whole_files(limits), list(KEYS)).withColumn("_bin", start("_us", "_width"))

    def instrument_error(of: Callable[[Column], Column]) -> Column:
        u = of(F.col("value_uncertainty"))
        root = F.sqrt(F.avg(u * u))
        return F.when(F.count(u) > 0, root / F.sqrt(F.count(u).cast("double"))) if reduce_instrument_error else root

    groups = binned.groupBy(*KEYS, "_bin").agg(*_bin_columns(order, instrument_error), *[F.max(c).alias(c) for c in ("_width", "_offset", "shape_time")])
    square = lambda c: F.col(c) * F.col(c)
    known_total = F.coalesce(square("instrument_error"), F.lit(0.0)) + F.coalesce(square("repr_error"), F.lit(0.0))
    total = F.when(F.col("instrument_error").isNotNull() | F.col("repr_error").isNotNull(), F.sqrt(known_total))
    return groups.withColumns({"value_uncertainty": total, "bin_time": index("_bin", "_width", "_offset"), "bin_start": time_at(F.col("_bin"))}).drop("_bin", "_width", "_offset")


#: Width of the time slices in which stride thinning counts.
SLICE_US = 600_000_000


def stride_thin(df: DataFrame, n: int | Column, order: Sequence[str] = ("time", "obs_id")) -> DataFrame:
    """Every n-th good row by time keeps flag 0, the others become hold-outs (-1); bad rows, and those of a null n, stay.

    ``order`` begins with a timestamp.  A row's place is the good rows of the
    earlier time slices plus its place in its own, so no task sorts more than the
    rows of a slice.
    """
    good = F.coalesce(F.col("qc_flag") == 0, F.lit(False))
    stride = n if isinstance(n, Column) else F.lit(n)
    marked = df.withColumns({"_good": good, "_slice": F.floor(micros(F.col(order[0])) / SLICE_US)})
    counts = marked.groupBy(*KEYS, "_slice").agg(F.count_if("_good").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*KEYS).orderBy("_slice")) - F.col("_n")
    placed = marked.join(counts.select(*KEYS, "_slice", before.alias("_before")), [*KEYS, "_slice"], "left")
    within = F.row_number().over(Window.partitionBy(*KEYS, "_slice", "_good").orderBy(*order)) - 1
    thinned = F.col("_good") & ((F.coalesce("_before", F.lit(0)) + F.col("_place")) % stride != 0)
    out = placed.withColumn("_place", within).withColumn("qc_flag", F.when(thinned, F.lit(-1)).otherwise(F.col("qc_flag")))
    return out.select(df.columns)


def by_pair(options: dict[str, int]) -> Column:
    """The option of a row's ``instrument.quantity`` pair; null where it has none."""
    if not options:
        return F.lit(None).cast("int")
    return F.create_map(*[F.lit(x) for item in options.items() for x in item])[F.concat_ws(".", "instrument", "quantity")]


def reduce_density(
    df: DataFrame,
    superobs: dict[str, tuple[dict[str, int], dict[str, int]]],
    time_bins: dict[str, tuple[int, int]],
    strides: dict[str, int],
) -> DataFrame:
    """Superobs, then time bins, then thinning, each for its ``instrument.quantity`` pairs.

    A pair can't have both superobs and time bins.  Every step takes all its pairs
    in one pass, with their options looked up by row.
    """
    if both := set(superobs) & set(time_bins):
        raise ValueError(f"pairs with both superobs and time bins: {sorted(both)}")
    pair = F.concat_ws(".", "instrument", "quantity")
    out = df.where(~pair.isin(*superobs, *time_bins)) if superobs or time_bins else df
    if superobs:
        sizes = {p: h | v for p, (h, v) in superobs.items()}
        dims = sorted({d for s in sizes.values() for d in s})
        columns = {d: by_pair({p: s[d] for p, s in sizes.items() if d in s}) for d in dims}
        out = out.unionByName(grid_superobs(df.where(pair.isin(*superobs)), columns, {}), allowMissingColumns=True)
    if time_bins:
        minutes, offsets = (by_pair({p: t[k] for p, t in time_bins.items()}) for k in range(2))
        out = out.unionByName(time_superobs(df.where(pair.isin(*time_bins)), minutes, offsets), allowMissingColumns=True)
    return stride_thin(out, by_pair(strides), ("time", "longitude", "latitude", "z")) if strides else out
