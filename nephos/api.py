"""The commands of the command line as functions: ingest, cycles, validation, post-processing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.functions.projection import LambertConformal, project
from nephos.operators import cycles, ensemble, filters, joins, superobs, validation
from nephos.plans.interpolation import Axis, interpolate_model
from nephos.plans.processors import Context, Pipeline
from nephos.plans.workflow import Ledger
from nephos.sources import exports, obs_files, settings
from nephos.sources.store import ObservationStore, write_csv, write_grid


@dataclass(frozen=True)
class Domain:
    """Where and when an experiment is: projection, bounds in metres, first and last time."""

    crs: LambertConformal
    x: tuple[float, float]
    y: tuple[float, float]
    start: dt.datetime
    end: dt.datetime


@dataclass(frozen=True)
class Reduction:
    """Density reduction by ``instrument.quantity``."""

    superobs: dict[str, tuple[dict[str, int], dict[str, int]]] = field(default_factory=dict)
    time_bins: dict[str, tuple[int, int]] = field(default_factory=dict)
    strides: dict[str, int] = field(default_factory=dict)


def trim(df: DataFrame, domain: Domain, ignore: Sequence[str] = ()) -> DataFrame:
    """Projected rows in the experiment's time, whole groups that touch the domain."""
    rows = project(filters.without_pairs(df, ignore), domain.crs).where(F.col("time").between(F.lit(domain.start), F.lit(domain.end)))
    inside = F.col("x").between(*domain.x) & F.col("y").between(*domain.y)
    return filters.trim_groups(rows, inside, F.col("orig_coords.indices"), F.col("orig_coords.shape"))


def add_observations(spark: SparkSession, store: ObservationStore, paths: Sequence[str], domain: Domain, ignore: Sequence[str] = (), reduction: Reduction | None = None) -> None:
    """Read files or folders, trim, reduce, and replace their rows in the store: one lineage, one write."""
    read = obs_files.read_obs(spark, *paths)
    names = sorted(unquote(f.rsplit("/", 1)[-1]) for f in read.inputFiles())
    rows = trim(read, domain, ignore)
    if reduction is not None:
        dims = sorted({d for h, v in reduction.superobs.values() for d in (*h, *v)})
        rows = ensemble.expand_coords(rows, dims).withColumnsRenamed({f"coord_{d}": d for d in dims})
        rows = rows.withColumn("obs_id", F.xxhash64("ingest_file", "instrument", "quantity", "time", "longitude", "latitude", "z", "orig_coords"))
        rows = superobs.reduce_density(rows, reduction.superobs, reduction.time_bins, reduction.strides).drop("obs_id")
    store.add(rows, names)


def prepare_cycles(calendar: DataFrame, obs: DataFrame, half_minutes: int, names: Sequence[str], factors: DataFrame, path: str) -> DataFrame:
    """Rows of every cycle as Parquet by cycle, and the good ones as the filter's text input."""
    rows = cycles.observations_for_cycles(calendar, obs, half_minutes, names, factors)
    rows.write.mode("overwrite").partitionBy("cycle_index").parquet(f"{path}/cycles")
    back = obs.sparkSession.read.schema(rows.schema).parquet(f"{path}/cycles")
    exports.filter_rows(filters.quality(back), "cycle_index").write.mode("overwrite").partitionBy("cycle_index").option("header", True).csv(f"{path}/filter_input")
    return back


def cycle_totals(info: DataFrame) -> DataFrame:
    """Grand totals of ``cycles.file_info``, in one row."""
    from nephos.functions.columns import percent

    sums = info.agg(F.sum("total").alias("total"), F.sum("assimilated").alias("assimilated"))
    return sums.withColumn("percent", percent(F.col("assimilated"), F.col("total")))


def files_of_cycles(groups: DataFrame, calendar: DataFrame, half_minutes: int, path: str | None = None) -> DataFrame:
    """(cycle_index, group, path) of the sequence files whose span meets a cycle's window."""
    spans = cycles.windows(calendar, half_minutes)
    found = joins.overlapping(groups, spans, ("start_date", "end_date"), ("window_start", "window_end")).select("cycle_index", "group", "path")
    if path is not None:
        write_csv(found, path, "cycle_index", "group", "path")
    return found


def interpolate_members(obs: DataFrame, grid: DataFrame, x_axis: Axis, y_axis: Axis) -> DataFrame:
    """(obs_id, instrument, quantity, time, member, value): every member's model equivalents."""
    found = interpolate_model(obs, grid, x_axis, y_axis, by=["member"]).where("member IS NOT NULL")
    return found.join(obs.select("obs_id", "instrument", "quantity", "time"), "obs_id").select("obs_id", "instrument", "quantity", "time", "member", F.col("model").alias("value"))


def requested_pairs(obs: DataFrame, pairs: Sequence[str]) -> list[str]:
    """The asked pairs that have rows, in the asked order, each once; ValueError names the others."""
    key = F.concat_ws(".", "instrument", "quantity")
    asked = list(dict.fromkeys(pairs))
    have = {r[0] for r in obs.where(key.isin(*asked)).select(key).distinct().collect()}
    if missing := [p for p in asked if p not in have]:
        raise ValueError(f"no rows of {', '.join(missing)}")
    return asked


def in_asked_order(df: DataFrame, pairs: Sequence[str]) -> DataFrame:
    """Rows of pairs in the order in which they were asked for."""
    place = F.array_position(F.array(*[F.lit(p) for p in pairs]), F.concat_ws(".", "instrument", "quantity"))
    return df.orderBy(place, *[c for c in df.columns if c in ("regime", "hour", "lat_bin", "lon_bin", "bin")])


def model_bounds(grid: DataFrame) -> DataFrame:
    """Domain and time of a model data set (t, x, y), in one row: least and greatest of each, and its frames and points."""
    ends = [f(c).alias(f"{n}_{c}") for c in ("t", "x", "y") for n, f in (("min", F.min), ("max", F.max))]
    return grid.agg(*ends, F.count_distinct("t").alias("frames"), F.count_distinct("x", "y").alias("points"))


def analyse_first_departures(
    obs: DataFrame,
    path: str | None = None,
    pairs: Sequence[str] = (),
    include: filters.Box | None = None,
    exclude: Sequence[filters.Box] = (),
    regimes: tuple[Sequence[float], Sequence[str]] | None = None,
    resolution: float = 1.0,
) -> dict[str, DataFrame]:
    """Statistics, hourly means, maps, histograms and regimes of all pairs, or of some that must exist, then in the asked order."""
    key = F.concat_ws(".", "instrument", "quantity")
    if pairs:
        pairs = requested_pairs(obs, pairs)
        obs = obs.where(key.isin(*pairs))
    rows = filters.boxes(filters.quality(obs, (0, -1)).where("model_forecast IS NOT NULL"), include, exclude)
    out = {
        "statistics": validation.first_departures(rows),
        "hourly": validation.hourly(rows),
        "spatial": validation.spatial_bins(rows, resolution),
        "histogram": validation.histogram(rows),
    }
    if regimes is not None:
        out["regimes"] = validation.by_regime(rows, *regimes)
    if pairs:
        out = {name: in_asked_order(df, pairs) for name, df in out.items()}
    if path is not None:
        for name in ("statistics", "regimes"):
            if name in out:
                write_csv(out[name], f"{path}/{name}", "instrument", "quantity")
    return out


def seed_from(forecasts: DataFrame, calendar: DataFrame, cycle: int, ledger: Ledger, own: Any = None, other: Any = None) -> DataFrame:
    """The first state of an experiment: another one's forecasts (cycle, member, t, ...) at the end of ``cycle``.

    Both experiments' configurations, where given, must agree, and every member must have a forecast;
    then the ledger goes on from that cycle.
    """
    if own is not None and (names := settings.differences(own, other)):
        raise ValueError(f"the experiments differ in {', '.join(names)}")
    end = calendar.where(F.col("cycle_index") == cycle).select(F.col("end_time").alias("t"))
    rows = forecasts.where(F.col("cycle") == cycle).join(end, "t", "left_semi")
    # At most one number a member comes back.
    have = {r[0] for r in rows.where(F.col("member").between(0, ledger.members - 1)).select("member").distinct().collect()}
    if missing := sorted(set(range(ledger.members)) - have):
        raise ValueError(f"no forecast of member {missing[0]} at the end of cycle {cycle}")
    ledger.seed(cycle)
    return rows


def point_summary(obs: DataFrame, value: str = "value") -> DataFrame:
    """Of each pair: distinct places, and the 1 and 99 % quantiles of its values."""
    by = ["instrument", "quantity"]
    places = obs.groupBy(*by).agg(F.count_distinct("longitude", "latitude").alias("places"))
    return places.join(validation.wide_quantiles(obs.select(*by, value), value, {"p01": 0.01, "p99": 0.99}, by), by, "left")


def without_first_frame(rows: DataFrame, start: dt.datetime, time: str = "t") -> DataFrame:
    """Frames after the cycle's start."""
    return rows.where(F.col(time) != F.lit(start))


def postprocess(members: DataFrame, path: str, cycle: int, processors: Pipeline | None = None, last_only: bool = False) -> DataFrame:
    """Mean and deviation of a cycle's member fields after its processors, appended by cycle."""
    rows = processors.run(members, Context(cycle)) if processors is not None else members
    if last_only:
        last = rows.agg(F.max("t_idx").alias("_last"))
        rows = rows.join(F.broadcast(last)).where(F.col("t_idx") == F.col("_last")).drop("_last")
    stats = ensemble.mean_spread(rows).withColumn("cycle", F.lit(cycle))
    write_grid(stats, path, "cycle")
    return stats
