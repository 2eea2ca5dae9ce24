"""Assimilation cycles: calendar, window counts, the rows of each cycle, run times."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nephos.functions.columns import percent
from nephos.operators.filters import bad_variance, instruments
from nephos.operators.joins import in_windows, with_factors


@dataclass(frozen=True)
class CycleOptions:
    """What one cycle may set for itself; None keeps the general setting."""

    duration: int | None = None
    output_interval: int | None = None
    forecast_extension: int | None = None


@dataclass(frozen=True)
class Cycle:
    index: int
    start: dt.datetime
    end: dt.datetime
    offset: dt.timedelta
    output_interval: int | None
    forecast_end: dt.datetime


@dataclass(frozen=True)
class Calendar:
    """Start, end and interval (minutes) of an experiment, with options by cycle index."""

    start: dt.datetime
    end: dt.datetime
    interval: int
    forecast_extension: int = 0
    options: dict[int, CycleOptions] = field(default_factory=dict)

    def cycles(self) -> list[Cycle]:
        """Cycles until the end; ends and forecasts are clamped to it, starts advance by whole durations."""
        out: list[Cycle] = []
        at = self.start
        while at < self.end:
            own = self.options.get(len(out), CycleOptions())
            step = dt.timedelta(minutes=self.interval if own.duration is None else own.duration)
            ahead = dt.timedelta(minutes=self.forecast_extension if own.forecast_extension is None else own.forecast_extension)
            end = min(at + step, self.end)
            out.append(Cycle(len(out), at, end, at - self.start, own.output_interval, min(end + ahead, self.end)))
            at += step
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c.index, c.start, c.end) for c in self.cycles()]
        return spark.createDataFrame(rows, "cycle_index int, start_time timestamp_ntz, end_time timestamp_ntz")


def windows(calendar: DataFrame, half_minutes: int) -> DataFrame:
    """Adds the assimilation window around each cycle's end."""
    half = F.make_dt_interval(mins=F.lit(half_minutes))
    return calendar.withColumns({"window_start": F.col("end_time") - half, "window_end": F.col("end_time") + half})


def summary(calendar: DataFrame, obs: DataFrame, half_minutes: int, assimilated: Sequence[str]) -> DataFrame:
    """For every cycle: rows within it, and good rows of some instruments within its window.

    Closed intervals: a row on a boundary counts in both cycles.  Observations are
    counted before they meet the calendar again, so they are never the broadcast side.
    """
    rows = obs.select("time", "instrument", "qc_flag")
    total = in_windows(rows, calendar, "time", "start_time", "end_time").groupBy("cycle_index").agg(F.count(F.lit(1)).alias("total"))
    used = instruments(rows.where("qc_flag = 0"), assimilated)
    near = in_windows(used, windows(calendar, half_minutes), "time", "window_start", "window_end").groupBy("cycle_index").agg(F.count(F.lit(1)).alias("in_window"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return calendar.join(total, "cycle_index", "left").join(near, "cycle_index", "left").select("cycle_index", "start_time", "end_time", zero("total"), zero("in_window"))


def file_info(calendar: DataFrame, obs: DataFrame, half_minutes: int, assimilated: Sequence[str]) -> DataFrame:
    """Rows of each (cycle window, instrument, file): all, assimilated, and the share."""
    near = in_windows(obs.select("time", "instrument", "qc_flag", "orig_filename"), windows(calendar, half_minutes), "time", "window_start", "window_end")
    use = (F.col("qc_flag") == 0) & (F.col("instrument").isin(*assimilated) if assimilated else F.lit(True))
    out = near.groupBy("cycle_index", "instrument", "orig_filename").agg(F.count(F.lit(1)).alias("total"), F.count_if(use).alias("assimilated"))
    return out.withColumn("percent", percent(F.col("assimilated"), F.col("total")))


def observations_for_cycles(calendar: DataFrame, obs: DataFrame, half_minutes: int, names: Sequence[str], factors: DataFrame) -> DataFrame:
    """The rows of every cycle's window, bad variances flagged and uncertainties inflated by the factors."""
    near = in_windows(instruments(obs, names), windows(calendar, half_minutes), "time", "window_start", "window_end")
    scaled = with_factors(bad_variance(near), factors)
    return scaled.withColumn("value_uncertainty", F.col("value_uncertainty") * F.col("factor"))


def runtime_stats(runs: DataFrame) -> DataFrame:
    """Run-time minutes by cycle, by member and overall, in one pass of grouping sets.

    ``runs`` holds cycle, member, start_time, end_time and duration_s.
    """
    minutes = F.col("duration_s") / 60.0
    sets = runs.groupingSets([["cycle"], ["member"], []], "cycle", "member")
    wall = (F.unix_micros(F.max("end_time").cast("timestamp")) - F.unix_micros(F.min("start_time").cast("timestamp"))) / 60e6
    level = F.when(F.grouping("cycle") == 0, "cycle").when(F.grouping("member") == 0, "member").otherwise("all")
    return sets.agg(
        level.alias("level"),
        F.count(F.lit(1)).alias("n"),
        F.avg(minutes).alias("mean_min"),
        F.min(minutes).alias("min_min"),
        F.max(minutes).alias("max_min"),
        F.stddev_pop(minutes).alias("std_min"),
        wall.alias("wall_min"),
        F.sum(minutes).alias("total_min"),
    )


def runtime_change(runs: DataFrame) -> DataFrame:
    """Each member's duration beside that of its cycle before."""
    w = Window.partitionBy("member").orderBy("cycle")
    before = F.lag("duration_s").over(w)
    return runs.select("member", "cycle", "duration_s", before.alias("previous_s"), (F.col("duration_s") - before).alias("change_s"))
