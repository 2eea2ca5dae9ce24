"""Row filters: places, times, quality, metadata, and the group-preserving trim."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Box = tuple[float, float, float, float]


def within(
    df: DataFrame,
    min_lat: float | None = None,
    max_lat: float | None = None,
    min_lon: float | None = None,
    max_lon: float | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
) -> DataFrame:
    """Inclusive ranges; bounds outside the globe or the wrong way round raise."""
    for name, value, most in (("latitude", min_lat, 90), ("latitude", max_lat, 90), ("longitude", min_lon, 180), ("longitude", max_lon, 180)):
        if value is not None and abs(value) > most:
            raise ValueError(f"{name} {value} is outside -{most} to {most}")
    for low, high in ((min_lat, max_lat), (min_lon, max_lon), (start, end)):
        if low is not None and high is not None and low > high:
            raise ValueError(f"{low} is above {high}")
    for column, low, high in (("latitude", min_lat, max_lat), ("longitude", min_lon, max_lon), ("time", start, end)):
        if low is not None:
            df = df.where(F.col(column) >= F.lit(low))
        if high is not None:
            df = df.where(F.col(column) <= F.lit(high))
    return df


def in_box(box: Box) -> Column:
    """``(min_lat, min_lon, max_lat, max_lon)``, inclusive."""
    return F.col("latitude").between(box[0], box[2]) & F.col("longitude").between(box[1], box[3])


def boxes(df: DataFrame, include: Box | None = None, exclude: Sequence[Box] = ()) -> DataFrame:
    if include is not None:
        df = df.where(in_box(include))
    for box in exclude:
        df = df.where(~in_box(box))
    return df


def instruments(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """An empty list keeps all."""
    return df.where(F.col("instrument").isin(*names)) if names else df


def without_pairs(df: DataFrame, pairs: Sequence[str]) -> DataFrame:
    """Drop ``instrument.quantity`` pairs."""
    return df.where(~F.concat_ws(".", "instrument", "quantity").isin(*pairs)) if pairs else df


def quality(df: DataFrame, flags: Sequence[int] = (0,)) -> DataFrame:
    return df.where(F.col("qc_flag").isin(*flags))


def metadata_is(df: DataFrame, key: str, op: str, value: str) -> DataFrame:
    """Rows whose metadata lacks the key, or holds (``=``) or doesn't hold (``!=``) the text."""
    if op not in ("=", "!="):
        raise ValueError(f"unknown operator {op}")
    found = F.get_json_object("metadata", f"$.{key}")
    return df.where(found.isNull() | ((found == value) if op == "=" else (found != value)))


def parse_metadata_filter(text: str) -> tuple[str, str, str]:
    """``key=value`` or ``key!=value``"""
    op = "!=" if "!=" in text else "="
    key, found, value = text.partition(op)
    if not found or not key.strip():
        raise ValueError(f"not a metadata filter: {text}")
    return key.strip(), op, value.strip()


def finite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose columns are all finite numbers."""
    bad = lambda c: F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
    for c in columns:
        df = df.where(~bad(c))
    return df


def bad_variance(df: DataFrame) -> DataFrame:
    """Uncertainties that are null or not positive get flag 99; negative ones become 0."""
    u = F.col("value_uncertainty")
    return df.withColumns({"qc_flag": F.when(u.isNull() | (u <= 0), F.lit(99)).otherwise(F.col("qc_flag")), "value_uncertainty": F.when(u < 0, F.lit(0.0)).otherwise(u)})


def away_from_edges(
    df: DataFrame, x: tuple[float, float], y: tuple[float, float], step: float, width: float = 0.0, error_factor: float = 0.0, error_width: float = 0.0
) -> DataFrame:
    """Rows of the domain less ``width`` grid points on every side; errors grow linearly towards the edge that is left.

    ``x`` and ``y`` are the domain's bounds and ``step`` a grid point.  The uncertainty is multiplied by 1 at
    ``error_width`` points from the edge and further in, by ``error_factor`` at the edge; a factor of 0 leaves
    all errors as they are.
    """
    rim = width * step
    inside = F.col("x").between(x[0] + rim, x[1] - rim) & F.col("y").between(y[0] + rim, y[1] - rim)
    kept = df.where(inside)
    if error_factor <= 0 or error_width <= 0:
        return kept
    depth = F.least(F.col("x") - (x[0] + rim), (x[1] - rim) - F.col("x"), F.col("y") - (y[0] + rim), (y[1] - rim) - F.col("y")) / (error_width * step)
    factor = 1 + (error_factor - 1) * (1 - F.least(depth, F.lit(1.0)))
    return kept.withColumn("value_uncertainty", F.col("value_uncertainty") * factor)


def trim_groups(df: DataFrame, inside: Column, indices: Column, shape: Column) -> DataFrame:
    """Keep whole groups that touch the domain.

    The smallest dimension of ``shape`` (the first, in a tie) runs along a group;
    the other indices name it.  Groups with a row inside stay complete, and rows
    outside lose their value and uncertainty.
    """
    along = F.array_position(shape, F.array_min(shape)).cast("int")
    key = F.filter(indices, lambda _, i: i != along - 1)
    group = Window.partitionBy("ingest_file", "quantity", "_group")
    kept = df.withColumns({"_inside": inside, "_group": key}).withColumn("_any", F.max("_inside").over(group)).where("_any")
    blank = lambda c: F.when(F.col("_inside"), F.col(c)).alias(c)
    return kept.select(*[blank(c) if c in ("value", "value_uncertainty") else F.col(c) for c in df.columns])
