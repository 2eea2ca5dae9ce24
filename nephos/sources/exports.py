"""Rows for the assimilation filter's text input, and what is read back from its files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephos.functions.columns import mapped, metadata_pairs, wrap_360

#: Observation types of the filter by quantity; others keep their name (fixed values).
FILTER_TYPES = {
    "AOD_500nm": "AIRSENSE_AOD",
    "AOD_550nm": "AIRSENSE_AOD",
    "AOD_Fine_550nm": "AIRSENSE_AOD_FINE",
    "AOD_Coarse_550nm": "AIRSENSE_AOD_COARSE",
}


def filter_rows(df: DataFrame, *keep: str) -> DataFrame:
    """Thirteen ordered columns, longitudes in [0, 360), without null values; ``keep`` comes first."""
    parts = {n: f("time") for n, f in (("year", F.year), ("month", F.month), ("day", F.dayofmonth), ("hour", F.hour), ("minute", F.minute), ("second", F.second))}
    return df.where("value IS NOT NULL").select(
        *keep,
        mapped(F.col("quantity"), FILTER_TYPES).alias("obs_type"),
        wrap_360(F.col("longitude")).alias("longitude"),
        "latitude",
        F.col("z").alias("vert"),
        *[c.alias(n) for n, c in parts.items()],
        F.col("value").alias("obs_value"),
        F.col("value_uncertainty").alias("obs_error"),
        metadata_pairs(F.col("metadata")).alias("obs_meta"),
    )


def sequence_count(header: Column) -> Column:
    """The number of observations that a sequence file's first 2 KB name: the word after ``num_obs:``; null without one."""
    found = F.filter(F.split(F.substring(header, 1, 2048), r"\s+"), lambda w: w != "")
    at = F.array_position(found, "num_obs:")
    return F.when(at > 0, F.get(found, at.cast("int"))).try_cast("bigint")


def diagnostics_rows(wide: DataFrame, n_members: int) -> DataFrame:
    """``member_i_prior`` and ``member_i_posterior`` columns as two arrays."""
    arrays = {s: F.array(*[F.col(f"member_{i}_{s}") for i in range(n_members)]) for s in ("prior", "posterior") if f"member_0_{s}" in wide.columns}
    members = {f"member_{i}_{s}" for i in range(n_members) for s in ("prior", "posterior")}
    return wide.withColumns(arrays).select(*[c for c in wide.columns if c not in members], *arrays)
