"""Density reduction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nephos.adapters import OBS_SQL, observations
from nephos.operators import superobs
from nephos.queries.shape import r, rounded
from nephos.registry import register

BASE_US = 1_704_067_200_000_000
TIME_SQL = f"make_timestamp(CAST(round(avg(CAST(epoch_us(\"time\") - {BASE_US} AS DOUBLE))) AS BIGINT) + {BASE_US}) AS \"time\""
CENTRE_SQL = r("avg(longitude) AS longitude", "avg(latitude) AS latitude", "avg(x) AS x", "avg(y) AS y", "avg(z) AS z", "avg(value) AS value")
FIRST = "arg_min({0}, (\"time\", obs_id))"


@register(
    "grid_bin_superobs",
    f"""WITH {OBS_SQL}, b AS (SELECT *, CAST(floor(c_profile/5.0) AS INT) AS bin_c_profile, CAST(floor(c_bin/4.0) AS INT) AS bin_c_bin FROM obs),
    g AS (SELECT *, max(CASE WHEN qc_flag = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY ingest_file, instrument, quantity, bin_c_profile, bin_c_bin) AS has_good FROM b),
    k AS (SELECT * FROM g WHERE qc_flag = 0 OR has_good = 0),
    a AS (SELECT ingest_file, instrument, quantity, bin_c_profile, bin_c_bin, count(*) AS n, 1 - max(has_good) AS qc_flag, {TIME_SQL}, {CENTRE_SQL},
      sqrt(avg(value_uncertainty*value_uncertainty))/sqrt(CAST(count(*) AS DOUBLE)) AS ie,
      CASE WHEN count(*) > 1 THEN stddev_samp(value) ELSE first(value_uncertainty) END AS re,
      (min({{'t': "time", 'i': obs_id, 'v': z_type}})).v AS z_type, (min({{'t': "time", 'i': obs_id, 'v': orig_filename}})).v AS orig_filename, (min({{'t': "time", 'i': obs_id, 'v': metadata}})).v AS metadata FROM k GROUP BY ALL)
    SELECT ingest_file, instrument, quantity, bin_c_profile, bin_c_bin, n, qc_flag, "time", longitude, latitude, x, y, z, value,
    {r("ie AS instrument_error", "re AS repr_error", "sqrt(ie*ie + re*re) AS value_uncertainty")}, z_type, orig_filename, metadata,
    max(bin_c_profile) OVER p + 1 AS shape_c_profile, max(bin_c_bin) OVER p + 1 AS shape_c_bin FROM a WINDOW p AS (PARTITION BY ingest_file, instrument, quantity)""",
)
def grid_bin_superobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(superobs.grid_superobs(observations(spark, sf_dir), {"c_profile": 5}, {"c_bin": 4}))


@register(
    "time_bin_superobs",
    f"""WITH {OBS_SQL}, o AS (SELECT *, epoch_us("time") AS us, CAST(floor(min(epoch_us("time")) OVER (PARTITION BY ingest_file, instrument, quantity)/86400000000) AS BIGINT)*86400000000 - 1800000000 AS origin FROM obs),
    b AS (SELECT *, origin + CAST(floor((us - origin)/3600000000) AS BIGINT)*3600000000 AS bin FROM o),
    g AS (SELECT *, max(CASE WHEN qc_flag = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY ingest_file, instrument, quantity, bin) AS has_good FROM b),
    k AS (SELECT * FROM g WHERE qc_flag = 0 OR has_good = 0),
    a AS (SELECT ingest_file, instrument, quantity, bin, count(*) AS n, 1 - max(has_good) AS qc_flag, {TIME_SQL}, {CENTRE_SQL},
      sqrt(avg(value_uncertainty*value_uncertainty))/sqrt(CAST(nullif(count(value_uncertainty), 0) AS DOUBLE)) AS ie,
      CASE WHEN count(*) > 1 THEN stddev_samp(value) ELSE first(value_uncertainty) END AS re,
      (min({{'t': "time", 'i': obs_id, 'v': z_type}})).v AS z_type, (min({{'t': "time", 'i': obs_id, 'v': orig_filename}})).v AS orig_filename, (min({{'t': "time", 'i': obs_id, 'v': metadata}})).v AS metadata FROM k GROUP BY ALL)
    SELECT ingest_file, instrument, quantity, n, qc_flag, "time", longitude, latitude, x, y, z, value, z_type, orig_filename, metadata, {r("ie AS instrument_error", "re AS repr_error",
      "CASE WHEN ie IS NOT NULL OR re IS NOT NULL THEN sqrt(coalesce(ie*ie, 0) + coalesce(re*re, 0)) END AS value_uncertainty")},
    CAST(floor((bin + 1800000000)/3600000000) AS INT) AS bin_time, make_timestamp(bin) AS bin_start,
    max(CAST(floor((bin + 1800000000)/3600000000) AS INT)) OVER (PARTITION BY ingest_file, instrument, quantity) + 1 AS shape_time FROM a""",
)
def time_bin_superobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(superobs.time_superobs(observations(spark, sf_dir), 60, -30))


@register(
    "stride_thin",
    f"""WITH {OBS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY ingest_file, instrument, quantity, qc_flag = 0 ORDER BY "time", obs_id) - 1 AS k FROM obs)
    SELECT obs_id, ingest_file, instrument, quantity, CASE WHEN qc_flag = 0 AND k % 5 <> 0 THEN -1 ELSE qc_flag END AS qc_flag FROM n""",
)
def stride_thin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superobs.stride_thin(observations(spark, sf_dir), 5).select("obs_id", "ingest_file", "instrument", "quantity", "qc_flag")


@register(
    "reduce_density",
    f"""WITH {OBS_SQL}, k AS (SELECT *, instrument || '.' || quantity AS pair, epoch_us("time") AS us FROM obs),
    b AS (SELECT *, CASE pair WHEN 'click.AOD_550nm' THEN CAST(floor(c_profile/5.0) AS BIGINT) WHEN 'click.HLOS_WIND' THEN CAST(floor(c_profile/12.0) AS BIGINT) END AS bp,
      CASE pair WHEN 'click.AOD_550nm' THEN CAST(floor(c_bin/4.0) AS BIGINT) END AS bb,
      CAST(floor((us - CAST(1800000000 AS BIGINT)*CASE pair WHEN 'signup.AOD_550nm' THEN -1 ELSE 1 END)/(CAST(60000000 AS BIGINT)*CASE pair WHEN 'signup.AOD_550nm' THEN 60 ELSE 120 END)) AS BIGINT) AS bt FROM k),
    f AS (SELECT *, instrument = 'click' AS in_grid, max(CASE WHEN qc_flag = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY ingest_file, instrument, quantity, CASE WHEN instrument = 'click' THEN bp END, CASE WHEN instrument = 'click' THEN bb END, CASE WHEN instrument = 'signup' THEN bt END) AS has_good FROM b WHERE instrument IN ('click', 'signup')),
    e AS (SELECT ingest_file, instrument, quantity, any_value(in_grid) AS in_grid, 1 - max(has_good) AS qc_flag, {TIME_SQL}, {CENTRE_SQL}, count(*) AS c, count(value_uncertainty) AS cu, sqrt(avg(value_uncertainty*value_uncertainty)) AS root,
      CASE WHEN count(*) > 1 THEN stddev_samp(value) ELSE first(value_uncertainty) END AS re, (min({{'t': "time", 'i': obs_id, 'v': z_type}})).v AS z_type, (min({{'t': "time", 'i': obs_id, 'v': orig_filename}})).v AS orig_filename
      FROM f WHERE qc_flag = 0 OR has_good = 0 GROUP BY ingest_file, instrument, quantity, CASE WHEN instrument = 'click' THEN bp END, CASE WHEN instrument = 'click' THEN bb END, CASE WHEN instrument = 'signup' THEN bt END),
    i AS (SELECT *, CASE WHEN in_grid THEN root/sqrt(CAST(c AS DOUBLE)) WHEN cu > 0 THEN root/sqrt(CAST(cu AS DOUBLE)) END AS ie FROM e),
    s AS (SELECT ingest_file, instrument, quantity, qc_flag, "time", longitude, latitude, x, y, z, value, z_type, orig_filename,
      CASE WHEN in_grid THEN sqrt(ie*ie + re*re) WHEN ie IS NOT NULL OR re IS NOT NULL THEN sqrt(coalesce(ie*ie, 0) + coalesce(re*re, 0)) END AS value_uncertainty FROM i),
    n AS (SELECT *, row_number() OVER (PARTITION BY ingest_file, instrument, quantity, qc_flag = 0 ORDER BY "time", longitude, latitude, z) - 1 AS k FROM k WHERE instrument NOT IN ('click', 'signup')),
    t AS (SELECT ingest_file, instrument, quantity, CASE WHEN qc_flag = 0 AND ((pair = 'view.HLOS_WIND' AND k % 3 <> 0) OR (pair = 'purchase.AOD_550nm' AND k % 7 <> 0)) THEN -1 ELSE qc_flag END AS qc_flag,
      "time", longitude, latitude, x, y, z, value, z_type, orig_filename, value_uncertainty FROM n)
    SELECT ingest_file, instrument, quantity, qc_flag, "time", z_type, orig_filename, {r("longitude AS longitude", "latitude AS latitude", "x AS x", "y AS y", "z AS z", "value AS value", "value_uncertainty AS value_uncertainty")} FROM (SELECT * FROM t UNION ALL SELECT * FROM s)""",
)
def reduce_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pairs of superobs with sizes of their own, two of time bins, two of strides."""
    grids = {"click.AOD_550nm": ({"c_profile": 5}, {"c_bin": 4}), "click.HLOS_WIND": ({"c_profile": 12}, {})}
    bins = {"signup.AOD_550nm": (60, -30), "signup.HLOS_WIND": (120, 30)}
    out = superobs.reduce_density(observations(spark, sf_dir), grids, bins, {"view.HLOS_WIND": 3, "purchase.AOD_550nm": 7})
    columns = "ingest_file instrument quantity qc_flag time z_type orig_filename longitude latitude x y z value value_uncertainty".split()
    return rounded(out.select(columns))
