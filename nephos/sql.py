"""The operators in SQL text: temporary functions over the views ``observations`` and ``frame_spans``.

    SELECT instrument, avg(departure(value, model_forecast)) FROM observations GROUP BY instrument;
    SELECT * FROM superobs(5, 4);
    SELECT * FROM brackets(3600) WHERE valid;

Each function is SQL itself, so Catalyst sees through it: filters and columns of the
query around it reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nephos.operators.joins import frame_intervals

#: Width of the time slices in which observations meet frames, in microseconds.
SLICE_US = 21_600_000_000

SCALARS = {
    "departure(value DOUBLE, model DOUBLE) RETURNS DOUBLE": "value - model",
    "wrap_180(longitude DOUBLE) RETURNS DOUBLE": "pmod(longitude + 180, 360) - 180",
    "wrap_360(longitude DOUBLE) RETURNS DOUBLE": "pmod(longitude + 360, 360)",
    "line_of_sight_wind(east DOUBLE, north DOUBLE, azimuth DOUBLE) RETURNS DOUBLE": "-east*sin(radians(azimuth)) - north*cos(radians(azimuth))",
}


def _preferred(expression: str) -> str:
    """An aggregate over a bin's good rows, or over all where it has none; ``{}`` stands for the filter."""
    good, every = expression.format("FILTER (WHERE qc_flag = 0)"), expression.format("")
    return f"CASE WHEN bool_or(coalesce(qc_flag = 0, false)) THEN {good} ELSE {every} END"


_CENTRES = ", ".join(f"{_preferred(f'avg({c}) {{}}')} AS {c}" for c in ("longitude", "latitude", "z", "value"))
_N = _preferred("count(*) {}")

TABLES = {
    "superobs(first_size INT, second_size INT) RETURNS TABLE(ingest_file STRING, instrument STRING, quantity STRING, bin_first INT, bin_second INT, n BIGINT, qc_flag INT, longitude DOUBLE, latitude DOUBLE, z DOUBLE, value DOUBLE, value_uncertainty DOUBLE)": f"""
      SELECT ingest_file, instrument, quantity, bin_first, bin_second, n, qc_flag, longitude, latitude, z, value, sqrt(instrument_error*instrument_error + repr_error*repr_error) AS value_uncertainty FROM (
        SELECT ingest_file, instrument, quantity, bin_first, bin_second, {_N} AS n, CASE WHEN bool_or(coalesce(qc_flag = 0, false)) THEN 0 ELSE 1 END AS qc_flag, {_CENTRES},
          {_preferred("sqrt(avg(value_uncertainty*value_uncertainty) {}) / sqrt(CAST(count(*) {} AS DOUBLE))".replace("{}", "{0}"))} AS instrument_error,
          {_preferred("CASE WHEN count(*) {0} > 1 THEN stddev_samp(value) {0} ELSE max(value_uncertainty) {0} END")} AS repr_error
        FROM (SELECT *, CAST(floor(get(orig_coords.indices, 0) / CAST(superobs.first_size AS DOUBLE)) AS INT) AS bin_first, CAST(floor(get(orig_coords.indices, 1) / CAST(superobs.second_size AS DOUBLE)) AS INT) AS bin_second FROM observations)
        GROUP BY ingest_file, instrument, quantity, bin_first, bin_second)""",
    "brackets(tolerance_seconds INT) RETURNS TABLE(obs_id BIGINT, left_idx INT, right_idx INT, t_weight DOUBLE, valid BOOLEAN)": f"""
      SELECT obs_id, left_idx, right_idx, CASE WHEN right_us = left_us THEN 0D ELSE (clipped - left_us) / CAST(right_us - left_us AS DOUBLE) END AS t_weight,
        us >= low - brackets.tolerance_seconds * 1000000L AND us <= high + brackets.tolerance_seconds * 1000000L AS valid
      FROM (SELECT obs_id, us, low, high, least(greatest(us, low), high) AS clipped, CAST(floor(least(greatest(us, low), high) / {SLICE_US}) AS BIGINT) AS slice
        FROM (SELECT obs_id, unix_micros(CAST(time AS TIMESTAMP)) AS us FROM observations) CROSS JOIN (SELECT min(left_us) AS low, max(left_us) AS high FROM frame_spans))
      JOIN (SELECT *, explode(sequence(CAST(floor(left_us / {SLICE_US}) AS BIGINT), CAST(floor(right_us / {SLICE_US}) AS BIGINT))) AS slice FROM frame_spans) USING (slice)
      WHERE clipped >= left_us AND (clipped < right_us OR is_last)""",
}


def register_views(observations: DataFrame, frames: DataFrame | None = None) -> None:
    """``observations`` as a view, and the intervals between model ``frames`` (t_idx, t) as another."""
    observations.createOrReplaceTempView("observations")
    if frames is not None:
        frame_intervals(frames).createOrReplaceTempView("frame_spans")


def register_functions(spark: SparkSession) -> None:
    """The functions that the views at hand allow."""
    have = {t.name for t in spark.catalog.listTables()}
    for head, body in (SCALARS | TABLES).items():
        if head.startswith("brackets") and "frame_spans" not in have:
            continue
        if head.startswith("superobs") and "observations" not in have:
            continue
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
