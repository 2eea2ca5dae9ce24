"""The driver's tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as observation rows with model equivalents."""
    e = F.col("event_id")
    number = lambda k, n: ((e * k) % n).cast("double")
    return table(spark, sf_dir, "events").select(
        e.alias("obs_id"),
        F.col("event_type").alias("instrument"),
        F.when(F.col("user_id") % 2 == 0, "AOD_550nm").otherwise("HLOS_WIND").alias("quantity"),
        F.col("ts").alias("time"),
        (number(37, 3600) / 10 - 180).alias("longitude"),
        (number(91, 1800) / 10 - 90).alias("latitude"),
        (number(37, 3600) * 1000).alias("x"),
        (number(91, 1800) * 1000).alias("y"),
        number(13, 20000).alias("z"),
        F.when(e % 3 == 0, "height").otherwise("columnar").alias("z_type"),
        "value",
        F.when(e % 50 != 0, F.lit(0.05) + F.lit(0.1) * F.col("value")).alias("value_uncertainty"),
        F.when(e % 7 == 0, 1).otherwise(0).alias("qc_flag"),
        F.floor(e / 24.0).cast("int").alias("c_profile"),
        (e % 24).cast("int").alias("c_bin"),
        F.concat(F.lit("file"), (F.col("user_id") % 4).cast("string")).alias("ingest_file"),
        F.concat(F.lit("raw"), (F.col("user_id") % 3).cast("string")).alias("orig_filename"),
        F.col("props").alias("metadata"),
        F.when(e % 10 != 0, F.col("value") * 0.9 + (e % 11) * 0.5).alias("model_forecast"),
        F.when(e % 9 != 0, F.col("value") * 0.95 + (e % 7) * 0.3).alias("model_analysis"),
        (F.lit(0.1) + (e % 5) * 0.2).alias("model_forecast_spread"),
        (F.lit(0.08) + (e % 4) * 0.15).alias("model_analysis_spread"),
    )


#: The same rows in DuckDB, for oracle SQL: ``WITH`` clause without the keyword.
OBS_SQL = """obs AS (SELECT
  event_id AS obs_id, event_type AS instrument,
  CASE WHEN user_id % 2 = 0 THEN 'AOD_550nm' ELSE 'HLOS_WIND' END AS quantity,
  ts AS "time",
  CAST((event_id*37) % 3600 AS DOUBLE)/10 - 180 AS longitude,
  CAST((event_id*91) % 1800 AS DOUBLE)/10 - 90 AS latitude,
  CAST((event_id*37) % 3600 AS DOUBLE)*1000 AS x,
  CAST((event_id*91) % 1800 AS DOUBLE)*1000 AS y,
  CAST((event_id*13) % 20000 AS DOUBLE) AS z,
  CASE WHEN event_id % 3 = 0 THEN 'height' ELSE 'columnar' END AS z_type,
  value,
  CASE WHEN event_id % 50 <> 0 THEN CAST(0.05 AS DOUBLE) + CAST(0.1 AS DOUBLE)*value END AS value_uncertainty,
  CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS qc_flag,
  CAST(floor(event_id/24.0) AS INT) AS c_profile,
  CAST(event_id % 24 AS INT) AS c_bin,
  'file' || CAST(user_id % 4 AS VARCHAR) AS ingest_file,
  'raw' || CAST(user_id % 3 AS VARCHAR) AS orig_filename,
  props AS metadata,
  CASE WHEN event_id % 10 <> 0 THEN value*CAST(0.9 AS DOUBLE) + CAST(event_id % 11 AS DOUBLE)*CAST(0.5 AS DOUBLE) END AS model_forecast,
  CASE WHEN event_id % 9 <> 0 THEN value*CAST(0.95 AS DOUBLE) + CAST(event_id % 7 AS DOUBLE)*CAST(0.3 AS DOUBLE) END AS model_analysis,
  CAST(0.1 AS DOUBLE) + CAST(event_id % 5 AS DOUBLE)*CAST(0.2 AS DOUBLE) AS model_forecast_spread,
  CAST(0.08 AS DOUBLE) + CAST(event_id % 4 AS DOUBLE)*CAST(0.15 AS DOUBLE) AS model_analysis_spread
FROM events)"""


def cycle_calendar(spark: SparkSession, n: int = 120, hours: int = 6, start: str = "2024-01-01 00:00:00") -> DataFrame:
    """Six-hour cycles over January 2024: (cycle_index, start_time, end_time)."""
    first = F.to_timestamp_ntz(F.lit(start))
    step = lambda k: first + F.make_dt_interval(hours=k * hours)
    i = F.col("id").cast("int")
    return spark.range(n).select(i.alias("cycle_index"), step(i).alias("start_time"), step(i + 1).alias("end_time"))


CALENDAR_SQL = """cycles AS (SELECT CAST(i AS INT) AS cycle_index,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (6*i) HOUR AS start_time,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (6*(i+1)) HOUR AS end_time FROM range(120) t(i))"""


def ensemble_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as a member grid: (var, t_idx, ix, iy, iz, member, value); 10 members, 64 levels."""
    level = F.posexplode("embedding").alias("iz", "value")
    return (
        table(spark, sf_dir, "embeddings")
        .select("vec_id", "label", level)
        .select(
            F.when(F.col("label") % 2 == 0, "T").otherwise("QVAPOR").alias("var"),
            (F.col("vec_id") % 2).cast("int").alias("t_idx"),
            (F.floor(F.col("vec_id") / 20.0) % 5).cast("int").alias("ix"),
            (F.floor(F.col("vec_id") / 100.0)).cast("int").alias("iy"),
            "iz",
            (F.floor(F.col("vec_id") / 2.0) % 10).cast("int").alias("member"),
            F.col("value").cast("double").alias("value"),
        )
    )


GRID_SQL = """grid AS (SELECT CASE WHEN label % 2 = 0 THEN 'T' ELSE 'QVAPOR' END AS var,
  CAST(vec_id % 2 AS INT) AS t_idx, CAST(CAST(floor(vec_id/20.0) AS BIGINT) % 5 AS INT) AS ix,
  CAST(floor(vec_id/100.0) AS INT) AS iy, CAST(k AS INT) AS iz,
  CAST(CAST(floor(vec_id/2.0) AS BIGINT) % 10 AS INT) AS member,
  CAST(embedding[k+1] AS DOUBLE) AS value FROM embeddings, range(64) r(k))"""


def model_frames(spark: SparkSession) -> DataFrame:
    """A model grid, rough in t, x, y and level: daily frames, 200 km spacing.

    (t_idx, t, ix, iy, x, y, profile of values, heights of the levels)
    """
    t = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(hours=F.col("t_idx") * 24)
    k = F.sequence(F.lit(0), F.lit(10))
    return (
        spark.range(31)
        .select(F.col("id").cast("int").alias("t_idx"))
        .crossJoin(spark.range(19).select(F.col("id").cast("int").alias("ix")))
        .crossJoin(spark.range(10).select(F.col("id").cast("int").alias("iy")))
        .select(
            "t_idx",
            t.alias("t"),
            "ix",
            "iy",
            (F.col("ix") * 200_000.0).alias("x"),
            (F.col("iy") * 200_000.0).alias("y"),
            F.transform(k, lambda l: F.col("t_idx") * 1.0 + F.col("ix") * 0.5 + F.col("iy") * 0.25 + l * 2.0 + (F.col("t_idx") * 7 + F.col("ix") * 5 + F.col("iy") * 3 + l * 11) % 13 * 0.5).alias("profile"),
            F.transform(k, lambda l: l * 2000.0 + F.lit(0.0)).alias("levels"),
        )
    )
