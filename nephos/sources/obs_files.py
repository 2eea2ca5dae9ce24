"""Observation files in Parquet: reading, writing, joining, expanding folders, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.schema import MODEL_COLUMNS, OBS_SCHEMA, validate


def read_obs(spark: SparkSession, *paths: str, check: bool = True) -> DataFrame:
    """Rows of observation files or folders of them; empty metadata is null; each row knows its file."""
    df = spark.read.schema(OBS_SCHEMA).option("pathGlobFilter", "*.parquet").parquet(*paths)
    df = df.withColumns({"metadata": F.nullif("metadata", F.lit("")), "ingest_file": F.col("_metadata.file_name")})
    return validate(df) if check else df


def write_obs(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The observation columns, then whatever else the frame has, after validation."""
    first = [f.name for f in OBS_SCHEMA.fields]
    validate(df).select(*first, *[c for c in df.columns if c not in first]).write.mode(mode).parquet(path)


def join_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return read_obs(spark, *paths)


def quantity_counts(df: DataFrame) -> DataFrame:
    """Rows of each (instrument, quantity), most first."""
    return df.groupBy("instrument", "quantity").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "instrument", "quantity")


def available_pairs(df: DataFrame, with_z_type: bool = False) -> DataFrame:
    return df.select("instrument", "quantity", *(["z_type"] if with_z_type else [])).distinct()


def file_overview(df: DataFrame) -> DataFrame:
    """First and last time, rows and rows with a model value of each (file, instrument)."""
    return df.groupBy("orig_filename", "instrument").agg(
        F.min("time").alias("start_time"), F.max("time").alias("end_time"), F.count(F.lit(1)).alias("count"), F.count("model_forecast").alias("model_values")
    )


def dump_info(df: DataFrame) -> DataFrame:
    """Ranges of time and place, and how many rows pass quality control; one row."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{name}_{c}") for c in ("time", "latitude", "longitude") for name, f in (("min", F.min), ("max", F.max))],
        F.count_if(F.col("qc_flag") == 0).alias("n_good"),
        F.coalesce(F.try_divide(F.count_if(F.col("qc_flag") == 0).cast("double"), F.count(F.lit(1)).cast("double")), F.lit(0.0)).alias("good_ratio"),
    )


def value_counts(df: DataFrame, columns: Sequence[str] = ("instrument", "quantity", "qc_flag")) -> DataFrame:
    """(column, value, count) of several columns in one pass of grouping sets."""
    sets = df.groupingSets([[c] for c in columns], *columns)
    name = F.coalesce(*[F.when(F.grouping(c) == 0, F.lit(c)) for c in columns])
    value = F.coalesce(*[F.when(F.grouping(c) == 0, F.col(c).cast("string")) for c in columns])
    return sets.agg(name.alias("column"), value.alias("value"), F.count(F.lit(1)).alias("count")).select("column", "value", "count")


def to_table(df: DataFrame) -> DataFrame:
    """Adds null model columns that a fresh frame lacks."""
    return df.withColumns({c: F.lit(None).cast("double") for c in MODEL_COLUMNS if c not in df.columns})


def pair_rows(
    df: DataFrame,
    instrument: str,
    quantity: str,
    flags: Sequence[int] = (0, -1),
    start: object = None,
    end: object = None,
    metadata: Sequence[tuple[str, str, str]] = (),
) -> DataFrame:
    """The rows of one pair that have a model value, with twelve columns only."""
    from nephos.operators.filters import metadata_is

    out = df.where((F.col("instrument") == instrument) & (F.col("quantity") == quantity) & F.col("model_forecast").isNotNull() & F.col("qc_flag").isin(*flags))
    if start is not None:
        out = out.where(F.col("time") >= F.lit(start))
    if end is not None:
        out = out.where(F.col("time") <= F.lit(end))
    for key, op, value in metadata:
        out = metadata_is(out, key, op, value)
    return out.select("instrument", "quantity", "time", "longitude", "latitude", "z", "z_type", "value", "value_uncertainty", "qc_flag", "model_forecast", "model_forecast_spread")
