"""Observation schemas and their validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Z_TYPES = ("surface", "pressure", "height", "model_level", "columnar")
QC_GOOD, QC_SUPEROB_OF_BAD, QC_HOLDOUT, QC_BAD_VARIANCE = 0, 1, -1, 99

ORIG_COORDS = T.StructType(
    [
        T.StructField("indices", T.ArrayType(T.IntegerType())),
        T.StructField("shape", T.ArrayType(T.IntegerType())),
        T.StructField("names", T.ArrayType(T.StringType())),
    ]
)

OBS_SCHEMA = T.StructType(
    [
        T.StructField("instrument", T.StringType(), False),
        T.StructField("quantity", T.StringType(), False),
        T.StructField("time", T.TimestampType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("z", T.DoubleType(), False),
        T.StructField("z_type", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
        T.StructField("value_uncertainty", T.DoubleType()),
        T.StructField("qc_flag", T.IntegerType()),
        T.StructField("orig_coords", ORIG_COORDS),
        T.StructField("orig_filename", T.StringType(), False),
        T.StructField("metadata", T.StringType()),
    ]
)

MODEL_COLUMNS = ("model_forecast", "model_analysis", "model_forecast_spread", "model_analysis_spread")

#: The analytic table: an explicit row id, the ingest file, projected places and model equivalents.
OBS_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("obs_id", T.LongType(), False),
        *OBS_SCHEMA.fields,
        T.StructField("x", T.DoubleType(), False),
        T.StructField("y", T.DoubleType(), False),
        *[T.StructField(c, T.DoubleType()) for c in MODEL_COLUMNS],
        T.StructField("ingest_file", T.StringType(), False),
    ]
)


class SchemaError(ValueError):
    """A frame does not follow the observation schema."""


def missing_columns(df: DataFrame) -> list[str]:
    return [f.name for f in OBS_SCHEMA.fields if f.name not in df.columns]


def violations(df: DataFrame) -> DataFrame:
    """One row of counts: rows that break each rule."""
    coords = F.col("orig_coords")
    sizes = [F.size(coords[c]) for c in ("indices", "shape", "names")]
    uneven = coords.isNotNull() & ((sizes[0] != sizes[1]) | (sizes[0] != sizes[2]))
    incomplete = coords.isNotNull() & (coords["indices"].isNull() | coords["shape"].isNull() | coords["names"].isNull())
    return df.agg(
        F.count_if(~F.coalesce(F.col("z_type").isin(*Z_TYPES), F.lit(False))).alias("bad_z_type"),
        F.count_if(F.coalesce(incomplete, F.lit(False))).alias("incomplete_orig_coords"),
        F.count_if(F.coalesce(uneven, F.lit(False))).alias("uneven_orig_coords"),
    )


def validate(df: DataFrame) -> DataFrame:
    """``df`` itself, or SchemaError; one aggregate pass over the rows."""
    if missing := missing_columns(df):
        raise SchemaError(f"missing columns: {', '.join(missing)}")
    counts = violations(df).first().asDict()
    if broken := {k: n for k, n in counts.items() if n}:
        raise SchemaError(f"rows that break a rule: {broken}")
    return df


def nan_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """NaN and infinities become null: aggregates then skip them."""
    bad = lambda c: F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
    return df.withColumns({c: F.when(~bad(c), F.col(c)) for c in columns})
