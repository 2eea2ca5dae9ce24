"""Live forms of the bounded operators: the same expressions over streams, with watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_arriving(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def time_bins(stream: DataFrame, minutes: int, offset_minutes: int = 0, late: str = "1 hour") -> DataFrame:
    """Time-binned observations, each bin final once the watermark passes it.

    Bins start at the epoch plus the offset, which is the bounded operator's rule
    for widths that divide a day.
    """
    offset = f"{offset_minutes % minutes} minutes"
    good = F.col("qc_flag") == 0
    pick = lambda f, c: F.when(F.count_if(good) > 0, f(F.when(good, F.col(c)))).otherwise(f(c))
    return (
        stream.withWatermark("time", late)
        .groupBy("instrument", "quantity", F.window("time", f"{minutes} minutes", f"{minutes} minutes", offset))
        .agg(
            F.when(F.count_if(good) > 0, F.count_if(good)).otherwise(F.count(F.lit(1))).alias("n"),
            F.when(F.count_if(good) > 0, 0).otherwise(1).alias("qc_flag"),
            pick(F.avg, "value").alias("value"),
            pick(F.stddev_samp, "value").alias("repr_error"),
        )
        .select("instrument", "quantity", F.col("window.start").alias("bin_start"), "n", "qc_flag", "value", "repr_error")
    )


def ensemble_stats(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """Mean and deviation of member fields (t, var, ix, iy, iz, member, value) as members arrive."""
    return (
        stream.withWatermark("t", late)
        .groupBy("t", "var", "ix", "iy", "iz")
        .agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    )


def append_to(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Finished rows appended as Parquet; with ``once`` it stops when all there is has been read."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
