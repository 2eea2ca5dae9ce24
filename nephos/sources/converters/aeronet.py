"""Sun-photometer tables: CSV with a preamble of six lines, wide to long.

Spark reads the lines, a large file in several tasks; a line's place in its file is its
place in its stretch and the lines of the stretches before.  Python splits the fields of
a batch of lines at a time.  A field ends with its line, quoted or not.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nephos.functions.columns import day_clock, null_if_missing
from nephos.operators.joins import small
from nephos.session import ship_package, write_shared
from nephos.sources.converters.base import observation, register

PREAMBLE = 6
PLACE = ("Site_Latitude(Degrees)", "Site_Longitude(Degrees)")
CLOCK = ("Date(dd:mm:yyyy)", "Time(hh:mm:ss)")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path as a URL, row, line): the bytes of every line of the files of ``path``, rows from 0 after the header, the header -1."""
    at = F.col("_metadata")
    text = spark.read.text(path).select(at["file_path"].alias("path"), at["file_block_start"].alias("stretch"), F.monotonically_increasing_id().alias("id"), F.col("value").cast("binary").alias("line"))
    stretches = write_shared(text.groupBy("path", "stretch").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "table-stretches")
    before = F.sum("n").over(Window.partitionBy("path").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    shift = (F.coalesce(before, F.lit(0)) - F.col("first") - PREAMBLE - 1).alias("shift")
    return text.join(small(stretches.select("path", "stretch", shift)), ["path", "stretch"]).select("path", (F.col("id") + F.col("shift")).alias("row"), "line")


def fields(line: bytes | None) -> list[str]:
    return next(csv.reader([bytes(line or b"").decode("latin-1")]), [])


def read_table(spark: SparkSession, path: str, quantities: Sequence[str]) -> DataFrame:
    """(row, file, date, clock, latitude, longitude, one column a quantity) of every file of ``path``."""
    ship_package(spark)
    names = [*CLOCK, *PLACE, *quantities]
    columns = ["row", "file", "date", "clock", "latitude", "longitude", *[f"q{k}" for k in range(len(quantities))]]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places, found = [], [unquote(p) for p in batch["path"]]
            for path_, line in zip(found, batch["line"], strict=True):
                header = fields(line)
                if missing := [n for n in names if n not in header]:
                    raise ValueError(f"{path_} has no column {', '.join(missing)}")
                places.append([header.index(n) for n in names])
            yield pd.DataFrame({"path": batch["path"], "file": [p.rsplit("/", 1)[-1] for p in found], "places": places})

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row, file, line, places in zip(batch["row"], batch["file"], batch["line"], batch["places"], strict=True):
                cells = fields(line)
                rows.append([row, file, *[cells[k] for k in places]])
            yield pd.DataFrame(rows, columns=columns)

    lines = numbered_lines(spark, path)
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"))
    headers = files.join(lines.where("row = -1").select("path", "line"), "path", "left").mapInPandas(find, "path string, file string, places array<int>")
    asked = lines.where("row >= 0 AND length(line) > 0").join(small(write_shared(headers, "table-headers")), "path").select("row", "file", "line", "places")
    values = ", ".join(f"q{k} string" for k in range(len(quantities)))
    raw = asked.mapInPandas(parse, f"row int, file string, date string, clock string, latitude string, longitude string, {values}")
    numbers = {c: F.col(c).try_cast("double") for c in ["latitude", "longitude"]}
    return raw.withColumns(numbers | {q: F.col(f"q{k}").try_cast("double") for k, q in enumerate(quantities)}).drop(*[f"q{k}" for k in range(len(quantities))])


@register("aeronet")
def convert(spark: SparkSession, path: str, quantities: Sequence[str] = ("AOD_340", "AOD_500")) -> DataFrame:
    """-999 is missing; rows without a value go; there is neither an uncertainty nor a flag."""
    wide = read_table(spark, path, quantities)
    ids = ["row", "file", "date", "clock", "latitude", "longitude"]
    long = wide.unpivot(ids, list(quantities), "quantity", "value").withColumn("value", null_if_missing(F.col("value"))).where("value IS NOT NULL")
    sizes = write_shared(long.groupBy("file").agg(F.count(F.lit(1)).cast("int").alias("n")), "table-sizes")
    sized = long.join(small(sizes), "file")
    where = F.struct(F.array("row").alias("indices"), F.array("n").alias("shape"), F.array(F.lit("row")).alias("names"))
    return observation(
        sized, instrument="AERONET", quantity=F.col("quantity"), time=day_clock(F.col("date"), F.col("clock")), longitude=F.col("longitude"), latitude=F.col("latitude"),
        z=0.0, z_type="surface", value=F.col("value"), qc_flag=0, orig_coords=where, orig_filename=F.col("file"),
    )


