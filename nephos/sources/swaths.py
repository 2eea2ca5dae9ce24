"""Products' files to cells: one row for each cell of a swath, with its indices and the swath's size.

A task reads a stretch of a swath's first dimension, so a large file costs no task more
than that.  Classic files are read as they are, those of the HDF5-based format where
netCDF4 is installed; a file without groups may hold a product's variables by their
last names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.session import ship_package
from nephos.sources.converters import lidar, radiometers
from nephos.sources.netcdf import open_grid

#: Cells that a task reads at a time, about.
STRETCH = 200_000


@dataclass(frozen=True)
class Product:
    """What a product's files hold: the variable over all cells, columns by variable, index columns by dimension.

    ``label`` names the text variable of the last dimension, ``times`` the columns that are
    times; further dimensions of a variable are reduced to their least value.
    """

    cells: str
    columns: dict[str, str]
    indices: tuple[str, ...]
    label: str | None = None
    times: frozenset[str] = field(default_factory=frozenset)


#: Names of the products' variables (fixed values).
PRODUCTS = {
    "viirs": Product(
        "Aerosol_Optical_Thickness_550_Land_Ocean_Best_Estimate",
        {
            "latitude": "Latitude",
            "longitude": "Longitude",
            "scan_time": "Scan_Start_Time",
            "aod": "Aerosol_Optical_Thickness_550_Land_Ocean_Best_Estimate",
            "error_land": "Aerosol_Optical_Thickness_550_Expected_Uncertainty_Land",
            "error_ocean": "Aerosol_Optical_Thickness_550_Expected_Uncertainty_Ocean",
        },
        ("along", "across"),
    ),
    "grasp-harp2": Product(
        "aerosol_optical_depth_total",
        {
            "latitude": "latitude",
            "longitude": "longitude",
            "unix_time": "measurement_time_unix",
            "total": "aerosol_optical_depth_total",
            "fine": "aerosol_fine_mode_optical_depth",
            "coarse": "aerosol_coarse_mode_optical_depth",
        },
        ("y", "x", "at_band"),
        label="band",
    ),
    "remotap-spexone": Product(
        "geophysical_data/aot550",
        {
            "latitude": "geolocation_data/latitude",
            "longitude": "geolocation_data/longitude",
            "utc_date": "geolocation_data/utc_date",
            "fraction": "geolocation_data/fracday",
            "aod": "geophysical_data/aot550",
            "error": "geophysical_data/aot550_uncertainty",
        },
        ("along", "across"),
    ),
    "earthcare-ebd": Product(
        "ScienceData/particle_extinction_coefficient_355nm_low_resolution",
        {
            "latitude": "ScienceData/latitude",
            "longitude": "ScienceData/longitude",
            "time": "ScienceData/time",
            "height": "ScienceData/height",
            "extinction": "ScienceData/particle_extinction_coefficient_355nm_low_resolution",
            "class": "ScienceData/simple_classification",
        },
        ("profile", "level"),
        times=frozenset({"time"}),
    ),
}


def _spread(values: np.ndarray, dims: list[str], wanted: list[str]) -> np.ndarray:
    """Values over ``dims`` as an array that broadcasts over ``wanted``; other dimensions are reduced to their least value."""
    for d in [d for d in dims if d not in wanted]:
        values = np.nanmin(values, axis=dims.index(d))
        dims = [x for x in dims if x != d]
    order = [d for d in wanted if d in dims]
    values = np.transpose(values, [dims.index(d) for d in order])
    return values.reshape([values.shape[order.index(d)] if d in dims else 1 for d in wanted])


def read_cells(spark: SparkSession, path: str, product: str) -> DataFrame:
    """The cells of a product's files: its columns, indices, the label, file, product_name, and n_ of each index."""
    ship_package(spark)
    p = PRODUCTS[product]
    names = [*p.columns, *([p.label] if p.label else [])]

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["path"]:
                data = open_grid(name)
                shape = data.shape(data.name(p.cells))
                step = max(1, STRETCH // max(1, int(np.prod(shape[1:]))))
                first = np.arange(0, shape[0], step, dtype=np.int32)
                yield pd.DataFrame({"file": name, "first": first, "last": np.minimum(first + step, shape[0]).astype(np.int32)})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, first, last in zip(batch["file"], batch["first"], batch["last"], strict=True):
                data = open_grid(name)
                main = data.name(p.cells)
                dims, whole = list(data.dims(main)), data.shape(main)
                shape = (last - first, *whole[1:])
                out = {}
                for column, variable in p.columns.items():
                    v = data.name(variable)
                    mine = list(data.dims(v))
                    values = np.stack([data.floats(v, int(k)) for k in range(first, last)]) if mine[:1] == dims[:1] else data.floats(v)
                    if column in p.times:
                        values = data.epoch(v, values)
                    out[column] = np.broadcast_to(_spread(values, mine, dims), shape).ravel()
                if p.label:
                    out[p.label] = np.broadcast_to(np.array(data.texts(data.name(p.label)), object), shape).ravel()
                places = np.indices(shape)
                places[0] += first
                for d, at, n in zip(p.indices, places, whole, strict=True):
                    out |= {d: at.ravel().astype(np.int32), f"n_{d}": np.int32(n)}
                yield pd.DataFrame(out | {"file": name.rsplit("/", 1)[-1], "product_name": str(data.attributes.get("product_name", ""))})

    kinds = ", ".join([*(f"`{c}` double" for c in p.columns), *(f"`{c}` string" for c in names[len(p.columns) :]), *(f"{d} int, n_{d} int" for d in p.indices)])
    files = spark.read.format("binaryFile").load(path).select("path")
    parts = files.mapInPandas(stretches, "file string, first int, last int").repartition("file", "first")
    cells = parts.mapInPandas(read, f"{kinds}, file string, product_name string")
    return cells.withColumns({c: F.timestamp_micros(F.round(F.col(c) * 1e6).cast("bigint")) for c in p.times})


def convert_files(spark: SparkSession, path: str, product: str, **options) -> DataFrame:
    """Observation rows of a product's files."""
    cells = read_cells(spark, path, product)
    if product == "viirs":
        return radiometers.viirs(cells, (F.col("n_along"), F.col("n_across")), F.col("file"), **options)
    if product == "grasp-harp2":
        return radiometers.harp2(cells, (F.col("n_y"), F.col("n_x")), F.col("file"), **options)
    if product == "remotap-spexone":
        return radiometers.spexone(cells, (F.col("n_along"), F.col("n_across")), F.col("product_name"), F.col("file"), **options)
    return lidar.earthcare(cells, (F.col("n_profile"), F.col("n_level")), F.col("file"), keys=("file",), **options)
