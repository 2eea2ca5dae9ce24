"""Gridded model files and filter diagnostics to rows, and gridded rows to files.

The engine itself works on the Parquet grid table; this is the way in and out.
Files of the classic format are read by ``classic``, a frame at a time; those of the
HDF5-based format where netCDF4 is installed on the workers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nephos.session import ship_package
from nephos.sources import classic

GRID = "file string, var string, t_idx int, t timestamp, member int, iy int, ix int, profile array<double>, levels array<double>"


def open_grid(path: str):
    """A classic file, or one of the other format with the same few methods."""
    try:
        return classic.open_path(path)
    except ValueError as wrong:
        if "HDF5" not in str(wrong):
            raise
        try:
            import netCDF4
        except ImportError as e:
            raise RuntimeError(f"reading {path} needs netCDF4 on the workers") from e
        return Hierarchical(netCDF4, path)


class Hierarchical:
    """A file of the HDF5-based format, through netCDF4; variables in groups by path."""

    def __init__(self, library, path: str):
        self.library, self.data = library, library.Dataset(re.sub("^file:/*", "/", path))
        self.variables = {k: type("V", (), {"dims": v.dimensions}) for k, v in self.data.variables.items()}
        self.attributes = {k: self.data.getncattr(k) for k in self.data.ncattrs()}

    def name(self, path: str) -> str:
        return path

    def dims(self, name: str) -> tuple[str, ...]:
        return self.data[name].dimensions

    def shape(self, name: str) -> tuple[int, ...]:
        return self.data[name].shape

    def floats(self, name: str, first: int | None = None) -> np.ndarray:
        x = self.data[name][:] if first is None else self.data[name][first]
        return np.ma.filled(np.ma.asarray(x).astype(float), np.nan)

    def texts(self, name: str) -> list[str]:
        x = self.data[name][:]
        return [str(t).strip() for t in (self.library.chartostring(x) if x.dtype.kind == "S" and x.ndim > 1 else x)]

    def epoch(self, name: str, numbers: np.ndarray) -> np.ndarray:
        start = self.library.num2date(0, self.data[name].units, only_use_cftime_datetimes=False)
        one = self.library.num2date(1, self.data[name].units, only_use_cftime_datetimes=False)
        return pd.Timestamp(start, tz="UTC").timestamp() + numbers * (one - start).total_seconds()

    def times(self, name: str) -> list:
        return list(self.library.num2date(self.data[name][:], self.data[name].units, only_use_cftime_datetimes=False))


def columns_of(field: np.ndarray, dims: Sequence[str], z: str, y: str, x: str) -> np.ndarray:
    """(y, x, z) of a field over some of z, y and x, whatever their order; missing ones have size 1."""
    out = field
    for d in (z, x, y):
        if d not in dims:
            out = out[None] if d == z else np.expand_dims(out, -1)
            dims = [d, *dims] if d == z else [*dims, d]
    return np.transpose(out, [list(dims).index(d) for d in (y, x, z)])


def read_grid(
    spark: SparkSession, path: str, variables: Sequence[str], time: str = "t", levels: str | None = None, member: str = "member", axes: tuple[str, str, str] = ("z", "y", "x"), require_member: bool = False
) -> DataFrame:
    """(file, var, t_idx, t, member, iy, ix, profile, levels) of the wanted variables; others are never read.

    A variable lies over (time, [member,] [z,] y, x); without a member dimension
    member is null, unless it is required: then the file raises.  ``levels`` names the vertical
    coordinate's variable, a field like the others or one number a level; without
    it levels are numbered.  t_idx numbers the distinct times of all files.  A task reads one
    frame of one file.
    """
    ship_package(spark)
    z, y, x = axes

    def list_frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["path"]:
                stamps = open_grid(name).times(time)
                yield pd.DataFrame({"file": name, "k": np.arange(len(stamps), dtype=np.int32), "t": pd.to_datetime(stamps)})

    def read_frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, k, t in zip(batch["file"], batch["k"], batch["t"], strict=True):
                data = open_grid(name)

                def field(var: str, member_at: int | None) -> np.ndarray:
                    dims = list(data.variables[var].dims)  # noqa: B023
                    whole = data.floats(var, int(k)) if dims[:1] == [time] else data.floats(var)  # noqa: B023
                    dims = dims[1:] if dims[:1] == [time] else dims
                    if member in dims:
                        whole = np.take(whole, 0 if member_at is None else member_at, axis=dims.index(member))
                        dims.remove(member)
                    return whole[None, None] if dims == [z] else columns_of(whole, dims, z, y, x)

                for var in (v for v in variables if v in data.variables):
                    dims = list(data.variables[var].dims)
                    if require_member and member not in dims:
                        raise ValueError(f"{var} of {name} has no dimension {member}")
                    members = range(data.floats(var, int(k)).shape[dims.index(member) - 1]) if member in dims else [None]
                    for m in members:
                        values = field(var, m)
                        ny, nx, nz = values.shape
                        heights = np.arange(nz, dtype=float) if levels is None else field(levels, m)
                        heights = np.broadcast_to(heights, values.shape)
                        iy, ix = (g.ravel() for g in np.indices((ny, nx)))
                        yield pd.DataFrame(
                            {
                                "file": name.rsplit("/", 1)[-1], "var": var, "t_idx": k, "t": t, "member": pd.array([m] * (ny * nx), "Int32"), "iy": iy, "ix": ix,
                                "profile": list(values.reshape(-1, nz)), "levels": list(heights.reshape(-1, nz)),
                            }
                        )

    files = spark.read.format("binaryFile").load(path).select("path")
    frames = files.mapInPandas(list_frames, "file string, k int, t timestamp")
    rows = frames.repartition("file", "k").mapInPandas(read_frames, GRID).drop("t_idx")
    times = frames.select("t").distinct().withColumn("t_idx", (F.row_number().over(Window.orderBy("t")) - 1).cast("int"))
    nan = lambda c: F.transform(c, lambda v: F.when(~F.isnan(v), v)).alias(c)
    return rows.join(times, "t").select("file", "var", "t_idx", "t", "member", "iy", "ix", nan("profile"), nan("levels"))


#: Copies of a diagnostics file that become columns (fixed values: the labels of the filter's files).
COPIES = {
    "obs": "observation",
    "obs_variance": "observation error variance",
    "prior_mean": "prior ensemble mean",
    "prior_spread": "prior ensemble spread",
    "posterior_mean": "posterior ensemble mean",
    "posterior_spread": "posterior ensemble spread",
}
QUALITY = "DART quality control"
DIAGNOSTICS = ", ".join(f"{c} double" for c in [*COPIES, "longitude", "latitude", "z"]) + ", dart_qc int, obs_type string, timestamp timestamp, prior array<double>, posterior array<double>, file string"


def label(text: str) -> str:
    return " ".join(text.split())


def read_diagnostics(spark: SparkSession, path: str) -> DataFrame:
    """One row for each observation of the filter's diagnostics files, members as arrays; types without a name are ``unknown_N``."""
    ship_package(spark)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["path"]:
                data = classic.open_path(name)
                copies = {label(c): i for i, c in enumerate(data.texts("CopyMetaData"))}
                values, place = data.floats("observations"), data.floats("location")
                flags = data.floats("qc")[:, [label(c) for c in data.texts("QCMetaData")].index(QUALITY)]
                kinds = dict(zip(data.read("ObsTypes").tolist(), map(label, data.texts("ObsTypesMetaData")), strict=True))
                members = sum(re.fullmatch(r"prior ensemble member \d+", c) is not None for c in copies)
                blank = np.full(len(values), np.nan)
                of = lambda c: values[:, copies[c]] if c in copies else blank  # noqa: B023, E731
                stack = lambda s: list(np.stack([of(f"{s} ensemble member {i + 1}") for i in range(members)], axis=1)) if members else [[]] * len(values)  # noqa: B023, E731
                columns = {k: of(c) for k, c in COPIES.items()} | {c: place[:, i] for i, c in enumerate(("longitude", "latitude", "z"))}
                yield pd.DataFrame(
                    columns
                    | {
                        "dart_qc": flags.astype(np.int32),
                        "obs_type": [kinds.get(int(k), f"unknown_{int(k)}") for k in data.read("obs_type")],
                        "timestamp": pd.to_datetime(data.times("time")),
                        "prior": stack("prior"),
                        "posterior": stack("posterior"),
                        "file": name.rsplit("/", 1)[-1],
                    }
                )

    rows = spark.read.format("binaryFile").load(path).select("path").mapInPandas(parse, DIAGNOSTICS)
    numbers = [*COPIES, "longitude", "latitude", "z"]
    return rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numbers} | {"obs_std": F.sqrt("obs_variance")})


def write_grid_files(df: DataFrame, folder: str, fields: Sequence[str], by: str = "file", units: str = "minutes since 2000-01-01 00:00:00") -> list[str]:
    """One classic file for each value of ``by`` from rows (by, t, [member,] iz, iy, ix, fields); its names.

    ``t`` is unlimited; cells without a row are NaN.  A file is put together by one task, so ``by`` should
    name no more than a cycle; it appears whole or not at all.
    """
    ship_package(df.sparkSession)
    start = pd.Timestamp(units.split("since ", 1)[1])
    dims = ["t", *(["member"] if "member" in df.columns else []), "iz", "iy", "ix"]
    names = {"t": "t", "member": "member", "iz": "z", "iy": "y", "ix": "x"}

    def write(part: pd.DataFrame) -> pd.DataFrame:
        found = {d: sorted(part[d].unique()) for d in dims}
        at = tuple(part[d].map({v: i for i, v in enumerate(found[d])}).to_numpy() for d in dims)
        minutes = np.array([(pd.Timestamp(t) - start).total_seconds() / 60 for t in found["t"]])
        variables = {"t": (("t",), minutes, {"units": units})}
        for f in fields:
            grid = np.full([len(found[d]) for d in dims], np.nan, np.float32)
            grid[at] = part[f].to_numpy(np.float32)
            variables[f] = (tuple(names[d] for d in dims), grid, {})
        name = str(part[by].iloc[0])
        fs, base = pafs.FileSystem.from_uri(folder)
        with fs.open_output_stream(f"{base}/_{name}") as out:
            out.write(classic.encode({names[d]: None if d == "t" else len(found[d]) for d in dims}, variables))
        fs.move(f"{base}/_{name}", f"{base}/{name}")
        return pd.DataFrame({"file": [name]})

    written = df.select(by, *dims, *fields).groupBy(by).applyInPandas(write, "file string")
    return sorted(r["file"] for r in written.collect())


def split_static(grid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fields that vary, and those whose every cell is the same in all frames, once."""
    spread = grid.groupBy("var", "iy", "ix").agg(F.countDistinct(F.to_json("profile")).alias("n")).groupBy("var").agg(F.max("n").alias("n"))
    fixed = spread.where("n = 1").select("var")
    return grid.join(fixed, "var", "left_anti"), grid.join(fixed, "var", "left_semi").where("t_idx = 0").drop("t_idx", "t")
