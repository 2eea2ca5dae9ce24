"""Imagers and polarimeters: aerosol optical depth and brightness temperatures of swath cells.

Inputs are decoded cells with their indices (along, across, or y, x) and sizes.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephos.functions.columns import clipped_error, date_fraction, land_ocean_error, null_if_missing, tai93
from nephos.sources.converters.base import Size, coords, observation, register

#: Quantities of polarimeter bands, and the names of a product's files (fixed values).
HARP_BANDS = {"440.16": "440nm", "549.57": "550nm", "664.57": "665nm", "865.63": "870nm"}
PRODUCT_NAME = r"PACE_SPEXONE.*AER_(?:LAND|OCEAN)_REMOTAP\.nc"


def _finite(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull() & ~F.isnan(c)
    return out


@register("modis")
def modis(cells: DataFrame, shape: tuple[Size, Size], filename: str | Column, scale: float = 0.001, fill: int = -9999, qa_fill: int = -128) -> DataFrame:
    """Cells (along, across, latitude, longitude, scan_time, aod, qa): good or very good quality only."""
    good = (F.col("aod") != fill) & (F.col("qa") != qa_fill) & (F.col("qa") >= 2)
    for c in ("latitude", "longitude", "scan_time"):
        good = good & (F.col(c) != -999.0)
    kept = cells.where(good & _finite("latitude", "longitude")).withColumn("value", F.col("aod") * scale)
    return observation(
        kept, instrument="MODIS", quantity="AOD_550nm", time=tai93(F.col("scan_time")), longitude=F.col("longitude"), latitude=F.col("latitude"), z=0.0, z_type="columnar",
        value=F.col("value"), value_uncertainty=land_ocean_error(F.col("value")), qc_flag=0, orig_filename=filename,
        orig_coords=coords(along_track=(F.col("along"), shape[0]), across_track=(F.col("across"), shape[1])),
    )


@register("viirs")
def viirs(cells: DataFrame, shape: tuple[Size, Size], filename: str | Column, names: Sequence[str] = ("along_track", "across_track")) -> DataFrame:
    """Cells (along, across, latitude, longitude, scan_time, aod, error_land, error_ocean): the land error if there is one."""
    error = F.coalesce(null_if_missing(F.col("error_land")), null_if_missing(F.col("error_ocean")))
    kept = cells.withColumns({"value": null_if_missing(F.col("aod")), "error": error}).where(F.col("value").isNotNull() & F.col("error").isNotNull() & _finite("latitude", "longitude"))
    return observation(
        kept, instrument="VIIRS", quantity="AOD_550nm", time=tai93(F.col("scan_time")), longitude=F.col("longitude"), latitude=F.col("latitude"), z=0.0, z_type="columnar",
        value=F.col("value"), value_uncertainty=F.col("error"), qc_flag=0, orig_filename=filename,
        orig_coords=coords(**{names[0]: (F.col("along"), shape[0]), names[1]: (F.col("across"), shape[1])}),
    )


@register("msg-seviri")
def seviri(pixels: DataFrame, grid: DataFrame, shape: tuple[int, int], origin: tuple[float, float], step: float, filename: str, uncertainty: float = 2.0) -> DataFrame:
    """Pixels (channel, x, y, time, value) averaged in the model grid's cells (iy, ix, latitude, longitude).

    Cells without a pixel give no row.
    """
    place = lambda c, first: F.floor((F.col(c) - first) / step + 0.5).cast("int")
    means = (
        pixels.where(_finite("value"))
        .groupBy("channel", place("y", origin[1]).alias("iy"), place("x", origin[0]).alias("ix"))
        .agg(F.avg("value").alias("value"), F.min("time").alias("time"))
        .where(F.col("ix").between(0, shape[1] - 1) & F.col("iy").between(0, shape[0] - 1))
    )
    cells = means.join(grid, ["iy", "ix"])
    return observation(
        cells, instrument="MSG_SEVIRI", quantity=F.col("channel"), time=F.col("time"), longitude=F.col("longitude"), latitude=F.col("latitude"), z=0.0, z_type="columnar",
        value=F.col("value"), value_uncertainty=uncertainty, qc_flag=0, orig_filename=filename, orig_coords=coords(y=(F.col("iy"), shape[0]), x=(F.col("ix"), shape[1])),
    )


@register("grasp-harp2")
def harp2(cells: DataFrame, shape: tuple[Size, Size], filename: str | Column, fine: bool = True, coarse: bool = True, disabled: Sequence[str] = (), mask: str | None = None) -> DataFrame:
    """Cells (y, x, band, latitude, longitude, unix_time, total, fine, coarse[, mask]), one row a band.

    An unknown band raises.  ``mask`` names the land-sea percentage; a cell is over
    land unless that is exactly 100.
    """
    modes = {"total": "AOD_"} | ({"fine": "AOD_Fine_"} if fine else {}) | ({"coarse": "AOD_Coarse_"} if coarse else {})
    known = F.create_map(*[x for k, v in HARP_BANDS.items() for x in (F.lit(k), F.lit(v))])
    band = F.coalesce(known[F.col("band")], F.raise_error(F.concat(F.lit("unknown band "), F.col("band"))))
    used = cells.where(~F.col("band").isin(*disabled)) if disabled else cells
    rows = F.array(*[F.named_struct(F.lit("prefix"), F.lit(p), F.lit("value"), F.col(m).cast("double")) for m, p in modes.items()])
    over_land = F.named_struct(F.lit("is_over_land"), (F.col(mask) != 100).cast("int")) if mask else None
    metadata = F.lit(None).cast("string") if over_land is None else F.to_json(over_land)
    whence = [c for c in used.columns if c in ("file", "n_y", "n_x")]
    flat = used.select("y", "x", "latitude", "longitude", "unix_time", *whence, band.alias("_band"), metadata.alias("metadata"), F.inline(rows))
    kept = flat.where(_finite("value", "latitude", "longitude") & (F.col("value") >= 0))
    return observation(
        kept, instrument="GRASP_HARP2", quantity=F.concat("prefix", "_band"), time=F.timestamp_seconds("unix_time"), longitude=F.col("longitude"), latitude=F.col("latitude"),
        z=0.0, z_type="columnar", value=F.col("value"), value_uncertainty=clipped_error(F.col("value")), qc_flag=0, orig_filename=filename, metadata=F.col("metadata"),
        orig_coords=coords(y=(F.col("y"), shape[0]), x=(F.col("x"), shape[1])),
    )


@register("remotap-spexone")
def spexone(cells: DataFrame, shape: tuple[Size, Size], product_name: str | Column, filename: str | Column, mask: str | None = None) -> DataFrame:
    """Cells (along, across, latitude, longitude, utc_date, fraction, aod, error[, mask]).

    The product's name tells land from ocean retrievals; with a land-sea percentage
    (ocean above 60) cells of the other kind go.  Flag 0 is good.
    """
    if isinstance(product_name, str) and not re.match(PRODUCT_NAME, product_name):
        raise ValueError(f"not the expected product: {product_name}")
    name = product_name if isinstance(product_name, Column) else F.lit(product_name)
    known = F.when(name.rlike(f"^{PRODUCT_NAME}"), name).otherwise(F.raise_error(F.concat(F.lit("not the expected product: "), name)))
    kept = cells.where(_finite("aod", "error") & (F.col("utc_date") != 29990101) & known.isNotNull())
    if mask is not None:
        kept = kept.where((F.col(mask) > 60) == known.contains("OCEAN"))
    return observation(
        kept, instrument="RemoTAP-spexone", quantity="AOD_550nm", time=date_fraction(F.col("utc_date"), F.col("fraction")), longitude=F.col("longitude"), latitude=F.col("latitude"),
        z=0.0, z_type="columnar", value=F.col("aod"), value_uncertainty=F.col("error"), qc_flag=0, orig_filename=filename,
        orig_coords=coords(bins_along_track=(F.col("along"), shape[0]), bins_across_track=(F.col("across"), shape[1])),
    )
