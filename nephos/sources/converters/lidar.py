"""Lidar profiles: extinction and line-of-sight winds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nephos.functions.columns import backscatter_error, relative_floor_error, seconds_since_2000, wrap_180
from nephos.operators.ensemble import dilate
from nephos.sources.converters.base import Size, coords, observation, register

#: Limits and masks of the products (fixed values).
DUST_CEILING = 2e-3
CLOUD_PROFILES, CLOUD_HEIGHTS = 2, 3
CLEAR_OR_AEROSOL = (0, 3)
AEROSOL_CLASSES = (3, 103, 13, 213)
SCA_VALID_BIT, PRO_PROBLEM_BITS = 0x01, 0x2F
LEAST_CLEAR_MEASUREMENTS = 15
WIND_ERRORS = {"rayleigh": 4.5, "mie": 2.5}
PER_MEGAMETRE = 1e-6


@register("earthcare-ebd")
def earthcare(cells: DataFrame, shape: tuple[Size, Size], filename: str | Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """Cells (profile, level, latitude, longitude, time, height, extinction, class).

    Cells that are missing, neither clear nor aerosol, over the ceiling, or within
    two profiles and three levels of a cloudy or missing one get flag 1.  ``keys``
    tell swaths apart.
    """
    ext = F.col("extinction")
    missing = ext.isNull() | F.isnan(ext)
    cloudy = ~F.coalesce(F.col("class").isin(*CLEAR_OR_AEROSOL), F.lit(False)) | missing
    marked = dilate(cells.withColumn("_cloudy", cloudy.cast("int")), "_cloudy", "profile", "level", CLOUD_PROFILES, CLOUD_HEIGHTS, keys)
    bad = (F.col("dilated") == 1) | F.coalesce(ext > DUST_CEILING, F.lit(False))
    value = F.when(missing, F.lit(0.0)).otherwise(F.greatest(ext, F.lit(0.0)))
    return observation(
        marked.withColumn("_value", value), instrument="EarthCARE_ATLID_EBD", quantity="LIDAR_EXTINCTION_355nm", time=F.col("time"), longitude=F.col("longitude"),
        latitude=F.col("latitude"), z=F.col("height"), z_type="height", value=F.col("_value"), value_uncertainty=backscatter_error(F.col("_value")),
        qc_flag=F.when(bad, 1).otherwise(0), orig_filename=filename, orig_coords=coords(along_track=(F.col("profile"), shape[0]), height=(F.col("level"), shape[1])),
    )


def clear_measurements(features: DataFrame) -> DataFrame:
    """(profile, height_bin, n_clear): measurements whose feature index is in [0, 6)."""
    clear = (F.col("feature") >= 0) & (F.col("feature") < 6)
    return features.groupBy("profile", "height_bin").agg(F.count_if(clear).alias("n_clear"))


def bin_centres(edges: DataFrame, keys: tuple[str, ...] = ("profile",)) -> DataFrame:
    """Midpoints of staggered edges (edge, latitude, longitude, altitude), with top and bottom."""
    w = Window.partitionBy(*keys).orderBy("edge")
    mid = lambda c: ((F.col(c) + F.lead(c).over(w)) / 2).alias(c)
    found = edges.select(*keys, F.col("edge").alias("height_bin"), mid("latitude"), mid("longitude"), mid("altitude"), F.col("altitude").alias("altitude_top"), F.lead("altitude").over(w).alias("altitude_bottom"))
    return found.where("altitude_bottom IS NOT NULL")


def _extinction(df: DataFrame, instrument: str, good: Column, metadata: Column, shape: tuple[int, int], filename: str) -> DataFrame:
    value = F.col("_ext") * PER_MEGAMETRE
    return observation(
        df, instrument=instrument, quantity="LIDAR_EXTINCTION_355nm", time=seconds_since_2000(F.col("start")), longitude=wrap_180(F.col("longitude")), latitude=F.col("latitude"),
        z=F.col("altitude"), z_type="height", value=value, value_uncertainty=relative_floor_error(value), qc_flag=F.when(good, 0).otherwise(1), orig_filename=filename,
        metadata=metadata, orig_coords=coords(profile=(F.col("profile"), shape[0]), height_bin=(F.col("height_bin"), shape[1])),
    )


def _known(df: DataFrame) -> DataFrame:
    return df.withColumn("_ext", F.when((F.col("extinction") != -1) & ~F.isnan("extinction"), F.col("extinction")))


@register("aeolus-l2a-mle")
def aeolus_mle(cells: DataFrame, features: DataFrame, shape: tuple[int, int], filename: str) -> DataFrame:
    """Cells (profile, height_bin, latitude, longitude, altitude, altitude_top, altitude_bottom, start, extinction)."""
    df = _known(cells).join(clear_measurements(features), ["profile", "height_bin"], "left").fillna(0, ["n_clear"])
    good = F.col("_ext").isNotNull() & (F.col("n_clear") > LEAST_CLEAR_MEASUREMENTS)
    meta = F.to_json(F.struct(F.col("profile").alias("profile_id"), "altitude_top", "altitude_bottom", F.col("n_clear").cast("double").alias("valid_measurements_in_brc")))
    return _extinction(df, "AEOLUS_L2A_MLE", good, meta, shape, filename)


@register("aeolus-l2a-sca")
def aeolus_sca(cells: DataFrame, features: DataFrame, shape: tuple[int, int], filename: str) -> DataFrame:
    """As MLE, with middle-bin places and a processing flag whose lowest bit means valid."""
    df = _known(cells).join(clear_measurements(features), ["profile", "height_bin"], "left").fillna(0, ["n_clear"])
    good = F.col("_ext").isNotNull() & (F.col("n_clear") > LEAST_CLEAR_MEASUREMENTS) & (F.col("processing_flag").cast("int").bitwiseAND(SCA_VALID_BIT) == 1)
    return _extinction(df, "AEOLUS_L2A_SCA", good, F.to_json(F.struct(F.col("profile").alias("profile_id"))), shape, filename)


@register("aeolus-l2a-aelpro")
def aeolus_pro(cells: DataFrame, n_measurements: int, shape: tuple[int, int], filename: str, subsample: bool = False) -> DataFrame:
    """Cells (brc, measurement, height_bin, latitude, longitude, altitude, altitude_top, altitude_bottom, start, extinction, class, quality).

    ``shape`` is (profiles, bins).  Subsampling averages the measurements of a
    range-bin cell, and is good only if all of them are.
    """
    ext = F.col("extinction")
    ok = (F.col("quality").cast("int").bitwiseAND(PRO_PROBLEM_BITS) == 0) & (ext != -1) & (ext < 1000) & F.col("class").isin(*AEROSOL_CLASSES)
    df = _known(cells).withColumn("_ok", F.coalesce(ok, F.lit(False)))
    if subsample:
        means = [F.avg(c).alias(c) for c in ("latitude", "longitude", "altitude", "altitude_top", "altitude_bottom", "start", "_ext")]
        df = df.groupBy("brc", "height_bin").agg(*means, F.bool_and("_ok").alias("_ok")).withColumns({"profile": F.col("brc"), "measurement": F.lit(-1)})
    else:
        df = df.withColumn("profile", F.col("brc") * n_measurements + F.col("measurement"))
    meta = F.to_json(F.struct(F.col("profile").alias("profile_id"), F.col("brc").alias("brc_id"), F.col("measurement").alias("measurement_id"), "altitude_top", "altitude_bottom"))
    return _extinction(df, "AEOLUS_L2A_AEL_PRO", F.col("_ok"), meta, shape, filename)


@register("aeolus-l2b")
def aeolus_winds(results: DataFrame, filename: str, mie: bool = True, rayleigh: bool = True) -> DataFrame:
    """Wind results (retrieval, row, wind_result_id, altitude, alt_bottom, alt_top, azimuth, latitude, longitude, t, t_start, t_stop, wind, validity, observation_type).

    Flag 1: not valid; 2, which takes precedence: not the type that suits the
    retrieval (Rayleigh needs clear air, Mie clouds).  Winds come in cm/s.
    """
    kinds = [k for k, on in (("mie", mie), ("rayleigh", rayleigh)) if on]
    df = results.where(F.col("retrieval").isin(*kinds))
    wrong = F.col("observation_type") != F.when(F.col("retrieval") == "rayleigh", 2).otherwise(1)
    flag = F.when(wrong, 2).when(F.coalesce(F.col("validity") != 1, F.lit(True)), 1).otherwise(0)
    error = F.when(F.col("retrieval") == "rayleigh", WIND_ERRORS["rayleigh"]).otherwise(WIND_ERRORS["mie"])
    meta = F.to_json(
        F.struct(
            F.col("retrieval").alias("retrieval_type"), "wind_result_id", "azimuth", "observation_type", seconds_since_2000(F.col("t_start")).alias("time_start"),
            seconds_since_2000(F.col("t_stop")).alias("time_stop"), "alt_bottom", "alt_top",
        )
    )
    n = df.agg(F.count(F.lit(1)).cast("int").alias("_n"))
    where = F.struct(F.array(F.col("row").cast("int")).alias("indices"), F.array("_n").alias("shape"), F.array(F.lit("measurement")).alias("names"))
    return observation(
        df.join(F.broadcast(n)), instrument=F.concat(F.lit("AEOLUS_L2B_"), F.upper("retrieval")), quantity="HLOS_WIND", time=seconds_since_2000(F.col("t")),
        longitude=wrap_180(F.col("longitude")), latitude=F.col("latitude"), z=F.col("altitude"), z_type="height", value=F.col("wind") / 100.0, value_uncertainty=error,
        qc_flag=flag, orig_filename=filename, metadata=meta, orig_coords=where,
    )
