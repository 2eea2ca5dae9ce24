"""Converters, from cells made of the event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.adapters import table
from nephos.queries.shape import rounded
from nephos.registry import fixed, register
from nephos.sources.converters import lidar, radiometers

#: The cells in DuckDB: a number, a place, a value and two indices.
CELL_SQL = """c AS (SELECT event_id AS e, CAST((event_id*37) % 3600 AS DOUBLE)/10 - 180 AS longitude, CAST((event_id*91) % 1800 AS DOUBLE)/10 - 90 AS latitude, value AS v,
  CAST(event_id // 24 AS INT) AS i0, CAST(event_id % 24 AS INT) AS i1, epoch_us(ts) AS us FROM events)"""
SHAPE = (100_000, 24)


def cells(spark: SparkSession, sf_dir: str, **extra: Column) -> DataFrame:
    e = F.col("event_id")
    base = table(spark, sf_dir, "events").select(
        e.alias("e"),
        (((e * 37) % 3600).cast("double") / 10 - 180).alias("longitude"),
        (((e * 91) % 1800).cast("double") / 10 - 90).alias("latitude"),
        F.col("value").alias("v"),
        F.floor(e / 24.0).cast("int").alias("i0"),
        (e % 24).cast("int").alias("i1"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
    )
    return base.withColumns(extra)


def seen(df: DataFrame, scale: float = 1.0) -> DataFrame:
    """What two engines compare: times in microseconds, indices, values to six digits after scaling."""
    number = lambda c: (F.col(c) * scale).alias(c)
    place = F.col("orig_coords.indices")
    return rounded(
        df.select(
            "instrument", "quantity", F.unix_micros("time").alias("t_us"), "longitude", "latitude", "z", "z_type", number("value"), number("value_uncertainty"), "qc_flag",
            F.get(place, F.lit(0)).alias("i0"), F.get(place, F.lit(1)).alias("i1"),
        )
    )


def seen_sql(source: str, instrument: str, quantity: str, t_us: str, z: str, z_type: str, value: str, error: str, flag: str = "0", i0: str = "i0", i1: str = "i1", longitude: str = "longitude", scale: str = "1") -> str:
    """``seen`` in oracle SQL."""
    plain = lambda x: f"CASE WHEN round({x}, 6) = 0 THEN CAST(0 AS DOUBLE) ELSE round({x}, 6) END"
    return f"""SELECT {instrument} AS instrument, {quantity} AS quantity, CAST({t_us} AS BIGINT) AS t_us, {plain(longitude)} AS longitude, {plain("latitude")} AS latitude, {plain(f"CAST({z} AS DOUBLE)")} AS z,
      '{z_type}' AS z_type, {plain(f"({value})*{scale}")} AS value, {plain(f"({error})*{scale}")} AS value_uncertainty, CAST({flag} AS INT) AS qc_flag, CAST({i0} AS INT) AS i0, CAST({i1} AS INT) AS i1 FROM {source}"""


TAI_US = "round((1000000000 + e*7.5::DOUBLE - 37)*1000000) + 725846400000000"
MODIS_VALUE = "CAST(e % 3000 AS DOUBLE)*CAST(0.001 AS DOUBLE)"


@register(
    "convert_modis",
    f"WITH {CELL_SQL} "
    + seen_sql("c", "'MODIS'", "'AOD_550nm'", TAI_US, "0", "columnar", MODIS_VALUE, f"greatest(0.05::DOUBLE + 0.3::DOUBLE*({MODIS_VALUE}), 0.1)")
    + " WHERE e % 11 <> 0 AND e % 13 <> 0 AND e % 4 >= 2",
)
def convert_modis(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("e")
    df = cells(
        spark, sf_dir, along=F.col("i0"), across=F.col("i1"), scan_time=F.lit(1e9) + e * 7.5,
        aod=F.when(e % 11 == 0, -9999).otherwise(e % 3000).cast("double"), qa=F.when(e % 13 == 0, -128).otherwise(e % 4),
    )
    return seen(radiometers.modis(df, SHAPE, "m.hdf"))


@register(
    "convert_viirs",
    f"WITH {CELL_SQL} " + seen_sql("c", "'VIIRS'", "'AOD_550nm'", TAI_US, "0", "columnar", "v", "CASE WHEN e % 3 = 0 THEN 0.2 ELSE 0.3 END") + " WHERE e % 7 <> 0 AND (e % 3 = 0 OR e % 5 <> 0) AND v IS NOT NULL",
)
def convert_viirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("e")
    df = cells(
        spark, sf_dir, along=F.col("i0"), across=F.col("i1"), scan_time=F.lit(1e9) + e * 7.5, aod=F.when(e % 7 == 0, -999.0).otherwise(F.col("v")),
        error_land=F.when(e % 3 == 0, 0.2).otherwise(-999.0), error_ocean=F.when(e % 5 == 0, float("nan")).otherwise(0.3),
    )
    return seen(radiometers.viirs(df, SHAPE, "v.nc"))


@register(
    "convert_seviri",
    f"""WITH {CELL_SQL}, p AS (SELECT 'IR_' || CAST(e % 5 AS VARCHAR) AS channel, CAST(floor((latitude + 90)/10 + 0.5) AS INT) AS i0, CAST(floor((longitude + 180)/10 + 0.5) AS INT) AS i1, v, us FROM c),
    m AS (SELECT channel, i0, i1, avg(v) AS v, min(us) AS us FROM p WHERE v IS NOT NULL AND i1 BETWEEN 0 AND 34 AND i0 BETWEEN 0 AND 16 GROUP BY ALL),
    g AS (SELECT *, i1*10 - CAST(180 AS DOUBLE) AS longitude, i0*10 - CAST(90 AS DOUBLE) AS latitude FROM m) """
    + seen_sql("g", "'MSG_SEVIRI'", "channel", "us", "0", "columnar", "v", "2.0"),
)
def convert_seviri(spark: SparkSession, sf_dir: str) -> DataFrame:
    channel = F.concat(F.lit("IR_"), (F.col("e") % 5).cast("string"))
    df = cells(spark, sf_dir, channel=channel, x=F.col("longitude"), y=F.col("latitude"), time=F.timestamp_micros("us"), value=F.col("v")).select("channel", "x", "y", "time", "value")
    iy, ix = F.floor(F.col("id") / 35).cast("int"), (F.col("id") % 35).cast("int")
    grid = spark.range(17 * 35).select(iy.alias("iy"), ix.alias("ix"), (iy * 10.0 - 90).alias("latitude"), (ix * 10.0 - 180).alias("longitude"))
    return seen(radiometers.seviri(df, grid, (17, 35), (-180.0, -90.0), 10.0, "s.nat"))


@register(
    "convert_harp2",
    f"""WITH {CELL_SQL}, m AS (SELECT *, unnest(['AOD_', 'AOD_Fine_', 'AOD_Coarse_']) AS prefix, unnest([v/97, v/193, CASE WHEN e % 4 = 0 THEN -1 ELSE v/307 END]) AS x FROM c WHERE e % 4 <> 3),
    k AS (SELECT *, prefix || (['440nm', '550nm', '665nm'])[e % 4 + 1] AS q FROM m WHERE x >= 0) """
    + seen_sql("k", "'GRASP_HARP2'", "q", "(1700000000 + e)*1000000", "0", "columnar", "x", "least(greatest(0.2853::DOUBLE*x + 0.0267::DOUBLE, 0.0267), 0.3)"),
)
def convert_harp2(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, v = F.col("e"), F.col("v")
    band = F.get(F.array(*[F.lit(b) for b in radiometers.HARP_BANDS]), (e % 4).cast("int"))
    df = cells(
        spark, sf_dir, y=F.col("i0"), x=F.col("i1"), band=band, unix_time=e + 1_700_000_000, total=v / 97, fine=v / 193, coarse=F.when(e % 4 == 0, -1.0).otherwise(v / 307), sea=F.when(e % 2 == 0, 100).otherwise(40)
    )
    return seen(radiometers.harp2(df, SHAPE, "h.nc", disabled=["865.63"], mask="sea"))


@register(
    "convert_spexone",
    f"WITH {CELL_SQL} "
    + seen_sql("c", "'RemoTAP-spexone'", "'AOD_550nm'", "epoch_us(TIMESTAMP '2024-03-01 00:00:00') + (e % 28)*CAST(86400000000 AS BIGINT) + round(CAST(e % 100 AS DOUBLE)/100*86400000000)", "0", "columnar", "v", "0.1::DOUBLE + v/10")
    + " WHERE e % 10 <> 0 AND e % 3 = 0 AND v IS NOT NULL",
)
def convert_spexone(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("e")
    day = F.when(e % 10 == 0, 29990101).otherwise(20240301 + e % 28).cast("int")
    df = cells(spark, sf_dir, along=F.col("i0"), across=F.col("i1"), utc_date=day, fraction=(e % 100) / 100.0, aod=F.col("v"), error=F.lit(0.1) + F.col("v") / 10, sea=F.when(e % 3 == 0, 90).otherwise(10))
    return seen(radiometers.spexone(df, SHAPE, "PACE_SPEXONE.20240301.AER_OCEAN_REMOTAP.nc", "s.nc", mask="sea"))


@register(
    "convert_earthcare",
    f"""WITH {CELL_SQL}, x AS (SELECT *, CASE WHEN e % 23 <> 0 THEN CAST(e % 40 - 1 AS DOUBLE)*0.0001::DOUBLE END AS ext, CASE WHEN e % 17 = 0 THEN 1 ELSE (e % 2)*3 END AS class FROM c),
    f AS (SELECT *, CASE WHEN ext IS NULL OR class NOT IN (0, 3) THEN 1 ELSE 0 END AS cloudy FROM x),
    l AS (SELECT *, max(cloudy) OVER (PARTITION BY i0 ORDER BY i1 RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS line FROM f),
    d AS (SELECT *, max(line) OVER (PARTITION BY i1 ORDER BY i0 RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS dilated, greatest(coalesce(ext, 0), 0) AS w FROM l) """
    + seen_sql("d", "'EarthCARE_ATLID_EBD'", "'LIDAR_EXTINCTION_355nm'", "us", "i1*100", "height", "w", "6.8e-5::DOUBLE + 0.2::DOUBLE*w", "CASE WHEN dilated = 1 OR coalesce(ext > 0.002, false) THEN 1 ELSE 0 END", scale="1000"),
)
def convert_earthcare(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("e")
    df = cells(
        spark, sf_dir, profile=F.col("i0"), level=F.col("i1"), time=F.timestamp_micros("us"), height=F.col("i1") * 100.0,
        extinction=F.when(e % 23 != 0, (e % 40 - 1) * 0.0001), **{"class": F.when(e % 17 == 0, 1).otherwise((e % 2) * 3).cast("int")},
    )
    return seen(lidar.earthcare(df, SHAPE, "e.h5"), 1000.0)


def aeolus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with edges, a start time, an extinction with missing ones, and flags."""
    e = F.col("e")
    return cells(
        spark, sf_dir, profile=F.col("i0"), height_bin=F.col("i1"), altitude=F.col("i1") * 500.0, altitude_top=F.col("i1") * 500.0 + 250, altitude_bottom=F.col("i1") * 500.0 - 250,
        start=(e * 2 + 600_000_000).cast("double"), extinction=(e % 50 - 1).cast("double"), processing_flag=(e % 4).cast("int"),
        brc=F.floor(e / 240).cast("int"), measurement=(F.floor(e / 24) % 10).cast("int"), quality=(e % 64).cast("int"), **{"class": F.get(F.array(*[F.lit(k) for k in (3, 103, 13, 1)]), (F.floor(e / 5) % 4).cast("int"))},
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty measurements' feature indices of each cell."""
    m = F.explode(F.sequence(F.lit(0), F.lit(29)))
    return cells(spark, sf_dir).select("e", F.col("i0").alias("profile"), F.col("i1").alias("height_bin"), m.alias("m")).withColumn("feature", (F.col("e") * (F.col("m") + 1)) % 12 - 1)


AEOLUS_SQL = f"""{CELL_SQL}, a AS (SELECT *, CAST(e % 50 - 1 AS DOUBLE) AS ext, (SELECT count(*) FROM range(30) r(m) WHERE (e*(m + 1)) % 12 - 1 BETWEEN 0 AND 5) AS n_clear, (longitude + 180) - 180 AS lon FROM c),
  k AS (SELECT *, CASE WHEN ext <> -1 THEN ext*1e-6::DOUBLE END AS x FROM a)"""
AEOLUS_ERROR = "CASE WHEN x IS NOT NULL THEN greatest(0.3::DOUBLE*x, 0.00001) END"
START_US = "(e*2 + 600000000)*1000000 + 946684800000000"
EXTINCTION = "'LIDAR_EXTINCTION_355nm'"


@register("convert_aeolus_mle", f"WITH {AEOLUS_SQL} " + seen_sql("k", "'AEOLUS_L2A_MLE'", EXTINCTION, START_US, "i1*500", "height", "x", AEOLUS_ERROR, "CASE WHEN x IS NOT NULL AND n_clear > 15 THEN 0 ELSE 1 END", scale="1000000"))
def convert_aeolus_mle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seen(lidar.aeolus_mle(aeolus(spark, sf_dir), features(spark, sf_dir), SHAPE, "a.dbl"), 1e6)


@register(
    "convert_aeolus_sca",
    f"WITH {AEOLUS_SQL} " + seen_sql("k", "'AEOLUS_L2A_SCA'", EXTINCTION, START_US, "i1*500", "height", "x", AEOLUS_ERROR, "CASE WHEN x IS NOT NULL AND n_clear > 15 AND e % 2 = 1 THEN 0 ELSE 1 END", scale="1000000"),
)
def convert_aeolus_sca(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seen(lidar.aeolus_sca(aeolus(spark, sf_dir), features(spark, sf_dir), SHAPE, "a.dbl"), 1e6)


PRO_OK = "(CAST(e % 64 AS INT) & 47) = 0 AND ext <> -1 AND ext < 1000 AND (e // 5) % 4 < 3"


@register(
    "convert_aeolus_pro",
    f"WITH {AEOLUS_SQL} " + seen_sql("k", "'AEOLUS_L2A_AEL_PRO'", EXTINCTION, START_US, "i1*500", "height", "x", AEOLUS_ERROR, f"CASE WHEN {PRO_OK} THEN 0 ELSE 1 END", scale="1000000"),
)
def convert_aeolus_pro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seen(lidar.aeolus_pro(aeolus(spark, sf_dir), 10, SHAPE, "a.dbl"), 1e6)


@register(
    "convert_aeolus_pro_subsample",
    f"""WITH {AEOLUS_SQL}, o AS (SELECT CAST(e // 240 AS INT) AS i0, i1, avg(longitude) AS longitude, avg(latitude) AS latitude, avg(CAST(e*2 + 600000000 AS DOUBLE)) AS start,
      avg(CASE WHEN ext <> -1 THEN ext END)*1e-6::DOUBLE AS x, bool_and({PRO_OK}) AS ok FROM k GROUP BY 1, 2) """
    + seen_sql("o", "'AEOLUS_L2A_AEL_PRO'", EXTINCTION, "round(start*1000000) + 946684800000000", "i1*500", "height", "x", AEOLUS_ERROR, "CASE WHEN ok THEN 0 ELSE 1 END", scale="1000000"),
)
def convert_aeolus_pro_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seen(lidar.aeolus_pro(aeolus(spark, sf_dir), 10, SHAPE, "a.dbl", subsample=True), 1e6)


@register(
    "convert_aeolus_winds",
    f"""WITH {CELL_SQL}, w AS (SELECT *, e % 2 = 0 AS rayleigh, e % 3 AS kind, e % 5 AS validity FROM c) """
    + seen_sql("w", "CASE WHEN rayleigh THEN 'AEOLUS_L2B_RAYLEIGH' ELSE 'AEOLUS_L2B_MIE' END", "'HLOS_WIND'", START_US, "i1*500", "height", "v*10/100", "CASE WHEN rayleigh THEN 4.5 ELSE 2.5 END",
               "CASE WHEN kind <> CASE WHEN rayleigh THEN 2 ELSE 1 END THEN 2 WHEN validity <> 1 THEN 1 ELSE 0 END", "e", "NULL"),
)
def convert_aeolus_winds(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("e")
    start = (e * 2 + 600_000_000).cast("double")
    df = cells(
        spark, sf_dir, retrieval=F.when(e % 2 == 0, "rayleigh").otherwise("mie"), row=e, wind_result_id=e, altitude=F.col("i1") * 500.0, alt_bottom=F.lit(0.0), alt_top=F.lit(1.0), azimuth=F.lit(100.0),
        t=start, t_start=start, t_stop=start + 12, wind=F.col("v") * 10, validity=e % 5, observation_type=e % 3,
    )
    return seen(lidar.aeolus_winds(df, "w.dbl"))


@register(
    "bin_centres",
    """WITH g AS (SELECT event_id // 25 AS profile, event_id % 25 AS edge, CAST(event_id % 25 AS DOUBLE)*500 AS altitude, CAST((event_id*91) % 1800 AS DOUBLE)/10 - 90 AS latitude FROM events),
    m AS (SELECT profile, edge AS height_bin, (altitude + lead(altitude) OVER w)/2 AS altitude, (latitude + lead(latitude) OVER w)/2 AS latitude, altitude AS altitude_top, lead(altitude) OVER w AS altitude_bottom
      FROM g WINDOW w AS (PARTITION BY profile ORDER BY edge))
    SELECT profile, height_bin, round(altitude, 6) AS altitude, round(latitude, 6) AS latitude, altitude_top, altitude_bottom FROM m WHERE altitude_bottom IS NOT NULL""",
)
def bin_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    edges = table(spark, sf_dir, "events").select(
        F.floor(e / 25).alias("profile"), (e % 25).alias("edge"), ((e % 25) * 500.0).alias("altitude"), (((e * 91) % 1800).cast("double") / 10 - 90).alias("latitude"), F.lit(0.0).alias("longitude")
    )
    return rounded(lidar.bin_centres(edges).drop("longitude"))


@fixed(
    "registered_converters",
    "SELECT unnest(['aeolus-l2a-aelpro', 'aeolus-l2a-mle', 'aeolus-l2a-sca', 'aeolus-l2b', 'aeronet', 'earthcare-ebd', 'grasp-harp2', 'modis', 'msg-seviri', 'remotap-spexone', 'viirs', 'x-plugin']) AS name",
)
def registered_converters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry, with a converter that a user adds."""
    from nephos.sources.converters import CONVERTERS
    from nephos.sources.converters import register as add

    add("x-plugin")(lambda df: df)
    names = sorted(CONVERTERS)
    del CONVERTERS["x-plugin"]
    return spark.createDataFrame([(n,) for n in names], "name string")
