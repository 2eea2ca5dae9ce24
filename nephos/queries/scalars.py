"""The scalar library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.adapters import OBS_SQL, observations, table
from nephos.functions import columns as C
from nephos.functions import profiles
from nephos.functions.projection import LambertConformal
from nephos.queries.shape import r, rounded
from nephos.registry import register

CRS = LambertConformal(30.0, 60.0, 45.0, 10.0)
PARALLEL = LambertConformal(25.0, 25.0, 25.0, -20.0)


def _lcc_sql(c: LambertConformal, x: str, y: str) -> str:
    rho = f"({c.radius!r}::DOUBLE*{c.factor!r}::DOUBLE/pow(tan(pi()/4 + radians(latitude)/2), {c.cone!r}::DOUBLE))"
    lon = f"(longitude - ({c.central_lon!r}::DOUBLE) + 180)"
    turn = f"({c.cone!r}::DOUBLE*radians({lon} - 360*floor({lon}/360) - 180))"
    return r(f"{rho}*sin({turn}) AS {x}", f"{c.origin_rho!r}::DOUBLE - {rho}*cos({turn}) AS {y}", digits=3)


@register("lcc_projection", f"WITH {OBS_SQL} SELECT obs_id, {_lcc_sql(CRS, 'x2', 'y2')}, {_lcc_sql(PARALLEL, 'x1', 'y1')} FROM obs WHERE latitude > -80 AND latitude < 80")
def lcc_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).where("latitude > -80 AND latitude < 80")
    (x2, y2), (x1, y1) = (c.forward(F.col("longitude"), F.col("latitude")) for c in (CRS, PARALLEL))
    return rounded(obs.select("obs_id", x2.alias("x2"), y2.alias("y2"), x1.alias("x1"), y1.alias("y1")), 3)


@register("lcc_inverse", f"WITH {OBS_SQL} SELECT obs_id, round(longitude, 6) AS longitude, round(latitude, 6) AS latitude FROM obs WHERE latitude > -80 AND latitude < 80 AND longitude > -179 AND longitude < 179")
def lcc_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """There and back again gives the places themselves."""
    obs = observations(spark, sf_dir).where("latitude > -80 AND latitude < 80 AND longitude > -179 AND longitude < 179")
    lon, lat = CRS.inverse(*CRS.forward(F.col("longitude"), F.col("latitude")))
    return rounded(obs.select("obs_id", lon.alias("longitude"), lat.alias("latitude")))


@register("longitude_wraps", f"WITH {OBS_SQL}, l AS (SELECT obs_id, longitude*2 AS d FROM obs) SELECT obs_id, round(d + 180 - 360*floor((d + 180)/360) - 180, 6) AS w180, round(d + 360 - 360*floor((d + 360)/360), 6) AS w360 FROM l")
def longitude_wraps(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("longitude") * 2
    return rounded(observations(spark, sf_dir).select("obs_id", C.wrap_180(d).alias("w180"), C.wrap_360(d).alias("w360")))


@register(
    "epoch_decoding",
    """SELECT event_id, TIMESTAMP '2000-01-01 00:00:00' + to_microseconds(CAST(event_id*1000500 AS BIGINT)) AS since_2000, TIMESTAMP '1993-01-01 00:00:00' + to_microseconds(CAST((event_id*2 - 37)*1000000 AS BIGINT)) AS tai,
    TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(event_id % 28 AS INT)) + INTERVAL 6 HOUR AS day_fraction, TIMESTAMP '2024-02-03 00:00:00' + to_seconds(event_id % 86400) AS clock FROM events""",
)
def epoch_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    s = e % 86400
    clock = F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    out = {"since_2000": C.seconds_since_2000(e * 1.0005), "tai": C.tai93(e * 2.0), "day_fraction": C.date_fraction(20240101 + e % 28, F.lit(0.25)), "clock": C.day_clock(F.lit("03:02:2024"), clock)}
    return table(spark, sf_dir, "events").select("event_id", *[c.cast("timestamp_ntz").alias(n) for n, c in out.items()])


@register(
    "error_models",
    f"""WITH {OBS_SQL}, v AS (SELECT obs_id, value/100 - 0.5::DOUBLE AS v FROM obs) SELECT obs_id, {r(
        "greatest(0.3::DOUBLE*v, 1e-5) AS relative_floor", "greatest(0.05::DOUBLE + 0.3::DOUBLE*v, 0.1::DOUBLE) AS land_ocean",
        "least(greatest(0.2853::DOUBLE*v + 0.0267::DOUBLE, 0.0267::DOUBLE), 0.3::DOUBLE) AS clipped", "6.8e-5 + 0.2::DOUBLE*greatest(v, 0) AS backscatter", digits=9)} FROM v WHERE v IS NOT NULL""",
)
def error_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value") / 100 - 0.5
    models = {"relative_floor": C.relative_floor_error, "land_ocean": C.land_ocean_error, "clipped": C.clipped_error, "backscatter": C.backscatter_error}
    return rounded(observations(spark, sf_dir).where("value IS NOT NULL").select("obs_id", *[f(v).alias(n) for n, f in models.items()]), 9)


@register(
    "pair_keys",
    f"""WITH {OBS_SQL} SELECT obs_id, instrument || '.' || quantity || '.x' AS pair, instrument AS first, quantity || '.x' AS second,
    date_diff('day', DATE '1601-01-01', CAST("time" AS DATE)) AS days_1601, CAST(hour("time")*3600 + minute("time")*60 + second("time") AS INT) AS day_seconds FROM obs""",
)
def pair_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = C.pair_key(F.col("instrument"), F.concat("quantity", F.lit(".x")))
    first, second = C.split_pair(key)
    return observations(spark, sf_dir).select(
        "obs_id", key.alias("pair"), first.alias("first"), second.alias("second"), C.days_since_1601(F.col("time")).cast("bigint").alias("days_1601"), C.seconds_of_day(F.col("time")).alias("day_seconds")
    )


@register(
    "letter_numeral",
    "SELECT event_id, chr(CAST(65 + (event_id % 17576)//676 AS INT)) || chr(CAST(65 + ((event_id % 17576)//26) % 26 AS INT)) || chr(CAST(65 + (event_id % 17576) % 26 AS INT)) AS numeral FROM events",
)
def letter_numeral(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", C.letter_numeral(F.col("event_id") % 17576 + 1).alias("numeral"))


@register(
    "pretty_and_percent",
    """SELECT event_id, format('{}h {:02d}m', event_id//3600, (event_id % 3600)//60) AS pretty, round(CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id*100.0::DOUBLE/(event_id % 4) END, 6) AS percent,
    CASE WHEN event_type = 'click' THEN 'CLICKED' ELSE event_type END AS mapped FROM events""",
)
def pretty_and_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return rounded(table(spark, sf_dir, "events").select("event_id", C.pretty_hours(e).alias("pretty"), C.percent(e, e % 4).alias("percent"), C.mapped(F.col("event_type"), {"click": "CLICKED"}).alias("mapped")))


@register(
    "significant_digits",
    """WITH v AS (SELECT *, l_discount - 0.05::DOUBLE AS d FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(l_extendedprice, CAST(2 - floor(log10(l_extendedprice)) AS INT)) AS price, CASE WHEN d = 0 THEN 0.0::DOUBLE ELSE round(d, CAST(2 - floor(log10(abs(d))) AS INT)) END AS off, count(*) AS n FROM v GROUP BY ALL""",
)
def significant_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows: prices, and discounts less 5 %, which are below, at and above zero."""
    by = [C.significant(F.col("l_extendedprice"), 3).alias("price"), C.significant(F.col("l_discount") - 0.05, 3).alias("off")]
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", *by).agg(F.count(F.lit(1)).alias("n"))


@register(
    "profile_diagnostics",
    """WITH p AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding[1:9]] AS a FROM embeddings)
    SELECT vec_id, round(a[9] - a[1], 6) AS total, round((a[1] + a[2])/2, 6) AS first_mid, round((2*a[2] - 2*a[1])/9.81::DOUBLE, 6) AS first_layer, 8 AS layers,
    round(1000/9.81::DOUBLE*0.1::DOUBLE/(1 + abs(a[1])), 6) AS density FROM p""",
)
def profile_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.transform(F.slice("embedding", 1, 9), lambda x: x.cast("double"))
    df = table(spark, sf_dir, "embeddings").select("vec_id", a.alias("a"))
    thick = profiles.layer_thickness(F.col("a"), F.col("a"))
    density = profiles.air_density(F.lit(600.0), F.lit(400.0), F.array(F.lit(-0.1)), F.array(1 + F.abs(F.col("a")[0])))
    total = F.aggregate(profiles.differences(F.col("a")), F.lit(0.0), lambda s, x: s + x)
    return rounded(df.select("vec_id", total.alias("total"), profiles.midpoints(F.col("a"))[0].alias("first_mid"), thick[0].alias("first_layer"), F.size(thick).alias("layers"), density[0].alias("density")))


@register("column_pruning", "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem")
def column_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.select_matching(table(spark, sf_dir, "lineitem"), [r"l_\w+key$", r"l_quant"])


@register(
    "sequence_headers",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS n FROM events""",
)
def sequence_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nephos.sources.exports import sequence_count

    e = F.col("event_id").cast("string")
    header = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" max_num_obs:  "), e)).otherwise(F.concat(F.lit(" obs_sequence\n  num_obs:   "), e, F.lit("  max_num_obs:  9")))
    return table(spark, sf_dir, "events").select("event_id", sequence_count(header).alias("n"))
