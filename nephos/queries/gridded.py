"""Joins in time and space: windows, as-of, interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos import api
from nephos.adapters import OBS_SQL, cycle_calendar, model_frames, observations, table
from nephos.functions.columns import hlos_wind
from nephos.functions.profiles import at_pressure, interpolate
from nephos.operators import joins, nearest
from nephos.plans.interpolation import interpolate_model, with_equivalents
from nephos.plans.observation_operators import model_equivalent
from nephos.queries.shape import r, rounded
from nephos.registry import register

FRAMES_SQL = """frames AS (SELECT CAST(i AS INT) AS t_idx, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (24*i) HOUR AS t FROM range(31) f(i)),
  spans AS (SELECT t_idx AS left_idx, epoch_us(t) AS lu, coalesce(lead(t_idx) OVER (ORDER BY t), t_idx) AS right_idx, coalesce(lead(epoch_us(t)) OVER (ORDER BY t), epoch_us(t)) AS ru,
    lead(t) OVER (ORDER BY t) IS NULL AS is_last FROM frames),
  lim AS (SELECT min(lu) AS lo, max(lu) AS hi FROM spans),
  clip AS (SELECT o.*, epoch_us("time") AS us, least(greatest(epoch_us("time"), lo), hi) AS cu, lo, hi FROM obs o, lim)"""


def frames(spark: SparkSession) -> DataFrame:
    return model_frames(spark).select("t_idx", "t").distinct()


@register(
    "bracket_asof_interp",
    f"""WITH {OBS_SQL}, {FRAMES_SQL} SELECT obs_id, left_idx, right_idx, round(CASE WHEN ru = lu THEN 0 ELSE (cu - lu)/CAST(ru - lu AS DOUBLE) END, 6) AS t_weight,
    us >= lo - 3600000000 AND us <= hi + 3600000000 AS valid FROM clip JOIN spans ON cu >= lu AND (cu < ru OR is_last)""",
)
def bracket_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(joins.bracket(observations(spark, sf_dir), frames(spark)).select("obs_id", "left_idx", "right_idx", "t_weight", "valid"))


@register(
    "nearest_asof",
    f"""WITH {OBS_SQL}, {FRAMES_SQL}, n AS (SELECT obs_id, us, t_idx, abs(us - epoch_us(t)) AS gap, row_number() OVER (PARTITION BY obs_id ORDER BY abs(us - epoch_us(t)), t) AS k FROM clip, frames)
    SELECT obs_id, t_idx, gap <= 3600000000 AS valid FROM n WHERE k = 1""",
)
def nearest_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.nearest_frame(observations(spark, sf_dir), frames(spark)).select("obs_id", "t_idx", "valid")


X_AXIS, Y_AXIS = (0.0, 200_000.0, 19), (0.0, 200_000.0, 10)


@register(
    "trilinear_interp",
    f"""WITH {OBS_SQL}, {FRAMES_SQL}, b AS (SELECT obs_id, us >= lo - 3600000000 AND us <= hi + 3600000000 AS valid, left_idx, right_idx, CASE WHEN ru = lu THEN 0 ELSE (cu - lu)/CAST(ru - lu AS DOUBLE) END AS w,
      least(floor(x/200000), 17) AS i, least(x/200000 - least(floor(x/200000), 17), 1) AS wx, least(floor(y/200000), 8) AS j, least(y/200000 - least(floor(y/200000), 8), 1) AS wy,
      least(floor(z/2000), 9) AS l, least(z/2000 - least(floor(z/2000), 9), 1) AS wl FROM clip JOIN spans ON cu >= lu AND (cu < ru OR is_last)),
    c AS (SELECT obs_id, valid, CASE WHEN dt = 0 THEN left_idx ELSE right_idx END AS t, CAST(i + dx AS INT) AS ix, CAST(j + dy AS INT) AS iy, CAST(l + dl AS INT) AS il,
      (CASE WHEN dt = 0 THEN 1 - w ELSE w END)*(CASE WHEN dx = 0 THEN 1 - wx ELSE wx END)*(CASE WHEN dy = 0 THEN 1 - wy ELSE wy END)*(CASE WHEN dl = 0 THEN 1 - wl ELSE wl END) AS weight
      FROM b, range(2) p(dt), range(2) q(dx), range(2) u(dy), range(2) v(dl))
    SELECT obs_id, round(CASE WHEN bool_and(valid) THEN sum(weight*(t + CAST(0.5 AS DOUBLE)*ix + CAST(0.25 AS DOUBLE)*iy + 2*il + CAST(0.5 AS DOUBLE)*((t*7 + ix*5 + iy*3 + il*11) % 13))) END, 6) AS model FROM c GROUP BY obs_id""",
)
def trilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid is rough, so every corner and weight counts; the levels are the same everywhere."""
    return rounded(interpolate_model(observations(spark, sf_dir), model_frames(spark), X_AXIS, Y_AXIS))


def wind_frames(spark: SparkSession) -> DataFrame:
    """The rough grid's values as one flat field with its spread, and two winds on levels in height and in pressure."""
    k, pressure = F.sequence(F.lit(0), F.lit(10)), lambda l: F.lit(100_000.0) - l * 9000.0
    rough = F.transform("profile", lambda v, i: v * 0.5 + i * F.col("ix") % 3)
    return model_frames(spark).select(
        "t_idx", "t", "ix", "iy", F.col("profile")[3].alias("AOD_550"), (F.col("ix") * 0.25 + F.col("t_idx") % 4).alias("AOD_550_sd"),
        F.col("profile").alias("wind_east"), rough.alias("wind_north"), F.col("levels").alias("geopotential_height"), F.transform(k, pressure).alias("air_pressure"),
    )


@register(
    "operator_departures",
    f"""WITH {OBS_SQL}, {FRAMES_SQL}, b AS (SELECT obs_id, quantity, z_type, value, us >= lo - 3600000000 AND us <= hi + 3600000000 AS valid, left_idx, right_idx, CASE WHEN ru = lu THEN 0 ELSE (cu - lu)/CAST(ru - lu AS DOUBLE) END AS w,
      least(floor(x/200000), 17) AS i, least(x/200000 - least(floor(x/200000), 17), 1) AS wx, least(floor(y/200000), 8) AS j, least(y/200000 - least(floor(y/200000), 8), 1) AS wy,
      least(floor(p), 9) AS l, least(p - least(floor(p), 9), 1) AS wl FROM (SELECT *, CASE WHEN z_type = 'height' THEN z/2000 ELSE least(greatest((100000 - z)/9000, 0), 10) END AS p FROM clip) JOIN spans ON cu >= lu AND (cu < ru OR is_last)),
    c AS (SELECT obs_id, quantity, z_type, value, valid, CASE WHEN dt = 0 THEN left_idx ELSE right_idx END AS t, CAST(i + dx AS INT) AS ix, CAST(j + dy AS INT) AS iy, CAST(greatest(l, 0) + dl AS INT) AS il,
      (CASE WHEN dt = 0 THEN 1 - w ELSE w END)*(CASE WHEN dx = 0 THEN 1 - wx ELSE wx END)*(CASE WHEN dy = 0 THEN 1 - wy ELSE wy END) AS flat, greatest(CASE WHEN dl = 0 THEN 1 - wl ELSE wl END, 0) AS up
      FROM b, range(2) p(dt), range(2) q(dx), range(2) u(dy), range(2) v(dl)),
    v AS (SELECT *, t + CAST(0.5 AS DOUBLE)*ix + CAST(0.25 AS DOUBLE)*iy + 2*il + CAST(0.5 AS DOUBLE)*((t*7 + ix*5 + iy*3 + il*11) % 13) AS east, t + CAST(0.5 AS DOUBLE)*ix + CAST(0.25 AS DOUBLE)*iy + 6 + CAST(0.5 AS DOUBLE)*((t*7 + ix*5 + iy*3 + 33) % 13) AS aod FROM c),
    g AS (SELECT obs_id, any_value(quantity) AS quantity, any_value(z_type) AS z_type, any_value(value) AS value, bool_and(valid) AS valid, sum(flat*aod)/2 AS aod, sum(flat*(CAST(0.25 AS DOUBLE)*ix + t % 4))/2 AS aod_sd,
      sum(flat*up*east) AS east, sum(flat*up*(CAST(0.5 AS DOUBLE)*east + (il*ix) % 3)) AS north FROM v GROUP BY obs_id),
    m AS (SELECT obs_id, value, CASE WHEN quantity = 'AOD_550nm' AND valid THEN aod WHEN valid AND z_type IN ('height', 'pressure') AND obs_id % 11 <> 0 THEN -east*sin(radians(CAST(obs_id % 360 AS DOUBLE))) - north*cos(radians(CAST(obs_id % 360 AS DOUBLE))) END AS model,
      CASE WHEN quantity = 'AOD_550nm' AND valid THEN aod_sd END AS spread FROM (SELECT g.* REPLACE (CASE WHEN z_type = 'columnar' AND obs_id % 5 = 0 THEN 'pressure' ELSE z_type END AS z_type) FROM g))
    SELECT obs_id, {r("model AS model_forecast", "spread AS model_forecast_spread", "value - model AS departure")} FROM m""",
)
def operator_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures of a flat quantity, with its spread, and of winds along a line of sight, from two fields in height or pressure; some rows lack the angle or a vertical coordinate."""
    e = F.col("obs_id")
    angle = F.to_json(F.struct(F.when(e % 11 != 0, (e % 360).cast("double")).alias("azimuth")))
    obs = observations(spark, sf_dir).withColumns({"metadata": angle, "z_type": F.when((F.col("z_type") == "columnar") & (e % 5 == 0), "pressure").otherwise(F.col("z_type"))})
    out = with_equivalents(obs, wind_frames(spark), X_AXIS, Y_AXIS)
    return rounded(out.select("obs_id", "model_forecast", "model_forecast_spread", "departure"))


@register(
    "vertical_interp",
    """WITH p AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v, CAST(vec_id % 70 AS DOUBLE) + CAST(0.25 AS DOUBLE) AS z FROM embeddings)
    SELECT vec_id, round(CASE WHEN z <= 0 THEN v[1] WHEN z >= 63 THEN v[64] ELSE v[CAST(floor(z) AS INT)+1] + (z - floor(z))*(v[CAST(floor(z) AS INT)+2] - v[CAST(floor(z) AS INT)+1]) END, 6) AS value FROM p""",
)
def vertical(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"), F.transform("embedding", lambda _, i: i.cast("double")).alias("c"), ((F.col("vec_id") % 70).cast("double") + 0.25).alias("z")
    )
    return rounded(profiles.select("vec_id", interpolate(F.col("c"), F.col("v"), F.col("z")).alias("value")))


@register(
    "pressure_slice",
    """WITH p AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v, (100000 - 50000.0::DOUBLE)/1000 AS k FROM embeddings)
    SELECT vec_id, round(v[51] + (k - 50)*(v[52] - v[51]), 6) AS value FROM p""",
)
def pressure_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels every 10 hPa from 1000 hPa up; the 500 hPa surface."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    p = F.transform("embedding", lambda _, i: 100_000.0 - i * 1000.0)
    return rounded(table(spark, sf_dir, "embeddings").select("vec_id", at_pressure(p, v, 500).alias("value")))


@register(
    "hlos_operator",
    """SELECT event_id, round(-value*sin(radians(CAST(event_id % 360 AS DOUBLE))) - (value*CAST(0.5 AS DOUBLE))*cos(radians(CAST(event_id % 360 AS DOUBLE))), 6) AS hlos,
    round(CASE WHEN event_id % 4 <> 0 THEN -value*sin(radians(CAST(event_id % 360 AS DOUBLE))) - (value*CAST(0.5 AS DOUBLE))*cos(radians(CAST(event_id % 360 AS DOUBLE))) END, 6) AS by_spec FROM events""",
)
def hlos(spark: SparkSession, sf_dir: str) -> DataFrame:
    angle = (F.col("event_id") % 360).cast("double")
    meta = F.when(F.col("event_id") % 4 != 0, F.to_json(F.struct(angle.alias("azimuth"))))
    df = table(spark, sf_dir, "events").select("event_id", F.col("value").alias("wind_east"), (F.col("value") * 0.5).alias("wind_north"), angle.alias("angle"), meta.alias("metadata"))
    return rounded(df.select("event_id", hlos_wind(F.col("wind_east"), F.col("wind_north"), F.col("angle")).alias("hlos"), model_equivalent(df, "HLOS_WIND").alias("by_spec")))


@register(
    "model_bounds",
    """WITH g AS (SELECT make_timestamp(1704067200000000 + (event_id % 72)*3600000000) AS t, CAST((event_id*37) % 3600 AS DOUBLE)*1000 AS x, CAST((event_id*91) % 1800 AS DOUBLE)*1000 AS y FROM events)
    SELECT min(t) AS min_t, max(t) AS max_t, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, count(DISTINCT t) AS frames, (SELECT count(*) FROM (SELECT DISTINCT x, y FROM g)) AS points FROM g""",
)
def model_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of a model data set with a point and a frame for each event."""
    e = F.col("event_id")
    t = F.timestamp_micros(F.lit(1_704_067_200_000_000) + (e % 72) * 3_600_000_000).cast("timestamp_ntz")
    grid = table(spark, sf_dir, "events").select(t.alias("t"), (((e * 37) % 3600).cast("double") * 1000).alias("x"), (((e * 91) % 1800).cast("double") * 1000).alias("y"))
    return api.model_bounds(grid)


@register(
    "interval_overlap_join",
    """WITH cycles AS (SELECT CAST(i AS INT) AS cycle_index, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (6*i) HOUR AS start_time, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (6*(i+1)) HOUR AS end_time FROM range(120) t(i)),
    f AS (SELECT event_type, user_id % 50 AS part, date_trunc('day', ts) AS day, min(ts) AS file_start, max(ts) AS file_end FROM events GROUP BY ALL)
    SELECT cycle_index, event_type, part, file_start, file_end FROM cycles JOIN f ON file_start <= end_time AND start_time <= file_end""",
)
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("day", "ts")
    files = table(spark, sf_dir, "events").groupBy("event_type", (F.col("user_id") % 50).alias("part"), day.alias("day")).agg(F.min("ts").alias("file_start"), F.max("ts").alias("file_end"))
    out = joins.overlapping(files, cycle_calendar(spark), ("file_start", "file_end"), ("start_time", "end_time"))
    return out.select("cycle_index", "event_type", "part", "file_start", "file_end")


@register(
    "latest_complete_cycle",
    """WITH f AS (SELECT DISTINCT o_orderkey % 97 AS cycle, o_custkey % 12 AS member FROM orders WHERE (o_orderkey + o_custkey) % 11 <> 0 OR o_orderkey % 97 < 60)
    SELECT max(cycle) AS cycle FROM (SELECT cycle FROM f GROUP BY cycle HAVING count(DISTINCT member) = 12) WHERE cycle < 80""",
)
def latest_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    files = table(spark, sf_dir, "orders").where(((k + c) % 11 != 0) | (k % 97 < 60)).select((k % 97).alias("cycle"), (c % 12).alias("member"))
    return joins.latest_complete(files, 12, 80)


@register(
    "lead_time_dedupe",
    """WITH f AS (SELECT date_trunc('hour', ts) AS t, user_id % 240 AS lead, event_id AS file FROM events),
    a AS (SELECT t, lead, file, row_number() OVER (PARTITION BY t ORDER BY lead, file) AS k, row_number() OVER (PARTITION BY t ORDER BY lead DESC, file) AS m FROM f)
    SELECT t, max(CASE WHEN k = 1 THEN lead END) AS short_lead, max(CASE WHEN k = 1 THEN file END) AS short_file,
    max(CASE WHEN m = 1 THEN lead END) AS long_lead, max(CASE WHEN m = 1 THEN file END) AS long_file FROM a GROUP BY t""",
)
def lead_time_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("t"), (F.col("user_id") % 240).alias("lead"), F.col("event_id").alias("file"))
    named = lambda df, n: df.select("t", F.col("lead").alias(f"{n}_lead"), F.col("file").alias(f"{n}_file"))
    return named(joins.dedupe_by_lead(f), "short").join(named(joins.dedupe_by_lead(f, True), "long"), "t")


@register(
    "nearest_grid_point",
    f"""WITH {OBS_SQL}, g AS (SELECT CAST(i AS INT) AS ix, CAST(j AS INT) AS iy, CAST(-180 + 20*i AS DOUBLE) AS glon, CAST(-90 + 20*j AS DOUBLE) AS glat FROM range(18) a(i), range(9) b(j)),
    d AS (SELECT obs_id, ix, iy, (longitude-glon)*(longitude-glon) + (latitude-glat)*(latitude-glat) AS d2 FROM obs, g),
    k AS (SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY d2, ix, iy) AS k FROM d) SELECT obs_id, ix, iy, round(d2, 6) AS d2 FROM k WHERE k = 1""",
)
def nearest_grid_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, j = F.floor(F.col("id") / 9), F.col("id") % 9
    grid = spark.range(162).select(i.cast("int").alias("ix"), j.cast("int").alias("iy"), (-180 + 20 * i).cast("double").alias("glon"), (-90 + 20 * j).cast("double").alias("glat"))
    return rounded(nearest.nearest_point(observations(spark, sf_dir), grid))


PART_GRID_SQL = "g AS (SELECT CAST(i AS INT) AS ix, CAST(j AS INT) AS iy, CAST(100 + 1.5*i + (j % 3)/10.0 AS DOUBLE) AS glon, CAST(-20 + 0.75*j + (i % 4)/20.0 AS DOUBLE) AS glat FROM range(40) a(i), range(50) b(j))"


def part_grid(spark: SparkSession) -> DataFrame:
    """A bent grid over a part of the globe, beside the date line."""
    i, j = F.floor(F.col("id") / 50), F.col("id") % 50
    return spark.range(2000).select(i.cast("int").alias("ix"), j.cast("int").alias("iy"), (100 + 1.5 * i + (j % 3) / 10.0).cast("double").alias("glon"), (-20 + 0.75 * j + (i % 4) / 20.0).cast("double").alias("glat"))


@register(
    "nearest_across_date_line",
    f"""WITH {OBS_SQL}, {PART_GRID_SQL}, p AS (SELECT DISTINCT longitude, latitude FROM obs),
    d AS (SELECT longitude, latitude, ix, iy, least((longitude-glon)*(longitude-glon), (longitude-360-glon)*(longitude-360-glon), (longitude+360-glon)*(longitude+360-glon)) + (latitude-glat)*(latitude-glat) AS d2 FROM p, g),
    k AS (SELECT longitude, latitude, min(struct_pack(d2 := d2, ix := ix, iy := iy)) AS b FROM d GROUP BY ALL)
    SELECT obs_id, b.ix AS ix, b.iy AS iy, round(b.d2, 6) AS d2 FROM obs JOIN k USING (longitude, latitude)""",
)
def nearest_across_date_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points all over the globe and a grid over a part of it: most are far outside, some nearer the other way round."""
    return rounded(nearest.nearest_point(observations(spark, sf_dir), part_grid(spark), wrap=True))


@register(
    "grid_windows",
    f"""WITH {OBS_SQL}, {PART_GRID_SQL}, c AS (SELECT obs_id, longitude, latitude FROM obs WHERE longitude BETWEEN 100 AND 155 AND latitude BETWEEN -20 AND 15),
    d AS (SELECT obs_id, ix, iy, (longitude-glon)*(longitude-glon) + (latitude-glat)*(latitude-glat) AS d2 FROM c, g),
    k AS (SELECT obs_id, min(struct_pack(d2 := d2, ix := ix, iy := iy)) AS b FROM d GROUP BY obs_id)
    SELECT obs_id, count(*) AS points, min(g.ix) AS first_ix, max(g.iy) AS last_iy, {r("sum(glon) AS total")} FROM k JOIN g ON g.ix BETWEEN b.ix - 5 AND b.ix + 5 AND g.iy BETWEEN b.iy - 5 AND b.iy + 5 GROUP BY obs_id""",
)
def grid_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of up to 11 x 11 grid points, by index, around the grid point nearest to each observation over the grid."""
    obs = observations(spark, sf_dir).where(F.col("longitude").between(100, 155) & F.col("latitude").between(-20, 15))
    grid = part_grid(spark)
    window = nearest.index_window(nearest.nearest_point(obs, grid), grid, 5)
    return rounded(window.groupBy("obs_id").agg(F.count(F.lit(1)).alias("points"), F.min("ix").alias("first_ix"), F.max("iy").alias("last_iy"), F.sum("glon").alias("total")))


@register(
    "model_value_update",
    f"""WITH {OBS_SQL}, u AS (SELECT obs_id, z*2 AS value FROM obs WHERE instrument IN ('click', 'view'))
    SELECT o.obs_id, round(CASE WHEN u.obs_id IS NOT NULL THEN u.value ELSE model_forecast END, 6) AS kept, round(u.value, 6) AS cleared FROM obs o LEFT JOIN u USING (obs_id)""",
)
def model_value_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).select("obs_id", "model_forecast")
    new = observations(spark, sf_dir).where("instrument IN ('click', 'view')").select("obs_id", (F.col("z") * 2).alias("value"))
    kept = joins.update_values(obs, new, "model_forecast").withColumnRenamed("model_forecast", "kept")
    cleared = joins.update_values(obs, new, "model_forecast", clear=True).withColumnRenamed("model_forecast", "cleared")
    return rounded(kept.join(cleared, "obs_id"))


@register(
    "member_long_join",
    f"""WITH {OBS_SQL}, m AS (SELECT l_orderkey AS obs_id, CAST(l_linenumber AS INT) AS member, l_quantity AS value FROM lineitem)
    SELECT m.member, o.instrument, count(*) AS n, count(o.value) AS n_obs, {r("avg(m.value) AS mean")}, {r("sum(m.value - o.value) AS departure", digits=3)} FROM m LEFT JOIN obs o USING (obs_id) GROUP BY ALL""",
)
def member_long_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from nephos.sources.store import with_observations

    m = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("obs_id"), F.col("l_linenumber").cast("int").alias("member"), F.col("l_quantity").alias("value"))
    both = with_observations(m, observations(spark, sf_dir)).join(observations(spark, sf_dir).select("obs_id", "instrument"), "obs_id", "left")
    out = both.groupBy("member", "instrument").agg(F.count(F.lit(1)).alias("n"), F.count("obs_value").alias("n_obs"), F.avg("value").alias("mean"), F.sum(F.col("value") - F.col("obs_value")).alias("departure"))
    return out.select("member", "instrument", "n", "n_obs", F.round("mean", 6).alias("mean"), F.round("departure", 3).alias("departure"))


@register(
    "state_overlay",
    """WITH b AS (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'T' ELSE 'U' END AS var, p_retailprice AS value FROM part),
    n AS (SELECT l_partkey AS p_partkey, max(l_extendedprice) AS value FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
    SELECT p_partkey, var, round(CASE WHEN var = 'T' THEN coalesce(n.value, b.value) ELSE b.value END, 6) AS value FROM b LEFT JOIN n USING (p_partkey)""",
)
def state_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, "T").otherwise("U").alias("var"), F.col("p_retailprice").alias("value"))
    new = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_extendedprice").alias("value"))
    return rounded(joins.overlay(base, new.withColumn("var", F.lit("T")), ["T"], ["p_partkey", "var"]).select("p_partkey", "var", "value"))


@register(
    "bucket_resample",
    f"WITH {OBS_SQL} SELECT CAST(floor((longitude + 180)/15) AS INT) AS ix, CAST(floor((latitude + 90)/15) AS INT) AS iy, round(avg(value), 6) AS value, count(value) AS n FROM obs GROUP BY 1, 2",
)
def bucket_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(joins.bin_mean(observations(spark, sf_dir), "longitude", "latitude", -180, -90, 15, 15, "value"))
