"""Gridded ensembles and arrays."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.adapters import GRID_SQL, OBS_SQL, ensemble_grid, observations, table
from nephos.operators import ensemble, joins
from nephos.queries.shape import normal_sql, r, rounded
from nephos.registry import fixed, register
from nephos.session import shared_dir
from nephos.sources.moments import MomentStore


@register("ensemble_mean_sd", f"WITH {GRID_SQL} SELECT var, t_idx, ix, iy, iz, count(value) AS n, {r('avg(value) AS mean', 'stddev_samp(value) AS sd')} FROM grid GROUP BY ALL")
def ensemble_mean_sd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ensemble.mean_spread(ensemble_grid(spark, sf_dir)))


@register(
    "member_arrivals",
    f"""WITH {GRID_SQL} SELECT var, t_idx, ix, iy, iz, count(value) AS n, {r('avg(value) AS mean', 'stddev_samp(value) AS sd')}, '8' AS missing, 2 AS parts FROM grid WHERE member <> 8 GROUP BY ALL""",
)
def member_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members in three arrivals, one of them twice and one never; two of the parts are put together in between."""
    grid = ensemble_grid(spark, sf_dir)
    store = MomentStore(spark, f"{shared_dir(spark)}/nephos/moments-{uuid.uuid4().hex}")
    for k, came in enumerate(([0, 1, 2, 3], [4, 5, 3], [6, 7, 9, 0])):
        store.merge(grid.where(F.col("member").isin(came)))
        if k == 1:
            store.compact()
    missing = ",".join(map(str, store.missing(range(10))))
    return rounded(store.read()).withColumns({"missing": F.lit(missing), "parts": F.lit(len(store._state()["parts"]))})


@register(
    "quantised_grid",
    f"""WITH {GRID_SQL}, b AS (SELECT *, CASE var WHEN 'T' THEN 10 ELSE 7 END AS bits, floor(log2(abs(value)))::INT AS e FROM grid),
    s AS (SELECT *, pow(2::DOUBLE, bits - e) AS scale FROM b), q AS (SELECT *, CASE WHEN value = 0 THEN 0 ELSE round_even(value*scale, 0)/scale END AS kept FROM s)
    SELECT var, t_idx, ix, iy, iz, member, kept AS value FROM q""",
)
def quantised_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members' fields with three significant digits of one variable and two of the other."""
    from nephos.sources.quantise import quantised

    return quantised(ensemble_grid(spark, sf_dir), {"T": 3, "Q.*": 2}).withColumn("value", F.col("value").cast("double"))


@register(
    "field_difference",
    f"""WITH {GRID_SQL}, a AS (SELECT var, ix, iy, iz, member, avg(value) AS value FROM grid WHERE t_idx = 1 GROUP BY ALL),
    f AS (SELECT var, ix, iy, iz, member, avg(value) AS value FROM grid WHERE t_idx = 0 GROUP BY ALL)
    SELECT var, ix, iy, iz, member, round(a.value - f.value, 6) AS value FROM a JOIN f USING (var, ix, iy, iz, member)""",
)
def field_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["var", "ix", "iy", "iz", "member"]
    at = lambda t: ensemble_grid(spark, sf_dir).where(F.col("t_idx") == t).groupBy(*keys).agg(F.avg("value").alias("value"))
    return rounded(ensemble.difference(at(1), at(0), keys))


@register(
    "forecast_align",
    """WITH a AS (SELECT date_trunc('day', ts) AS t, count(*) FILTER (event_type = 'purchase') >= count(*) FILTER (event_type = 'view') AS busy FROM events GROUP BY 1),
    f AS (SELECT t FROM a WHERE busy) SELECT a.t, coalesce(f.t, (SELECT max(t) FROM f)) AS frame_t FROM a LEFT JOIN f USING (t)""",
)
def forecast_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysis has a frame for each day, the forecast for the days with as many purchases as views."""
    kind = lambda k: F.count_if(F.col("event_type") == k)
    days = table(spark, sf_dir, "events").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("t")).agg((kind("purchase") >= kind("view")).alias("busy"))
    return ensemble.align_or_last(days.where("busy").select("t"), days.select("t"))


@register(
    "member_normalise",
    f"""WITH {GRID_SQL}, s AS (SELECT member, avg(value) AS m, stddev_pop(value) AS s FROM grid GROUP BY member)
    SELECT var, t_idx, ix, iy, iz, g.member, round(least(greatest((value - m)/s*0.5 + 1, 0.0), 2.0), 6) AS value FROM grid g JOIN s USING (member)""",
)
def member_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ensemble.normalise_members(ensemble_grid(spark, sf_dir), 1.0, 0.5, 0.0, 2.0).select("var", "t_idx", "ix", "iy", "iz", "member", "value"))


def smooth_sql(source: str, axis: str, keep: str, sigma: str, radius: int, n: str) -> str:
    """One axis of ``source`` (keep, axis, value) smoothed with mirrored edges, as a SELECT."""
    return f"""SELECT {keep}, i AS {axis}, sum(w*value) AS value FROM (
      SELECT {", ".join("c." + k.strip() for k in keep.split(","))}, c.{axis} AS i, w.w, s.value FROM {source} c
      JOIN (SELECT k, exp(-0.5*(k/{sigma})*(k/{sigma}))/(SELECT sum(exp(-0.5*(j/{sigma})*(j/{sigma}))) FROM range(-{radius}, {radius + 1}) r(j)) AS w FROM range(-{radius}, {radius + 1}) r(k)) w ON true
      JOIN {source} s ON {" AND ".join(f"s.{k.strip()} = c.{k.strip()}" for k in keep.split(","))} AND s.{axis} = CASE WHEN ((c.{axis} + w.k) % (2*{n}) + 2*{n}) % (2*{n}) < {n}
        THEN ((c.{axis} + w.k) % (2*{n}) + 2*{n}) % (2*{n}) ELSE 2*{n} - 1 - ((c.{axis} + w.k) % (2*{n}) + 2*{n}) % (2*{n}) END) GROUP BY ALL"""


@fixed(
    "perturbation_field",
    f"""WITH raw AS (SELECT CAST(id // 1200 AS INT) AS member, CAST((id // 30) % 40 AS INT) AS ix, CAST(id % 30 AS INT) AS iy, 1 + 10*{normal_sql("id", 7)} AS value FROM range(4800) t(id)),
    g AS (SELECT member, ix, iy, CASE WHEN ix < 3 OR ix >= 37 OR iy < 3 OR iy >= 27 THEN 1.0 ELSE value END AS value FROM raw),
    sx AS ({smooth_sql("g", "ix", "member, iy", "CAST(2.5 AS DOUBLE)", 10, "40")}), sy AS ({smooth_sql("sx", "iy", "member, ix", "CAST(2.5 AS DOUBLE)", 10, "30")}),
    m AS (SELECT member, avg(value) AS m, stddev_pop(value) AS s FROM sy GROUP BY member)
    SELECT member, ix, iy, round(least(greatest((value - m)/s*CAST(0.1 AS DOUBLE) + 1, 0.5), 1.5), 6) AS value FROM sy JOIN m USING (member)""",
)
def perturbation_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ensemble.perturbation_fields(spark, 4, 40, 30, 1.0, 0.1, boundary=3, low=0.5, high=1.5, seed=7).select("member", "ix", "iy", "value"))


@register(
    "gaussian_smooth",
    f"""WITH g AS (SELECT CAST(c_custkey % 10 AS INT) AS line, CAST(row_number() OVER (PARTITION BY c_custkey % 10 ORDER BY c_custkey) - 1 AS INT) AS ix,
      CAST(count(*) OVER (PARTITION BY c_custkey % 10) AS INT) AS n, c_acctbal AS value FROM customer)
    SELECT line, ix, round(value, 4) AS value FROM ({smooth_sql("g", "ix", "line, n", "CAST(1 AS DOUBLE)", 4, "c.n")})""",
)
def gaussian_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers in ten lines, as long as they are."""
    from pyspark.sql import Window

    line = (F.col("c_custkey") % 10).cast("int")
    place = (F.row_number().over(Window.partitionBy("line").orderBy("c_custkey")) - 1).cast("int")
    grid = table(spark, sf_dir, "customer").select(line.alias("line"), "c_custkey", F.col("c_acctbal").alias("value")).withColumn("ix", place).select("line", "ix", "value")
    return rounded(ensemble.smooth_axis(grid, "ix", None, 1.0, ["line", "ix"]), 4)


@register(
    "perturb_tapered",
    f"""WITH {GRID_SQL}, p AS (SELECT DISTINCT member, ix, iy, CAST(1 + 0.1*member + 0.01*ix AS DOUBLE) AS p FROM grid),
    w AS (SELECT g.*, p.p, 1 - least(1.0, least(ix, 4 - ix, iy, 99 - iy)/CAST(2 AS DOUBLE)) AS w FROM grid g JOIN p USING (member, ix, iy))
    SELECT var, t_idx, ix, iy, iz, member, {r("value*(1 + (p - 1)*w) AS multiplied", "value + p*w AS added", "value*(1 - w) + p*w AS assigned")} FROM w""",
)
def perturb_tapered(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = ensemble_grid(spark, sf_dir)
    fields = grid.select("member", "ix", "iy").distinct().withColumn("value", (1 + 0.1 * F.col("member") + 0.01 * F.col("ix")).cast("double"))
    keys = ["var", "t_idx", "ix", "iy", "iz", "member"]
    big = lambda op: ensemble.perturb(grid, fields, op, 5, 100, 2).select(*keys, "value")
    out = big("multiply").withColumnRenamed("value", "multiplied")
    for op, name in (("add", "added"), ("assign", "assigned")):
        out = out.join(big(op).withColumnRenamed("value", name), keys)
    return rounded(out)


DILATE_SQL = """f AS (SELECT DISTINCT CAST(o_custkey % 60 AS INT) AS profile, CAST(o_orderkey % 24 AS INT) AS level FROM orders),
  s AS (SELECT profile, level, CASE WHEN (profile*7 + level*13) % 101 = 0 THEN 1 ELSE 0 END AS flag FROM f)"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when((F.col("profile") * 7 + F.col("level") * 13) % 101 == 0, 1).otherwise(0)
    o = table(spark, sf_dir, "orders")
    return o.select((F.col("o_custkey") % 60).cast("int").alias("profile"), (F.col("o_orderkey") % 24).cast("int").alias("level")).distinct().withColumn("flag", flag)


@register(
    "binary_dilation_2d",
    f"""WITH {DILATE_SQL}, l AS (SELECT *, max(flag) OVER (PARTITION BY profile ORDER BY level RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS line FROM s)
    SELECT profile, level, flag, max(line) OVER (PARTITION BY level ORDER BY profile RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS dilated FROM l""",
)
def binary_dilation_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ensemble.dilate(cells(spark, sf_dir), "flag", "profile", "level", 2, 3)


@register(
    "drop_empty_slices",
    f"""WITH {DILATE_SQL}, v AS (SELECT profile, level, CASE WHEN profile % 5 <> 0 AND level % 4 <> 1 THEN flag END AS flag FROM s),
    a AS (SELECT *, count(flag) OVER (PARTITION BY profile) AS n FROM v), b AS (SELECT *, count(flag) OVER (PARTITION BY level) AS m FROM a WHERE n > 0)
    SELECT profile, level, flag FROM b WHERE m > 0""",
)
def drop_empty_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cells(spark, sf_dir).withColumn("flag", F.when((F.col("profile") % 5 != 0) & (F.col("level") % 4 != 1), F.col("flag")))
    return ensemble.drop_empty_slices(df, "flag", ["profile", "level"])


@register(
    "dense_reconstruct",
    f"""WITH {OBS_SQL}, v AS (SELECT instrument, c_profile % 500 AS p, c_bin AS b, max(value) AS value FROM obs GROUP BY ALL),
    s AS (SELECT i.instrument, CAST(p AS INT) AS p, CAST(b AS INT) AS b FROM (SELECT DISTINCT instrument FROM v) i, range(500) x(p), range(24) y(b))
    SELECT s.instrument, s.p, s.b, round(coalesce(value, -1), 6) AS value FROM s LEFT JOIN v USING (instrument, p, b)""",
)
def dense_reconstruct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each instrument has rows in some of the cells only."""
    v = observations(spark, sf_dir).groupBy("instrument", (F.col("c_profile") % 500).alias("p"), F.col("c_bin").alias("b")).agg(F.max("value").alias("value"))
    return rounded(ensemble.dense(v, {"p": 500, "b": 24}, ["value"], -1.0, ["instrument"]))


@register("orig_coords_expand", f"WITH {OBS_SQL} SELECT obs_id, c_profile AS coord_profile, c_bin AS coord_bin, CAST(NULL AS INT) AS coord_other FROM obs")
def orig_coords_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = F.struct(F.array("c_profile", "c_bin").alias("indices"), F.array(F.lit(100), F.lit(24)).alias("shape"), F.array(F.lit("profile"), F.lit("bin")).alias("names"))
    df = observations(spark, sf_dir).select("obs_id", packed.alias("orig_coords"))
    return ensemble.expand_coords(df, ["profile", "bin", "other"]).drop("orig_coords")


@register("duplicate_coords", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ensemble.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "unpivot_wide",
    f"""WITH {OBS_SQL}, u AS (UNPIVOT (SELECT obs_id, value, model_forecast, model_analysis FROM obs) ON value, model_forecast, model_analysis INTO NAME quantity VALUE v)
    SELECT quantity, count(*) AS n, {r("sum(v) AS total", digits=3)} FROM u GROUP BY 1""",
)
def unpivot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = ensemble.unpivot_values(observations(spark, sf_dir).select("obs_id", "value", "model_forecast", "model_analysis"), ["obs_id"], ["value", "model_forecast", "model_analysis"], value="v")
    return long.groupBy("quantity").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 3).alias("total"))


@register(
    "union_files",
    """WITH a AS (SELECT event_id, value, NULL AS props FROM events WHERE event_type IN ('click', 'view') UNION ALL SELECT event_id, NULL, props FROM events WHERE event_type NOT IN ('click', 'view'))
    SELECT count(*) AS n, count(value) AS n_value, count(props) AS n_props FROM a""",
)
def union_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    seen = F.col("event_type").isin("click", "view")
    both = ensemble.union_all([e.where(seen).select("event_id", "value"), e.where(~seen).select("event_id", "props")])
    return both.agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_value"), F.count("props").alias("n_props"))


@register(
    "completeness_check",
    """SELECT l_linenumber AS cycle, count(*) FILTER (l_returnflag <> 'N') AS n_files, bool_or(l_tax <> 0) AS tax_set, bool_or(l_quantity > 1000) AS big_set FROM lineitem GROUP BY 1""",
)
def completeness_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = F.when(F.col("l_quantity") > 1000, 1).otherwise(0)
    files = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("cycle"), (F.col("l_returnflag") != "N").alias("exists"), F.col("l_tax").alias("tax"), big.alias("big"))
    return ensemble.completeness(files, ["tax", "big"])


@register(
    "boundary_fill",
    """WITH c AS (SELECT CAST((event_id*37) % 20 AS INT) AS ix, CAST((event_id*91) % 15 AS INT) AS iy, round(avg(value), 6) AS value FROM events GROUP BY ALL)
    SELECT ix, iy, CASE WHEN ix < 3 OR ix >= 17 OR iy < 3 OR iy >= 12 THEN 1.0::DOUBLE ELSE value END AS value FROM c""",
)
def boundary_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean values of events in the cells of a grid, with a constant border."""
    e = F.col("event_id")
    cells = table(spark, sf_dir, "events").groupBy(((e * 37) % 20).cast("int").alias("ix"), ((e * 91) % 15).cast("int").alias("iy")).agg(F.round(F.avg("value"), 6).alias("value"))
    return ensemble.set_boundary(cells, 20, 15, 3, 1.0)


@register(
    "mask_lookup",
    f"""WITH {OBS_SQL} SELECT obs_id, round(least(greatest((longitude + 180)/10, 0), 35)*2 + least(greatest((latitude + 90)/10, 0), 17), 6) AS mask FROM obs""",
)
def mask_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bilinear lookup of a land-sea mask that is linear in both axes: one frame, one level."""
    i, j = F.floor(F.col("id") / 18).cast("int"), (F.col("id") % 18).cast("int")
    grid = spark.range(36 * 18).select(F.lit(0).alias("t_idx"), i.alias("ix"), j.alias("iy"), F.array((i * 2 + j).cast("double")).alias("profile"))
    points = observations(spark, sf_dir).select("obs_id", F.col("longitude").alias("x"), F.col("latitude").alias("y"), F.lit(0).alias("left_idx"), F.lit(0).alias("right_idx"), F.lit(0.0).alias("t_weight"))
    out = joins.gather_corners(points, grid, (-180.0, 10.0, 36), (-90.0, 10.0, 18))
    return rounded(out.select("obs_id", F.col("profile")[0].alias("mask")))
