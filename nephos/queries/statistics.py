"""Validation statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.adapters import CALENDAR_SQL, OBS_SQL, cycle_calendar, observations, table
from nephos.operators import cycles, diagnostics, validation
from nephos.operators.joins import in_windows
from nephos.queries.shape import normal_sql, r, rounded
from nephos.registry import register

DEP_SQL = f"""{OBS_SQL}, dep AS (SELECT *, value - model_forecast AS departure,
  (value - model_forecast IS NOT NULL AND value_uncertainty IS NOT NULL) AS known,
  (value - model_forecast IS NOT NULL AND value_uncertainty IS NOT NULL
   AND model_forecast_spread*model_forecast_spread + value_uncertainty*value_uncertainty > 0) AS valid FROM obs)"""
STATS_SQL = (
    "count(departure) AS count, "
    + r(
        "avg(departure) AS bias",
        "stddev_samp(departure) AS std",
        "sqrt(avg(departure*departure)) AS rmse",
        "min(departure) AS min",
        "max(departure) AS max",
        "quantile_cont(departure, 0.25) AS q25",
        "quantile_cont(departure, 0.5) AS median",
        "quantile_cont(departure, 0.75) AS q75",
        "avg(CASE WHEN valid THEN departure/sqrt(model_forecast_spread*model_forecast_spread + value_uncertainty*value_uncertainty) END) AS norm_bias",
        "stddev_samp(CASE WHEN valid THEN departure/sqrt(model_forecast_spread*model_forecast_spread + value_uncertainty*value_uncertainty) END) AS norm_std",
        "avg(CASE WHEN valid THEN model_forecast_spread/nullif(value_uncertainty, 0) END) AS spread_to_obserr_ratio",
        "var_samp(CASE WHEN known THEN departure END) - avg(CASE WHEN known THEN model_forecast_spread*model_forecast_spread END) AS r_est",
    )
)


@register("first_departures", f"WITH {DEP_SQL} SELECT instrument, quantity, {STATS_SQL} FROM dep GROUP BY instrument, quantity")
def first_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validation.first_departures(observations(spark, sf_dir)))


EDGES, LABELS = (0.0, 10.0, 50.0, 100.0, 400.0), ("low", "middle", "high", "extreme")


@register(
    "regime_stats",
    f"""WITH {DEP_SQL}, reg AS (SELECT *, CAST(0.5 AS DOUBLE)*(model_forecast + value) AS m FROM dep),
    cut AS (SELECT *, CASE WHEN m > 0 AND m <= 10 THEN 'low' WHEN m > 10 AND m <= 50 THEN 'middle'
      WHEN m > 50 AND m <= 100 THEN 'high' WHEN m > 100 AND m <= 400 THEN 'extreme' END AS regime FROM reg)
    SELECT instrument, quantity, regime, {STATS_SQL} FROM cut WHERE regime IS NOT NULL GROUP BY ALL""",
)
def regime_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validation.by_regime(observations(spark, sf_dir), EDGES, LABELS))


@register(
    "spatial_bins",
    f"""WITH {DEP_SQL} SELECT instrument, quantity, floor(latitude/10)*10 AS lat_bin, floor(longitude/10)*10 AS lon_bin,
    {r("avg(departure) AS mean", "stddev_samp(departure) AS std")}, count(departure) AS count
    FROM dep GROUP BY ALL HAVING stddev_samp(departure) IS NOT NULL""",
)
def spatial_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validation.spatial_bins(observations(spark, sf_dir), 10.0))


@register(
    "hourly_resample",
    f"""WITH {DEP_SQL}, h AS (SELECT instrument, quantity, date_trunc('hour', "time") AS hour, avg(departure) AS mean,
      stddev_samp(departure) AS std, count(departure) AS count FROM dep GROUP BY ALL),
    spine AS (SELECT instrument, quantity, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM h GROUP BY instrument, quantity)
    SELECT s.instrument, s.quantity, s.hour, {r("h.mean AS mean", "h.std AS std")}, coalesce(h.count, 0) AS count
    FROM spine s LEFT JOIN h USING (instrument, quantity, hour)""",
)
def hourly_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validation.hourly(observations(spark, sf_dir)))


@register(
    "departure_histogram",
    f"""WITH {DEP_SQL}, lim AS (SELECT instrument, quantity, min(departure) AS lo, max(departure) AS hi, count(*) AS n FROM dep WHERE departure IS NOT NULL GROUP BY ALL),
    b AS (SELECT d.instrument, d.quantity, CAST(least(floor((departure-lo)*50/(hi-lo)), 49) AS INT) AS bin, lo, hi, n, count(*) AS count
      FROM dep d JOIN lim USING (instrument, quantity) WHERE departure IS NOT NULL GROUP BY ALL)
    SELECT instrument, quantity, bin, {r("lo + bin*((hi-lo)/50) AS left_edge")}, count, {r("count/(n*((hi-lo)/50)) AS density")} FROM b""",
)
def departure_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validation.histogram(observations(spark, sf_dir)))


@register(
    "kde_curve",
    f"""WITH {DEP_SQL}, w AS (SELECT instrument, quantity, min(departure) AS lo, max(departure) AS hi, stddev_samp(departure)*pow(count(*), CAST(-0.2 AS DOUBLE)) AS h, count(*) AS n
      FROM dep WHERE departure IS NOT NULL GROUP BY ALL),
    p AS (SELECT instrument, quantity, lo + (hi - lo)*k/199 AS px FROM w, range(200) r(k))
    SELECT p.instrument, p.quantity, round(px, 6) AS x, round(sum(exp(-(px - departure)*(px - departure)/(2*h*h)))/(any_value(n)*any_value(h)*sqrt(2*pi())), 5) AS density
    FROM p JOIN w USING (instrument, quantity) JOIN dep d ON d.instrument = p.instrument AND d.quantity = p.quantity AND departure IS NOT NULL GROUP BY p.instrument, p.quantity, px""",
)
def kde_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against the kernel sum over every row, to five digits."""
    curve = validation.density_curve(observations(spark, sf_dir))
    return rounded(curve.withColumn("density", F.round("density", 5)))


@register(
    "height_bins",
    f"""WITH {DEP_SQL}, lim AS (SELECT instrument, quantity, min(z) AS lo, max(z) AS hi FROM dep GROUP BY ALL)
    SELECT d.instrument, d.quantity, CAST(least(greatest(ceil((z-lo)*70/(hi-lo)) - 1, 0), 69) AS INT) AS z_bin,
    {r("avg(departure) AS mean")}, count(departure) AS count FROM dep d JOIN lim USING (instrument, quantity) GROUP BY ALL""",
)
def height_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validation.height_bins(observations(spark, sf_dir)))


@register(
    "percentile_ranges",
    f"""WITH {OBS_SQL} SELECT instrument, quantity, {r(
        "quantile_cont(value, 0.02) AS p_low", "quantile_cont(value, 0.98) AS p_high", "quantile_cont(abs(value), 0.98) AS abs_high",
        "min(value) - CAST(0.05 AS DOUBLE)*(max(value)-min(value)) AS limit_low", "max(value) + CAST(0.05 AS DOUBLE)*(max(value)-min(value)) AS limit_high",
    )} FROM obs GROUP BY ALL""",
)
def percentile_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validation.value_ranges(observations(spark, sf_dir)))


@register(
    "exact_quantiles",
    f"""WITH {OBS_SQL} SELECT instrument, quantity, p, round(CASE WHEN p = 0.01 THEN quantile_cont(value, 0.01) WHEN p = 0.5 THEN quantile_cont(value, 0.5)
      ELSE quantile_cont(value, 0.99) END, 6) AS quantile
    FROM obs, (SELECT CAST(unnest([0.01, 0.5, 0.99]) AS DOUBLE) AS p) WHERE value IS NOT NULL GROUP BY instrument, quantity, p""",
)
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validation.exact_quantiles(observations(spark, sf_dir), "value", [0.01, 0.5, 0.99], validation.PAIR))


CORRELATED = ("value", "model_forecast", "model_analysis", "value_uncertainty", "model_forecast_spread", "model_analysis_spread")


@register(
    "correlation_matrix",
    f"WITH {OBS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, " + ("CAST(1.0 AS DOUBLE) AS r" if a == b else f"{r(f'corr({a}, {b}) AS r')} FROM obs") for a in CORRELATED for b in CORRELATED
    ),
)
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validation.correlations(observations(spark, sf_dir), CORRELATED))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as filter diagnostics: the first number is the observation, 32 others are members."""
    df = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding")[0].cast("double").alias("obs"), F.lit(0.25).alias("obs_variance"), F.transform(F.slice("embedding", 2, 32), lambda x: x.cast("double")).alias("prior")
    )
    return diagnostics.with_array_stats(df, "prior", "prior")


MEMBERS_SQL = """m AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS obs, [CAST(x AS DOUBLE) FOR x IN embedding[2:33]] AS prior FROM embeddings),
  d AS (SELECT *, list_avg(prior) AS prior_mean, list_stddev_samp(prior) AS prior_spread FROM m)"""


@register(
    "rank_histogram",
    f"""WITH {MEMBERS_SQL}, k AS (SELECT len(list_filter(prior, lambda x: x < obs)) AS rank FROM d), c AS (SELECT rank, count(*) AS n FROM k GROUP BY rank),
    t AS (SELECT count(*) AS n FROM d)
    SELECT CAST(s.rank AS INT) AS rank, coalesce(c.n, 0) AS count,
    {r("t.n * (1/CAST(33 AS DOUBLE)) AS expected", "t.n*(1/CAST(33 AS DOUBLE)) - 1.96*sqrt(t.n*(1/CAST(33 AS DOUBLE))*(1-1/CAST(33 AS DOUBLE))) AS low",
       "t.n*(1/CAST(33 AS DOUBLE)) + 1.96*sqrt(t.n*(1/CAST(33 AS DOUBLE))*(1-1/CAST(33 AS DOUBLE))) AS high")}
    FROM range(33) s(rank) LEFT JOIN c ON s.rank = c.rank, t""",
)
def rank_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(diagnostics.rank_histogram(members(spark, sf_dir)))


@register(
    "rank_diagnostics",
    f"""WITH {MEMBERS_SQL}, i AS (SELECT *, obs - prior_mean AS inn, (obs - prior_mean)/sqrt(prior_spread*prior_spread + 0.25) AS norm FROM d)
    SELECT count(*) AS n_obs, CAST(max(len(prior)) AS INT) AS n_ensemble, {r("avg(inn) AS innovation_mean", "stddev_pop(inn) AS innovation_std",
      "avg(norm) AS normalized_innov_mean", "stddev_pop(norm) AS normalized_innov_std", "corr(obs, prior_mean) AS correlation", "sqrt(avg(inn*inn)) AS rmse")} FROM i""",
)
def rank_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(diagnostics.rank_diagnostics(members(spark, sf_dir)))


@register(
    "rank_histogram_dithered",
    f"""WITH {MEMBERS_SQL}, n AS (SELECT *, obs + {normal_sql("vec_id", 3)}*sqrt(0.25) AS noisy FROM d),
    k AS (SELECT len(list_filter(prior, lambda x: x < noisy)) AS rank FROM n), c AS (SELECT rank, count(*) AS n FROM k GROUP BY rank), t AS (SELECT count(*) AS n FROM d)
    SELECT CAST(s.rank AS INT) AS rank, coalesce(c.n, 0) AS count,
    {r("t.n * (1/CAST(33 AS DOUBLE)) AS expected", "t.n*(1/CAST(33 AS DOUBLE)) - 1.96*sqrt(t.n*(1/CAST(33 AS DOUBLE))*(1-1/CAST(33 AS DOUBLE))) AS low",
       "t.n*(1/CAST(33 AS DOUBLE)) + 1.96*sqrt(t.n*(1/CAST(33 AS DOUBLE))*(1-1/CAST(33 AS DOUBLE))) AS high")}
    FROM range(33) s(rank) LEFT JOIN c ON s.rank = c.rank, t""",
)
def rank_histogram_dithered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(diagnostics.rank_histogram(members(spark, sf_dir), seed=3, key="vec_id"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as member runs."""
    k = F.col("o_orderkey")
    secs = (60 + k % 541).cast("int")
    return table(spark, sf_dir, "orders").select(
        (k % 40).cast("int").alias("cycle"),
        (F.floor(k / 40) % 20).cast("int").alias("member"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=secs.cast("decimal(18,6)"))).alias("end_time"),
        secs.alias("duration_s"),
        k.alias("run_id"),
    )


RUNS_SQL = """runs AS (SELECT CAST(o_orderkey % 40 AS INT) AS cycle, CAST((o_orderkey // 40) % 20 AS INT) AS member, o_orderdate AS start_time,
  o_orderdate + to_seconds(60 + o_orderkey % 541) AS end_time, CAST(60 + o_orderkey % 541 AS INT) AS duration_s, o_orderkey AS run_id FROM orders)"""


@register(
    "runtime_stats",
    f"""WITH {RUNS_SQL} SELECT cycle, member, CASE WHEN grouping(cycle) = 0 THEN 'cycle' WHEN grouping(member) = 0 THEN 'member' ELSE 'all' END AS level, count(*) AS n,
    {r("avg(duration_s/60.0::DOUBLE) AS mean_min", "min(duration_s/60.0::DOUBLE) AS min_min", "max(duration_s/60.0::DOUBLE) AS max_min", "stddev_pop(duration_s/60.0::DOUBLE) AS std_min",
       "(epoch_us(max(end_time)) - epoch_us(min(start_time)))/60e6 AS wall_min", "sum(duration_s/60.0::DOUBLE) AS total_min")}
    FROM runs GROUP BY GROUPING SETS ((cycle), (member), ())""",
)
def runtime_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cycles.runtime_stats(runs(spark, sf_dir)))


@register(
    "cycle_delta_lag",
    f"""WITH {RUNS_SQL}, m AS (SELECT member, cycle, max(duration_s) AS duration_s FROM runs GROUP BY ALL)
    SELECT member, cycle, duration_s, lag(duration_s) OVER w AS previous_s, duration_s - lag(duration_s) OVER w AS change_s FROM m WINDOW w AS (PARTITION BY member ORDER BY cycle)""",
)
def cycle_delta_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    longest = runs(spark, sf_dir).groupBy("member", "cycle").agg(F.max("duration_s").alias("duration_s"))
    return cycles.runtime_change(longest)


@register(
    "cycle_calendar",
    """WITH e AS (SELECT min(date_trunc('day', ts)) AS first, max(ts) AS last FROM events),
    s AS (SELECT i, CASE WHEN i = 3 THEN 720 ELSE 360 END AS minutes, first, last FROM range(400) t(i), e),
    w AS (SELECT i, first + to_minutes(CAST(sum(minutes) OVER (ORDER BY i) - minutes AS BIGINT)) AS start_time, minutes, last FROM s),
    c AS (SELECT CAST(i AS INT) AS cycle_index, start_time, least(start_time + to_minutes(minutes), last) AS end_time FROM w WHERE start_time < last)
    SELECT cycle_index, start_time, end_time, (SELECT count(*) FROM events WHERE ts >= start_time AND ts < end_time) + CASE WHEN end_time = (SELECT max(ts) FROM events) THEN (SELECT count(*) FROM events WHERE ts = end_time) ELSE 0 END AS n FROM c""",
)
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour cycles over the span of all events, one of twelve hours, the last cut off at the end, and the events in each."""
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.date_trunc("day", F.min("ts")), F.max("ts")).first()
    plan = cycles.Calendar(first.replace(tzinfo=None), last.replace(tzinfo=None), 360, options={3: cycles.CycleOptions(duration=720)}).frame(spark)
    held = in_windows(events.select("ts"), plan, "ts", "start_time", "end_time").where((F.col("ts") < F.col("end_time")) | (F.col("end_time") == F.lit(last)))
    counts = held.groupBy("cycle_index").agg(F.count(F.lit(1)).alias("n"))
    return plan.join(counts, "cycle_index", "left").withColumn("n", F.coalesce("n", F.lit(0)))


WINDOW_SQL = f"{OBS_SQL}, {CALENDAR_SQL}, win AS (SELECT *, end_time - INTERVAL 90 MINUTE AS window_start, end_time + INTERVAL 90 MINUTE AS window_end FROM cycles)"
USED = ("click", "view")


@register(
    "cycle_summary",
    f"""WITH {WINDOW_SQL} SELECT c.cycle_index, c.start_time, c.end_time,
    (SELECT count(*) FROM obs o WHERE o."time" BETWEEN c.start_time AND c.end_time) AS total,
    (SELECT count(*) FROM obs o WHERE o."time" BETWEEN c.window_start AND c.window_end AND qc_flag = 0 AND instrument IN ('click', 'view')) AS in_window FROM win c""",
)
def cycle_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.summary(cycle_calendar(spark), observations(spark, sf_dir), 90, USED)


@register(
    "cycle_file_info",
    f"""WITH {WINDOW_SQL} SELECT cycle_index, instrument, orig_filename, count(*) AS total, count(*) FILTER (qc_flag = 0 AND instrument IN ('click', 'view')) AS assimilated,
    {r("count(*) FILTER (qc_flag = 0 AND instrument IN ('click', 'view'))*100.0::DOUBLE/count(*) AS percent")}
    FROM win JOIN obs ON obs."time" BETWEEN window_start AND window_end GROUP BY ALL""",
)
def cycle_file_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cycles.file_info(cycle_calendar(spark), observations(spark, sf_dir), 90, USED))


@register(
    "cycle_observations_inflated",
    f"""WITH {WINDOW_SQL}, f AS (SELECT 'click' AS instrument, 'AOD_550nm' AS quantity, CAST(1.5 AS DOUBLE) AS factor UNION ALL SELECT 'view', 'HLOS_WIND', 2.0)
    SELECT cycle_index, obs_id, CASE WHEN value_uncertainty IS NULL OR value_uncertainty <= 0 THEN 99 ELSE qc_flag END AS qc_flag,
    {r("(CASE WHEN value_uncertainty < 0 THEN 0 ELSE value_uncertainty END)*coalesce(factor, 1) AS value_uncertainty", "coalesce(factor, 1) AS factor")}
    FROM win JOIN obs ON obs."time" BETWEEN window_start AND window_end LEFT JOIN f USING (instrument, quantity) WHERE instrument IN ('click', 'view')""",
)
def cycle_observations_inflated(spark: SparkSession, sf_dir: str) -> DataFrame:
    factors = spark.createDataFrame([("click", "AOD_550nm", 1.5), ("view", "HLOS_WIND", 2.0)], "instrument string, quantity string, factor double")
    rows = cycles.observations_for_cycles(cycle_calendar(spark), observations(spark, sf_dir), 90, USED, factors)
    return rounded(rows.select("cycle_index", "obs_id", "qc_flag", "value_uncertainty", "factor"))
