"""The observation lake: overviews, filters, exports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.adapters import OBS_SQL, observations
from nephos.functions.columns import json_number, json_text
from nephos.operators import filters
from nephos.queries.shape import r, rounded
from nephos.registry import register
from nephos.schema import violations
from nephos.sources import exports, obs_files


@register("quantity_counts", f"WITH {OBS_SQL} SELECT instrument, quantity, count(*) AS count FROM obs GROUP BY ALL")
def quantity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_files.quantity_counts(observations(spark, sf_dir))


@register("available_quantities", f"WITH {OBS_SQL} SELECT DISTINCT instrument, quantity, z_type FROM obs")
def available_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_files.available_pairs(observations(spark, sf_dir), with_z_type=True)


@register(
    "file_overview",
    f"""WITH {OBS_SQL} SELECT orig_filename, instrument, min("time") AS start_time, max("time") AS end_time, count(*) AS count, count(model_forecast) AS model_values FROM obs GROUP BY ALL""",
)
def file_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_files.file_overview(observations(spark, sf_dir))


@register(
    "dump_info",
    f"""WITH {OBS_SQL} SELECT count(*) AS n, min("time") AS min_time, max("time") AS max_time, {r("min(latitude) AS min_latitude", "max(latitude) AS max_latitude", "min(longitude) AS min_longitude", "max(longitude) AS max_longitude")}, count(*) FILTER (qc_flag = 0) AS n_good, {r("count(*) FILTER (qc_flag = 0)/CAST(count(*) AS DOUBLE) AS good_ratio")} FROM obs""",
)
def dump_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(obs_files.dump_info(observations(spark, sf_dir)))


@register(
    "value_counts",
    f"""WITH {OBS_SQL} SELECT 'instrument' AS "column", instrument AS value, count(*) AS count FROM obs GROUP BY 2 UNION ALL SELECT 'quantity', quantity, count(*) FROM obs GROUP BY 2
    UNION ALL SELECT 'qc_flag', CAST(qc_flag AS VARCHAR), count(*) FROM obs GROUP BY 2""",
)
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs_files.value_counts(observations(spark, sf_dir))


@register(
    "schema_violations",
    f"""WITH {OBS_SQL}, c AS (SELECT CASE WHEN obs_id % 40 = 0 THEN 'sideways' ELSE z_type END AS z, obs_id % 9 AS m FROM obs)
    SELECT count(*) FILTER (z NOT IN ('surface', 'pressure', 'height', 'model_level', 'columnar')) AS bad_z_type,
    count(*) FILTER (m = 1) AS incomplete_orig_coords, count(*) FILTER (m = 2) AS uneven_orig_coords FROM c""",
)
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, two = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
    m = F.col("obs_id") % 9
    shape = F.when(m == 1, F.lit(None).cast("array<int>")).when(m == 2, two).otherwise(one)
    bad = observations(spark, sf_dir).withColumns(
        {"z_type": F.when(F.col("obs_id") % 40 == 0, "sideways").otherwise(F.col("z_type")), "orig_coords": F.struct(one.alias("indices"), shape.alias("shape"), F.array(F.lit("row")).alias("names"))}
    )
    return violations(bad)


IDS = ("obs_id", "instrument", "quantity")


@register(
    "bbox_time_filter",
    f"""WITH {OBS_SQL} SELECT obs_id, instrument, quantity FROM obs WHERE latitude >= -30 AND latitude <= 45 AND longitude >= -100 AND longitude <= 120
    AND "time" >= TIMESTAMP '2024-01-05 00:00:00' AND "time" <= TIMESTAMP '2024-01-20 12:00:00'""",
)
def bbox_time_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.within(observations(spark, sf_dir), -30, 45, -100, 120, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20, 12)).select(*IDS)


@register(
    "bbox_include_exclude",
    f"""WITH {OBS_SQL} SELECT obs_id, instrument, quantity FROM obs WHERE latitude BETWEEN -60 AND 60 AND longitude BETWEEN -150 AND 150
    AND NOT (latitude BETWEEN 0 AND 20 AND longitude BETWEEN 0 AND 40) AND NOT (latitude BETWEEN -40 AND -10 AND longitude BETWEEN -80 AND -20)""",
)
def bbox_include_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.boxes(observations(spark, sf_dir), (-60, -150, 60, 150), [(0, 0, 20, 40), (-40, -80, -10, -20)]).select(*IDS)


@register(
    "metadata_filter",
    f"""WITH {OBS_SQL} SELECT obs_id, json_extract_string(metadata, '$.k') AS k, CAST(json_extract_string(metadata, '$.k') AS DOUBLE) AS number FROM obs
    WHERE (json_extract_string(metadata, '$.k') IS NULL OR json_extract_string(metadata, '$.k') <> '7') AND (json_extract_string(metadata, '$.none') IS NULL OR json_extract_string(metadata, '$.none') = 'x')""",
)
def metadata_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = observations(spark, sf_dir)
    for text in ("k!=7", "none=x"):
        df = filters.metadata_is(df, *filters.parse_metadata_filter(text))
    return df.select("obs_id", json_text(F.col("metadata"), "k").alias("k"), json_number(F.col("metadata"), "k").alias("number"))


@register(
    "pair_rows",
    f"""WITH {OBS_SQL} SELECT instrument, quantity, "time", round(longitude, 6) AS longitude, round(latitude, 6) AS latitude, z, z_type, round(value, 6) AS value, round(value_uncertainty, 6) AS value_uncertainty, qc_flag,
    round(model_forecast, 6) AS model_forecast, round(model_forecast_spread, 6) AS model_forecast_spread FROM obs
    WHERE instrument = 'click' AND quantity = 'HLOS_WIND' AND model_forecast IS NOT NULL AND qc_flag IN (0, -1) AND "time" >= TIMESTAMP '2024-01-03 00:00:00'
    AND (json_extract_string(metadata, '$.k') IS NULL OR json_extract_string(metadata, '$.k') <> '5')""",
)
def pair_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = obs_files.pair_rows(observations(spark, sf_dir), "click", "HLOS_WIND", start=dt.datetime(2024, 1, 3), metadata=[("k", "!=", "5")])
    return rounded(out)


@register(
    "bad_variance_rule",
    f"""WITH {OBS_SQL}, v AS (SELECT obs_id, qc_flag, CASE WHEN obs_id % 13 = 0 THEN -value_uncertainty ELSE value_uncertainty END AS u FROM obs)
    SELECT obs_id, CASE WHEN u IS NULL OR u <= 0 THEN 99 ELSE qc_flag END AS qc_flag, round(CASE WHEN u < 0 THEN 0 ELSE u END, 6) AS value_uncertainty FROM v""",
)
def bad_variance_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.when(F.col("obs_id") % 13 == 0, -F.col("value_uncertainty")).otherwise(F.col("value_uncertainty"))
    return rounded(filters.bad_variance(observations(spark, sf_dir).withColumn("value_uncertainty", u)).select("obs_id", "qc_flag", "value_uncertainty"))


@register(
    "instrument_pair_filters",
    f"""WITH {OBS_SQL} SELECT instrument, quantity, count(*) AS n FROM obs WHERE instrument IN ('click', 'view', 'purchase') AND NOT (instrument = 'view' AND quantity = 'AOD_550nm')
    AND qc_flag IN (0, -1) AND model_forecast IS NOT NULL GROUP BY ALL""",
)
def instrument_pair_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = filters.without_pairs(filters.instruments(observations(spark, sf_dir), ["click", "view", "purchase"]), ["view.AOD_550nm"])
    df = filters.finite(filters.quality(df, (0, -1)), ["model_forecast"])
    return df.groupBy("instrument", "quantity").agg(F.count(F.lit(1)).alias("n"))


@register(
    "spatial_trim",
    f"""WITH {OBS_SQL}, i AS (SELECT *, latitude BETWEEN -15 AND 15 AND longitude BETWEEN -60 AND 60 AS inside,
      CASE WHEN quantity = 'HLOS_WIND' THEN c_profile ELSE c_bin END AS k FROM obs),
    g AS (SELECT *, bool_or(inside) OVER (PARTITION BY ingest_file, quantity, k) AS any_in FROM i)
    SELECT obs_id, round(CASE WHEN inside THEN value END, 6) AS value, round(CASE WHEN inside THEN value_uncertainty END, 6) AS value_uncertainty FROM g WHERE any_in""",
)
def spatial_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AOD rows lie on a 20-by-24 array, winds on a 24-by-20 one, so groups run along different dimensions."""
    wind = F.col("quantity") == "HLOS_WIND"
    shape = F.when(wind, F.array(F.lit(1000), F.lit(24))).otherwise(F.array(F.lit(20), F.lit(24)))
    inside = filters.in_box((-15, -60, 15, 60))
    out = filters.trim_groups(observations(spark, sf_dir), inside, F.array("c_profile", "c_bin"), shape)
    return rounded(out.select("obs_id", "value", "value_uncertainty"))


@register(
    "away_from_edges",
    f"""WITH {OBS_SQL}, d AS (SELECT *, least(x - 100000, 3500000 - x, y - 100000, 1700000 - y)/1000000 AS depth FROM obs WHERE x BETWEEN 100000 AND 3500000 AND y BETWEEN 100000 AND 1700000)
    SELECT obs_id, round(value_uncertainty*(1 + 2*(1 - least(depth, 1))), 6) AS value_uncertainty FROM d""",
)
def away_from_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One grid point of 100 km is cut from every side; errors grow to three times over the next ten."""
    out = filters.away_from_edges(observations(spark, sf_dir), (0.0, 3_600_000.0), (0.0, 1_800_000.0), 100_000.0, 1, 3, 10)
    return rounded(out.select("obs_id", "value_uncertainty"))


@register(
    "filter_input_rows",
    f"""WITH {OBS_SQL} SELECT CASE WHEN quantity = 'AOD_550nm' THEN 'AIRSENSE_AOD' ELSE quantity END AS obs_type,
    round(CASE WHEN longitude + 360 >= 360 THEN longitude ELSE longitude + 360 END, 6) AS longitude, round(latitude, 6) AS latitude, z AS vert,
    CAST(year("time") AS INT) AS year, CAST(month("time") AS INT) AS month, CAST(day("time") AS INT) AS day, CAST(hour("time") AS INT) AS hour, CAST(minute("time") AS INT) AS minute, CAST(second("time") AS INT) AS second,
    round(value, 6) AS obs_value, round(value_uncertainty, 6) AS obs_error, 'k=' || json_extract_string(metadata, '$.k') AS obs_meta FROM obs WHERE value IS NOT NULL""",
)
def filter_input_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(exports.filter_rows(observations(spark, sf_dir)))


@register(
    "observation_sql",
    f"""WITH {OBS_SQL} SELECT instrument, quantity, count(*) AS n, {r("avg(value) AS mean_value", "min(value) AS min_value", "max(value) AS max_value")}
    FROM obs WHERE qc_flag = 0 GROUP BY instrument, quantity""",
)
def observation_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL over the table's view."""
    observations(spark, sf_dir).createOrReplaceTempView("observations")
    return spark.sql(
        """SELECT instrument, quantity, count(*) AS n, round(avg(value), 6) AS mean_value, round(min(value), 6) AS min_value, round(max(value), 6) AS max_value
        FROM observations WHERE qc_flag = 0 GROUP BY instrument, quantity"""
    )


@register("store_roundtrip", f"WITH {OBS_SQL} SELECT ingest_file, count(*) AS n, round(sum(CASE WHEN ingest_file = 'file1' THEN 2*value ELSE value END), 3) AS total FROM obs WHERE ingest_file <> 'file3' GROUP BY 1")
def store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add all files, add one again with other values, delete one: what the store then holds."""
    import uuid

    from nephos.session import shared_dir
    from nephos.sources.store import ObservationStore

    coords = F.struct(F.array("c_profile", "c_bin").alias("indices"), F.array(F.lit(1000), F.lit(24)).alias("shape"), F.array(F.lit("profile"), F.lit("bin")).alias("names"))
    obs = observations(spark, sf_dir).withColumns({"orig_coords": coords, "time": F.col("time").cast("timestamp")}).drop("c_profile", "c_bin")
    store = ObservationStore(spark, f"{shared_dir(spark)}/nephos/store-{uuid.uuid4().hex}")
    store.add(obs)
    store.add(obs.where("ingest_file = 'file1'").withColumn("value", F.col("value") * 2))
    store.delete("file3")
    return store.read().groupBy("ingest_file").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total"))
