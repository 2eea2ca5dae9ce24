"""Files in and out, the store, settings, the ledger and the commands around them.

What a query writes goes to a folder of its own in the shared storage; settings and
the ledger are files that only the driver reads, in a folder that goes at once.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos import api, sql
from nephos.adapters import CALENDAR_SQL, GRID_SQL, OBS_SQL, cycle_calendar, ensemble_grid, model_frames, observations, table
from nephos.functions.columns import metadata_values, micros
from nephos.functions.projection import LambertConformal
from nephos.operators import ensemble, filters, superobs
from nephos.plans import processors, workflow
from nephos.plans.interpolation import interpolate_model
from nephos.plans.observation_operators import QUANTITIES
from nephos.queries.gridded import FRAMES_SQL
from nephos.queries.products import CELL_SQL, seen, seen_sql
from nephos.queries.shape import r, rounded
from nephos.queries.statistics import DEP_SQL, EDGES, LABELS, STATS_SQL
from nephos.registry import fixed, register
from nephos.session import shared_path, write_shared
from nephos.sources import classic, netcdf, obs_files, settings, store, swaths
from nephos.sources.converters import aeronet
from nephos.streaming import live


def scratch(spark: SparkSession, label: str) -> str:
    return shared_path(spark, f"{label}-{uuid.uuid4().hex}")


def put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file in the shared storage."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(p)
    out.write(bytearray(data))
    out.close()


def whole_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with the columns of an observation file."""
    coords = F.struct(F.array("c_profile", "c_bin").alias("indices"), F.array(F.lit(5000), F.lit(24)).alias("shape"), F.array(F.lit("profile"), F.lit("bin")).alias("names"))
    return observations(spark, sf_dir).withColumns({"orig_coords": coords, "time": F.col("time").cast("timestamp")}).drop("c_profile", "c_bin")


def two_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Observation files of two groups of instruments; the second group's metadata is empty text."""
    rows, folder = whole_rows(spark, sf_dir).drop("x", "y", "obs_id", "ingest_file", "model_forecast", "model_analysis", "model_forecast_spread", "model_analysis_spread"), scratch(spark, "obs-files")
    seen_first = F.col("instrument").isin("click", "view")
    obs_files.write_obs(rows.where(seen_first).coalesce(1), f"{folder}/a")
    obs_files.write_obs(rows.where(~seen_first).withColumn("metadata", F.lit("")).coalesce(1), f"{folder}/b")
    return f"{folder}/a", f"{folder}/b"


@register(
    "obs_files_roundtrip",
    f"""WITH {OBS_SQL} SELECT instrument, quantity, count(*) AS n, count(DISTINCT z_type) AS z_types, count(CASE WHEN instrument IN ('click', 'view') THEN metadata END) AS n_metadata,
    round(sum(value), 3) AS total, max(c_profile) AS last_profile, max("time") AS last_time FROM obs GROUP BY ALL""",
)
def obs_files_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write two observation files, join and read them: empty metadata comes back as null."""
    df = obs_files.join_files(spark, two_files(spark, sf_dir))
    return df.groupBy("instrument", "quantity").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("z_type").alias("z_types"), F.count("metadata").alias("n_metadata"), F.round(F.sum("value"), 3).alias("total"),
        F.max(F.get("orig_coords.indices", F.lit(0))).alias("last_profile"), F.max("time").cast("timestamp_ntz").alias("last_time"),
    )


START, END = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20, 12)
DOMAIN = api.Domain(LambertConformal(30.0, 60.0, 45.0, 0.0), (-1e12, 1e12), (-1e12, 1e12), START, END)


@register(
    "bulk_add",
    f"""WITH {OBS_SQL}, t AS (SELECT * FROM obs WHERE "time" BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00' AND instrument IN ('click', 'view') AND NOT (instrument = 'view' AND quantity = 'AOD_550nm')),
    g AS (SELECT *, bool_or(latitude > -90) OVER (PARTITION BY quantity, c_profile) AS any_in FROM t)
    SELECT instrument, quantity, count(*) AS n, count(*) AS n_placed, count(*) - count(*) AS n_model, round(sum(CASE WHEN latitude > -90 THEN value END), 3) AS total FROM g WHERE any_in GROUP BY ALL""",
)
def bulk_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add two folders, cut to the experiment's time (the south pole has no place on the map); then the second again with all its pairs ignored: its rows go."""
    a, b = two_files(spark, sf_dir)
    table_ = store.ObservationStore(spark, f"{scratch(spark, 'store')}/table")
    api.add_observations(spark, table_, [a, b], DOMAIN, ["view.AOD_550nm"])
    pairs = [f"{i}.{q}" for i in ("error", "purchase", "signup") for q in ("AOD_550nm", "HLOS_WIND")]
    api.add_observations(spark, table_, [b], DOMAIN, pairs)
    out = table_.read().groupBy("instrument", "quantity")
    return out.agg(F.count(F.lit(1)).alias("n"), F.count("x").alias("n_placed"), F.count("model_forecast").alias("n_model"), F.round(F.sum("value"), 3).alias("total"))


@register(
    "store_names",
    f"""WITH {OBS_SQL} SELECT 'kept' AS what, count(*) AS n FROM obs WHERE ingest_file <> 'file1' UNION ALL SELECT 'deleted', 1 UNION ALL SELECT 'again', 0
    UNION ALL SELECT 'raw1', count(*) FROM obs WHERE ingest_file <> 'file1' AND orig_filename = 'raw1' UNION ALL SELECT 'nowhere', 0""",
)
def store_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose names hold colons, percent signs and blanks are found and deleted by name."""
    table_ = store.ObservationStore(spark, f"{scratch(spark, 'store')}/table")
    table_.add(whole_rows(spark, sf_dir).withColumn("ingest_file", F.concat(F.lit("12:00 50% "), "ingest_file")))
    deleted, again = table_.delete("12:00 50% file1"), table_.delete("12:00 50% file1")
    raw, nowhere = table_.find("raw1"), table_.find("nowhere")
    rows = [("kept", table_.read().count()), ("deleted", int(deleted)), ("again", int(again)), ("raw1", 0 if raw is None else raw.count()), ("nowhere", 0 if nowhere is None else 1)]
    return spark.createDataFrame(rows, "what string, n bigint")


@fixed(
    "typed_table",
    """SELECT * FROM (VALUES ('obs_id', 'bigint'), ('instrument', 'string'), ('quantity', 'string'), ('time', 'timestamp'), ('longitude', 'double'), ('latitude', 'double'), ('z', 'double'), ('z_type', 'string'),
    ('value', 'double'), ('value_uncertainty', 'double'), ('qc_flag', 'int'), ('orig_coords', 'struct<indices:array<int>,shape:array<int>,names:array<string>>'), ('orig_filename', 'string'), ('metadata', 'string'),
    ('x', 'double'), ('y', 'double'), ('model_forecast', 'double'), ('model_analysis', 'double'), ('model_forecast_spread', 'double'), ('model_analysis_spread', 'double'), ('ingest_file', 'string')) t(name, type)""",
)
def typed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a table that a file of rows has made."""
    table_ = store.ObservationStore(spark, f"{scratch(spark, 'store')}/table")
    table_.add(whole_rows(spark, sf_dir))
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in table_.read().schema.fields], "name string, type string")


@register(
    "chunked_update",
    f"""WITH {OBS_SQL} SELECT instrument, count(*) AS n, count(CASE WHEN quantity = 'AOD_550nm' OR instrument = 'view' THEN 1 END) AS n_model,
    round(sum(CASE WHEN quantity = 'AOD_550nm' THEN 2*z WHEN instrument = 'view' THEN 3*z END), 3) AS total FROM obs GROUP BY ALL""",
)
def chunked_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first chunk of model values clears the column, later ones add to it."""
    rows = whole_rows(spark, sf_dir)
    table_ = store.ObservationStore(spark, f"{scratch(spark, 'store')}/table")
    table_.add(rows)
    first = F.col("quantity") == "AOD_550nm"
    table_.update(rows.where(first).select("obs_id", (F.col("z") * 2).alias("value")), "model_forecast", clear=True)
    table_.update(rows.where(~first & (F.col("instrument") == "view")).select("obs_id", (F.col("z") * 3).alias("value")), "model_forecast")
    return table_.read().groupBy("instrument").agg(F.count(F.lit(1)).alias("n"), F.count("model_forecast").alias("n_model"), F.round(F.sum("model_forecast"), 3).alias("total"))


#: Counts and sums over the columns of whole rows but the forecast, one at least for each, in words of both engines.
WHOLE_COUNTS = [
    "count(CASE WHEN quantity = 'AOD_550nm' THEN 1 END) AS n_aod", "count(CASE WHEN z_type = 'height' THEN 1 END) AS n_heights",
    "count(CASE WHEN orig_filename = 'raw1' THEN 1 END) AS n_raw1", "count(CASE WHEN ingest_file = 'file1' THEN 1 END) AS n_file1",
    *[f"CAST(sum({x}) AS BIGINT) AS {name}" for x, name in (("obs_id", "ids"), ("qc_flag", "n_flagged"), ("length(metadata)", "n_metadata_chars"), ("c_profile", "profiles"), ("c_bin", "bins"), ("seconds", "seconds"))],
]
#: Whole numbers, and ten-thousandths as such, add up to the same in any order.
WHOLE_SUMS = [*[f"sum({c}) AS total_{c}" for c in ("x", "y", "z")], *[f"sum(round({c}*10000))/10000 AS total_{c}" for c in ("longitude", "latitude", "value", "value_uncertainty", "model_analysis", "model_forecast_spread", "model_analysis_spread")]]
TOTAL_BEFORE = "sum(round(model_forecast*10000))/10000 AS total_before"


@register(
    "store_commits",
    f"""WITH {OBS_SQL}, m AS (SELECT *, floor(epoch_us("time")/1000000) AS seconds, CASE WHEN ingest_file = 'file2' THEN 5*z WHEN quantity = 'AOD_550nm' AND z < 9000 THEN 4*z WHEN quantity = 'AOD_550nm' THEN 2*z WHEN instrument = 'view' THEN 3*z END AS m FROM obs WHERE ingest_file <> 'file3'),
    now AS (SELECT instrument, count(*) AS n, count(m) AS n_model, round(sum(m), 3) AS total, max("time") AS last_time, count(*) AS n_shaped, {", ".join([*WHOLE_COUNTS, *WHOLE_SUMS])} FROM m GROUP BY 1),
    first AS (SELECT instrument AS i, count(*) AS n_before, count(model_forecast) AS n_model_before, {TOTAL_BEFORE} FROM obs GROUP BY 1)
    SELECT now.*, n_before, n_model_before, total_before, 1 AS conflict, 1 AS small_deltas, 1 AS same_compacted FROM now JOIN first ON instrument IS NOT DISTINCT FROM i""",
)
def store_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three chunks of model values from two writers, one of them behind, a file that both replace, one deleted, a compaction, and a reader of the first version.

    The rows left in the end are summed over all their columns, as is the forecast that they had in the first version.
    """
    rows = whole_rows(spark, sf_dir)
    table_ = store.ObservationStore(spark, f"{scratch(spark, 'store')}/table")
    first = table_.add(rows)
    other = store.ObservationStore(spark, table_.path)
    behind = other.snapshot()
    aod = F.col("quantity") == "AOD_550nm"
    table_.update(rows.where(aod).select("obs_id", (F.col("z") * 2).alias("value")), "model_forecast", clear=True)
    other.update(rows.where(~aod & (F.col("instrument") == "view")).select("obs_id", (F.col("z") * 3).alias("value")), "model_forecast", base=behind)
    table_.update(rows.where(aod & (F.col("z") < 9000)).select("obs_id", (F.col("z") * 4).alias("value")), "model_forecast")
    small_deltas = table_.delta_bytes() < 25 * 3 * rows.count()
    again = rows.where("ingest_file = 'file2'").withColumn("model_forecast", F.col("z") * 5)
    table_.add(again)
    try:
        table_.add(again, base=behind)
        conflict = 0
    except store.Conflict:
        conflict = 1
    table_.delete("file3")
    figures = [F.count(F.lit(1)).alias("n"), F.count("model_forecast").alias("n_model"), F.round(F.sum("model_forecast"), 3).alias("total")]
    uncompacted = table_.read().groupBy("instrument").agg(*figures)
    table_.compact()
    coords = F.col("orig_coords")
    shaped = (coords["shape"] == F.array(F.lit(5000), F.lit(24))) & (coords["names"] == F.array(F.lit("profile"), F.lit("bin")))
    flat = table_.read().withColumns({"c_profile": F.get(coords["indices"], F.lit(0)), "c_bin": F.get(coords["indices"], F.lit(1)), "seconds": F.floor(micros(F.col("time")) / 1_000_000)})
    whole = [F.max("time").cast("timestamp_ntz").alias("last_time"), F.count_if(shaped).alias("n_shaped"), *[F.expr(x) for x in (*WHOLE_COUNTS, *WHOLE_SUMS)]]
    compacted = write_shared(flat.groupBy("instrument").agg(*figures, *whole), "compacted")
    before = table_.read(first).groupBy(F.col("instrument").alias("i")).agg(F.count(F.lit(1)).alias("n_before"), F.count("model_forecast").alias("n_model_before"), F.expr(TOTAL_BEFORE))
    same = int(uncompacted.exceptAll(compacted.select(uncompacted.columns)).isEmpty() and not table_.snapshot().deltas)
    out = compacted.join(before, F.col("instrument").eqNullSafe(F.col("i"))).drop("i")
    return out.withColumns({"conflict": F.lit(conflict), "small_deltas": F.lit(int(small_deltas)), "same_compacted": F.lit(same)})


@register(
    "store_skipping",
    f"""WITH {OBS_SQL} SELECT 'box' AS what, instrument, count(*) AS n, round(sum(value), 3) AS total, 1 AS skipped FROM obs
      WHERE "time" BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-07 12:00:00' AND latitude BETWEEN 10 AND 50 AND longitude BETWEEN -20 AND 60 GROUP BY 2
    UNION ALL SELECT 'name', instrument, count(*), round(sum(value), 3), 1 FROM obs WHERE orig_filename = 'raw1' AND ingest_file = 'file1' GROUP BY 2""",
)
def store_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a box and a time span, and of one source file, from the files that may hold them: at most half of all."""
    rows = whole_rows(spark, sf_dir)
    # Only one of the ingest files has rows of raw1.
    own = F.col("ingest_file") == "file1"
    named = rows.withColumn("orig_filename", F.when(own, F.col("orig_filename")).otherwise(F.concat(F.lit("x"), F.col("ingest_file"))))
    table_ = store.ObservationStore(spark, f"{scratch(spark, 'store')}/table", rows_per_file=max(10, rows.count() // 100))
    table_.add(named)
    total = table_.files().count()
    asked = {"box": {"start": dt.datetime(2024, 1, 5), "end": dt.datetime(2024, 1, 7, 12), "box": (10.0, -20.0, 50.0, 60.0)}, "name": {"orig_filename": "raw1"}}
    found = []
    for what, by in asked.items():
        part = table_.select(**by).groupBy("instrument").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total"))
        found.append(part.withColumns({"what": F.lit(what), "skipped": F.lit(int(2 * table_.files(**by).count() <= total + 1))}))
    return found[0].unionByName(found[1])


@register(
    "sql_functions",
    f"""WITH {OBS_SQL}, {FRAMES_SQL}, b AS (SELECT *, CAST(floor(c_profile/5.0) AS INT) AS p, CAST(floor(c_bin/4.0) AS INT) AS q FROM obs),
    g AS (SELECT *, max(CASE WHEN qc_flag = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY ingest_file, instrument, quantity, p, q) AS has_good FROM b),
    a AS (SELECT instrument, count(*) AS n, avg(value) AS value, sqrt(avg(value_uncertainty*value_uncertainty))/sqrt(CAST(count(*) AS DOUBLE)) AS ie, CASE WHEN count(*) > 1 THEN stddev_samp(value) ELSE max(value_uncertainty) END AS re
      FROM g WHERE qc_flag = 0 OR has_good = 0 GROUP BY ingest_file, instrument, quantity, p, q),
    w AS (SELECT instrument, CASE WHEN ru = lu THEN 0 ELSE (cu - lu)/CAST(ru - lu AS DOUBLE) END AS weight FROM clip JOIN spans ON cu >= lu AND (cu < ru OR is_last) WHERE us >= lo - 3600000000 AND us <= hi + 3600000000)
    SELECT 'departures' AS what, instrument, count(value - model_forecast) AS n, {r("sum(value - model_forecast) AS total", digits=3)} FROM obs GROUP BY 2
    UNION ALL SELECT 'superobs', instrument, sum(n), {r("sum(value + sqrt(ie*ie + re*re)) AS total", digits=3)} FROM a GROUP BY 2
    UNION ALL SELECT 'brackets', instrument, count(*), {r("sum(weight) AS total", digits=3)} FROM w GROUP BY 2""",
)
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures, superobs and brackets called in one SQL text over the view."""
    frames = model_frames(spark).select("t_idx", "t").distinct()
    sql.register_views(whole_rows(spark, sf_dir), frames)
    sql.register_functions(spark)
    rounded_sum = lambda x: f"CASE WHEN round(sum({x}), 3) = 0 THEN 0D ELSE round(sum({x}), 3) END AS total"
    return spark.sql(
        f"""SELECT 'departures' AS what, instrument, count(departure(value, model_forecast)) AS n, {rounded_sum("departure(value, model_forecast)")} FROM observations GROUP BY instrument
        UNION ALL SELECT 'superobs', instrument, sum(n), {rounded_sum("value + value_uncertainty")} FROM superobs(5, 4) GROUP BY instrument
        UNION ALL SELECT 'brackets', instrument, count(*), {rounded_sum("t_weight")} FROM brackets(3600) JOIN observations USING (obs_id) WHERE valid GROUP BY instrument"""
    )


@register(
    "member_files",
    f"""WITH {OBS_SQL}, m AS (SELECT l_orderkey AS obs_id, CAST(l_linenumber AS INT) AS member, l_quantity AS value FROM lineitem)
    SELECT member, 'forecast' AS source, instrument, count(*) AS n, {r("avg(m.value) AS mean", "avg(o.value) AS obs_mean")} FROM m JOIN obs o USING (obs_id) GROUP BY ALL""",
)
def member_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long member values by source and member, read back beside their observations."""
    path = f"{scratch(spark, 'members')}/table"
    obs = observations(spark, sf_dir)
    m = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("obs_id"), F.lit("forecast").alias("source"), F.col("l_linenumber").cast("int").alias("member"), F.col("l_quantity").alias("value"))
    store.write_members(m.join(obs.select("obs_id", "instrument", "quantity", "time"), "obs_id"), path)
    back = store.with_observations(spark.read.parquet(path), obs, "inner")
    return rounded(back.groupBy("member", "source", "instrument").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.avg("obs_value").alias("obs_mean")))


REPORT_SQL = f"{DEP_SQL}, used AS (SELECT * FROM dep WHERE qc_flag IN (0, -1) AND model_forecast IS NOT NULL)"


@register(
    "report_csv",
    f"""WITH {REPORT_SQL}, reg AS (SELECT *, CAST(0.5 AS DOUBLE)*(model_forecast + value) AS m FROM used),
    cut AS (SELECT *, CASE WHEN m > 0 AND m <= 10 THEN 'low' WHEN m > 10 AND m <= 50 THEN 'middle' WHEN m > 50 AND m <= 100 THEN 'high' WHEN m > 100 AND m <= 400 THEN 'extreme' END AS regime FROM reg)
    SELECT instrument, quantity, 'all' AS regime, {STATS_SQL} FROM used GROUP BY ALL UNION ALL BY NAME SELECT instrument, quantity, regime, {STATS_SQL} FROM cut WHERE regime IS NOT NULL GROUP BY ALL""",
)
def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and regimes written as CSV and read back."""
    path = scratch(spark, "report")
    found = api.analyse_first_departures(observations(spark, sf_dir), path, regimes=(EDGES, LABELS))
    back = lambda name: spark.read.schema(found[name].schema).option("header", True).csv(f"{path}/{name}")
    return rounded(back("statistics").withColumn("regime", F.lit("all")).unionByName(back("regimes")))


@register("requested_pairs", f"WITH {REPORT_SQL} SELECT instrument, quantity, count(departure) AS count FROM used WHERE instrument || '.' || quantity IN ('view.HLOS_WIND', 'click.AOD_550nm') GROUP BY ALL")
def requested_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = api.analyse_first_departures(observations(spark, sf_dir), pairs=["view.HLOS_WIND", "click.AOD_550nm"])
    return out["statistics"].select("instrument", "quantity", "count")


@register(
    "cycle_files_csv",
    f"""WITH {CALENDAR_SQL}, f AS (SELECT event_type AS "group", event_type || '/' || strftime(date_trunc('day', ts), '%Y%m%d') AS path, min(ts) AS s, max(ts) AS e FROM events GROUP BY ALL),
    m AS (SELECT cycle_index, "group", path FROM cycles JOIN f ON s <= end_time + INTERVAL 30 MINUTE AND end_time - INTERVAL 30 MINUTE <= e)
    SELECT CAST(row_number() OVER (ORDER BY cycle_index, "group", path) AS INT) AS line, * FROM m""",
)
def cycle_files_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which files meet which cycle, in the order of the written lines."""
    day = F.date_trunc("day", "ts")
    name = F.concat(F.col("event_type"), F.lit("/"), F.date_format(day, "yyyyMMdd"))
    groups = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("group"), name.alias("path")).agg(F.min("ts").alias("start_date"), F.max("ts").alias("end_date"))
    path = f"{scratch(spark, 'cycle-files')}/csv"
    api.files_of_cycles(groups, cycle_calendar(spark), 30, path)
    from pyspark.sql import Window

    back = spark.read.schema("cycle_index int, `group` string, path string").option("header", True).csv(path)
    return back.withColumn("line", F.row_number().over(Window.orderBy("cycle_index", "group", "path")))


@register(
    "grid_append",
    f"""WITH {GRID_SQL}, s AS (SELECT var, t_idx, ix, iy, iz, count(value) AS n, CAST(avg(value) AS FLOAT) AS mean, CAST(stddev_samp(value) AS FLOAT) AS sd FROM grid GROUP BY ALL)
    SELECT var, t_idx, count(*) AS n, count(sd) AS n_sd, round(sum(CAST(mean AS DOUBLE)), 3) AS total, 1 AS refused FROM s GROUP BY ALL""",
)
def grid_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation in float32, appended frame by frame; a frame that is there is refused."""
    stats, path = ensemble.mean_spread(ensemble_grid(spark, sf_dir)), f"{scratch(spark, 'grid')}/table"
    for t in (0, 1):
        store.write_grid(stats.where(F.col("t_idx") == t).withColumn("cycle", F.lit(3)), path, "cycle", time="t_idx")
    refused = 0
    try:
        store.write_grid(stats.where("t_idx = 1").withColumn("cycle", F.lit(3)), path, "cycle", time="t_idx")
    except ValueError:
        refused = 1
    out = spark.read.parquet(path).groupBy("var", "t_idx").agg(F.count(F.lit(1)).alias("n"), F.count("sd").alias("n_sd"), F.round(F.sum(F.col("mean").cast("double")), 3).alias("total"))
    return out.withColumn("refused", F.lit(refused))


@register("ensemble_append", f"WITH {GRID_SQL} SELECT 4 AS cycle, member, count(*) AS n, count(DISTINCT t_idx) AS frames, round(sum(CAST(CAST(value AS FLOAT) AS DOUBLE)), 3) AS total FROM grid GROUP BY member")
def ensemble_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member fields by cycle and member, one frame after the other."""
    path = f"{scratch(spark, 'ensemble')}/table"
    grid = ensemble_grid(spark, sf_dir).withColumns({"t": F.timestamp_seconds(F.col("t_idx") * 3600), "cycle": F.lit(4)})
    for t in (0, 1):
        store.write_ensemble(grid.where(F.col("t_idx") == t), path)
    return spark.read.parquet(path).groupBy("cycle", "member").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("t_idx").alias("frames"), F.round(F.sum(F.col("value").cast("double")), 3).alias("total"))


@register(
    "live_append",
    "SELECT event_type, count(*) AS n, round(sum(value), 3) AS total FROM events WHERE event_type <> 'error' GROUP BY 1",
)
def live_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrive as files in two steps are appended once each by a stream that stops and goes on."""
    folder = scratch(spark, "live")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    for kinds in (("click", "view"), ("purchase", "signup", "error")):
        rows.where(F.col("event_type").isin(*kinds)).write.mode("append").parquet(f"{folder}/in")
        live.append_to(live.read_arriving(spark, f"{folder}/in", rows.schema).where("event_type <> 'error'"), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total"))


@register(
    "live_late_bins",
    f"""WITH {OBS_SQL}, k AS (SELECT *, CAST(floor(epoch_us("time")/3600000000.0) AS BIGINT) AS h FROM obs WHERE NOT (obs_id % 10 = 1 AND "time" < TIMESTAMP '2024-01-11 00:00:00')),
    g AS (SELECT *, max(CASE WHEN qc_flag = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY instrument, quantity, h) AS has_good FROM k)
    SELECT instrument, quantity, make_timestamp(h*3600000000) AS bin_start, count(*) AS n, 1 - max(has_good) AS qc_flag, {r("avg(value) AS value", "stddev_samp(value) AS repr_error")} FROM g
    WHERE (qc_flag = 0 OR has_good = 0) AND (h + 1)*3600000000 <= (SELECT max(epoch_us("time")) FROM obs) - 86400000000 GROUP BY instrument, quantity, h""",
)
def live_late_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bins of rows that arrive as three files, out of order: what is less than a day behind counts, what is later does not.

    The stream stops after two files and goes on from its checkpoint; its last bins stay open until the watermark passes them.
    """
    folder = scratch(spark, "late")
    e, t = F.col("obs_id"), F.col("time")
    rows = observations(spark, sf_dir).select("obs_id", "instrument", "quantity", t.cast("timestamp").alias("time"), "qc_flag", "value")
    at = lambda day, hour=0: F.lit(dt.datetime(2024, 1, day, hour))
    behind = (e % 10 == 2) & (t >= at(10, 12)) & (t < at(11))
    late = (e % 10 == 1) & (t < at(11))
    batches = ((t < at(11)) & ~behind & ~late, ((t >= at(11)) & (t < at(21))) | behind, (t >= at(21)) | late)
    for run in ((0, 1), (2,)):
        for k in run:
            rows.where(batches[k]).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        bins = live.time_bins(live.read_arriving(spark, f"{folder}/in", rows.schema, 1), 60, late="1 day")
        live.append_to(bins, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    found = spark.read.schema(bins.schema).parquet(f"{folder}/out")
    return rounded(found.withColumn("bin_start", F.col("bin_start").cast("timestamp_ntz")))


def model_cells(spark: SparkSession) -> DataFrame:
    """Rows of two model files: 2 members, 6 hourly frames, 4 levels, 8 x 10 points; level heights rise by 1000."""
    i = F.col("id")
    at = lambda size, n, name: (F.floor(i / size) % n).cast("int").alias(name)
    df = spark.range(6 * 2 * 4 * 8 * 10).select(at(640, 6, "k"), at(320, 2, "member"), at(80, 4, "iz"), at(10, 8, "iy"), at(1, 10, "ix"))
    value = F.col("k") * 16 + F.col("member") * 8 + F.col("iz") * 4 + F.col("iy") * 2 + F.col("ix") * 0.5
    return df.select(
        F.when(F.col("k") < 3, "model_a.nc").otherwise("model_b.nc").alias("file"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("k") * 3600).alias("t"), "member", "iz", "iy", "ix",
        value.alias("AIR"), (F.col("iz") * 1000.0 + F.col("member") * 10).alias("height"), F.lit(1.0).alias("unused"),
    )


MODEL_SQL = """m AS (SELECT CAST(k AS INT) AS t_idx, CAST(mem AS INT) AS member, CAST(z AS INT) AS iz, CAST(y AS INT) AS iy, CAST(x AS INT) AS ix, k*16 + mem*8 + z*4 + y*2 + x*0.5::DOUBLE AS value,
  z*1000 + mem*10 AS height, CASE WHEN k < 3 THEN 'model_a.nc' ELSE 'model_b.nc' END AS file FROM range(6) a(k), range(2) b(mem), range(4) c(z), range(8) d(y), range(10) e(x))"""


def model_files(spark: SparkSession) -> str:
    folder = scratch(spark, "model-files")
    netcdf.write_grid_files(model_cells(spark), folder, ["AIR", "height", "unused"])
    return f"{folder}/*.nc"


@fixed("gridded_files", f"WITH {MODEL_SQL} SELECT file, 'AIR' AS var, t_idx, member, ix, iy, iz, value, CAST(height AS DOUBLE) AS height FROM m")
def gridded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two classic files written and read back, a frame a task; frames are numbered over both."""
    grid = netcdf.read_grid(spark, model_files(spark), ["AIR", "absent"], levels="height", require_member=True)
    flat = grid.select("file", "var", "t_idx", "member", "ix", "iy", F.posexplode(F.arrays_zip("profile", "levels")).alias("iz", "p"))
    return flat.select("file", "var", "t_idx", "member", "ix", "iy", "iz", F.col("p.profile").alias("value"), F.col("p.levels").alias("height"))


@register(
    "gridded_file_interp",
    """WITH p AS (SELECT event_id, CAST(event_id % 90 AS DOUBLE)/10 AS x, CAST(event_id % 70 AS DOUBLE)/10 AS y, CAST(event_id % 3000 AS DOUBLE) AS z, CAST(event_id % 300 AS DOUBLE)/60 AS t FROM events)
    SELECT event_id AS obs_id, CAST(mem AS INT) AS member, round(t*16 + mem*8 + greatest(least((z - mem*10)/1000, 3), 0)*4 + y*2 + x*0.5::DOUBLE, 6) AS model FROM p, range(2) m(mem)""",
)
def gridded_file_interp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From model files to every member's model equivalents."""
    grid = netcdf.read_grid(spark, model_files(spark), ["AIR"], levels="height")
    e = F.col("event_id")
    obs = table(spark, sf_dir, "events").select(
        e.alias("obs_id"), F.timestamp_seconds(F.lit(1_704_067_200) + (e % 300) * 60).alias("time"), ((e % 90) / 10.0).alias("x"), ((e % 70) / 10.0).alias("y"), (e % 3000).cast("double").alias("z")
    )
    return rounded(interpolate_model(obs, grid, (0.0, 1.0, 10), (0.0, 1.0, 8), by=["member"]))


@fixed(
    "diagnostics_file",
    """SELECT CAST(i AS DOUBLE) AS obs, CAST(CASE WHEN i % 7 <> 0 THEN i + 100 END AS DOUBLE) AS prior_mean, round(sqrt(CAST(i + 200 AS DOUBLE)), 6) AS obs_std, 3 AS n_prior, CAST(i + 700 AS DOUBLE) AS second_prior, CAST(i % 8 AS INT) AS dart_qc,
    CASE i % 3 WHEN 0 THEN 'AIRSENSE AOD' WHEN 1 THEN 'HLOS_WIND' ELSE 'unknown_2' END AS obs_type, CAST(i*10 AS DOUBLE) AS longitude, (1704067200 + i*60)*1000000 AS t_us FROM range(40) t(i)""",
)
def diagnostics_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter-diagnostics file: uneven blanks in its labels, a type without a name, a missing value."""
    copies = ["observation", "prior ensemble mean", "observation error  variance", "prior ensemble spread", *[f"prior ensemble member     {k + 1}" for k in range(3)]]
    text = lambda rows: np.array([list(x.ljust(40)) for x in rows], "S1")
    i = np.arange(40.0)
    values = np.stack([i, np.where(i % 7 == 0, -888888.0, i + 100), i + 200, i + 300, i + 600, i + 700, i + 800], axis=1)
    variables = {
        "CopyMetaData": (("copy", "length"), text(copies), {}),
        "QCMetaData": (("qc_copy", "length"), text(["data QC", "DART   quality control"]), {}),
        "ObsTypesMetaData": (("ObsTypes", "length"), text(["AIRSENSE  AOD", "HLOS_WIND"]), {}),
        "ObsTypes": (("ObsTypes",), np.array([0, 1], np.int32), {}),
        "observations": (("ObsIndex", "copy"), values, {"missing_value": -888888.0}),
        "qc": (("ObsIndex", "qc_copy"), np.stack([i * 0, i % 8], axis=1).astype(np.int32), {}),
        "obs_type": (("ObsIndex",), (i % 3).astype(np.int32), {}),
        "location": (("ObsIndex", "locdim"), np.stack([i * 10, i, i], axis=1), {}),
        "time": (("ObsIndex",), i / 1440, {"units": "days since 2024-01-01 00:00:00"}),
    }
    folder = scratch(spark, "diagnostics")
    put_bytes(spark, f"{folder}/cycle_0.nc", classic.encode({"ObsIndex": None, "copy": 7, "qc_copy": 2, "ObsTypes": 2, "locdim": 3, "length": 40}, variables))
    df = netcdf.read_diagnostics(spark, f"{folder}/cycle_0.nc")
    return rounded(df.select("obs", "prior_mean", "obs_std", F.size("prior").alias("n_prior"), F.get("prior", F.lit(1)).alias("second_prior"), "dart_qc", "obs_type", "longitude", F.unix_micros("timestamp").alias("t_us")))


@register(
    "convert_aeronet",
    """WITH r AS (SELECT event_id, user_id % 20 AS site, row_number() OVER (PARTITION BY user_id % 20 ORDER BY event_id) - 1 AS i, epoch_us(date_trunc('second', ts)) AS us, value,
      (event_id*91 % 1800)/10.0::DOUBLE - 90 AS latitude, (event_id*37 % 3600)/10.0::DOUBLE - 180 AS longitude FROM events),
    c AS (SELECT *, unnest(['AOD_340', 'AOD_500']) AS q, unnest([CASE WHEN event_id % 5 <> 0 THEN value END, value*2]) AS v FROM r), k AS (SELECT * FROM c WHERE v IS NOT NULL AND v <> -999) """
    + seen_sql("k", "'AERONET'", "q", "us", "0", "surface", "v", "NULL", i0="i", i1="NULL"),
)
def convert_aeronet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sun photometers' tables, one a site, made of all events: a preamble in Latin-1, then a line for each."""
    preamble = ["AERONET Version 3", "Orleans", "x", "x", "x", "x", "Date(dd:mm:yyyy),Time(hh:mm:ss),AOD_340,AOD_500,Site_Latitude(Degrees),Site_Longitude(Degrees)"]
    e, text = F.col("event_id"), lambda c: c.cast("string")
    site = (F.col("user_id") % 20).alias("site")
    place = [((e * 91) % 1800).cast("double") / 10 - 90, ((e * 37) % 3600).cast("double") / 10 - 180]
    values = [F.when(e % 5 == 0, F.lit(-999.0)).otherwise(F.col("value")), F.col("value") * 2]
    rows = table(spark, sf_dir, "events")
    lines = rows.select(site, e.cast("bigint").alias("no"), F.concat_ws(",", F.date_format("ts", "dd:MM:yyyy"), F.date_format("ts", "HH:mm:ss"), *[text(v) for v in (*values, *place)]).alias("line"))
    heads = lines.select("site").distinct().select("site", F.posexplode(F.array(*[F.lit(x) for x in preamble])).alias("no", "line")).withColumn("no", F.col("no").cast("bigint") - 100)
    folder = f"{scratch(spark, 'aeronet')}/sites"
    lines.unionByName(heads).repartition("site").sortWithinPartitions("site", "no").select("site", "line").write.partitionBy("site").option("encoding", "ISO-8859-1").text(folder)
    return seen(aeronet.convert(spark, f"{folder}/site=*"))


SETTINGS = """[time]
start = 2024-01-01T00:00:00
cycles = 4
[superob]
"a.b" = 3
c.d = 4
"""


@fixed(
    "settings_files",
    """SELECT * FROM (VALUES ('overlay', 'cycles', '7'), ('overlay', 'start', '2024-01-01T00:00:00'), ('pairs', 'a.b', '3'), ('pairs', 'c.d', '4'), ('namelist', 'time_control.run_hours', '[6, 12]'), ('namelist', 'time_control.restart', 'True'),
    ('namelist', 'time_control.name', 'a!b'), ('again', 'time_control', 'True'), ('group', 'aod', 'a.seq'), ('differs', 'start', 'cycle 0')) t(kind, name, value)""",
)
def settings_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOML with an overlay, pair tables, a namelist there and back, groups, and a comparison of configurations."""
    from nephos.operators.cycles import Calendar

    with tempfile.TemporaryDirectory() as folder:
        at = Path(folder)
        (at / "s.toml").write_text(SETTINGS)
        (at / "o.toml").write_text("[time]\ncycles = 7\n")
        (at / "g.toml").write_text('[aod]\nkind = "AOD"\n[[aod.files]]\npath = "a.seq"\nstart_date = 2024-01-01T00:00:00\nend_date = 2024-01-02T00:00:00\n')
        read = settings.read_settings(at / "s.toml", at / "o.toml")
        groups = [(g["group"], g["path"]) for g in settings.read_groups(spark, at / "g.toml").collect()]
    rows = [("overlay", "cycles", str(read["time"]["cycles"])), ("overlay", "start", read["time"]["start"].isoformat())]
    rows += [("pairs", k, str(v)) for k, v in settings.flat_pairs(read["superob"], int).items()]
    found = settings.read_namelist("&time_control\n run_hours = 6, 12,\n restart = .true. ! note\n name = 'a!b'\n/\n")
    rows += [("namelist", f"time_control.{k}", str(v)) for k, v in found["time_control"].items()]
    rows += [("again", "time_control", str(settings.read_namelist(settings.write_namelist(found)) == found))]
    rows += [("group", *g) for g in groups]
    one, other = Calendar(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3), 360), Calendar(dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3), 360)
    rows += [("differs", k, "cycle 0") for k in settings.differences(one, other)]
    return spark.createDataFrame(rows, "kind string, name string, value string")


@fixed(
    "workflow_steps",
    """SELECT * FROM (VALUES (1, 'filter_complete', 'initialized', 0, true), (2, 'advance 0', 'advancing_members', 1, false), (3, 'all_members_advanced', 'advancing_members', 1, true), (4, 'advance 1, 2', 'advancing_members', 3, false),
    (5, 'all_members_advanced', 'members_advanced', 3, false), (6, 'reset', 'initialized', 0, false), (7, 'advance 0, 1, 2', 'advancing_members', 3, false), (8, 'all_members_advanced', 'members_advanced', 3, false),
    (9, 'filter_complete', 'filter_complete', 3, false), (10, 'analysis_complete', 'analysis_complete', 3, false), (11, 'cycle_complete', 'initialized', 0, false), (12, 'runs', '3', 3, false), (13, 'operations', '[[1, ''note'']]', 1, false),
    (14, 'two writers', '1', 2, false)) t(no, step, state, n, refused)""",
)
def workflow_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cycle's states, steps that are refused, a reset, the ledger of runs, and two writers of one ledger."""
    rows: list[tuple[int, str, str, int, bool]] = []
    with tempfile.TemporaryDirectory() as folder:
        ledger = workflow.Ledger(Path(folder) / "s.json", 3)

        def go(step: workflow.Step) -> None:
            refused = False
            try:
                ledger.step(step)
            except ValueError:
                refused = True
            rows.append((len(rows) + 1, step.value, ledger.state.value, len(ledger.data["advanced"]), refused))

        def advance(*members: int) -> None:
            ledger.advance_all([(m, "2024-01-01 00:00:00", "2024-01-01 00:10:00", 600) for m in members])
            rows.append((len(rows) + 1, f"advance {', '.join(map(str, members))}", ledger.state.value, len(ledger.data["advanced"]), False))

        go(workflow.Step.FILTER_COMPLETE)
        advance(0)
        go(workflow.Step.ALL_MEMBERS_ADVANCED)
        advance(1, 2)
        go(workflow.Step.ALL_MEMBERS_ADVANCED)
        ledger.reset()
        rows.append((len(rows) + 1, "reset", ledger.state.value, len(ledger.data["advanced"]), False))
        advance(0, 1, 2)
        for step in (workflow.Step.ALL_MEMBERS_ADVANCED, workflow.Step.FILTER_COMPLETE, workflow.Step.ANALYSIS_COMPLETE, workflow.Step.CYCLE_COMPLETE):
            go(step)
        rows.append((len(rows) + 1, "runs", str(ledger.runs(spark).count()), ledger.statuses(spark).count(), False))
        ledger.note("note")
        ledger.note("note")
        rows.append((len(rows) + 1, "operations", str(ledger.data["operations"]), len(ledger.data["operations"]), False))
        other = workflow.Ledger(Path(folder) / "s.json", 3)
        ledger.advance(0, "2024-01-01 00:00:00", "2024-01-01 00:10:00", 600)
        other.advance(2, "2024-01-01 00:00:00", "2024-01-01 00:10:00", 600)
        rows.append((len(rows) + 1, "two writers", str(other.data["cycle"]), len(other.data["advanced"]), False))
    return spark.createDataFrame(rows, "no int, step string, state string, n int, refused boolean")


@fixed("replaced_file", "SELECT 'second' AS text, 1 AS files")
def replaced_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    with tempfile.TemporaryDirectory() as folder:
        for text in ("first", "second"):
            settings.replace_file(Path(folder) / "f", text)
        rows = [((Path(folder) / "f").read_text(), len(list(Path(folder).iterdir())))]
    return spark.createDataFrame(rows, "text string, files int")


@register("processor_chain", "SELECT event_id, round(value*2 + 3, 6) AS value FROM events WHERE event_type <> 'error'")
def processor_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processors in order, one inserted before the others, one loaded by name."""
    chain = processors.Pipeline(processors.load("nephos.plans.processors:KeepMatching", patterns=["val"], always=["event_id"]))
    chain.add(lambda df, context: df.withColumn("value", F.col("value") * 2 + context.cycle))
    chain.insert(0, lambda df, _: df.where("event_type <> 'error'"))
    return rounded(chain.run(table(spark, sf_dir, "events"), processors.Context(cycle=3)))


@register("level_slice", "SELECT vec_id, round(CAST(embedding[8] AS DOUBLE), 6) AS value, CAST(NULL AS DOUBLE) AS beyond FROM embeddings")
def level_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("profile"))
    return rounded(ensemble.at_level(df, 7).join(ensemble.at_level(df, 64, value="beyond"), "vec_id"))


@register("member_dimension", f"WITH {GRID_SQL} SELECT var, t_idx, CAST(CASE WHEN var = 'T' THEN NULL ELSE 5 END AS INT) AS member, count(*) AS n FROM grid GROUP BY ALL")
def member_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a file without members become those of member 5; its static variable T belongs to none."""
    rows = ensemble.with_member(ensemble_grid(spark, sf_dir).drop("member"), 5, static=["T"])
    return rows.groupBy("var", "t_idx", "member").agg(F.count(F.lit(1)).alias("n"))


@register(
    "static_fields",
    """SELECT var, kind, count(*) AS n FROM (SELECT 'VEC' AS var, 'varying' AS kind FROM embeddings, range(2) UNION ALL SELECT 'LABEL', 'fixed' FROM embeddings) GROUP BY ALL""",
)
def static_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two fields in two frames, the one that never changes is kept once."""
    e = table(spark, sf_dir, "embeddings").crossJoin(spark.range(2).select(F.col("id").cast("int").alias("t_idx")))
    place = [F.col("t_idx"), F.timestamp_seconds(F.col("t_idx")).alias("t"), F.floor(F.col("vec_id") / 20).alias("iy"), (F.col("vec_id") % 20).alias("ix")]
    one = e.select(F.lit("VEC").alias("var"), *place, F.transform("embedding", lambda x: x + F.col("t_idx")).alias("profile"))
    other = e.select(F.lit("LABEL").alias("var"), *place, F.array(F.col("label").cast("float")).alias("profile"))
    varying, fixed = netcdf.split_static(one.unionByName(other))
    both = varying.select("var", F.lit("varying").alias("kind")).union(fixed.select("var", F.lit("fixed").alias("kind")))
    return both.groupBy("var", "kind").agg(F.count(F.lit(1)).alias("n"))


@register(
    "native_array",
    f"""WITH {OBS_SQL} SELECT c_profile, 24 AS size, round(max(CASE WHEN c_bin = 3 THEN value END), 6) AS fourth, count(CASE WHEN qc_flag = 0 THEN 1 END) AS held, round(sum(CASE WHEN qc_flag = 0 THEN value END), 3) AS total
    FROM obs GROUP BY c_profile HAVING count(CASE WHEN qc_flag = 0 THEN 1 END) > 0 AND (max(CASE WHEN c_bin = 3 AND qc_flag = 0 THEN value END) IS NOT NULL OR max(CASE WHEN c_bin = 3 AND qc_flag = 0 THEN 1 END) IS NULL AND false)""",
)
def native_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each profile as one array of 24 bins, null where no good row is; profiles whose fourth bin is held."""
    out = ensemble.native_array(observations(spark, sf_dir).where("qc_flag = 0"), "c_bin", "value", 24, ["c_profile"])
    total = F.aggregate("value", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    held = F.size(F.filter("value", lambda x: x.isNotNull()))
    rows = out.select("c_profile", F.size("value").alias("size"), F.round(F.get("value", F.lit(3)), 6).alias("fourth"), held.cast("bigint").alias("held"), F.round(total, 3).alias("total"))
    return rows.where("fourth IS NOT NULL")


@register("display_scales", f"WITH {CELL_SQL} SELECT e, round(v, 6) AS plain, round(v*1000000, 3) AS scaled FROM c")
def display_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as the quantity registry shows them: optical depths as they are, extinctions in 1/Mm."""
    v = F.col("value")
    scale = lambda q: QUANTITIES[q].display_scale
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("e"), F.round(v * scale("AOD_550nm"), 6).alias("plain"), F.round(v * scale("LIDAR_EXTINCTION_355nm"), 3).alias("scaled"))


@register("declared_metadata", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def declared_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", *metadata_values(F.col("props"), ["k"]))


@register(
    "last_frame",
    f"""WITH {GRID_SQL} SELECT var, ix, iy, iz, count(value) AS n, {r("avg(value) AS mean", digits=4)} FROM grid WHERE t_idx = (SELECT max(t_idx) FROM grid) GROUP BY ALL""",
)
def last_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post-processing of the last frame only, without the cycle's first one, read back from its table."""
    path = f"{scratch(spark, 'post')}/table"
    rows = api.without_first_frame(ensemble_grid(spark, sf_dir).withColumn("t", F.timestamp_seconds(F.col("t_idx") * 3600).cast("timestamp_ntz")), dt.datetime(1970, 1, 1))
    api.postprocess(rows, path, 2, last_only=True)
    return spark.read.parquet(path).select("var", "ix", "iy", "iz", "n", F.round(F.col("mean").cast("double"), 4).alias("mean"))


@register("first_least_index", "SELECT vec_id, CAST(list_position(embedding, list_min(embedding)) AS BIGINT) AS at FROM embeddings")
def first_least_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.array_position("embedding", F.array_min("embedding")).alias("at"))


@register(
    "held_out_ids",
    f"""WITH {OBS_SQL}, g AS (SELECT obs_id, row_number() OVER (PARTITION BY ingest_file, instrument, quantity ORDER BY "time", obs_id) - 1 AS k FROM obs WHERE qc_flag = 0) SELECT obs_id FROM g WHERE k % 4 <> 0""",
)
def held_out_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good rows less those that thinning keeps."""
    obs = observations(spark, sf_dir)
    kept = filters.quality(superobs.stride_thin(obs, 4)).select("obs_id")
    return filters.quality(obs).select("obs_id").exceptAll(kept)


@register(
    "ordered_counts",
    f"""WITH {OBS_SQL}, n AS (SELECT instrument, quantity, count(*) AS count FROM obs GROUP BY ALL) SELECT CAST(row_number() OVER (ORDER BY count DESC, instrument, quantity) AS INT) AS place, * FROM n""",
)
def ordered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's rows in their order."""
    rows = [(k + 1, r_["instrument"], r_["quantity"], r_["count"]) for k, r_ in enumerate(obs_files.quantity_counts(observations(spark, sf_dir)).toLocalIterator())]
    return spark.createDataFrame(rows, "place int, instrument string, quantity string, count bigint")


@register(
    "prepared_cycles",
    f"""WITH {OBS_SQL}, {CALENDAR_SQL}, p AS (SELECT cycle_index, o.*, CASE WHEN value_uncertainty IS NULL OR value_uncertainty <= 0 THEN 99 ELSE qc_flag END AS flag FROM cycles
      JOIN obs o ON "time" BETWEEN end_time - INTERVAL 60 MINUTE AND end_time + INTERVAL 60 MINUTE WHERE instrument IN ('click', 'view'))
    SELECT cycle_index, count(*) AS n, count(*) FILTER (flag = 0 AND value IS NOT NULL) AS lines, round(coalesce(sum(value) FILTER (flag = 0), 0), 3) AS total FROM p GROUP BY ALL""",
)
def prepared_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cycle's rows as Parquet, and its good rows as lines for the filter."""
    path = scratch(spark, "cycles")
    factors = spark.createDataFrame([("click", "AOD_550nm", 1.5)], "instrument string, quantity string, factor double")
    rows = api.prepare_cycles(cycle_calendar(spark), observations(spark, sf_dir), 60, ["click", "view"], factors, path)
    lines = spark.read.option("header", True).option("inferSchema", True).csv(f"{path}/filter_input").groupBy("cycle_index").agg(F.count(F.lit(1)).alias("lines"), F.sum("obs_value").alias("total"))
    found = rows.groupBy("cycle_index").agg(F.count(F.lit(1)).alias("n")).join(lines, "cycle_index", "left")
    return found.select("cycle_index", "n", F.coalesce("lines", F.lit(0)).alias("lines"), F.round(F.coalesce("total", F.lit(0.0)), 3).alias("total"))


@register(
    "point_summary",
    f"""WITH {OBS_SQL} SELECT instrument, quantity, count(DISTINCT (longitude, latitude)) AS places, {r("quantile_cont(value, 0.01) AS p01", "quantile_cont(value, 0.99) AS p99")} FROM obs GROUP BY ALL""",
)
def point_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(api.point_summary(observations(spark, sf_dir)))


@register(
    "member_commands",
    f"""WITH {GRID_SQL}, m AS (SELECT DISTINCT member FROM grid), c AS (SELECT DISTINCT CAST(day(ts) AS INT) AS cycle_index FROM events)
    SELECT cycle_index, member, 'advance ' || member || ' of ' || cycle_index AS command FROM c, m""",
)
def member_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A command for each member there is and each day with observations."""
    members, days = ensemble_grid(spark, sf_dir).select("member").distinct(), table(spark, sf_dir, "events").select(F.dayofmonth("ts").alias("cycle_index")).distinct()
    pairs = ensemble.member_cycles(members, days)
    return pairs.select("cycle_index", "member", F.concat(F.lit("advance "), F.col("member").cast("string"), F.lit(" of "), F.col("cycle_index").cast("string")).alias("command"))


def harp_file() -> bytes:
    """A small polarimeter swath: 6 x 5 cells, two bands, a time with a further dimension, one value missing."""
    y, x, b = np.meshgrid(np.arange(6), np.arange(5), np.arange(2), indexing="ij")
    total = (y * 0.01 + x * 0.002 + b * 0.5).astype(np.float64)
    total[2, 3, 1] = -9.0
    cell = ("y", "x", "band")
    variables = {
        "aerosol_optical_depth_total": (cell, total, {"_FillValue": -9.0}),
        "aerosol_fine_mode_optical_depth": (cell, total / 2, {}),
        "aerosol_coarse_mode_optical_depth": (cell, total / 4, {}),
        "latitude": (("y", "x"), (y[..., 0] * 1.5).astype(np.float64), {}),
        "longitude": (("y", "x"), (x[..., 0] * 2.5).astype(np.float64), {}),
        "measurement_time_unix": ((*cell, "instrument"), ((1_700_000_000 + y * 10)[..., None] + np.arange(2)).astype(np.float64), {}),
        "band": (("band", "length"), np.array([list("440.16"), list("549.57")], "S1"), {}),
    }
    return classic.encode({"y": 6, "x": 5, "band": 2, "instrument": 2, "length": 6}, variables)


@fixed(
    "harp2_file",
    """WITH c AS (SELECT y AS i0, x AS i1, y*1.5::DOUBLE AS latitude, x*2.5::DOUBLE AS longitude, y*0.01::DOUBLE + x*0.002::DOUBLE + b*0.5::DOUBLE AS total, (['440nm', '550nm'])[b + 1] AS q, y, unnest(['AOD_', 'AOD_Fine_', 'AOD_Coarse_']) AS prefix, unnest([1, 2, 4]) AS part, b, x
      FROM range(6) s(y), range(5) t(x), range(2) u(b)), k AS (SELECT *, total/part AS v FROM c WHERE NOT (y = 2 AND x = 3 AND b = 1)) """
    + seen_sql("k", "'GRASP_HARP2'", "prefix || q", "(1700000000 + y*10)*1000000", "0", "columnar", "v", "least(greatest(0.2853::DOUBLE*v + 0.0267::DOUBLE, 0.0267), 0.3)"),
)
def harp2_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polarimeter's file to observation rows."""
    folder = scratch(spark, "swaths")
    put_bytes(spark, f"{folder}/h.nc", harp_file())
    return seen(swaths.convert_files(spark, f"{folder}/h.nc", "grasp-harp2"))


def plain_swath(names: dict[str, np.ndarray], units: str | None = None, product: str = "") -> bytes:
    """A file of variables over (a, b), or over a alone, by their last names."""
    n, m = max(v.shape for v in names.values())
    variables = {k: (("a", "b")[: v.ndim], v.astype(np.float64), {"units": units} if k == "time" and units else {}) for k, v in names.items()}
    return classic.encode({"a": n, "b": m}, variables, {"product_name": product})


@fixed(
    "swath_files",
    """WITH c AS (SELECT CAST(i AS INT) AS i0, CAST(j AS INT) AS i1, i*0.1::DOUBLE + j*0.01::DOUBLE AS v, i + 0.5::DOUBLE AS latitude, j + 0.25::DOUBLE AS longitude FROM range(30) a(i), range(8) b(j)),
    e AS (SELECT *, CASE WHEN i0 = 15 AND i1 = 4 THEN 1 ELSE 0 END AS seed, i0 BETWEEN 13 AND 17 AND i1 BETWEEN 1 AND 7 AS near, v/1000 AS x FROM c) """
    + seen_sql("c", "'VIIRS'", "'AOD_550nm'", "round((1000000000 + i0 - 37)*1000000::DOUBLE) + 725846400000000", "0", "columnar", "v", "0.125")
    + " UNION ALL "
    + seen_sql("c", "'RemoTAP-spexone'", "'AOD_550nm'", "epoch_us(TIMESTAMP '2024-03-05 12:00:00')", "0", "columnar", "v", "0.125")
    + " UNION ALL "
    + seen_sql("e", "'EarthCARE_ATLID_EBD'", "'LIDAR_EXTINCTION_355nm'", "epoch_us(TIMESTAMP '2024-01-01 00:00:00') + i0*2000000", "i1*100", "height", "x", "6.8e-5::DOUBLE + 0.2::DOUBLE*x", "CASE WHEN near OR x > 0.002 THEN 1 ELSE 0 END"),
)
def swath_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three products, their variables without groups, to observation rows."""
    i, j = np.meshgrid(np.arange(30), np.arange(8), indexing="ij")
    v, lat, lon, flat = i * 0.1 + j * 0.01, i + 0.5, j + 0.25, np.full(i.shape, 0.125)
    best = "Aerosol_Optical_Thickness_550_"
    files = {
        "viirs": plain_swath({f"{best}Land_Ocean_Best_Estimate": v, f"{best}Expected_Uncertainty_Land": flat * 0 - 999, f"{best}Expected_Uncertainty_Ocean": flat, "Latitude": lat, "Longitude": lon, "Scan_Start_Time": 1e9 + i}),
        "remotap-spexone": plain_swath({"aot550": v, "aot550_uncertainty": flat, "latitude": lat, "longitude": lon, "utc_date": flat * 0 + 20240305, "fracday": flat * 4}, product="PACE_SPEXONE.20240305.AER_LAND_REMOTAP.nc"),
        "earthcare-ebd": plain_swath(
            {
                "particle_extinction_coefficient_355nm_low_resolution": v / 1000, "simple_classification": np.where((i == 15) & (j == 4), 1, 3), "height": j * 100.0, "latitude": lat, "longitude": lon,
                "time": np.arange(30) * 2.0,
            },
            "seconds since 2024-01-01 00:00:00",
        ),
    }
    folder, parts = scratch(spark, "swaths"), []
    for product, data in files.items():
        put_bytes(spark, f"{folder}/{product}.nc", data)
        parts.append(seen(swaths.convert_files(spark, f"{folder}/{product}.nc", product)))
    return ensemble.union_all(parts)


@register("seeded_experiment", f"WITH {GRID_SQL} SELECT member, var, count(*) AS n, round(sum(value), 4) AS total, 1 AS cycle, 10 AS advanced FROM grid WHERE t_idx = 1 GROUP BY ALL")
def seeded_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An experiment that begins with another's forecasts of cycle 1."""
    calendar = cycle_calendar(spark)
    grid = ensemble_grid(spark, sf_dir).withColumn("cycle", F.col("t_idx"))
    timed = grid.join(calendar.select(F.col("cycle_index").alias("cycle"), F.col("end_time").alias("t")), "cycle")
    with tempfile.TemporaryDirectory() as folder:
        ledger = workflow.Ledger(Path(folder) / "s.json", 10)
        rows = api.seed_from(timed, calendar, 1, ledger)
        state = ledger.data
    out = rows.groupBy("member", "var").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.withColumns({"cycle": F.lit(state["cycle"]), "advanced": F.lit(len(state["advanced"]))})
