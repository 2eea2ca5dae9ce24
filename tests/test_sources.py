import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from nephos import schema
from nephos.plans import observation_operators as ops
from nephos.plans import processors, workflow
from nephos.sources import exports, obs_files, settings
from nephos.sources.converters import CONVERTERS, aeronet
from nephos.sources.store import ObservationStore
from nephos.streaming import live

T0 = dt.datetime(2024, 1, 1)


def rows(n, file="raw", z_type="height"):
    return [("I", "Q", T0 + dt.timedelta(minutes=i), 1.0, 2.0, 3.0, z_type, float(i), 0.1, 0, ([i], [n], ["row"]), file, "" if i % 2 else '{"a": 1}') for i in range(n)]


@pytest.fixture()
def obs(spark):
    return spark.createDataFrame(rows(4), schema.OBS_SCHEMA)


def test_write_and_read_back(spark, obs, tmp_path):
    obs_files.write_obs(obs, str(tmp_path / "a.parquet"))
    back = obs_files.read_obs(spark, str(tmp_path / "a.parquet"))
    assert back.count() == 4 and back.where("metadata IS NULL").count() == 2
    assert back.where("ingest_file IS NULL").count() == 0
    assert obs_files.join_files(spark, [str(tmp_path / "a.parquet")] * 2).count() in (4, 8)


def test_validation_names_what_is_wrong(spark, obs):
    with pytest.raises(schema.SchemaError, match="z_type"):
        schema.validate(spark.createDataFrame(rows(2, z_type="depth"), schema.OBS_SCHEMA))
    with pytest.raises(schema.SchemaError, match="missing"):
        schema.validate(obs.drop("value"))
    uneven = obs.withColumn("orig_coords", F.struct(F.array(F.lit(1)).alias("indices"), F.array(F.lit(1), F.lit(2)).alias("shape"), F.array(F.lit("r")).alias("names")))
    with pytest.raises(schema.SchemaError, match="uneven"):
        schema.validate(uneven)


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,)], "v double")
    assert schema.nan_to_null(df, "v").where("v IS NULL").count() == 2


def test_store_replaces_updates_and_deletes(spark, obs, tmp_path):
    store = ObservationStore(spark, str(tmp_path / "store"))
    assert store.read().count() == 0
    full = obs.withColumns({"x": F.lit(0.0), "y": F.lit(0.0), "obs_id": F.monotonically_increasing_id()})
    for name in ("a", "b", "a"):
        store.add(full.withColumn("ingest_file", F.lit(name)))
    assert store.read().count() == 8
    ids = store.read().where("ingest_file = 'a'").select("obs_id").limit(1).withColumn("value", F.lit(9.0))
    store.update(ids, "model_forecast")
    assert store.read().where("model_forecast = 9.0").count() == 2  # both files hold the id
    assert store.delta_bytes() < 5_000
    store.update(ids.limit(0), "model_forecast", clear=True)
    assert store.read().where("model_forecast IS NOT NULL").count() == 0
    assert store.delete("a") and not store.delete("a") and store.read().count() == 4
    assert store.find("raw") is not None and store.find("none") is None


def test_sequence_count(spark):
    df = spark.createDataFrame([(" obs\n num_obs:  12 max_num_obs: 15",), ("max_num_obs: 3",)], "h string")
    assert [r["n"] for r in df.select(exports.sequence_count(F.col("h")).alias("n")).collect()] == [12, None]


def test_diagnostics_arrays(spark):
    wide = spark.createDataFrame([(1.0, 2.0, 3.0)], "obs double, member_0_prior double, member_1_prior double")
    assert exports.diagnostics_rows(wide, 2).first()["prior"] == [2.0, 3.0]


def test_settings_merge_and_pairs(tmp_path):
    (tmp_path / "a.toml").write_text('[s]\nx = 1\ny = {z = 2}\n["I.Q"]\nn = 3\n')
    (tmp_path / "b.toml").write_text("[s]\ny = {w = 5}\n")
    found = settings.read_settings(tmp_path / "a.toml", tmp_path / "b.toml")
    assert found["s"] == {"x": 1, "y": {"z": 2, "w": 5}}
    assert settings.flat_pairs({"I.Q": {"n": 3}}) == settings.flat_pairs({"I": {"Q": {"n": 3}}}) == {"I.Q": {"n": 3}}


def test_namelist_there_and_back():
    text = "&time\n run_hours = 6, 12,\n flag = .true. ! note\n name = 'a!b'\n dx = 3.5\n/\n"
    found = settings.read_namelist(text)
    assert found == {"time": {"run_hours": [6, 12], "flag": True, "name": "a!b", "dx": 3.5}}
    assert settings.read_namelist(settings.write_namelist(found)) == found


def test_groups(spark, tmp_path):
    (tmp_path / "g.toml").write_text('[aod]\nkind = "AOD"\n[[aod.files]]\npath = "a.seq"\nstart_date = 2024-01-01T00:00:00\nend_date = 2024-01-02T00:00:00\n')
    assert settings.read_groups(spark, tmp_path / "g.toml").first()["path"] == "a.seq"


def test_workflow_rules(spark, tmp_path):
    ledger = workflow.Ledger(tmp_path / "s.json", 2)
    with pytest.raises(ValueError, match="not possible"):
        ledger.step(workflow.Step.FILTER_COMPLETE)
    ledger.advance(0, "2024-01-01 00:00:00", "2024-01-01 00:10:00", 600)
    with pytest.raises(ValueError, match="1 of 2"):
        ledger.step(workflow.Step.ALL_MEMBERS_ADVANCED)
    ledger.advance(1, "2024-01-01 00:00:00", "2024-01-01 00:20:00", 1200)
    for step in (workflow.Step.ALL_MEMBERS_ADVANCED, workflow.Step.FILTER_COMPLETE, workflow.Step.ANALYSIS_COMPLETE, workflow.Step.CYCLE_COMPLETE):
        ledger.step(step)
    again = workflow.Ledger(tmp_path / "s.json", 2)
    assert again.data["cycle"] == 1 and again.state is workflow.State.INITIALIZED
    assert again.runs(spark).count() == 2
    again.note("x")
    again.note("x")
    assert again.data["operations"] == [[1, "x"]]


def test_processors_chain_and_load(spark, tmp_path):
    (tmp_path / "mine.py").write_text("class Twice:\n    def __call__(self, df, context):\n        return df.selectExpr('a * 2 AS a', 'b')\n")
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    chain = processors.Pipeline(processors.load(str(tmp_path / "mine.py"))).add(processors.KeepMatching(["a"]))
    assert chain.run(df).collect() == [(2,)]
    assert isinstance(processors.load("nephos.plans.processors:KeepMatching", patterns=["x"]), processors.KeepMatching)


def test_quantities_need_one_source():
    with pytest.raises(ValueError):
        ops.QuantitySpec("x")
    assert ops.required_fields(["HLOS_WIND", "AOD_550nm"]) == ["wind_east", "wind_north", "AOD_550"]


def test_missing_field_gives_null(spark):
    df = spark.createDataFrame([(1.0,)], "wind_east double")
    assert df.select(ops.model_equivalent(df, "HLOS_WIND").alias("x")).first()["x"] is None


def test_sun_photometer_table(spark, tmp_path):
    text = "\n".join(["p"] * 6 + ["Date(dd:mm:yyyy),Time(hh:mm:ss),AOD_340,AOD_500,Site_Latitude(Degrees),Site_Longitude(Degrees)", "02:03:2024,04:05:06,0.5,-999.,10.5,-20.25", "02:03:2024,04:06:06,-999.,0.25,10.5,-20.25"])
    (tmp_path / "a.lev15").write_bytes(text.encode("latin-1"))
    out = CONVERTERS["aeronet"](spark, str(tmp_path / "a.lev15")).orderBy("quantity").collect()
    assert [(r["quantity"], r["value"], r["orig_coords"]["indices"]) for r in out] == [("AOD_340", 0.5, [0]), ("AOD_500", 0.25, [1])]
    assert out[0]["time"] == dt.datetime(2024, 3, 2, 4, 5, 6) and out[0]["orig_filename"] == "a.lev15"


def test_sun_photometer_table_in_stretches(spark, tmp_path):
    head = "Site,AOD_500,Date(dd:mm:yyyy),Time(hh:mm:ss),AOD_340,Site_Latitude(Degrees),Site_Longitude(Degrees)"
    line = lambda i: f'"Orl\u00e9ans, {i}",{i}.5,02:03:2024,04:05:06,-999.,10.5,-20.25'
    rows = [line(i) if i % 10 else "" for i in range(1, 400)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "b 50%20.lev15").write_bytes("\r\n".join(["pr\u00e9"] * 6 + [head, *rows]).encode("latin-1"))
    (tmp_path / "a" / "short.lev15").write_bytes("\n".join(["p"] * 6 + [head, line(7)]).encode("latin-1"))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        wide = aeronet.read_table(spark, str(tmp_path / "a"), ["AOD_500"])
        assert wide.rdd.getNumPartitions() > 8  # no task takes the whole file
        got = sorted((r["file"], r["row"], r["AOD_500"]) for r in wide.collect())
        out = CONVERTERS["aeronet"](spark, str(tmp_path / "a")).collect()
        for name, content in (("headless", "p\n" * 6), ("other", "p\n" * 6 + "x,y\n1,2\n")):
            (tmp_path / name).mkdir()
            (tmp_path / name / "c.lev15").write_text(content)
            with pytest.raises(Exception, match="c.lev15 has no column .*AOD_500"):
                aeronet.read_table(spark, str(tmp_path / name), ["AOD_500"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == [("b 50%20.lev15", i - 1, i + 0.5) for i in range(1, 400) if i % 10] + [("short.lev15", 0, 7.5)]
    assert {(r["orig_filename"], r["orig_coords"]["shape"][0]) for r in out} == {("b 50%20.lev15", 360), ("short.lev15", 1)}


def test_imager_masks_and_scales(spark):
    cells = spark.createDataFrame([(0, 0, 1.0, 2.0, 37.0, 500, 3), (0, 1, 1.0, 2.0, 37.0, -9999, 3), (0, 2, 1.0, 2.0, 37.0, 500, 1), (0, 3, -999.0, 2.0, 37.0, 500, 3)], "along int, across int, latitude double, longitude double, scan_time double, aod int, qa int")
    out = CONVERTERS["modis"](cells, (1, 4), "f").collect()
    assert len(out) == 1 and out[0]["value"] == 0.5 and abs(out[0]["value_uncertainty"] - 0.2) < 1e-12
    assert out[0]["time"] == dt.datetime(1993, 1, 1)


def test_viirs_prefers_the_land_error(spark):
    cells = spark.createDataFrame([(0, 0, 1.0, 2.0, 37.0, 0.3, 0.1, 0.2), (0, 1, 1.0, 2.0, 37.0, 0.3, -999.0, 0.2), (0, 2, 1.0, 2.0, 37.0, -999.0, 0.1, 0.2)], "along int, across int, latitude double, longitude double, scan_time double, aod double, error_land double, error_ocean double")
    assert sorted(r["value_uncertainty"] for r in CONVERTERS["viirs"](cells, (1, 3), "f").collect()) == [0.1, 0.2]


def test_polarimeter_bands(spark):
    cells = spark.createDataFrame([(0, 0, "549.57", 1.0, 2.0, 0, 2.0, 0.1, float("nan"), 100.0)], "y int, x int, band string, latitude double, longitude double, unix_time long, total double, fine double, coarse double, sea double")
    out = {r["quantity"]: r for r in CONVERTERS["grasp-harp2"](cells, (1, 1), "f", mask="sea").collect()}
    assert set(out) == {"AOD_550nm", "AOD_Fine_550nm"} and out["AOD_550nm"]["value_uncertainty"] == 0.3
    assert json.loads(out["AOD_550nm"]["metadata"]) == {"is_over_land": 0}
    with pytest.raises(Exception, match="unknown band"):
        CONVERTERS["grasp-harp2"](cells.withColumn("band", F.lit("1")), (1, 1), "f").collect()


def test_spex_drops_the_other_surface(spark):
    cells = spark.createDataFrame([(0, 0, 1.0, 2.0, 20240101, 0.5, 0.3, 0.1, 90.0), (0, 1, 1.0, 2.0, 20240101, 0.5, 0.3, 0.1, 10.0), (0, 2, 1.0, 2.0, 29990101, 0.5, 0.3, 0.1, 90.0)], "along int, across int, latitude double, longitude double, utc_date int, fraction double, aod double, error double, sea double")
    out = CONVERTERS["remotap-spexone"](cells, (1, 3), "PACE_SPEXONE_x_AER_OCEAN_REMOTAP.nc", "f", "sea").collect()
    assert len(out) == 1 and out[0]["time"] == dt.datetime(2024, 1, 1, 12) and out[0]["qc_flag"] == 0
    with pytest.raises(ValueError):
        CONVERTERS["remotap-spexone"](cells, (1, 3), "other.nc", "f")


def test_seviri_averages_in_cells(spark):
    pixels = spark.createDataFrame([("c", 0.1, 0.0, T0, 1.0), ("c", -0.1, 0.2, T0, 3.0), ("c", 9.0, 9.0, T0, 5.0)], "channel string, x double, y double, time timestamp, value double")
    grid = spark.createDataFrame([(0, 0, 5.0, 6.0), (0, 1, 5.0, 7.0)], "iy int, ix int, latitude double, longitude double")
    out = CONVERTERS["msg-seviri"](pixels, grid, (1, 2), (0.0, 0.0), 1.0, "f").collect()
    assert [(r["value"], r["longitude"]) for r in out] == [(2.0, 6.0)]


def test_lidar_cloud_buffer(spark):
    cells = spark.createDataFrame([(p, h, 1.0, 2.0, T0, float(h), -1e-5 if h == 0 else 1e-4, 1 if (p, h) == (5, 5) else 3) for p in range(11) for h in range(11)], "profile int, level int, latitude double, longitude double, time timestamp, height double, extinction double, class int")
    out = CONVERTERS["earthcare-ebd"](cells, (11, 11), "f")
    assert out.where("qc_flag = 1").count() == 35 and out.where("value < 0").count() == 0


def test_lidar_extinction_products(spark):
    features = spark.createDataFrame([(0, 0, m, 2) for m in range(16)] + [(0, 1, m, 7) for m in range(16)], "profile int, height_bin int, measurement int, feature int")
    cells = spark.createDataFrame([(0, b, 1.0, 190.0, 5.0, 6.0, 4.0, 0.0, 100.0, 1) for b in (0, 1)], "profile int, height_bin int, latitude double, longitude double, altitude double, altitude_top double, altitude_bottom double, start double, extinction double, processing_flag int")
    for name in ("aeolus-l2a-mle", "aeolus-l2a-sca"):
        out = CONVERTERS[name](cells, features, (1, 2), "f").orderBy("qc_flag").collect()
        assert [r["qc_flag"] for r in out] == [0, 1] and out[0]["longitude"] == -170.0 and abs(out[0]["value"] - 1e-4) < 1e-12


def test_lidar_measurement_product(spark):
    cells = spark.createDataFrame([(0, m, 0, 1.0, 2.0, 5.0, 6.0, 4.0, 0.0, 100.0, 3, 0x10 if m == 0 else 0x01) for m in (0, 1)], "brc int, measurement int, height_bin int, latitude double, longitude double, altitude double, altitude_top double, altitude_bottom double, start double, extinction double, class int, quality int")
    assert sorted(r["qc_flag"] for r in CONVERTERS["aeolus-l2a-aelpro"](cells, 2, (2, 1), "f").collect()) == [0, 1]
    assert [r["qc_flag"] for r in CONVERTERS["aeolus-l2a-aelpro"](cells, 2, (1, 1), "f", True).collect()] == [1]


def test_winds_flags_and_errors(spark):
    one = lambda k, v, t: (k, 0, 1, 5.0, 4.0, 6.0, 90.0, 1.0, 350.0, 0.0, 0.0, 0.0, 250.0, v, t)
    df = spark.createDataFrame([one("mie", 1, 1), one("mie", 0, 1), one("rayleigh", 0, 1), one("rayleigh", 1, 2)], "retrieval string, row int, wind_result_id int, altitude double, alt_bottom double, alt_top double, azimuth double, latitude double, longitude double, t double, t_start double, t_stop double, wind double, validity int, observation_type int")
    out = CONVERTERS["aeolus-l2b"](df, "f").collect()
    assert sorted((r["instrument"], r["qc_flag"], r["value_uncertainty"]) for r in out) == [("AEOLUS_L2B_MIE", 0, 2.5), ("AEOLUS_L2B_MIE", 1, 2.5), ("AEOLUS_L2B_RAYLEIGH", 0, 4.5), ("AEOLUS_L2B_RAYLEIGH", 2, 4.5)]
    assert out[0]["value"] == 2.5 and json.loads(out[0]["metadata"])["azimuth"] == 90.0


def test_live_time_bins(spark, obs, tmp_path):
    obs.coalesce(1).write.parquet(str(tmp_path / "in"))
    late = obs.withColumn("time", F.col("time") + F.expr("INTERVAL 1 DAY"))
    late.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    bins = live.time_bins(live.read_arriving(spark, str(tmp_path / "in"), schema.OBS_SCHEMA, 1), 60)
    live.append_to(bins, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(got) >= 1 and all(r["n"] == 4 and r["value"] == 1.5 for r in got)


def test_store_drops_files_that_lost_all_rows_and_escapes_names(spark, obs, tmp_path):
    store = ObservationStore(spark, str(tmp_path / "store"))
    for name in ("a:b%c.parquet", "other file"):
        store.add(obs.withColumns({"ingest_file": F.lit(name), "x": F.lit(0.0), "y": F.lit(0.0)}))
    n = obs.count()
    store.add(obs.limit(0).withColumns({"ingest_file": F.lit("z"), "x": F.lit(0.0), "y": F.lit(0.0)}), ["other file", "never there"])
    assert {r["ingest_file"] for r in store.read().collect()} == {"a:b%c.parquet"}
    store.add(obs.limit(1).withColumns({"ingest_file": F.lit("a:b%c.parquet"), "x": F.lit(0.0), "y": F.lit(0.0)}), ["a:b%c.parquet"])
    assert store.read().count() == 1 < n
    assert store.delete("a:b%c.parquet") and store.read().count() == 0


def placed(obs, name, **columns):
    return obs.withColumns({"ingest_file": F.lit(name), "x": F.lit(0.0), "y": F.lit(0.0)} | columns)


def test_what_no_commit_names_is_not_the_table(spark, obs, tmp_path):
    store = ObservationStore(spark, str(tmp_path / "store"))
    store.add(placed(obs, "a"))
    obs.withColumn("_data", F.lit("lost")).write.parquet(str(tmp_path / "store" / "data" / "lost" / "_part=x"))
    assert store.read().count() == obs.count()
    store.update(store.read().select("obs_id", F.lit(2.0).alias("value")), "model_forecast")
    assert store.read().where("model_forecast = 2.0").count() == obs.count()
    store.update(store.read().select("obs_id", F.lit(None).cast("double").alias("value")), "model_forecast")
    assert store.read().where("model_forecast IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="several values"):
        twice = store.read().select("obs_id").limit(1)
        store.update(twice.withColumn("value", F.lit(1.0)).union(twice.withColumn("value", F.lit(2.0))), "model_forecast")


def test_a_number_is_taken_once(spark, tmp_path):
    from nephos.sources.commits import CommitLog

    one, two = (CommitLog(spark, f"file://{tmp_path}/log") for _ in range(2))
    assert one.versions() == [] and one.put(1, {"a": "é"}) and not two.put(1, {"a": "other"})
    assert two.get(1) == {"a": "é"} and two.put(2, {}) and one.versions() == [1, 2]
    assert {p.suffix for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")} == {".json"}


def test_writers_behind_others_retry_or_conflict(spark, obs, tmp_path):
    from nephos.sources.store import Conflict

    mine, other = (ObservationStore(spark, str(tmp_path / "store")) for _ in range(2))
    mine.add(placed(obs, "a"))
    behind = other.snapshot()
    mine.update(mine.read().select("obs_id", F.lit(1.0).alias("value")), "model_forecast")
    ids = mine.read().select("obs_id").limit(1)
    assert other.update(ids.withColumn("value", F.lit(7.0)), "model_analysis", base=behind) == 3
    assert other.add(placed(obs, "b"), base=behind) == 4
    with pytest.raises(Conflict):
        other.add(placed(obs, "b"), base=behind)
    got = mine.read().collect()
    assert len(got) == 2 * obs.count() and sum(r["model_analysis"] == 7.0 for r in got) == 1
    assert sum(r["model_forecast"] == 1.0 for r in got) == obs.count()


def test_old_snapshots_stay_until_the_vacuum(spark, obs, tmp_path):
    store = ObservationStore(spark, str(tmp_path / "store"))
    store.add(placed(obs, "a").unionByName(placed(obs, "b")))
    old = store.read(1)
    store.update(store.read().where("ingest_file = 'a'").select("obs_id", F.lit(3.0).alias("value")), "model_forecast")
    late = store.snapshot()
    assert store.compact() == 3 and store.compact() == 0
    # A delta that came while rows were compacted still holds; so does one of the time before for who reads that time.
    store.update(store.read().where("ingest_file = 'b'").select("obs_id", F.lit(4.0).alias("value")), "model_forecast", base=late)
    assert old.where("model_forecast IS NOT NULL").count() == 0 and store.read(2).where("model_forecast = 3.0").count() == obs.count()
    assert store.read().where("model_forecast = 3.0").count() == store.read().where("model_forecast = 4.0").count() == obs.count()
    before = sorted(map(str, store.read().collect()))
    assert store.vacuum(1) > 0 and sorted(map(str, store.read().collect())) == before


def test_clearing_leaves_rows_that_come_later(spark, obs, tmp_path):
    store = ObservationStore(spark, str(tmp_path / "store"))
    store.add(placed(obs, "a", model_forecast=F.lit(1.0)))
    store.update(store.read().select("obs_id", F.lit(2.0).alias("value")).limit(0), "model_forecast", clear=True)
    store.add(placed(obs, "b", model_forecast=F.lit(5.0)))
    for _ in range(2):
        got = {(r["ingest_file"], r["model_forecast"]) for r in store.read().collect()}
        assert got == {("a", None), ("b", 5.0)}
        store.compact()
    assert not store.snapshot().deltas


def test_a_log_of_many_commits_is_read_from_its_last_state(spark, obs, tmp_path, monkeypatch):
    from nephos.sources import store as module

    monkeypatch.setattr(module, "STATE_EVERY", 3)
    store = ObservationStore(spark, str(tmp_path / "store"))
    for name in "abcd":
        store.add(placed(obs.limit(1), name))
    store.delete("b")
    assert store.log.get(3)["state"]["live"].keys() == set("abc") and store.log.get(4).get("state") is None
    assert sorted(r["ingest_file"] for r in store.read().collect()) == ["a", "c", "d"] and sorted(r["ingest_file"] for r in store.read(2).collect()) == ["a", "b"]


def test_files_that_cannot_hold_rows_are_skipped(spark, tmp_path):
    import random

    rng = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    rows = [("I", "Q", t0 + dt.timedelta(minutes=rng.randrange(40_000)), rng.uniform(-180, 180), rng.uniform(-90, 90), 0.0, "height", float(i), 0.1, 0, None, f"raw{i // 500}", None, f"f{i // 2000}", 0.0, 0.0) for i in range(8000)]
    columns = [*schema.OBS_SCHEMA.fieldNames(), "ingest_file", "x", "y"]
    kinds = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in schema.OBS_SCHEMA.fields), "ingest_file string", "x double", "y double"])
    df = spark.createDataFrame([dict(zip(columns, r, strict=True)) for r in rows], kinds)
    store = ObservationStore(spark, str(tmp_path / "store"), rows_per_file=50)
    store.add(df)
    total = store.files().count()
    assert total >= 160 and store.files().agg(F.sum("n_rows")).first()[0] == 8000
    span = {"start": t0 + dt.timedelta(days=3), "end": t0 + dt.timedelta(days=6), "box": (0.0, 0.0, 60.0, 90.0)}
    want = sorted(r[7] for r in rows if span["start"] <= r[2] <= span["end"] and 0 <= r[4] <= 60 and 0 <= r[3] <= 90)
    assert sorted(r["value"] for r in store.select(**span).collect()) == want and want
    assert store.files(**span).count() <= total / 5
    assert sorted(r["value"] for r in store.find("raw7").collect()) == [float(i) for i in range(3500, 4000)]
    assert store.files(orig_filename="raw7").count() <= total / 4 + 8 and store.files(orig_filename="nowhere").count() <= total / 10 and store.find("nowhere") is None
    assert len(store.select(**span).inputFiles()) == store.files(**span).count()


def test_classic_files_there_and_back():
    import io

    import numpy as np

    from nephos.sources import classic

    rng = np.random.default_rng(3)
    arrays = {
        "t": (("t",), np.arange(3.0), {"units": "hours since 2024-01-01 06:00:00"}),
        "T": (("t", "z", "x"), rng.normal(size=(3, 2, 5)).astype(np.float32), {"_FillValue": np.float32(-9.0)}),
        "odd": (("t", "x"), rng.integers(-100, 100, (3, 5)).astype(np.int8), {}),
        "x": (("x",), np.arange(5, dtype=np.int16), {"scale_factor": 0.5, "add_offset": 10.0}),
        "name": (("z", "text"), np.array([list("ab "), list("c  ")], "S1"), {}),
    }
    arrays["T"][1][1, 0, 2] = -9.0
    sizes = {"t": None, "z": 2, "x": 5, "text": 3}
    file = classic.parse(io.BytesIO(classic.encode(sizes, arrays, {"title": "a test", "n": np.array([1, 2], np.int32)})))
    assert file.sizes == {"t": 3, "z": 2, "x": 5, "text": 3} and file.attributes["title"] == "a test" and file.attributes["n"].tolist() == [1, 2]
    for name, (dims, values, _) in arrays.items():
        assert file.variables[name].dims == dims and (file.read(name) == values).all() and file.read(name).dtype.itemsize == values.dtype.itemsize
    assert (file.read("T", 2) == arrays["T"][1][2]).all() and np.isnan(file.floats("T")[1, 0, 2])
    assert file.floats("x").tolist() == [10, 10.5, 11, 11.5, 12] and file.texts("name") == ["ab", "c"]
    assert [t.hour for t in file.times("t")] == [6, 7, 8]
    one = classic.parse(io.BytesIO(classic.encode({"t": None, "x": 3}, {"b": (("t", "x"), np.arange(6, dtype=np.int8).reshape(2, 3), {})})))
    assert one.read("b").tolist() == [[0, 1, 2], [3, 4, 5]] and one.record_bytes == 3
    for wrong in (b"CDF", b"CDF\3" + bytes(40), b"\x89HDF\r\n\x1a\n" + bytes(40)):
        with pytest.raises((ValueError, Exception)):
            classic.parse(io.BytesIO(wrong))


def test_grid_files_need_their_members(spark, tmp_path):
    import numpy as np

    from nephos.sources import classic, netcdf

    values = np.arange(12.0).reshape(2, 2, 3)
    variables = {"t": (("t",), np.array([0.0, 60.0]), {"units": "minutes since 2024-01-01 00:00:00"}), "P": (("t", "y", "x"), values, {})}
    (tmp_path / "p.nc").write_bytes(classic.encode({"t": None, "y": 2, "x": 3}, variables))
    rows = netcdf.read_grid(spark, str(tmp_path / "p.nc"), ["P"]).collect()
    assert len(rows) == 12 and all(r["member"] is None and r["profile"] == [values[r["t_idx"], r["iy"], r["ix"]]] and r["levels"] == [0.0] for r in rows)
    with pytest.raises(Exception, match="no dimension member"):
        netcdf.read_grid(spark, str(tmp_path / "p.nc"), ["P"], require_member=True).collect()
    (tmp_path / "h.nc").write_bytes(b"\x89HDF\r\n\x1a\n" + bytes(100))
    with pytest.raises(Exception, match="netCDF4"):
        netcdf.read_grid(spark, str(tmp_path / "h.nc"), ["P"]).collect()


def test_frames_come_once(spark, tmp_path):
    from nephos.sources.store import write_grid

    rows = spark.createDataFrame([(1, 0, 2.0)], "cycle int, t_idx int, mean double")
    write_grid(rows, str(tmp_path / "g"), "cycle", time="t_idx")
    with pytest.raises(ValueError, match="already holds"):
        write_grid(rows, str(tmp_path / "g"), "cycle", time="t_idx")
    write_grid(rows.withColumn("t_idx", F.lit(1)), str(tmp_path / "g"), "cycle", time="t_idx")
    assert spark.read.parquet(str(tmp_path / "g")).count() == 2


def test_two_writers_of_a_ledger_lose_nothing(tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    def one(m):
        workflow.Ledger(tmp_path / "s.json", 40).advance(m, "2024-01-01 00:00:00", "2024-01-01 00:10:00", 600)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(one, range(40)))
    ledger = workflow.Ledger(tmp_path / "s.json", 40)
    assert ledger.data["advanced"] == list(range(40)) and len(ledger.data["runs"]) == 40
    ledger.forget(0)
    assert ledger.data["runs"] == []
    with pytest.raises(ValueError, match="no member 40"):
        ledger.advance_all([(1, "", "", 1), (40, "", "", 1)])


class StubVariable:
    """As much of a netCDF4 variable as the reader uses."""

    def __init__(self, dims, values, units=""):
        self.dimensions, self.values, self.units, self.shape = dims, values, units, values.shape

    def __getitem__(self, at):
        return self.values[at]


class StubLibrary:
    """netCDF4 with one open file."""

    def __init__(self, variables):
        self.found = variables

    def Dataset(self, path):
        self.opened = path
        return self

    variables = {}

    def ncattrs(self):
        return ["product_name"]

    def getncattr(self, name):
        return "PACE"

    def __getitem__(self, path):
        return self.found[path]

    def num2date(self, numbers, units, only_use_cftime_datetimes):
        import numpy as np

        start = dt.datetime.fromisoformat(units.split("since ")[1])
        found = [start + dt.timedelta(hours=float(x)) for x in np.atleast_1d(numbers)]
        return found[0] if np.ndim(numbers) == 0 else found

    def chartostring(self, chars):
        return ["".join(c.decode() for c in row) for row in chars]


def test_grouped_files_through_a_library():
    import numpy as np

    from nephos.sources.netcdf import Hierarchical

    masked = np.ma.masked_equal(np.array([[1.0, -9.0], [3.0, 4.0]]), -9.0)
    library = StubLibrary({"geo/v": StubVariable(("a", "b"), masked), "geo/t": StubVariable(("a",), np.array([0.0, 2.0]), "hours since 2024-01-01T00:00:00"), "name": StubVariable(("a", "n"), np.array([list("ab"), list("c ")], "S1"))})
    file = Hierarchical(library, "file:/data/x.nc")
    assert library.opened == "/data/x.nc" and file.attributes == {"product_name": "PACE"}
    assert file.dims("geo/v") == ("a", "b") and file.shape(file.name("geo/v")) == (2, 2)
    assert np.isnan(file.floats("geo/v")[0, 1]) and file.floats("geo/v", 1).tolist() == [3.0, 4.0]
    assert file.epoch("geo/t", np.array([0.0, 2.0])).tolist() == [1_704_067_200.0, 1_704_074_400.0]
    assert file.times("geo/t")[1] == dt.datetime(2024, 1, 1, 2) and file.texts("name") == ["ab", "c"]


def test_moments_grow_by_arrivals(spark, tmp_path):
    import random
    import statistics

    from nephos.sources.moments import MomentStore

    rng = random.Random(8)
    values = {(x, m): 1e6 + rng.gauss(0, 1) for x in range(3) for m in range(6)}
    frame = lambda members: spark.createDataFrame([("T", 0, x, 0, 0, m, v) for (x, m), v in values.items() if m in members] + [("T", 0, 9, 0, 0, m, None) for m in members], "var string, t_idx int, ix int, iy int, iz int, member int, value double")
    one, two = (MomentStore(spark, str(tmp_path / "m")) for _ in range(2))
    assert one.read().count() == 0 and not one.compact()
    assert one.merge(frame([0])) == [0]
    (first,) = [r for r in one.read().collect() if r["ix"] == 0]
    assert (first["n"], first["mean"], first["sd"]) == (1, values[0, 0], None)
    assert two.merge(frame([0, 1, 2])) == [1, 2] and one.merge(frame([2])) == []
    assert one.compact() and two.merge(frame([4])) == [4] and one.members() == [0, 1, 2, 4] and one.missing(range(6)) == [3, 5]
    for r in one.read().collect():
        want = [values[r["ix"], m] for m in (0, 1, 2, 4)] if r["ix"] < 3 else []
        assert r["n"] == len(want)
        if want:
            assert r["mean"] == pytest.approx(statistics.fmean(want)) and r["sd"] == pytest.approx(statistics.stdev(want), rel=1e-6)
        else:
            assert r["mean"] is None and r["sd"] is None


def test_an_arrival_that_lost_the_race_takes_the_next_number(spark, tmp_path, monkeypatch):
    from nephos.sources.moments import MomentStore

    frame = lambda *members: spark.createDataFrame([("T", 0, 0, 0, 0, m, float(m)) for m in members], "var string, t_idx int, ix int, iy int, iz int, member int, value double")
    mine, other = (MomentStore(spark, str(tmp_path / "m")) for _ in range(2))
    put = mine.log.put
    raced = []

    def late(version, commit):
        if not raced:
            raced.append(other.merge(frame(1, 2)))
        return put(version, commit)

    monkeypatch.setattr(mine.log, "put", late)
    assert mine.merge(frame(2, 3)) == [3] and raced == [[1, 2]]
    (row,) = mine.read().collect()
    assert (row["n"], row["mean"]) == (3, 2.0) and mine.members() == [1, 2, 3]


def test_many_new_values_are_not_counted_first(spark, tmp_path, monkeypatch):
    from nephos.sources import store

    asked, whole = [], store.small
    monkeypatch.setattr(store, "BROADCAST_ROWS", 2, raising=False)
    monkeypatch.setattr(store, "small", lambda df: asked.append("_new" in df.columns) or whole(df))
    table = ObservationStore(spark, f"file://{tmp_path}/t")
    table.add(spark.range(6).selectExpr("id AS obs_id", "'f' AS ingest_file", "'i' AS instrument"))
    for n, want in ((2, [True]), (6, [])):
        table.update(spark.range(n).selectExpr("id AS obs_id", "id * 2.0D AS value"), "model_forecast", clear=True)
        asked.clear()
        got = {r["obs_id"]: r["model_forecast"] for r in table.read().collect()}
        assert got == {i: i * 2.0 if i < n else None for i in range(6)} and [a for a in asked if a] == want
