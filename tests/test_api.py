import datetime as dt

import pytest
from pyspark.sql import functions as F

from nephos import api, schema
from nephos.adapters import ensemble_grid, model_frames, observations
from nephos.functions.columns import metadata_values
from nephos.functions.projection import LambertConformal
from nephos.operators.cycles import Calendar, file_info
from nephos.plans.interpolation import interpolate_model
from nephos.sources import netcdf
from nephos.sources.store import ObservationStore

T0 = dt.datetime(2024, 1, 1)
CRS = LambertConformal(30.0, 60.0, 45.0, 0.0)


@pytest.fixture()
def files(spark, tmp_path):
    def row(i, lon):
        return ("I", "Q", T0 + dt.timedelta(minutes=i), lon, 45.0, 10.0, "height", float(i), 0.5, 0, ([i // 4, i % 4], [100, 4], ["profile", "bin"]), "raw", None)

    rows = [row(i, 0.0 if i < 20 else 80.0) for i in range(40)]
    spark.createDataFrame(rows, schema.OBS_SCHEMA).coalesce(1).write.parquet(str(tmp_path / "obs"))
    return str(tmp_path / "obs")


def test_ingest_trims_reduces_and_is_repeatable(spark, files, tmp_path):
    store = ObservationStore(spark, str(tmp_path / "store"))
    domain = api.Domain(CRS, (-1e6, 1e6), (-1e6, 1e6), T0, T0 + dt.timedelta(minutes=30))
    reduction = api.Reduction(superobs={"I.Q": ({"profile": 2}, {"bin": 4})})
    for _ in range(2):
        api.add_observations(spark, store, [files], domain, reduction=reduction)
    rows = store.read().collect()
    assert sorted(r["value"] for r in rows) == [3.5, 11.5, 17.5]
    api.add_observations(spark, store, [files], domain, ignore=["I.Q"])


def test_cycles_to_files(spark, tmp_path, sf_dir):
    plan = Calendar(T0, T0 + dt.timedelta(hours=12), 360).frame(spark)
    factors = spark.createDataFrame([("click", "AOD_550nm", 2.0)], "instrument string, quantity string, factor double")
    back = api.prepare_cycles(plan, observations(spark, sf_dir), 600, ["click"], factors, str(tmp_path / "c"))
    text = spark.read.option("header", True).csv(str(tmp_path / "c" / "filter_input"))
    assert text.count() == back.where("qc_flag = 0 AND value IS NOT NULL").count()
    assert len(text.columns) == 14
    totals = api.cycle_totals(file_info(plan, observations(spark, sf_dir), 60, ["click"])).first()
    assert 0 <= totals["percent"] <= 100


def test_member_equivalents_differ_by_member(spark, sf_dir):
    grid = model_frames(spark)
    both = grid.withColumn("member", F.lit(0)).unionByName(grid.withColumns({"member": F.lit(1), "profile": F.transform("profile", lambda v: v + 1)}))
    obs = observations(spark, sf_dir).limit(50)
    axes = ((0.0, 200_000.0, 19), (0.0, 200_000.0, 10))
    one = {r["obs_id"]: r["model"] for r in interpolate_model(obs, grid, *axes).collect()}
    rows = api.interpolate_members(obs, both, *axes).collect()
    assert len(rows) == 100
    assert all(abs(r["value"] - one[r["obs_id"]] - r["member"]) < 1e-9 for r in rows)


def test_departure_report(spark, sf_dir, tmp_path):
    out = api.analyse_first_departures(observations(spark, sf_dir), str(tmp_path / "r"), ["click.HLOS_WIND"], regimes=([0.0, 50.0], ["low"]))
    assert out["statistics"].count() == 1 and out["regimes"].count() <= 1
    assert spark.read.option("header", True).csv(str(tmp_path / "r" / "statistics")).count() == 1
    with pytest.raises(ValueError, match="no rows"):
        api.analyse_first_departures(observations(spark, sf_dir), pairs=["x.y"])


def test_postprocess_appends_by_cycle(spark, sf_dir, tmp_path):
    for c in (0, 1):
        api.postprocess(ensemble_grid(spark, sf_dir), str(tmp_path / "g"), c, last_only=True)
    back = spark.read.parquet(str(tmp_path / "g"))
    assert {r["cycle"] for r in back.select("cycle").distinct().collect()} == {0, 1} and dict(back.dtypes)["mean"] == "float"


def test_sequence_files_of_cycles(spark, tmp_path):
    plan = Calendar(T0, T0 + dt.timedelta(hours=12), 360).frame(spark)
    groups = spark.createDataFrame([("g", "a", T0, T0 + dt.timedelta(hours=5)), ("g", "b", T0 + dt.timedelta(hours=8), T0 + dt.timedelta(hours=13))], "group string, path string, start_date timestamp_ntz, end_date timestamp_ntz")
    found = api.files_of_cycles(groups, plan, 90, str(tmp_path / "f")).collect()
    assert sorted((r["cycle_index"], r["path"]) for r in found) == [(0, "a"), (1, "b")]


def test_declared_metadata_must_be_there(spark):
    df = spark.createDataFrame([('{"a": 1}',)], "m string")
    assert df.select(*metadata_values(F.col("m"), ["a"])).first()["a"] == "1"
    with pytest.raises(Exception, match="lacks b"):
        df.select(*metadata_values(F.col("m"), ["b"])).collect()


def test_static_fields_are_split_off(spark):
    grid = spark.createDataFrame([("h", t, 0, 0, [1.0]) for t in (0, 1)] + [("T", t, 0, 0, [float(t)]) for t in (0, 1)], "var string, t_idx int, iy int, ix int, profile array<double>").withColumn("t", F.current_timestamp())
    varying, fixed = netcdf.split_static(grid)
    assert {r["var"] for r in varying.collect()} == {"T"} and [r["var"] for r in fixed.collect()] == ["h"]


def test_gridded_files_need_a_reader(spark, tmp_path):
    (tmp_path / "x.nc").write_bytes(b"CDF")
    with pytest.raises(Exception):
        netcdf.read_grid(spark, str(tmp_path / "x.nc"), ["T"]).collect()


def test_pairs_keep_the_asked_order(spark, sf_dir):
    obs = observations(spark, sf_dir)
    asked = ["view.HLOS_WIND", "click.AOD_550nm", "view.HLOS_WIND", "error.AOD_550nm"]
    assert api.requested_pairs(obs, asked) == ["view.HLOS_WIND", "click.AOD_550nm", "error.AOD_550nm"]
    rows = api.analyse_first_departures(obs, pairs=asked)["statistics"].collect()
    assert [f"{r['instrument']}.{r['quantity']}" for r in rows] == ["view.HLOS_WIND", "click.AOD_550nm", "error.AOD_550nm"]
    with pytest.raises(ValueError, match="no rows of x.y"):
        api.requested_pairs(obs, ["click.AOD_550nm", "x.y"])

