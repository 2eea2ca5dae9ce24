import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from nephos.operators import cycles, ensemble, filters, joins, nearest, superobs, validation

T0 = dt.datetime(2024, 1, 1)
OBS = "obs_id long, ingest_file string, instrument string, quantity string, time timestamp_ntz, longitude double, latitude double, x double, y double, z double, z_type string, value double, value_uncertainty double, qc_flag int, orig_filename string, metadata string, c int, d int"


def obs(spark, rows):
    """(minute, value, uncertainty, flag, c) rows."""
    return spark.createDataFrame([(i, "f", "I", "Q", T0 + dt.timedelta(minutes=m), 1.0, 2.0, 3.0, 4.0, 5.0, "height", v, u, q, "raw", '{"a": 1}', c, 0) for i, (m, v, u, q, c) in enumerate(rows)], OBS)


def test_superob_of_one_row_counts_its_error_twice(spark):
    row = superobs.grid_superobs(obs(spark, [(0, 2.0, 0.5, 0, 0)]), {"c": 2}, {"d": 1}).first()
    assert row["n"] == 1 and math.isclose(row["value_uncertainty"], math.sqrt(2) * 0.5) and row["qc_flag"] == 0


def test_superob_prefers_good_rows_and_divides_by_all_of_them(spark):
    df = obs(spark, [(0, 1.0, 0.3, 0, 0), (1, 3.0, None, 0, 1), (2, 9.0, 9.0, 1, 0)])
    row = superobs.grid_superobs(df, {"c": 2}, {"d": 1}).first()
    assert (row["n"], row["value"], row["qc_flag"]) == (2, 2.0, 0)
    assert math.isclose(row["instrument_error"], 0.3 / math.sqrt(2)) and math.isclose(row["repr_error"], math.sqrt(2))
    assert row["time"] == T0 + dt.timedelta(seconds=30)
    whole = superobs.grid_superobs(df, {"c": 2}, {"d": 1}, reduce_instrument_error=False).first()
    assert math.isclose(whole["instrument_error"], 0.3)


def test_superob_without_good_rows_uses_all_and_is_flagged(spark):
    row = superobs.grid_superobs(obs(spark, [(0, 1.0, 0.3, 3, 0), (1, 3.0, 0.3, 2, 1)]), {"c": 2}, {"d": 1}).first()
    assert (row["n"], row["qc_flag"], row["value"]) == (2, 1, 2.0)


def test_time_bin_leaves_out_missing_errors(spark):
    df = obs(spark, [(0, 1.0, None, 0, 0), (70, 3.0, 0.4, 0, 0), (75, 5.0, None, 0, 0)])
    rows = superobs.time_superobs(df, 60).orderBy("bin_start").collect()
    assert [r["n"] for r in rows] == [1, 2]
    assert rows[0]["value_uncertainty"] is None
    assert math.isclose(rows[1]["value_uncertainty"], math.sqrt(0.4**2 + 2))


@pytest.mark.parametrize(("minutes", "offset"), [(60, -30), (50, 0), (7, 3)])
def test_time_bins_start_at_the_first_rows_midnight(spark, minutes, offset):
    df = obs(spark, [(m, float(m), 0.1, 0, 0) for m in (5, 40, 100, 1500)])
    starts = {r["bin_start"] for r in superobs.time_superobs(df, minutes, offset).collect()}
    want = {T0 + dt.timedelta(minutes=offset + (m - offset) // minutes * minutes) for m in (5, 40, 100, 1500)}
    assert starts == want


@pytest.mark.parametrize("n", [1, 3])
def test_stride_keeps_every_nth_good_row(spark, n):
    rows = superobs.stride_thin(obs(spark, [(m, 1.0, 0.1, 1 if m == 2 else 0, 0) for m in range(8)]), n).collect()
    good = sorted(r["time"] for r in rows if r["qc_flag"] == 0)
    assert len(rows) == 8 and len(good) == math.ceil(7 / n) and sum(r["qc_flag"] == 1 for r in rows) == 1


def test_density_steps_exclude_each_other(spark):
    with pytest.raises(ValueError, match="both"):
        superobs.reduce_density(obs(spark, []), {"I.Q": ({"c": 2}, {"d": 1})}, {"I.Q": (60, 0)}, {})


def test_superob_metadata_merges_json(spark):
    merged = superobs.with_superob_metadata(F.lit('{"a": 1}'), F.lit(2), F.lit(0.5), F.lit(0.25))
    text = spark.range(1).select(merged.alias("m")).first()["m"]
    assert '"a":"1"' in text and "n_contributing" in text


def test_trim_of_one_dimension_keeps_the_whole_file(spark):
    df = obs(spark, [(0, 1.0, 0.1, 0, 0), (1, 2.0, 0.1, 0, 1)])
    out = filters.trim_groups(df, F.col("c") == 0, F.array("c"), F.array(F.lit(2))).orderBy("obs_id").collect()
    assert [r["value"] for r in out] == [1.0, None]


def test_trim_drops_groups_outside(spark):
    df = obs(spark, [(0, 1.0, 0.1, 0, c) for c in range(4)]).withColumn("d", F.col("c") % 2)
    out = filters.trim_groups(df, F.col("c") == 3, F.array("c", "d"), F.array(F.lit(4), F.lit(2))).collect()
    assert {r["c"] for r in out} == {3}


def test_filter_checks_its_bounds(spark):
    for bad in ({"min_lat": 91}, {"min_lon": 10, "max_lon": 5}):
        with pytest.raises(ValueError):
            filters.within(obs(spark, []), **bad)


def test_calendar_overrides_clamp_and_extension():
    plan = cycles.Calendar(T0, T0 + dt.timedelta(hours=14), 360, 120, {1: cycles.CycleOptions(duration=60, output_interval=5)})
    got = [(c.index, (c.start - T0).seconds // 3600, (c.end - T0).seconds // 3600, (c.forecast_end - T0).seconds // 3600, c.output_interval) for c in plan.cycles()]
    assert got == [(0, 0, 6, 8, None), (1, 6, 7, 9, 5), (2, 7, 13, 14, None), (3, 13, 14, 14, None)]


def test_boundary_row_counts_in_both_cycles(spark):
    plan = cycles.Calendar(T0, T0 + dt.timedelta(hours=12), 360).frame(spark)
    out = cycles.summary(plan, obs(spark, [(360, 1.0, 0.1, 0, 0)]), 30, ["I"]).orderBy("cycle_index").collect()
    assert [(r["total"], r["in_window"]) for r in out] == [(1, 1), (1, 0)]


def test_overlap_counts_a_long_pair_once(spark):
    one = spark.createDataFrame([(T0, T0 + dt.timedelta(hours=50))], "a timestamp_ntz, b timestamp_ntz")
    two = one.toDF("c", "d")
    assert joins.overlapping(one, two, ("a", "b"), ("c", "d")).count() == 1


def test_dilation_of_one_seed(spark):
    grid = spark.range(15 * 15).select(F.floor(F.col("id") / 15).cast("int").alias("p"), (F.col("id") % 15).cast("int").alias("h")).withColumn("f", F.when((F.col("p") == 7) & (F.col("h") == 7), 1).otherwise(0))
    assert ensemble.dilate(grid, "f", "p", "h", 2, 3).where("dilated = 1").count() == 35


def test_smoothing_keeps_a_constant(spark):
    flat = spark.range(30).select(F.lit(0).alias("m"), F.col("id").cast("int").alias("ix"), F.lit(4.0).alias("value"))
    assert all(math.isclose(r["value"], 4.0) for r in ensemble.smooth_axis(flat, "ix", 30, 2.5, ["m", "ix"]).collect())


def test_perturbation_fields_have_the_wanted_moments(spark):
    stats = ensemble.perturbation_fields(spark, 2, 20, 20, 1.5, 0.2, seed=1).groupBy("member").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s")).collect()
    assert len(stats) == 2 and all(math.isclose(r["m"], 1.5, abs_tol=1e-9) and math.isclose(r["s"], 0.2, abs_tol=1e-9) for r in stats)


def test_null_corner_gives_null(spark):
    grid = spark.createDataFrame([(t, x, y, [None if (t, x, y) == (1, 1, 1) else 1.0]) for t in (0, 1) for x in (0, 1) for y in (0, 1)], "t_idx int, ix int, iy int, profile array<double>")
    points = spark.createDataFrame([(1, 0.5, 0.5, 0, 1, 0.5), (2, 0.5, 0.5, 0, 0, 0.0)], "obs_id int, x double, y double, left_idx int, right_idx int, t_weight double")
    got = {r["obs_id"]: r["profile"][0] for r in joins.gather_corners(points, grid, (0.0, 1.0, 2), (0.0, 1.0, 2)).collect()}
    assert got == {1: None, 2: 1.0}


def test_check_one_shape(spark):
    df = spark.createDataFrame([(([1], [2], ["row"]),)], "orig_coords struct<indices: array<int>, shape: array<int>, names: array<string>>")
    assert ensemble.check_one_shape(df) == ([2], ["row"])
    with pytest.raises(ValueError):
        ensemble.check_one_shape(df.limit(0))


def scans(df):
    """Scans of the source in the plan that was written, before any reuse."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_density_reduction_scans_do_not_grow_with_pairs(spark, sf_dir):
    from nephos.adapters import observations

    rows = observations(spark, sf_dir)
    pairs = [f"{i}.{q}" for i in ("click", "view", "purchase", "signup", "error") for q in ("AOD_550nm", "HLOS_WIND")]

    def plan(n):
        grids = {p: ({"c_profile": 5 + k}, {"c_bin": 2 + k}) for k, p in enumerate(pairs[:n])}
        bins = {p: (60 * (k + 1), 0) for k, p in enumerate(pairs[4 : 4 + n])}
        return superobs.reduce_density(rows, grids, bins, {p: 3 + k for k, p in enumerate(pairs[-n:])})

    assert scans(plan(1)) == scans(plan(2)) == scans(plan(4)) < 16


def test_thinning_counts_over_time_slices(spark):
    df = obs(spark, [(m, 1.0, 0.1, 0, 0) for m in range(100)]).withColumn("time", F.col("time") + F.expr("INTERVAL 7 MINUTES") * (F.col("obs_id") % 5))
    order = [r["obs_id"] for r in df.orderBy("time", "obs_id").collect()]
    kept = {r["obs_id"] for r in superobs.stride_thin(df, 7).where("qc_flag = 0").collect()}
    assert kept == set(order[::7])
    assert superobs.stride_thin(df, F.lit(None).cast("int")).where("qc_flag = 0").count() == 100


def exact_density(values, points=200):
    n = len(values)
    mean = sum(values) / n
    h = math.sqrt(sum((v - mean) ** 2 for v in values) / (n - 1)) * n**-0.2
    low, high = min(values), max(values)
    at = [low + (high - low) * k / (points - 1) for k in range(points)]
    return [sum(math.exp(-0.5 * ((x - v) / h) ** 2) for v in values) / (n * h * math.sqrt(2 * math.pi)) for x in at]


def test_density_curve_beside_an_outlier_is_the_exact_one(spark):
    import random

    rng = random.Random(1)
    values = [rng.gauss(0, 1) for _ in range(3000)] + [3_000.0]
    df = spark.createDataFrame([("i", "q", v) for v in values], "instrument string, quantity string, departure double")
    got = [r["density"] for r in validation.density_curve(df).orderBy("x").collect()]
    want = exact_density(values)
    assert len(got) == 200 and max(abs(a - b) for a, b in zip(got, want, strict=True)) < 2e-4 * max(want)


def test_quantiles_of_ties_and_small_groups(spark):
    rows = [("a", float(v)) for v in [1, 1, 1, 5, 9]] + [("b", 2.0)] + [("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: (r["lo"], r["mid"]) for r in validation.wide_quantiles(df, "v", {"lo": 0.25, "mid": 0.6}, ["k"]).collect()}
    assert got == {"a": (1.0, pytest.approx(2.6)), "b": (2.0, 2.0)}


def test_nearest_point_far_outside_and_in_ties(spark):
    grid = spark.createDataFrame([(i, j, float(i), float(j)) for i in range(12) for j in range(12)], "ix int, iy int, glon double, glat double")
    places = [(1, 0.5, 0.5), (2, -5_000.0, 3.2), (3, 11.4, 900.0), (4, 4.4, 7.6), (5, 4.4, 7.6)]
    points = spark.createDataFrame(places, "obs_id int, longitude double, latitude double")
    got = {r["obs_id"]: (r["ix"], r["iy"]) for r in nearest.nearest_point(points, grid).collect()}
    assert got == {1: (0, 0), 2: (0, 3), 3: (11, 11), 4: (4, 8), 5: (4, 8)}


def test_quad_tree_splits_and_finds_what_a_scan_finds(spark, monkeypatch):
    import random

    monkeypatch.setattr(nearest, "LEAF", 4)
    rng = random.Random(6)
    spots = [(i, 0, rng.gauss(0, 3), rng.gauss(0, 1)) for i in range(150)] + [(200 + i, 1, 50.0, 10.0) for i in range(30)] + [(300, 2, 179.5, 0.0)]
    places = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(60)] + [(100 + i, rng.gauss(0, 3), rng.gauss(0, 1)) for i in range(60)] + [(500, None, 1.0), (501, float("nan"), 0.0)]
    grid = spark.createDataFrame(spots, "ix int, iy int, glon double, glat double")
    points = spark.createDataFrame(places, "obs_id int, longitude double, latitude double")
    assert len(nearest.QuadTree(grid).levels) >= 3

    def scan(p, turns):
        return min(((p[1] + t - s[2]) * (p[1] + t - s[2]) + (p[2] - s[3]) * (p[2] - s[3]), s[0], s[1]) for s in spots for t in turns)

    for wrap, turns in ((False, (0,)), (True, (0.0, -360.0, 360.0))):
        got = {r["obs_id"]: (r["d2"], r["ix"], r["iy"]) for r in nearest.nearest_point(points, grid, wrap=wrap).collect()}
        assert got == {p[0]: scan(p, turns) if p[0] < 500 else (None, None, None) for p in places}
    plan = nearest.nearest_point(points, grid)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert {tuple(r)[1:] for r in nearest.nearest_point(points, grid.limit(0)).collect()} == {(None, None, None)}


def test_each_place_goes_through_the_tree_once(spark, monkeypatch):
    grid = spark.createDataFrame([(i, j, 170.0 + i, float(j)) for i in range(12) for j in range(12)], "ix int, iy int, glon double, glat double")
    points = spark.range(400).selectExpr("id AS obs_id", "CAST(id % 4 * 90 - 179 AS DOUBLE) AS longitude", "IF(id % 8 < 4, 0.0D, -0.0D) AS latitude")
    asked, walk = [], nearest.QuadTree.nearest

    def spy(tree, places, *how):
        asked.append(places.count())
        return walk(tree, places, *how)

    monkeypatch.setattr(nearest.QuadTree, "nearest", spy)
    for wrap, want in ((False, [(0, 349.0**2), (0, 259.0**2), (0, 169.0**2), (0, 79.0**2)]), (True, [(11, 0.0), (11, 90.0**2), (0, 169.0**2), (0, 79.0**2)])):
        got = {r["obs_id"]: (r["ix"], r["iy"], r["d2"]) for r in nearest.nearest_point(points, grid, wrap=wrap).collect()}
        assert got == {i: (want[i % 4][0], 0, want[i % 4][1]) for i in range(400)}
    assert asked == [4, 4]


def test_windows_around_an_index(spark):
    grid = spark.createDataFrame([(i, j, float(i), float(j)) for i in range(8) for j in range(6)], "ix int, iy int, glon double, glat double")
    centres = spark.createDataFrame([(1, 0, 0), (2, 4, 3)], "obs_id int, ix int, iy int")
    window = nearest.index_window(centres, grid, 2)
    got = {r["obs_id"]: r["n"] for r in window.groupBy("obs_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {1: 9, 2: 25}
    obs = spark.createDataFrame([(1, 3.0, 3.0), (2, 6.15, 3.0), (3, 6.3, 3.0)], "obs_id int, longitude double, latitude double")
    assert {r["obs_id"] for r in nearest.seen_in_window(obs, window.where("obs_id = 2")).collect()} == {1, 2}


def test_updates_of_a_repeated_key(spark):
    rows = spark.createDataFrame([(1, 0.0), (2, 0.0)], "obs_id int, m double")
    same = spark.createDataFrame([(1, 5.0), (1, 5.0)], "obs_id int, value double")
    assert sorted(map(tuple, joins.update_values(rows, same, "m").collect())) == [(1, 5.0), (2, 0.0)]
    with pytest.raises(Exception, match="several values for key 1"):
        joins.update_values(rows, same.unionAll(spark.createDataFrame([(1, 6.0)], same.schema)), "m").collect()


def test_corners_of_missing_cells_and_members(spark):
    grid = spark.createDataFrame([(0, x, y, m, [float(m), 2.0 * x]) for x in (0, 1, 2) for y in (0, 1) for m in (1, 2) if (x, y) != (2, 1)], "t_idx int, ix int, iy int, member int, profile array<double>")
    points = spark.createDataFrame([(1, 0.5, 0.0, 0, 0, 0.0), (2, 1.5, 0.0, 0, 0, 0.0)], "obs_id int, x double, y double, left_idx int, right_idx int, t_weight double")
    got = {(r["obs_id"], r["member"]): r["profile"] for r in joins.gather_corners(points, grid, (0.0, 1.0, 3), (0.0, 1.0, 2), by=["member"]).collect()}
    assert got == {(1, 1): [1.0, 1.0], (1, 2): [2.0, 1.0], (2, 1): None, (2, 2): None}


def test_noise_follows_from_key_and_seed(spark):
    from nephos.functions.columns import standard_normal

    draws = spark.range(20_000).select(standard_normal(F.col("id"), 4).alias("v"))
    stats = draws.agg(F.avg("v").alias("m"), F.stddev("v").alias("s")).first()
    assert abs(stats["m"]) < 0.03 and abs(stats["s"] - 1) < 0.03
    assert draws.repartition(7).agg(F.sum("v")).first()[0] == pytest.approx(draws.agg(F.sum("v")).first()[0])


def test_broadcast_hints_need_a_checked_size(spark):
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()
    rows = spark.range(10).withColumn("s", F.repeat(F.lit("x"), 100))
    assert hinted(joins.small(rows)) and not hinted(joins.small(rows, most_rows=9)) and not hinted(joins.small(rows, most_bytes=1000))
    assert hinted(joins.small(rows.limit(0)))
