import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nephos.functions import columns as C
from nephos.functions import profiles
from nephos.functions.projection import LambertConformal, project


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_")).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("i", "text"), [(1, "AAA"), (26, "AAZ"), (27, "ABA"), (28, "ABB"), (53, "ACA"), (676, "AZZ"), (677, "BAA"), (17576, "ZZZ")])
def test_letter_numeral(spark, i, text):
    assert one(spark, C.letter_numeral(F.col("i")), i=i) == text


@pytest.mark.parametrize("i", [0, 17577])
def test_letter_numeral_out_of_range(spark, i):
    with pytest.raises(Exception, match="letter numerals"):
        one(spark, C.letter_numeral(F.col("i")), i=i)


def test_floor_div_rounds_down(spark):
    assert [one(spark, C.floor_div(F.col("x0"), 5), x0=v) for v in (-7, 7, -5)] == [-2.0, 1.0, -1.0]


def test_wraps(spark):
    assert [one(spark, C.wrap_180(F.col("v")), v=v) for v in (180.0, -180.0, 359.0, 540.0)] == [-180.0, -180.0, -1.0, -180.0]
    assert [one(spark, C.wrap_360(F.col("v")), v=v) for v in (-1.0, 360.0, 0.0)] == [359.0, 0.0, 0.0]


def test_sentinels_become_null(spark):
    assert one(spark, C.null_if_missing(F.col("v")), v=-999.0) is None
    assert one(spark, C.null_if_missing(F.col("v")), v=float("nan")) is None
    assert one(spark, C.null_if_missing(F.col("v")), v=0.5) == 0.5


def test_cut_is_right_closed_without_its_lowest_edge(spark):
    label = C.cut(F.col("v"), [0.0, 1.0, 2.0], ["a", "b"])
    assert [one(spark, label, v=v) for v in (0.0, 0.5, 1.0, 2.0, 2.1)] == [None, "a", "a", "b", None]


def test_histogram_and_equal_bins_at_their_ends(spark):
    h = C.histogram_bin(F.col("v"), F.lit(0.0), F.lit(10.0), 5)
    assert [one(spark, h, v=v) for v in (0.0, 2.0, 10.0)] == [0, 1, 4]
    e = C.equal_width_bin(F.col("v"), F.lit(0.0), F.lit(10.0), 5)
    assert [one(spark, e, v=v) for v in (0.0, 2.0, 2.1, 10.0)] == [0, 0, 1, 4]


def test_metadata_pairs_skip_nested_and_bad_json(spark):
    assert one(spark, C.metadata_pairs(F.col("m")), m='{"a": 1, "b": {"c": 2}, "d": [1], "e": "x"}') == "a=1|e=x"
    assert one(spark, C.metadata_pairs(F.col("m")), m="not json") == ""


def test_error_models_keep_null(spark):
    for f in (C.relative_floor_error, C.land_ocean_error, C.clipped_error, C.backscatter_error):
        assert spark.range(1).select(f(F.lit(None).cast("double")).alias("x")).first()["x"] is None


def profile(spark, levels, values, at):
    return one(spark, profiles.interpolate(F.col("l"), F.col("v"), F.col("z")), l=levels, v=values, z=at)


def test_profile_interpolation(spark):
    levels, values = [0.0, 10.0, 20.0], [1.0, 2.0, 4.0]
    assert [profile(spark, levels, values, z) for z in (-5.0, 0.0, 5.0, 15.0, 20.0, 30.0)] == [1.0, 1.0, 1.5, 3.0, 4.0, 4.0]
    assert profile(spark, [20.0, 0.0, 10.0], [4.0, 1.0, 2.0], 5.0) == 1.5
    assert profile(spark, levels, [1.0, float("nan"), 4.0], 10.0) == 2.5
    assert profile(spark, levels, [1.0, float("nan"), float("nan")], 10.0) is None
    assert profile(spark, [0.0, 10.0, 10.0], [1.0, 2.0, 3.0], 10.0) == 2.0


@given(st.floats(-170, 170), st.floats(-70, 80))
@settings(max_examples=8, deadline=None)
def test_projection_there_and_back(spark, lon, lat):
    crs = LambertConformal(30.0, 60.0, 40.0, 5.0)
    df = project(spark.createDataFrame([(lon, lat)], "longitude double, latitude double"), crs)
    back = df.select(*[c.alias(n) for c, n in zip(crs.inverse(F.col("x"), F.col("y")), "ab", strict=True)]).first()
    assert math.isclose(back["a"], lon, abs_tol=1e-6) and math.isclose(back["b"], lat, abs_tol=1e-6)


def test_mantissa_bits_bound_the_error_and_shrink_files(spark, tmp_path):
    import numpy as np

    from nephos.sources import quantise

    rng = np.random.default_rng(2)
    x = (rng.normal(size=20_000) * 10.0 ** rng.integers(-20, 20, 20_000)).astype(np.float32)
    for digits in (1, 2, 3, 5):
        bits = quantise.bits_for(digits)
        kept = quantise.keep_bits(x, bits)
        assert (np.abs(kept.astype(np.float64) - x) <= 0.5 * 10.0 ** (1 - digits) * np.abs(x.astype(np.float64)) / 10).all()
        assert not (kept.view(np.uint32) & np.uint32((1 << (23 - bits)) - 1)).any()
    odd = np.array([0.0, -0.0, np.nan, np.inf, -np.inf, np.float32(3.4e38), 1.0], np.float32)
    got = quantise.keep_bits(odd, 5)
    assert np.array_equal(got[[0, 1, 3, 4, 6]], odd[[0, 1, 3, 4, 6]]) and np.isnan(got[2]) and np.isfinite(got[5])
    assert quantise.rule_for("QVAPOR", {"T": 3, "Q.*": 2}) == 2 and quantise.rule_for("TT", {"T": 3}) is None
    rows = spark.createDataFrame([("T", float(v)) for v in rng.normal(280, 20, 30_000)] + [("P", 1.5), (None, 2.5), ("T", None)], "var string, value double").coalesce(1)
    sizes = []
    for name, rules in (("plain", {}), ("few", {"T": 3})):
        quantise.write_quantised(rows.withColumn("cycle", F.lit(1)), str(tmp_path / name), rules, "cycle")
        sizes.append(sum(p.stat().st_size for p in (tmp_path / name).rglob("*.parquet")))
    assert sizes[1] < 0.6 * sizes[0]
    back = spark.read.parquet(str(tmp_path / "few"))
    assert back.count() == 30_003 and back.where("var = 'P'").first()["value"] == 1.5 and back.where("value IS NULL").count() == 1

