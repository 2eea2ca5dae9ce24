"""Whitening against plain numpy: exact sums, eigen-solve, identity, defined cases."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nephos.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def brute(rows, most=8):
    """{(id, component): (n, deviation, whitened, explained)} by integers and LAPACK, for distinct ids."""
    kept = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if v is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    y = (n * x - sums).astype(np.float64) / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    out = {}
    for k in range(min(most, len(v))):
        e, u = values[-1 - k], vectors[:, -1 - k]
        for (i, _), row, dev in zip(kept, y, n * x - sums, strict=True):
            out[i, k + 1] = (n, sum(int(d) ** 2 for d in dev), float(row @ u) / math.sqrt(e), e / v.trace())
    return out


def same(got, want):
    assert {(r["vec_id"], r["component"]) for r in got} == set(want)
    signs = {}
    for r in got:
        n, dev, white, share = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, dev)
        assert r["explained"] == pytest.approx(share, rel=1e-9)
        assert abs(r["whitened"]) == pytest.approx(abs(white), abs=1e-7)
        if abs(white) > 1e-3:
            assert signs.setdefault(r["component"], math.copysign(1, white * r["whitened"])) == math.copysign(1, white * r["whitened"])
        assert r["identity_error"] < 1e-8


def test_random_vectors_match_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=12) @ np.diag(np.arange(1, 13))).tolist()) for i in range(200)]
    same(whitening.whiten(table(spark, rows).repartition(5)).collect(), brute(rows))


def test_hard_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(30)] + [(90, None), (91, [1.0, None, 2.0]), (92, [float("nan"), 0.0, 0.0]), (93, [float("-inf"), 0.0, 0.0]), (94, [])]
    want = brute(rows)
    rows += [(95, [1.0, 2.0]), (96, [1e30, 0.0, 0.0])]
    wide = table(spark, rows)
    from pyspark.sql import functions as F

    from tests.llm.helpers import with_clashing_columns

    same(whitening.whiten(with_clashing_columns(wide).withColumns({"vector": F.lit("x"), "part": F.lit(1), "n": F.lit(2)})).collect(), want)
    again = whitening.whiten(wide.unionByName(table(spark, [(None, rows[0][1]), (0, rows[0][1])]))).where("component = 1").collect()
    assert len(again) == 32 and len({r["whitened"] for r in again if r["vec_id"] in (None, 0)}) == 1


def test_no_spread_and_empty(spark):
    (row,) = whitening.whiten(table(spark, [(1, [2.0])])).collect()
    assert (row["n"], row["deviation"], row["whitened"], row["explained"], row["identity_error"]) == (1, 0, None, None, None)
    flat = whitening.whiten(table(spark, [(i, [float(i), float(i), 1.0]) for i in range(5)])).collect()
    assert [r["whitened"] is None for r in sorted(flat, key=lambda r: (r["vec_id"], r["component"]))[:3]] == [False, True, True]
    assert whitening.whiten(table(spark, [])).count() == 0


@given(st.integers(1, 9), st.integers(0, 10**6), st.sampled_from(["random", "low rank", "repeated"]))
@settings(max_examples=60, deadline=None)
def test_eigen_solve(d, seed, kind):
    rng = np.random.default_rng(seed)
    b = rng.normal(size=(d, 1 if kind == "low rank" else d))
    a = np.eye(d) * 3.0 if kind == "repeated" else b @ b.T
    values, vectors = whitening.symmetric_qr(a)
    scale = max(np.abs(a).max(), 1.0)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-12 * scale)
    assert np.allclose(vectors @ vectors.T, np.eye(d), atol=1e-13 * d)
    assert np.allclose(vectors.T @ np.diag(values) @ vectors, a, atol=1e-12 * scale)


@given(st.lists(st.integers(1, 6), min_size=1, max_size=5), st.integers(0, 10**6))
@settings(max_examples=60, deadline=None)
def test_merged_moments_are_those_of_all_rows(sizes, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(99_000, 101_000, size=(sum(sizes), 4)).astype(float)
    total, at = whitening.Moments(4), 0
    for n in sizes:
        part = whitening.Moments(4)
        for row in x[at : at + n]:
            part.add(row)
        total.merge(part.n, part.sums, part.mean, part.m2)
        at += n
    centred = x - x.mean(axis=0)
    assert total.n == len(x) and np.allclose(total.m2, centred.T @ centred, atol=1e-5)


def test_deviations_beyond_a_long():
    assert whitening.deviations(np.array([[2**31, 0], [3, 4]], dtype=object)) == [2**62, 25]
    assert whitening.deviations(np.array([[2**40, 2**40]])) == [None]


def test_query_on_the_test_data(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    same(queries.queries()["op13_embedding_whitening"](spark, sf_dir).collect(), brute(rows))
