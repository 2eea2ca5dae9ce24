"""Vertical profiles as arrays: interpolation, thickness, destaggering."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for ``body``, which runs inside higher-order functions."""
    return F.transform(F.array(value), body)[0]


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def interpolate(levels: Column, values: Column, at: Column) -> Column:
    """Linear in the levels, clamped at both ends; null under two finite pairs."""
    pairs = F.array_sort(F.filter(F.zip_with(levels, values, lambda c, v: F.struct(c.alias("c"), v.alias("v"))), lambda p: _finite(p["c"]) & _finite(p["v"])))

    def of(p: Column) -> Column:
        def between(r: Column) -> Column:
            low, high = F.get(p, r - 1), F.get(p, r)
            span = high["c"] - low["c"]
            part = F.when(span == 0, F.lit(0.0)).otherwise((at - low["c"]) / F.when(span == 0, F.lit(1.0)).otherwise(span))
            return F.when(r == 0, F.get(p, F.lit(0))["v"]).when(r == F.size(p), F.get(p, F.size(p) - 1)["v"]).otherwise(low["v"] + part * (high["v"] - low["v"]))

        rank = F.size(F.filter(p, lambda x: x["c"] < at))
        return F.when(F.size(p) >= 2, bind(rank, between))

    return F.when(_finite(at), bind(pairs, of))


def differences(a: Column) -> Column:
    """a[k+1] - a[k]"""
    return F.zip_with(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))), lambda x, y: y - x)


def midpoints(a: Column) -> Column:
    """Means of neighbours: from staggered edges to level centres."""
    return F.zip_with(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))), lambda x, y: (x + y) / 2)


def layer_thickness(ph: Column, phb: Column, gravity: float = 9.81) -> Column:
    """Thickness of layers from perturbation and base geopotential on edges."""
    return differences(F.zip_with(ph, phb, lambda a, b: (a + b) / gravity))


def air_density(mu: Column, mub: Column, dnw: Column, thickness: Column, gravity: float = 9.81) -> Column:
    return F.zip_with(dnw, thickness, lambda d, t: (mu + mub) / gravity * (-d) / t)


def at_pressure(pressures: Column, values: Column, hectopascal: float) -> Column:
    """A field on a pressure surface, linear in pressure (Pa), ends clamped."""
    return interpolate(pressures, values, F.lit(float(hectopascal) * 100))
