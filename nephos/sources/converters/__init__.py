"""Converters from instruments' products to observation rows.

A product's binary file is decoded to rows elsewhere (readers of HDF and NetCDF
are optional and not part of Spark); a converter takes the decoded cells as a
DataFrame, one row for each cell, and does masks, scales, times, error models and
metadata as Spark expressions.  ``CONVERTERS`` is the registry; ``register`` adds
to it.
"""

from __future__ import annotations

from nephos.sources.converters.base import CONVERTERS, Converter, register
from nephos.sources.converters import aeronet, lidar, radiometers  # noqa: F401  they register themselves

__all__ = ["CONVERTERS", "Converter", "register"]
