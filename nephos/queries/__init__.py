"""Registered queries over the driver's tables, each beside its oracle SQL."""

from nephos.queries import densities, ensembles, files, gridded, lake, products, scalars, statistics  # noqa: F401  they register themselves
