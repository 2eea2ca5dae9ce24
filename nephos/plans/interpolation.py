"""Model equivalents of observations: brackets in time, corners in space, profiles in height, operators on top."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephos.functions.columns import json_number
from nephos.functions.profiles import interpolate
from nephos.operators.joins import bracket, gather_fields
from nephos.plans.observation_operators import QUANTITIES, QuantitySpec
from nephos.session import write_shared

Axis = tuple[float, float, int]
#: The field that gives the levels of each vertical coordinate.
VERTICAL = {"height": "geopotential_height", "pressure": "air_pressure"}
#: What a field's name ends in where it holds the ensemble's spread.
SPREAD = "_sd"


def _placed(obs: DataFrame, grid: DataFrame, tolerance_us: int, *keep: str) -> DataFrame:
    # One row a model time, read from the grid once; the bracket asks for them several times.
    frames = write_shared(grid.select("t_idx", "t").distinct(), "frames")
    return bracket(obs.select("obs_id", "time", "x", "y", *keep), frames, "time", tolerance_us)


def interpolate_model(obs: DataFrame, grid: DataFrame, x_axis: Axis, y_axis: Axis, tolerance_us: int = 3_600_000_000, by: Sequence[str] = ()) -> DataFrame:
    """(obs_id, by, model): the field at each observation's place, time and height.

    ``grid`` holds (t_idx, t, ix, iy, profile, levels).  Rows more than the
    tolerance outside the model's times are null.  With ``by`` ('member') every member
    gives a row.
    """
    placed = _placed(obs, grid, tolerance_us, "z")
    at = gather_fields(placed, grid, x_axis, y_axis, ["profile", "levels"], by=by, keep=("z", "valid"))
    return at.select("obs_id", *by, F.when(F.col("valid"), interpolate(F.col("levels"), F.col("profile"), F.col("z"))).alias("model"))


def interpolate_equivalents(
    obs: DataFrame,
    grid: DataFrame,
    x_axis: Axis,
    y_axis: Axis,
    quantities: Mapping[str, QuantitySpec] | None = None,
    vertical: Mapping[str, str] = VERTICAL,
    tolerance_us: int = 3_600_000_000,
    by: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """(obs_id, by, keep, model, model_spread): every observation's model equivalent by its quantity.

    ``grid`` holds (t_idx, t, ix, iy) and the model's fields: numbers, or arrays over
    levels whose places the fields in ``vertical`` give by ``z_type``.  A quantity asks
    for its fields; all of them, the levels and the spreads (``<field>_sd``) meet the
    observations in one join, each row computing what its own quantity needs.

    The model is null for unknown quantities, fields or metadata that are missing, a
    profile without a vertical coordinate of the row's type, and times beyond the
    tolerance.  An operator's spread doesn't follow from its fields' spreads: null.
    """
    have = set(grid.columns)
    arrays = {f.name for f in grid.schema.fields if f.dataType.simpleString().startswith("array")}
    known = {q: s for q, s in (QUANTITIES if quantities is None else quantities).items() if set(s.model_fields) <= have}
    levels = {z: f for z, f in vertical.items() if f in have}
    spreads = {q: f"{s.model_equivalent}{SPREAD}" for q, s in known.items() if s.operator is None and f"{s.model_equivalent}{SPREAD}" in have}
    fields = list(dict.fromkeys([*[f for s in known.values() for f in s.model_fields], *spreads.values(), *levels.values()]))
    users = {f: [q for q, s in known.items() if f in (*s.model_fields, spreads.get(q))] for f in fields}
    deep = [q for q, s in known.items() if arrays & {*s.model_fields}]
    kind = lambda names: F.col("quantity").isin(*names) if names else F.lit(False)
    wanted = {f: kind(users[f]) for f in fields if f not in levels.values()} | {f: (F.col("z_type") == z) & kind(deep) for z, f in levels.items()}
    keys = list(dict.fromkeys(k for s in known.values() if s.operator for k in s.operator.metadata))
    rows = obs.withColumns({f"_m_{k}": json_number(F.col("metadata"), k) for k in keys}) if keys else obs
    kept = list(dict.fromkeys(["z", "z_type", "quantity", *[f"_m_{k}" for k in keys], *[c for c in keep if c not in ("obs_id", "time", "x", "y")]]))
    placed = [c for c in keep if c in ("time", "x", "y")]
    if not known:
        return rows.select("obs_id", *keep, *[F.lit(None).alias(b) for b in by], F.lit(None).cast("double").alias("model"), F.lit(None).cast("double").alias("model_spread"))
    at = gather_fields(_placed(rows, grid, tolerance_us, *kept), grid, x_axis, y_axis, fields, by=by, keep=(*placed, *kept, "valid"), wanted=wanted)

    def number(f: str) -> Column:
        if f not in arrays:
            return F.col(f)
        cases = [F.when((F.col("z_type") == z) & kind(users[f]), interpolate(F.col(c), F.col(f), F.col("z"))) for z, c in levels.items()]
        return F.coalesce(*cases, F.lit(None).cast("double"))

    inputs = [f for f in fields if f not in levels.values() or users[f]]
    columns = list(dict.fromkeys(["obs_id", "quantity", "valid", *by, *keep, *[f"_m_{k}" for k in keys]]))
    single = at.select(*columns, *[number(f).alias(f"_f_{f}") for f in inputs])

    def result(s: QuantitySpec) -> Column:
        if s.operator is None:
            return F.col(f"_f_{s.model_equivalent}")
        return s.operator.column_fn({f: F.col(f"_f_{f}") for f in s.model_fields}, {k: F.col(f"_m_{k}") for k in s.operator.metadata})

    def chosen(results: Mapping[str, Column]) -> Column:
        none = F.lit(None).cast("double")
        return reduce(lambda rest, q: F.when(F.col("valid") & (F.col("quantity") == q), results[q]).otherwise(rest), results, none)

    spread = chosen({q: F.col(f"_f_{f}") for q, f in spreads.items()})
    return single.select(*dict.fromkeys(["obs_id", *by, *keep]), chosen({q: result(s) for q, s in known.items()}).alias("model"), spread.alias("model_spread"))


def with_equivalents(obs: DataFrame, grid: DataFrame, x_axis: Axis, y_axis: Axis, column: str = "model_forecast", **options) -> DataFrame:
    """``obs`` (times not null) with ``column``, ``<column>_spread`` and the departure of its value, observation less model."""
    columns = [c for c in obs.columns if c not in (column, f"{column}_spread", "departure")]
    found = interpolate_equivalents(obs, grid, x_axis, y_axis, keep=columns, **options).withColumnsRenamed({"model": column, "model_spread": f"{column}_spread"})
    return found.withColumn("departure", F.col("value") - F.col(column))
