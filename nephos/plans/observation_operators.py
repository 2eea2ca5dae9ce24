"""Observation operators and the quantity registry."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephos.functions.columns import hlos_wind, json_number

Fields = Mapping[str, Column]


@dataclass(frozen=True)
class OperatorSpec:
    """A function of model fields and metadata, and what it needs of both.

    ``column_fn`` gets columns and returns one; a ``pandas_udf`` may be called in it.
    """

    column_fn: Callable[[Fields, Fields], Column]
    model_fields: tuple[str, ...]
    metadata: tuple[str, ...] = ()


@dataclass(frozen=True)
class QuantitySpec:
    """A quantity is one model field, or an operator's result; never both."""

    name: str
    units: str = ""
    model_equivalent: str | None = None
    operator: OperatorSpec | None = None
    display_scale: float = 1.0

    def __post_init__(self) -> None:
        if (self.model_equivalent is None) == (self.operator is None):
            raise ValueError(f"{self.name} needs either a model field or an operator")

    @property
    def model_fields(self) -> tuple[str, ...]:
        return self.operator.model_fields if self.operator else (self.model_equivalent,)


HLOS = OperatorSpec(lambda fields, meta: hlos_wind(fields["wind_east"], fields["wind_north"], meta["azimuth"]), ("wind_east", "wind_north"), ("azimuth",))

QUANTITIES: dict[str, QuantitySpec] = {
    q.name: q
    for q in [
        *[QuantitySpec(f"AOD{m}_{w}nm", "1", f"AOD{m.upper()}_{w}") for m in ("", "_Fine", "_Coarse") for w in (440, 550, 665, 870)],
        QuantitySpec("AOD_340", "1", "AOD_340"),
        QuantitySpec("AOD_500", "1", "AOD_500"),
        QuantitySpec("AOD_500nm", "1", "AOD_500"),
        QuantitySpec("LIDAR_EXTINCTION_355nm", "1/m", "extinction_355", display_scale=1e6),
        QuantitySpec("HLOS_WIND", "m/s", operator=HLOS),
    ]
}


def register(quantity: QuantitySpec) -> None:
    QUANTITIES[quantity.name] = quantity


def required_fields(names: list[str]) -> list[str]:
    """Model fields that some quantities need together, each once."""
    return list(dict.fromkeys(f for n in names for f in QUANTITIES[n].model_fields))


def model_equivalent(df: DataFrame, quantity: str, metadata: str = "metadata") -> Column:
    """The model's value of a quantity from a frame's interpolated fields.

    Null where a field or a metadata value is missing; null throughout where the
    frame lacks a field.
    """
    spec = QUANTITIES[quantity]
    if not set(spec.model_fields) <= set(df.columns):
        return F.lit(None).cast("double")
    fields = {f: F.col(f) for f in spec.model_fields}
    if spec.operator is None:
        return fields[spec.model_equivalent]
    return spec.operator.column_fn(fields, {k: json_number(F.col(metadata), k) for k in spec.operator.metadata})
