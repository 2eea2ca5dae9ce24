"""The registry and the shape of a converter's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephos.schema import OBS_SCHEMA

Converter = Callable[..., DataFrame]
CONVERTERS: dict[str, Converter] = {}


def register(name: str) -> Callable[[Converter], Converter]:
    def add(fn: Converter) -> Converter:
        CONVERTERS[name] = fn
        return fn

    return add


Size = int | Column


def coords(**dims: tuple[Column, Size]) -> Column:
    """An orig_coords struct: name = (index, size)."""
    return F.struct(
        F.array(*[i.cast("int") for i, _ in dims.values()]).alias("indices"),
        F.array(*[(n if isinstance(n, Column) else F.lit(n)).cast("int") for _, n in dims.values()]).alias("shape"),
        F.array(*[F.lit(d) for d in dims]).alias("names"),
    )


def observation(df: DataFrame, **columns: Column | str | float | int | None) -> DataFrame:
    """The observation columns in order; plain values become literals of the column's type."""
    out = []
    for f in OBS_SCHEMA.fields:
        c = columns.get(f.name)
        c = c if isinstance(c, Column) else F.lit(c)
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)
