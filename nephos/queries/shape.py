"""Helpers for results that two engines must agree on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded, as sums differ in their last bits with the order of rows; no negative zero."""

    def value(name: str):
        x = F.round(name, digits)
        return F.when(x == 0, F.lit(0.0)).otherwise(x).alias(name)

    return df.select(*[value(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema.fields])


def r(*expressions: str, digits: int = DIGITS) -> str:
    """``expr AS name`` items of oracle SQL, rounded alike."""
    parts = [e.rsplit(" AS ", 1) for e in expressions]
    return ", ".join(f"CASE WHEN round({e}, {digits}) = 0 THEN CAST(0 AS DOUBLE) ELSE round({e}, {digits}) END AS {n}" for e, n in parts)


def normal_sql(key: str, seed: int) -> str:
    """``columns.standard_normal`` in oracle SQL."""
    part = lambda at: f"CAST(('0x' || substr(md5('{seed}:' || {key}), {at}, 8)) AS BIGINT)"
    return f"(sqrt(-2*ln(({part(1)} + 1)/CAST(4294967296 AS DOUBLE)))*cos(2*pi()*{part(9)}/CAST(4294967296 AS DOUBLE)))"
