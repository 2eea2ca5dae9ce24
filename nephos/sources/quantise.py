"""Fewer mantissa bits before compression: floats keep the bits that their variable's precision asks for."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nephos.session import ship_package

#: Mantissa bits of a 32-bit float that are stored.
STORED_BITS = 23


def bits_for(digits: int) -> int:
    """The stored bits whose relative error, half a step, is at most half a unit of the last of so many significant digits."""
    return min(STORED_BITS, max(0, math.ceil(digits * math.log2(10))))


def keep_bits(values: np.ndarray, bits: int) -> np.ndarray:
    """32-bit floats rounded to so many stored mantissa bits, ties to even, by integer arithmetic on their bits.

    Not a number, infinities and zeros stay; a value that rounds past the greatest
    float stays as it is.
    """
    x = np.ascontiguousarray(values, np.float32)
    drop = STORED_BITS - bits
    if drop <= 0:
        return x
    raw = x.view(np.uint32)
    half, odd = np.uint32((1 << (drop - 1)) - 1), (raw >> np.uint32(drop)) & np.uint32(1)
    rounded = ((raw + half + odd) & ~np.uint32((1 << drop) - 1)).view(np.float32)
    return np.where(np.isfinite(x) & np.isfinite(rounded), rounded, x)


def rule_for(name: str, rules: Mapping[str, int], default: int | None = None) -> int | None:
    """The significant digits of the first rule that matches the whole name."""
    return next((d for pattern, d in rules.items() if re.fullmatch(pattern, name)), default)


def quantised(df: DataFrame, rules: Mapping[str, int], variable: str = "var", value: str = "value", default: int | None = None) -> DataFrame:
    """``df`` with ``value`` as a 32-bit float of as many significant digits as its row's variable asks for.

    A variable without a rule keeps all bits; nulls stay.
    """
    ship_package(df.sparkSession)
    names = df.columns
    at, of = names.index(value), names.index(variable)
    known = dict(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(at).cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float32)
            coded = batch.column(of).dictionary_encode()
            code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            for k, name in enumerate(coded.dictionary.to_pylist()):
                digits = rule_for(name, known, default)
                if digits is not None:
                    x[code == k] = keep_bits(x[code == k], bits_for(digits))
            kept = pa.array(x, pa.float32(), mask=np.asarray(batch.column(at).is_null()))
            yield pa.RecordBatch.from_arrays([kept if i == at else c for i, c in enumerate(batch.columns)], names=names)

    schema = ", ".join(f"`{f.name}` {'float' if f.name == value else f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, schema)


def write_quantised(df: DataFrame, path: str, rules: Mapping[str, int], *by: str, variable: str = "var", value: str = "value") -> None:
    """Quantised rows as zstd-compressed Parquet by ``by``."""
    quantised(df, rules, variable, value).write.mode("append").option("compression", "zstd").partitionBy(*by).parquet(path)
