"""Scalar building blocks as Spark columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = (-999.0, -9999.0)


def floor_div(x: Column, size: float) -> Column:
    """Division rounded down, also for negative numbers, as a double."""
    return F.floor(x / F.lit(float(size))).cast("double")


def wrap_180(lon: Column) -> Column:
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def wrap_360(lon: Column) -> Column:
    return F.pmod(lon + 360, F.lit(360.0))


def null_if_missing(x: Column, sentinels: Sequence[float] = MISSING) -> Column:
    """Null for sentinels and NaN."""
    return F.when(~(x.isin(*[float(s) for s in sentinels]) | F.isnan(x)), x)


# --- time


def micros(t: Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without zone (UTC sessions)."""
    return F.unix_micros(t.cast("timestamp"))


def time_at(us: Column) -> Column:
    return F.timestamp_micros(us.cast("bigint")).cast("timestamp_ntz")


def seconds_since_2000(s: Column) -> Column:
    return F.timestamp_micros(F.round(s * 1e6).cast("bigint") + 946_684_800_000_000)


def tai93(s: Column) -> Column:
    """Seconds since 1993 in atomic time, with the constant offset of 37 s."""
    return F.timestamp_micros(F.round((s - 37) * 1e6).cast("bigint") + 725_846_400_000_000)


def date_fraction(day: Column, fraction: Column) -> Column:
    """A yyyymmdd number and a fraction of that day."""
    start = F.unix_micros(F.to_timestamp(day.cast("int").cast("string"), "yyyyMMdd"))
    return F.timestamp_micros(start + F.round(fraction * 86_400e6).cast("bigint"))


def day_clock(day: Column, clock: Column) -> Column:
    """``dd:mm:yyyy`` and ``hh:mm:ss`` strings."""
    return F.to_timestamp(F.concat_ws(" ", day, clock), "dd:MM:yyyy HH:mm:ss")


def mean_time(t: Column, base_us: int = 1_704_067_200_000_000) -> Column:
    """Aggregate: the mean timestamp, as an offset from a base so that doubles stay exact."""
    return time_at(F.round(F.avg((micros(t) - base_us).cast("double"))).cast("bigint") + base_us)


def days_since_1601(t: Column) -> Column:
    return F.datediff(t, F.to_date(F.lit("1601-01-01")))


def seconds_of_day(t: Column) -> Column:
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def minutes_since(t: Column, reference: Column) -> Column:
    return F.floor((micros(t) - micros(reference)) / 60_000_000).cast("int")


# --- error models


def relative_floor_error(v: Column, share: float = 0.3, least: float = 1e-5) -> Column:
    return F.when(v.isNotNull(), F.greatest(share * v, F.lit(least)))


def land_ocean_error(v: Column) -> Column:
    """max(0.05 + 0.3 v, 0.1)"""
    return F.when(v.isNotNull(), F.greatest(0.05 + 0.3 * v, F.lit(0.1)))


def clipped_error(v: Column, slope: float = 0.2853, base: float = 0.0267, low: float = 0.0267, high: float = 0.3) -> Column:
    return F.when(v.isNotNull(), F.least(F.greatest(slope * v + base, F.lit(low)), F.lit(high)))


def backscatter_error(v: Column, base: float = 6.8e-5, share: float = 0.2) -> Column:
    return F.when(v.isNotNull(), base + share * F.greatest(v, F.lit(0.0)))


# --- departures


def departure(value: str = "value", model: str = "model_forecast") -> Column:
    return F.col(value) - F.col(model)


def hlos_wind(u: Column, v: Column, azimuth: Column) -> Column:
    """Wind along a horizontal line of sight; azimuth in degrees."""
    a = F.radians(azimuth)
    return -u * F.sin(a) - v * F.cos(a)


# --- noise


def standard_normal(key: Column, seed: int) -> Column:
    """A standard normal number from a key and a seed, the same in every run: Box and Muller's on two parts of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    part = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("double")
    return F.sqrt(-2 * F.log((part(1) + 1) / 2.0**32)) * F.cos(2 * math.pi * part(9) / 2.0**32)


# --- strings and JSON


def pair_key(instrument: Column, quantity: Column) -> Column:
    return F.concat_ws(".", instrument, quantity)


def split_pair(key: Column) -> tuple[Column, Column]:
    """The instrument, and the quantity with any further dots."""
    parts = F.split(key, r"\.", 2)
    return F.get(parts, 0), F.get(parts, 1)


def json_text(metadata: Column, key: str) -> Column:
    return F.get_json_object(metadata, f"$.{key}")


def json_number(metadata: Column, key: str) -> Column:
    return json_text(metadata, key).try_cast("double")


def metadata_values(metadata: Column, keys: Sequence[str]) -> list[Column]:
    """One text column for each declared key; a row that lacks one raises."""
    lacks = lambda k: F.raise_error(F.concat(F.lit(f"metadata lacks {k}: "), F.coalesce(metadata, F.lit("null"))))
    return [F.coalesce(json_text(metadata, k), lacks(k)).alias(k) for k in keys]


def metadata_pairs(metadata: Column) -> Column:
    """``k=v`` pairs joined by a pipe; nested values are left out, bad JSON gives an empty string."""
    entries = F.from_json(metadata, "map<string,string>")
    flat = F.map_filter(entries, lambda _, v: v.isNotNull() & ~v.startswith("{") & ~v.startswith("["))
    pairs = F.transform(F.map_entries(flat), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.coalesce(F.array_join(F.array_sort(pairs), "|"), F.lit(""))


def letter_numeral(i: Column) -> Column:
    """1 to 17576 as AAA to ZZZ; anything else raises."""
    k = i - 1
    letter = lambda n: F.char((65 + n % 26).cast("int"))
    text = F.concat(letter(F.floor(k / 676)), letter(F.floor(k / 26)), letter(k))
    return F.when((i >= 1) & (i <= 17576), text).otherwise(F.raise_error(F.lit("letter numerals go from 1 to 17576")))


def pretty_hours(seconds: Column) -> Column:
    return F.format_string("%dh %02dm", F.floor(seconds / 3600), F.floor(F.pmod(seconds, F.lit(3600)) / 60))


def percent(part: Column, whole: Column) -> Column:
    """Zero where the whole is zero."""
    return F.coalesce(F.try_divide(part * 100.0, whole.cast("double")), F.lit(0.0))


def mapped(key: Column, names: dict[str, str]) -> Column:
    """A dictionary lookup that falls through to the key."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[key], key)


def significant(x: Column, digits: int) -> Column:
    """``x`` to so many significant digits."""
    scale = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x * scale) / scale)


# --- bins


def cut(x: Column, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """The right-closed interval of ``x``; null outside, and at the lowest edge."""
    out = None
    for k, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        label = F.lit(labels[k] if labels else k)
        inside = (x > low) & (x <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def equal_width_bin(x: Column, low: Column, high: Column, n: int) -> Column:
    """Right-closed equal bins 0 to n-1 between two bounds; the lowest value falls in the first."""
    place = F.ceil((x - low) * n / (high - low)) - 1
    return F.when(high > low, F.least(F.greatest(place, F.lit(0)), F.lit(n - 1))).otherwise(F.lit(0)).cast("int")


def histogram_bin(x: Column, low: Column, high: Column, n: int) -> Column:
    """Left-closed equal bins whose last one is closed on both sides."""
    place = F.floor((x - low) * n / (high - low))
    return F.when(high > low, F.least(place, F.lit(n - 1))).otherwise(F.lit(0)).cast("int")


def edge_taper(ix: Column, iy: Column, nx: int, ny: int, width: int) -> Column:
    """1 in the border, falling to 0 at ``width`` cells inside."""
    inside = F.least(ix, nx - 1 - ix, iy, ny - 1 - iy)
    return 1 - F.least(F.lit(1.0), inside / float(width))


def select_matching(df: DataFrame, patterns: Sequence[str], always: Sequence[str] = ()) -> DataFrame:
    """The columns that some pattern matches from the start, and those always kept."""
    import re

    tests = [re.compile(p) for p in patterns]
    return df.select(*[c for c in df.columns if c in always or any(t.match(c) for t in tests)])
