"""Experiment settings: TOML with overlays, observation groups, Fortran namelists."""

from __future__ import annotations

import dataclasses
import datetime as dt
import os
import re
import tomllib
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def merged(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """``base`` with ``over`` on top; tables merge key by key, anything else is replaced."""
    out = dict(base)
    for key, value in over.items():
        both = isinstance(value, Mapping) and isinstance(out.get(key), Mapping)
        out[key] = merged(out[key], value) if both else value
    return out


def read_settings(path: str | Path, overlay: str | Path | None = None) -> dict[str, Any]:
    """A TOML file, with another on top."""
    settings = tomllib.loads(Path(path).read_text())
    return merged(settings, tomllib.loads(Path(overlay).read_text())) if overlay else settings


def flat_pairs(table: Mapping[str, Any], leaf: type = dict) -> dict[str, Any]:
    """``instrument.quantity`` keys of a table, whether quoted or nested by an unquoted dot."""
    out: dict[str, Any] = {}
    for key, value in table.items():
        if "." in key or not isinstance(value, Mapping):
            out[key] = value
        else:
            nested = {k: v for k, v in value.items() if isinstance(v, leaf)}
            out |= {f"{key}.{k}": v for k, v in nested.items()} if nested and len(nested) == len(value) else {key: value}
    return out


def differences(a: Any, b: Any, ignore: frozenset[str] = frozenset()) -> list[str]:
    """Names of the fields in which two dataclasses differ."""
    return [f.name for f in dataclasses.fields(a) if f.name not in ignore and getattr(a, f.name) != getattr(b, f.name)]


def read_groups(spark: SparkSession, path: str | Path) -> DataFrame:
    """(group, kind, path, start_date, end_date) of an observation-group file."""
    rows = []
    for name, group in tomllib.loads(Path(path).read_text()).items():
        rows += [(name, group.get("kind"), f["path"], f["start_date"], f["end_date"]) for f in group.get("files", [])]
    return spark.createDataFrame(rows, "group string, kind string, path string, start_date timestamp, end_date timestamp")


def _namelist_value(text: str) -> Any:
    t = text.strip()
    if t.lower() in (".true.", ".t.", "t", ".false.", ".f.", "f"):
        return t.lower().strip(".").startswith("t")
    if t[:1] in "'\"" and t[-1:] == t[:1]:
        return t[1:-1]
    for kind in (int, float):
        try:
            return kind(t.lower().replace("d", "e") if kind is float else t)
        except ValueError:
            continue
    return t


def read_namelist(text: str) -> dict[str, dict[str, Any]]:
    """Groups ``&name ... /`` of ``key = value[, value]`` lines."""
    out: dict[str, dict[str, Any]] = {}
    group: dict[str, Any] | None = None
    key = None
    for raw in text.splitlines():
        line = re.sub(r"""!(?=(?:[^'"]|'[^']*'|"[^"]*")*$).*""", "", raw).strip()
        if line.startswith("&"):
            group = out.setdefault(line[1:].strip().lower(), {})
        elif line == "/":
            group = None
        elif group is not None and line:
            name, found, values = line.partition("=")
            key = name.strip() if found else key
            parts = [p for p in re.findall(r"""'[^']*'|"[^"]*"|[^,\s]+""", values if found else line)]
            group[key] = (group.get(key, []) if not found else []) + [_namelist_value(p) for p in parts]
    return {g: {k: v[0] if len(v) == 1 else v for k, v in values.items()} for g, values in out.items()}


def write_namelist(groups: Mapping[str, Mapping[str, Any]]) -> str:
    def shown(v: Any) -> str:
        if isinstance(v, bool):
            return ".true." if v else ".false."
        if isinstance(v, dt.datetime):
            v = v.strftime("%Y-%m-%d_%H:%M:%S")
        return f"'{v}'" if isinstance(v, str) else repr(v)

    lines = []
    for name, values in groups.items():
        lines.append(f"&{name}")
        lines += [f"  {k} = {', '.join(shown(x) for x in (v if isinstance(v, list) else [v]))}" for k, v in values.items()]
        lines += ["/", ""]
    return "\n".join(lines)


def replace_file(path: str | Path, text: str) -> None:
    """Write a file whole or not at all."""
    path = Path(path)
    beside = path.with_name(f".{path.name}.{os.getpid()}")
    beside.write_text(text)
    os.replace(beside, path)
