"""Field processors: functions of a frame, chained, and loaded by name."""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame

from nephos.functions.columns import select_matching


@dataclass(frozen=True)
class Context:
    """What a processor may know of where it runs."""

    cycle: int = 0
    member: int | None = None
    settings: dict[str, Any] = field(default_factory=dict)


Processor = Callable[[DataFrame, Context], DataFrame]


class KeepMatching:
    """Only the columns that some pattern matches, and those always kept."""

    def __init__(self, patterns: Sequence[str], always: Sequence[str] = ()):
        self.patterns, self.always = patterns, always

    def __call__(self, df: DataFrame, context: Context) -> DataFrame:
        return select_matching(df, self.patterns, self.always)


class Pipeline:
    """Processors in order."""

    def __init__(self, *processors: Processor):
        self.processors = list(processors)

    def add(self, processor: Processor) -> Pipeline:
        self.processors.append(processor)
        return self

    def insert(self, at: int, processor: Processor) -> Pipeline:
        self.processors.insert(at, processor)
        return self

    def run(self, df: DataFrame, context: Context | None = None) -> DataFrame:
        for p in self.processors:
            df = df.transform(p, context or Context())
        return df


def load(name: str, **options: Any) -> Processor:
    """``module:Name``, or ``file.py[:Name]``; without a name the file's only processor class.

    A class is built with ``options``; a function is taken as it is.
    """
    place, _, wanted = name.partition(":")
    if place.endswith(".py"):
        spec = importlib.util.spec_from_file_location(Path(place).stem, place)
        if spec is None or not Path(place).is_file():
            raise FileNotFoundError(place)
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        if not wanted:
            own = [k for k, v in vars(module).items() if isinstance(v, type) and v.__module__ == module.__name__]
            if len(own) != 1:
                raise ValueError(f"{place} has {len(own)} classes; name one")
            wanted = own[0]
    else:
        module = importlib.import_module(place)
    found = getattr(module, wanted)
    return found(**options) if isinstance(found, type) else found
