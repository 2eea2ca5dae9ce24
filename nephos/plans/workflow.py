"""The cycle workflow: states, allowed steps, and the ledger of members and run times."""

from __future__ import annotations

import fcntl
import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from enum import StrEnum
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from nephos.sources.settings import replace_file


class State(StrEnum):
    INITIALIZED = "initialized"
    ADVANCING_MEMBERS = "advancing_members"
    MEMBERS_ADVANCED = "members_advanced"
    FILTER_COMPLETE = "filter_complete"
    ANALYSIS_COMPLETE = "analysis_complete"
    CYCLE_COMPLETE = "cycle_complete"


class Step(StrEnum):
    START_ADVANCING = "start_advancing"
    MEMBER_ADVANCED = "member_advanced"
    ALL_MEMBERS_ADVANCED = "all_members_advanced"
    FILTER_COMPLETE = "filter_complete"
    ANALYSIS_COMPLETE = "analysis_complete"
    CYCLE_COMPLETE = "cycle_complete"


#: (state, step) to the state after it; the names of states and steps, and the seven rules, are fixed values.
STEPS: dict[tuple[State, Step], State] = {
    (State.INITIALIZED, Step.START_ADVANCING): State.ADVANCING_MEMBERS,
    (State.ADVANCING_MEMBERS, Step.MEMBER_ADVANCED): State.ADVANCING_MEMBERS,
    (State.ADVANCING_MEMBERS, Step.ALL_MEMBERS_ADVANCED): State.MEMBERS_ADVANCED,
    (State.MEMBERS_ADVANCED, Step.FILTER_COMPLETE): State.FILTER_COMPLETE,
    (State.FILTER_COMPLETE, Step.ANALYSIS_COMPLETE): State.ANALYSIS_COMPLETE,
    (State.ANALYSIS_COMPLETE, Step.CYCLE_COMPLETE): State.CYCLE_COMPLETE,
    (State.MEMBERS_ADVANCED, Step.CYCLE_COMPLETE): State.CYCLE_COMPLETE,
}


def after(state: State, step: Step, advanced: int | None = None, members: int | None = None) -> State:
    """The next state; ValueError says what was not allowed."""
    if (state, step) not in STEPS:
        allowed = ", ".join(s for q, s in STEPS if q == state) or "nothing"
        raise ValueError(f"{step} is not possible in {state}; possible: {allowed}")
    if step is Step.ALL_MEMBERS_ADVANCED and (advanced is None or members is None or advanced < members):
        raise ValueError(f"{advanced} of {members} members have advanced")
    return STEPS[state, step]


class Ledger:
    """The state of an experiment in one JSON file, replaced whole at every change.

    A change locks the file's neighbour, reads what others have written, and writes,
    so several writers on one host lose nothing.
    """

    def __init__(self, path: str | Path, members: int):
        self.path, self.members = Path(path), members
        self.data = self._read()

    def _read(self) -> dict[str, Any]:
        empty = {"cycle": 0, "state": State.INITIALIZED, "advanced": [], "runs": [], "operations": []}
        return json.loads(self.path.read_text()) if self.path.exists() else empty

    @contextmanager
    def _change(self) -> Iterator[dict[str, Any]]:
        """The data as it is now, saved at the end unless something raises."""
        with self.path.with_name(f".{self.path.name}.lock").open("a") as lock:
            fcntl.flock(lock, fcntl.LOCK_EX)
            data = self._read()
            yield data
            replace_file(self.path, json.dumps(data))
            self.data = data

    @property
    def state(self) -> State:
        return State(self.data["state"])

    def step(self, step: Step) -> State:
        with self._change() as data:
            data["state"] = after(State(data["state"]), step, len(data["advanced"]), self.members)
            if step is Step.CYCLE_COMPLETE:
                data |= {"cycle": data["cycle"] + 1, "state": State.INITIALIZED, "advanced": []}
        return self.state

    def advance(self, member: int, start: str, end: str, seconds: int) -> None:
        """Record a member's run; a member counts once."""
        self.advance_all([(member, start, end, seconds)])

    def advance_all(self, runs: Sequence[tuple[int, str, str, int]]) -> None:
        """Record several members' runs (member, start, end, seconds) in one change, or none of them."""
        if wrong := [m for m, *_ in runs if not 0 <= m < self.members]:
            raise ValueError(f"no member {wrong[0]}")
        with self._change() as data:
            if data["state"] == State.INITIALIZED and runs:
                data["state"] = after(State.INITIALIZED, Step.START_ADVANCING)
            for member, start, end, seconds in runs:
                data["state"] = after(State(data["state"]), Step.MEMBER_ADVANCED)
                data["advanced"] = sorted({*data["advanced"], member})
                kept = [r for r in data["runs"] if (r["cycle"], r["member"]) != (data["cycle"], member)]
                data["runs"] = [*kept, {"cycle": data["cycle"], "member": member, "start_time": start, "end_time": end, "duration_s": seconds}]

    def reset(self) -> None:
        """Back to the start of the cycle."""
        with self._change() as data:
            data |= {"state": State.INITIALIZED, "advanced": []}

    def note(self, operation: str) -> None:
        """Record an optional operation of the cycle, once."""
        with self._change() as data:
            if [data["cycle"], operation] not in data["operations"]:
                data["operations"].append([data["cycle"], operation])

    def seed(self, cycle: int) -> None:
        """Go on from another experiment's forecasts of ``cycle``: all members count as advanced."""
        with self._change() as data:
            data |= {"cycle": cycle, "state": State.ADVANCING_MEMBERS, "advanced": list(range(self.members))}

    def forget(self, cycle: int) -> None:
        """Drop the runs and operations of a cycle."""
        with self._change() as data:
            data["runs"] = [r for r in data["runs"] if r["cycle"] != cycle]
            data["operations"] = [o for o in data["operations"] if o[0] != cycle]

    def statuses(self, spark: SparkSession) -> DataFrame:
        """(cycle, member, advanced) of the cycle's members, in order."""
        rows = [(self.data["cycle"], m, m in self.data["advanced"]) for m in range(self.members)]
        return spark.createDataFrame(rows, "cycle int, member int, advanced boolean")

    def runs(self, spark: SparkSession) -> DataFrame:
        """Run times as a frame for ``operators.cycles.runtime_stats``."""
        rows = [(r["cycle"], r["member"], r["start_time"], r["end_time"], r["duration_s"]) for r in self.data["runs"]]
        raw = spark.createDataFrame(rows, "cycle int, member int, start_time string, end_time string, duration_s int")
        return raw.withColumns({c: raw[c].cast("timestamp") for c in ("start_time", "end_time")})
