"""The observation table on plain Parquet: files by ingest file, deltas of changed columns, and a log of commits.

``data/<id>`` holds the rows of one ``add``, in a folder for each ingest file, sorted
along a curve over time and place, so a file covers a small box.  ``stats/<id>`` has a
row for each of those files: least and greatest time, longitude and latitude, and a
Bloom filter of the names that the rows come from; ``select`` and ``find`` ask it
which files to read.  ``delta/<id>`` holds new values of one model column by ingest
file and row id; nothing else is written for an update.  Readers lay deltas over the
rows, the latest first; ``compact`` writes the rows they touch anew and folds them in.

A commit is a number that can be taken once (``commits``).  A writer that finds its
number taken looks at what came in between: it takes the next number, or raises
Conflict where both replaced the same ingest file.  Readers keep the snapshot that
they began with, as files stay until ``vacuum``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nephos.functions.columns import micros
from nephos.operators.filters import Box
from nephos.operators.joins import BROADCAST_ROWS, one_value, small
from nephos.schema import MODEL_COLUMNS, OBS_TABLE_SCHEMA
from nephos.sources.commits import CommitLog

#: Hours of the curve's cells, and bits of a cell's index: the globe is cut into as many cells each way; higher bits of time go before the curve.
CELL_HOURS, CURVE_BITS = 6, 7
#: Bits that a name sets among those of a file's Bloom filter.
BLOOM_HASHES, BLOOM_BITS = 3, 32_768
#: Commits between two that hold the whole state, and times that a writer tries the next number.
STATE_EVERY, TRIES = 50, 100
ROWS_PER_FILE = 2_000_000


class Conflict(RuntimeError):
    """Another writer replaced the same ingest file."""


@dataclass
class Snapshot:
    """What the commits up to ``version`` make: data folder of each ingest file, the version whose deltas each folder holds, and the deltas since."""

    version: int = 0
    live: dict[str, str] = field(default_factory=dict)
    born: dict[str, int] = field(default_factory=dict)
    deltas: list[dict[str, Any]] = field(default_factory=list)

    def after(self, version: int, commit: dict[str, Any]) -> Snapshot:
        """The next snapshot; this one is used up."""
        self.version = version
        for name in commit["drops"]:
            self.live.pop(name, None)
        if commit["data"]:
            self.live |= dict.fromkeys(commit["files"], commit["data"])
            self.born[commit["data"]] = commit["as_of"] or version
        if commit["delta"]:
            self.deltas.append(commit["delta"] | {"version": version})
        self.deltas = [d for d in self.deltas if d["id"] not in commit["folded"]]
        held = set(self.live.values())
        self.born = {k: v for k, v in self.born.items() if k in held}
        return self


def curve(time: Column, longitude: Column, latitude: Column) -> Column:
    """The place of a row's cell on a curve that keeps neighbours in time and place together (bits of the cell's indices by turns)."""
    mask, n = (1 << CURVE_BITS) - 1, float(1 << CURVE_BITS)
    slot = F.floor(micros(time) / (CELL_HOURS * 3_600_000_000)).cast("bigint")
    x = F.floor(F.pmod(longitude + 180.0, F.lit(360.0)) / 360.0 * n).cast("bigint")
    y = F.least(F.floor((latitude + 90.0) / 180.0 * n), F.lit(n - 1)).cast("bigint")
    out = F.shiftleft(F.shiftright(slot, CURVE_BITS), 3 * CURVE_BITS)
    for bit in range(CURVE_BITS):
        for k, index in enumerate((slot, x, y)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(index.bitwiseAND(F.lit(mask)), bit).bitwiseAND(F.lit(1)), 3 * bit + 2 - k))
    return out


def bloom_bits(name: Column) -> list[Column]:
    """The bits, from 1 on, that a name sets."""
    return [F.pmod(F.xxhash64(F.lit(k), name), F.lit(BLOOM_BITS)) + 1 for k in range(BLOOM_HASHES)]


def may_hold(bloom: Column, name: Column) -> Column:
    """False only if no row of a file has the name."""
    hit = F.lit(True)
    for bit in bloom_bits(name):
        byte = F.conv(F.hex(F.substring(bloom, (F.floor((bit - 1) / 8) + 1).cast("int"), 1)), 16, 10).cast("int")
        mask = F.get(F.array(*[F.lit(1 << k) for k in range(8)]), F.pmod(bit - 1, F.lit(8)).cast("int"))
        hit = hit & (byte.bitwiseAND(mask) != 0)
    return hit


def part_of(ingest_file: str) -> str:
    return hashlib.sha256(ingest_file.encode()).hexdigest()[:32]


class ObservationStore:
    """A table below ``path``."""

    def __init__(self, spark: SparkSession, path: str, rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.path, self.rows_per_file = spark, path.rstrip("/"), rows_per_file
        self.log = CommitLog(spark, f"{self.path}/log")

    # Commits

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The table as of ``version``, the latest by default."""
        have = [v for v in self.log.versions() if version is None or v <= version]
        out, commits = Snapshot(), []
        for v in reversed(have):
            commit = self.log.get(v)
            commits.append((v, commit))
            if commit.get("state") is not None:
                break
        for v, commit in reversed(commits):
            if (state := commit.get("state")) is not None:
                out = Snapshot(v, state["live"], state["born"], state["deltas"])
            else:
                out = out.after(v, commit)
        return out

    def _commit(self, base: int, data: str | None = None, files: Sequence[str] = (), drops: Sequence[str] = (), delta: dict[str, Any] | None = None, folded: Sequence[str] = (), as_of: int | None = None) -> int:
        """Take the first free number after ``base``; what a compaction no longer holds for is left as others made it."""
        files, drops = list(files), list(drops)
        for _ in range(TRIES):
            commit = {"data": data, "files": files, "drops": drops, "delta": delta, "folded": list(folded), "as_of": as_of}
            whole = commit
            if (base + 1) % STATE_EVERY == 0:
                after = self.snapshot(base).after(base + 1, commit)
                whole = commit | {"state": {"live": after.live, "born": after.born, "deltas": after.deltas}}
            if self.log.put(base + 1, whole):
                return base + 1
            base += 1
            taken = self.log.get(base)
            touched = {*taken["files"], *taken["drops"]}
            if as_of is not None:
                files = [f for f in files if f not in touched]
            elif both := touched & {*files, *drops}:
                raise Conflict(f"{self.path}: commit {base} replaced {sorted(both)[0]} as well")
        raise Conflict(f"{self.path}: no free number in {TRIES} tries")

    # Reading

    def exists(self) -> bool:
        return bool(self.log.versions())

    def read(self, version: int | None = None) -> DataFrame:
        """All rows as of ``version``, the latest by default."""
        at = self.snapshot(version)
        return self._rows(at, [f"{self.path}/data/{data}/_part={part_of(name)}" for name, data in sorted(at.live.items())])

    def _rows(self, at: Snapshot, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], OBS_TABLE_SCHEMA)
        rows = self.spark.read.schema(T.StructType([*OBS_TABLE_SCHEMA.fields, T.StructField("_data", T.StringType())])).parquet(*paths)
        for column in MODEL_COLUMNS:
            rows = self._laid_over(rows, at, column)
        return rows.select(OBS_TABLE_SCHEMA.names)

    def _laid_over(self, rows: DataFrame, at: Snapshot, column: str) -> DataFrame:
        """``column`` with its deltas: the latest value since the row's folder was written, and since the column was cleared."""
        deltas = [d for d in at.deltas if d["column"] == column]
        if not deltas:
            return rows
        cleared = max((d["version"] for d in deltas if d["clear"]), default=0)
        # As many rows as there are data folders.
        born = small(self.spark.createDataFrame(sorted(at.born.items()), "_data string, _born bigint"))
        rows = rows.join(born, "_data")
        kept = F.when(F.col("_born") >= cleared, F.col(column))
        used = [d for d in deltas if d["version"] >= cleared and d["rows"]]
        if not used:
            return rows.withColumn(column, kept).drop("_born")
        values = self.spark.read.schema("ingest_file string, obs_id bigint, value double, version_id string").parquet(*[f"{self.path}/delta/{d['id']}" for d in used])
        number = small(self.spark.createDataFrame([(d["id"], d["version"]) for d in used], "version_id string, v bigint"))
        new = values.join(number, "version_id").groupBy("ingest_file", "obs_id").agg(F.collect_list(F.struct("v", "value")).alias("_new"))
        # The log knows how many values there are at most: many aren't summed once more to be counted.
        met = rows.join(small(new) if sum(d["rows"] for d in used) <= BROADCAST_ROWS else new, ["ingest_file", "obs_id"], "left")
        last = F.array_max(F.filter("_new", lambda d: d["v"] > F.col("_born")))
        return met.withColumn("_last", last).withColumn(column, F.when(F.col("_last").isNotNull(), F.col("_last.value")).otherwise(kept)).drop("_born", "_new", "_last")

    def files(self, start: dt.datetime | None = None, end: dt.datetime | None = None, box: Box | None = None, orig_filename: str | None = None, version: int | None = None) -> DataFrame:
        """(path, n_rows, ...) of the live files that may hold rows of a closed time span, a box (least and greatest latitude and longitude) and a name."""
        at = self.snapshot(version)
        if not at.live:
            return self.spark.createDataFrame([], "ingest_file string, data string, path string, n_rows bigint")
        live = small(self.spark.createDataFrame(sorted(at.live.items()), "ingest_file string, data string"))
        found = self.spark.read.parquet(*[f"{self.path}/stats/{data}" for data in sorted(set(at.live.values()))]).join(live, ["ingest_file", "data"])
        if start is not None:
            found = found.where(F.col("last_time") >= F.lit(start))
        if end is not None:
            found = found.where(F.col("first_time") <= F.lit(end))
        if box is not None:
            low_lat, low_lon, high_lat, high_lon = box
            found = found.where((F.col("high_latitude") >= low_lat) & (F.col("low_latitude") <= high_lat) & (F.col("high_longitude") >= low_lon) & (F.col("low_longitude") <= high_lon))
        if orig_filename is not None:
            found = found.where(may_hold(F.col("names"), F.lit(orig_filename)))
        return found

    def select(self, start: dt.datetime | None = None, end: dt.datetime | None = None, box: Box | None = None, orig_filename: str | None = None, version: int | None = None) -> DataFrame:
        """The rows of a closed time span, a box and a name, from the files that may hold them."""
        at = self.snapshot(version)
        paths = sorted(r["path"] for r in self.files(start, end, box, orig_filename, at.version).select("path").collect())
        rows = self._rows(at, paths)
        if start is not None:
            rows = rows.where(F.col("time") >= F.lit(start))
        if end is not None:
            rows = rows.where(F.col("time") <= F.lit(end))
        if box is not None:
            rows = rows.where(F.col("latitude").between(box[0], box[2]) & F.col("longitude").between(box[1], box[3]))
        return rows if orig_filename is None else rows.where(F.col("orig_filename") == orig_filename)

    def find(self, orig_filename: str) -> DataFrame | None:
        found = self.select(orig_filename=orig_filename)
        return None if found.isEmpty() else found

    # Writing

    def _put(self, rows: DataFrame) -> tuple[str, list[str]]:
        """Write rows and their files' statistics; the folder's id and the ingest files in it."""
        data = uuid.uuid4().hex
        folder = f"{self.path}/data/{data}"
        keyed = rows.withColumns({"_data": F.lit(data), "_part": F.substring(F.sha2("ingest_file", 256), 1, 32), "_curve": curve(F.col("time"), F.col("longitude"), F.col("latitude"))})
        # The row id keeps a cell with a third of all rows from being one partition.
        dealt = keyed.repartitionByRange("_part", "_curve", "obs_id").sortWithinPartitions("_part", "_curve", "obs_id").drop("_curve")
        dealt.write.option("maxRecordsPerFile", self.rows_per_file).partitionBy("_part").parquet(folder)
        stats = self._stats(folder, data)
        stats.write.option("compression", "zstd").parquet(f"{self.path}/stats/{data}")
        return data, sorted(r[0] for r in self.spark.read.parquet(f"{self.path}/stats/{data}").select("ingest_file").distinct().collect())

    def _stats(self, folder: str, data: str) -> DataFrame:
        """One row for each file of a folder, and its ingest file."""
        schema = "ingest_file string, orig_filename string, time timestamp, longitude double, latitude double"
        rows = self.spark.read.schema(schema).parquet(folder).withColumn("path", F.col("_metadata.file_path"))
        limits = [f(c).alias(f"{name}_{c}") for c, names in (("time", ("first", "last")), ("longitude", ("low", "high")), ("latitude", ("low", "high"))) for f, name in zip((F.min, F.max), names, strict=True)]
        by = ["path", "ingest_file"]
        spans = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *limits)
        bits = rows.select(*by, "orig_filename").distinct().select(*by, F.explode(F.array(*bloom_bits(F.col("orig_filename")))).alias("bit"))
        names = bits.groupBy(*by).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("names"))
        return spans.join(names, by).withColumn("data", F.lit(data))

    def add(self, df: DataFrame, replaces: Sequence[str] = (), base: Snapshot | None = None) -> int:
        """Rows with an ``ingest_file``; the files they name, and those in ``replaces`` even if no row is left of them, are replaced, others stay."""
        base = self.snapshot() if base is None else base
        order = [f.name for f in OBS_TABLE_SCHEMA.fields]
        have = df.withColumns({c: F.lit(None).cast(OBS_TABLE_SCHEMA[c].dataType) for c in order if c not in df.columns})
        if "obs_id" not in df.columns:
            have = have.withColumn("obs_id", F.xxhash64("ingest_file", "instrument", "quantity", "time", "longitude", "latitude", "z", "orig_coords"))
        data, files = self._put(have.select(*[F.col(c).cast(OBS_TABLE_SCHEMA[c].dataType) for c in order]))
        return self._commit(base.version, data if files else None, files, [r for r in replaces if r not in files])

    def delete(self, ingest_file: str) -> bool:
        """Drop a file's rows; False if there are none."""
        base = self.snapshot()
        return ingest_file in base.live and bool(self._commit(base.version, drops=[ingest_file]))

    def update(self, updates: DataFrame, column: str, clear: bool = False, base: Snapshot | None = None) -> int:
        """New values (obs_id, value) of a model column; other rows keep theirs, or with ``clear`` lose it.

        Only the new values are written.  An id that comes with different values raises.
        """
        if column not in MODEL_COLUMNS:
            raise ValueError(f"{column} is no model column")
        base = self.snapshot() if base is None else base
        delta = uuid.uuid4().hex
        paths = [f"{self.path}/data/{data}/_part={part_of(name)}" for name, data in sorted(base.live.items())]
        n = 0
        if paths:
            home = self.spark.read.schema("obs_id bigint, ingest_file string").parquet(*paths).distinct()
            values = one_value(updates).join(home, "obs_id").select("ingest_file", "obs_id", F.col("value").cast("double").alias("value"), F.lit(delta).alias("version_id"))
            # They lie by id already; readers take a delta whole.
            values.sortWithinPartitions("ingest_file", "obs_id").write.parquet(f"{self.path}/delta/{delta}")
            n = self.spark.read.parquet(f"{self.path}/delta/{delta}").count()
        return self._commit(base.version, delta={"id": delta, "column": column, "clear": clear, "rows": n})

    def compact(self) -> int:
        """Fold all deltas into the rows of the ingest files that they touch; the version this made, 0 if there was nothing to fold."""
        at = self.snapshot()
        if not at.deltas:
            return 0
        cleared = max((d["version"] for d in at.deltas if d["clear"]), default=0)
        touched = {name for name, data in at.live.items() if at.born[data] < cleared}
        if used := [d["id"] for d in at.deltas if d["rows"]]:
            touched |= {r[0] for r in self.spark.read.parquet(*[f"{self.path}/delta/{d}" for d in used]).select("ingest_file").distinct().collect()} & at.live.keys()
        data, files = None, []
        if touched:
            data, files = self._put(self._rows(at, [f"{self.path}/data/{at.live[name]}/_part={part_of(name)}" for name in sorted(touched)]))
        return self._commit(at.version, data, files, folded=[d["id"] for d in at.deltas], as_of=at.version)

    def vacuum(self, keep: int = 10) -> int:
        """Delete folders that none of the last ``keep`` versions reads, older snapshots with them; how many went."""
        versions = self.log.versions()
        if not versions:
            return 0
        used: set[str] = set()
        for v in versions[-keep:]:
            at = self.snapshot(v)
            used |= {*at.live.values(), *(d["id"] for d in at.deltas)}
        gone = 0
        for kind in ("data", "stats", "delta"):
            fs, p = self.log._fs(f"{self.path}/{kind}")
            for status in fs.listStatus(p) if fs.exists(p) else []:
                if status.getPath().getName() not in used:
                    gone += bool(fs.delete(status.getPath(), True))
        return gone

    def delta_bytes(self, ids: Iterable[str] | None = None) -> int:
        """Bytes of the deltas, all or some."""
        ids = [d["id"] for d in self.snapshot().deltas] if ids is None else ids
        total = 0
        for i in ids:
            fs, p = self.log._fs(f"{self.path}/delta/{i}")
            total += fs.getContentSummary(p).getLength() if fs.exists(p) else 0
        return total


def write_members(df: DataFrame, path: str) -> None:
    """Long member values (obs_id, instrument, quantity, time, member, value) by source and member."""
    df.write.mode("append").partitionBy("source", "member").parquet(path)


def with_observations(members: DataFrame, obs: DataFrame, how: str = "left") -> DataFrame:
    """Member values beside their observations."""
    return members.join(obs.select("obs_id", F.col("value").alias("obs_value"), "value_uncertainty", "longitude", "latitude", "z", "qc_flag"), "obs_id", how)


def write_grid(df: DataFrame, path: str, *by: str, time: str | None = None) -> None:
    """A gridded field, float32 values, appended by (cycle, ...).

    With ``time`` a frame that is already there raises, as a time comes once.
    """
    if time is not None:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p):
            again = df.select(time).distinct().join(spark.read.parquet(path).select(time).distinct(), time, "left_semi").limit(1).collect()
            if again:
                raise ValueError(f"{path} already holds {time} {again[0][0]}")
    floats = {f.name: F.col(f.name).cast("float") for f in df.schema.fields if f.dataType.simpleString() == "double" and f.name not in by}
    df.withColumns(floats).write.mode("append").option("compression", "zstd").partitionBy(*by).parquet(path)


def write_ensemble(df: DataFrame, path: str) -> None:
    """Member fields (cycle, t, member, ...), float32, by cycle and member; a member's frame that is there already raises."""
    marked = df.withColumn("frame", F.concat_ws("/", F.col("t").cast("string"), F.col("member").cast("string")))
    write_grid(marked, path, "cycle", "member", time="frame")


def write_csv(df: DataFrame, path: str, *order: str) -> None:
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("header", True).csv(path)
