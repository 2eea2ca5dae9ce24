"""The classic NetCDF file format (versions 1, 2 and 5) in numpy: a reader of slabs and a writer.

Only the header and the bytes that a slab needs are read, so a frame of a large file
costs a frame.  Files of the HDF5-based format are left to a reader that is
installed; without one they raise.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import struct
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any, BinaryIO

import numpy as np
import pyarrow.fs as pafs

#: Types by code, from the public format (fixed values).
TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
CODES = {"i1": 1, "S1": 2, "i2": 3, "i4": 4, "f4": 5, "f8": 6}
DIMENSIONS, VARIABLES, ATTRIBUTES = 10, 11, 12
UNITS = {"seconds": 1, "second": 1, "minutes": 60, "minute": 60, "hours": 3600, "hour": 3600, "days": 86_400, "day": 86_400}


@dataclass
class Variable:
    """A variable: its dimensions and attributes, and where its values are."""

    name: str
    dims: tuple[str, ...]
    attributes: dict[str, Any]
    kind: np.dtype
    begin: int
    record: bool


@dataclass
class Classic:
    """An open file."""

    source: BinaryIO
    sizes: dict[str, int] = field(default_factory=dict)
    attributes: dict[str, Any] = field(default_factory=dict)
    variables: dict[str, Variable] = field(default_factory=dict)
    record_bytes: int = 0

    def name(self, path: str) -> str:
        """A variable by its name, or by the last part of a grouped name."""
        last = path.rsplit("/", 1)[-1]
        if path not in self.variables and last not in self.variables:
            raise ValueError(f"the file has no variable {path}")
        return path if path in self.variables else last

    def dims(self, name: str) -> tuple[str, ...]:
        return self.variables[name].dims

    def shape(self, name: str) -> tuple[int, ...]:
        return tuple(self.sizes[d] for d in self.variables[name].dims)

    def read(self, name: str, first: int | None = None) -> np.ndarray:
        """All values, or those at one place of the first dimension, in the machine's byte order; text stays bytes."""
        v, shape = self.variables[name], self.shape(name)
        slab = int(np.prod(shape[1:], dtype=np.int64)) if shape else 1
        rows = [first] if first is not None else list(range(shape[0])) if v.record else [None]
        parts = []
        for row in rows:
            step = self.record_bytes if v.record else slab * v.kind.itemsize
            count = slab if row is not None else int(np.prod(shape, dtype=np.int64))
            self.source.seek(v.begin + (row or 0) * step)
            parts.append(np.frombuffer(self.source.read(count * v.kind.itemsize), v.kind, count))
        flat = np.concatenate(parts) if parts else np.empty(0, v.kind)
        return flat.astype(v.kind.newbyteorder("=")).reshape(shape[1:] if first is not None else shape)

    def floats(self, name: str, first: int | None = None) -> np.ndarray:
        """Values as doubles, with fills as NaN, scaled and offset."""
        a, x = self.variables[name].attributes, self.read(name, first)
        out = x.astype(np.float64)
        for key in ("_FillValue", "missing_value"):
            if key in a:
                out[x == np.asarray(a[key]).astype(x.dtype).ravel()[0]] = np.nan
        return out * float(np.ravel(a.get("scale_factor", 1.0))[0]) + float(np.ravel(a.get("add_offset", 0.0))[0])

    def texts(self, name: str) -> list[str]:
        """The rows of a character array, without padding."""
        return [b"".join(row.tolist()).decode("latin-1").strip("\0 ") for row in self.read(name)]

    def epoch(self, name: str, numbers: np.ndarray) -> np.ndarray:
        """``units since reference`` numbers as seconds since 1970."""
        found = re.match(r"(\w+) since (\d+-\d+-\d+)(?:[ T](\d+:\d+(?::\d+)?))?", str(self.variables[name].attributes.get("units", "")))
        if not found or found[1] not in UNITS:
            raise ValueError(f"{name} has no time units")
        start = dt.datetime.fromisoformat(f"{found[2]}T{found[3] or '00:00:00'}+00:00").timestamp()
        return start + numbers.astype(np.float64) * UNITS[found[1]]

    def times(self, name: str) -> list[dt.datetime]:
        """A time variable's values."""
        start = dt.datetime(1970, 1, 1)
        return [start + dt.timedelta(seconds=x) for x in self.epoch(name, self.read(name)).tolist()]


def open_path(path: str) -> Classic:
    """A file of any store that Arrow knows, read in pieces."""
    if "://" not in path and not path.startswith("file:"):
        path = f"file://{path}"
    fs, name = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return parse(fs.open_input_file(name))


def parse(source: BinaryIO) -> Classic:
    """Read the header."""
    magic = source.read(4)
    if magic[:3] != b"CDF" or magic[3:] not in (b"\1", b"\2", b"\5"):
        raise ValueError("not a classic NetCDF file" + ("; the HDF5-based format needs netCDF4" if magic[1:] == b"HDF" else ""))
    version = magic[3]
    wide, place = (">q" if version == 5 else ">i"), (">i" if version == 1 else ">q")

    def number(form: str = wide) -> int:
        raw = source.read(struct.calcsize(form))
        return struct.unpack(form, raw)[0]

    def padded(n: int) -> bytes:
        raw = source.read(n)
        source.read(-n % 4)
        return raw

    def listed(tag: int) -> int:
        found, n = number(">i"), number()
        if found not in (0, tag) or (found == 0 and n):
            raise ValueError("the header's lists are out of order")
        return n

    def attributes() -> dict[str, Any]:
        out = {}
        for _ in range(listed(ATTRIBUTES)):
            name, kind, n = padded(number()).decode(), number(">i"), number()
            raw = padded(n * np.dtype(TYPES[kind]).itemsize)
            out[name] = raw.decode("latin-1").rstrip("\0") if kind == 2 else np.frombuffer(raw, TYPES[kind], n)
        return out

    file = Classic(source)
    records = number()
    names = []
    for _ in range(listed(DIMENSIONS)):
        name, size = padded(number()).decode(), number()
        names.append((name, size == 0))
        file.sizes[name] = size or records
    file.attributes = attributes()
    sizes = []
    for _ in range(listed(VARIABLES)):
        name = padded(number()).decode()
        dims = [names[number()] for _ in range(number())]
        found, kind = attributes(), np.dtype(TYPES[number(">i")])
        number()  # the size, which follows from the shape
        v = Variable(name, tuple(d for d, _ in dims), found, kind, number(place), bool(dims and dims[0][1]))
        file.variables[name] = v
        if v.record:
            sizes.append(int(np.prod(file.shape(name)[1:], dtype=np.int64)) * kind.itemsize)
    file.record_bytes = sizes[0] if len(sizes) == 1 else sum(n + -n % 4 for n in sizes)
    return file


def encode(sizes: Mapping[str, int | None], variables: Mapping[str, tuple[tuple[str, ...], np.ndarray, Mapping[str, Any]]], attributes: Mapping[str, Any] | None = None) -> bytes:
    """A file (64-bit offsets) of name: (dimensions, values, attributes); a dimension of size None is unlimited and comes first."""
    free = next((d for d, n in sizes.items() if n is None), None)
    records = max((len(a) for dims, a, _ in variables.values() if dims[:1] == (free,)), default=0)
    text = lambda s: struct.pack(">i", len(s.encode())) + s.encode() + b"\0" * (-len(s.encode()) % 4)

    def listed(tag: int, items: list[bytes]) -> bytes:
        return struct.pack(">ii", tag if items else 0, len(items)) + b"".join(items)

    def attribute(name: str, value: Any) -> bytes:
        if isinstance(value, str):
            raw, kind, n = value.encode("latin-1"), 2, len(value.encode("latin-1"))
        else:
            a = np.atleast_1d(value)
            kind, n = CODES[a.dtype.str[1:]], a.size
            raw = a.astype(TYPES[kind]).tobytes()
        return text(name) + struct.pack(">ii", kind, n) + raw + b"\0" * (-len(raw) % 4)

    order, ids = {d: i for i, d in enumerate(sizes)}, list(variables.items())
    kinds = {k: np.dtype(TYPES[CODES[a.dtype.str[1:]]]) for k, (_, a, _) in ids}
    is_record = {k: dims[:1] == (free,) and free is not None for k, (dims, _, _) in ids}
    slab = {k: (a[:1].size if is_record[k] and len(a) else a.size) * kinds[k].itemsize for k, (_, a, _) in ids}
    single = sum(is_record.values()) == 1
    room = {k: n if single and is_record[k] else n + -n % 4 for k, n in slab.items()}

    def header(begin: Mapping[str, int]) -> bytes:
        rows = [
            text(k) + struct.pack(">i", len(dims)) + b"".join(struct.pack(">i", order[d]) for d in dims) + listed(ATTRIBUTES, [attribute(*x) for x in found.items()])
            + struct.pack(">iiq", CODES[a.dtype.str[1:]], room[k] + -room[k] % 4, begin[k])
            for k, (dims, a, found) in ids
        ]
        dims = [text(d) + struct.pack(">i", n or 0) for d, n in sizes.items()]
        return b"CDF\2" + struct.pack(">i", records) + listed(DIMENSIONS, dims) + listed(ATTRIBUTES, [attribute(*x) for x in (attributes or {}).items()]) + listed(VARIABLES, rows)

    at, begin = len(header(dict.fromkeys(variables, 0))), {}
    for k in [*(k for k in variables if not is_record[k]), *(k for k in variables if is_record[k])]:
        begin[k] = at
        at += room[k]
    out = io.BytesIO()
    out.write(header(begin))
    pad = lambda raw, k: raw + b"\0" * (room[k] - len(raw))
    for k, (_, a, _) in ids:
        if not is_record[k]:
            out.write(pad(a.astype(kinds[k]).tobytes(), k))
    for row in range(records):
        for k, (_, a, _) in ids:
            if is_record[k]:
                out.write(pad(a[row : row + 1].astype(kinds[k]).tobytes(), k))
    return out.getvalue()
