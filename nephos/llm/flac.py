"""FLAC media columns: encoder, decoder and PCM blocks, vectorised over frames in numpy.

Frames are lanes of arrays: the decoder takes one bit position for each frame
and reads the same sample of all frames at a time, so its Python work is one
loop over a block's samples, however many frames and documents a batch holds.

Decoded are constant, verbatim, fixed and linear-predictor subframes, both Rice
methods with partitions and escapes, wasted bits, and stereo decorrelation.
Header CRC-8, frame CRC-16 and the stream's MD5 are verified.  Frame starts come
from the sync codes whose CRCs hold, so a stream needs no index to be read; the
seek table that the encoder writes gives sample offsets of every SEEK_FRAMES.

The encoder writes mono 8-bit streams of 192-sample frames.  Each frame takes the
cheaper of the best fixed predictor of orders 0 to 2 and a linear predictor of
order ORDER, by Levinson and Durbin's recursion on whole-number autocorrelations,
and its best Rice parameter.

Decoded streams are written as PCM blocks, rows that each know their sample
offset, so that a reader may start anywhere; digests are computed from the blocks
read back.

Defined cases: a null text counts as empty, one frame of spaces; a very long text
is one stream of many blocks; a null doc_id passes through; equal texts have equal
streams, repeated rows stay apart by their row number, and no ties arise; extra columns are ignored;
an empty table gives no rows; a damaged stream raises ``FlacError``.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nephos.llm.common import map_arrow, slices
from nephos.session import ship_package, write_shared

BLOCK, RATE, SEEK_FRAMES = 192, 8000, 64
#: Frames that are encoded or decoded together, at most.
LANES = 4096
#: The encoder's linear predictors: order, bits of a coefficient, and a parabolic window in whole numbers.
ORDER, PRECISION = 3, 6
WINDOW = np.rint(256 * (1 - ((np.arange(BLOCK) - (BLOCK - 1) / 2) / ((BLOCK + 1) / 2)) ** 2)).astype(np.int64)
#: Samples of a PCM block.
PCM_BLOCK = 262_144
#: Coefficients of the fixed predictors by order, newest sample first.
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))


class FlacError(ValueError):
    """The bytes are not a FLAC stream whose checks hold."""


def _crc_table(poly: int, bits: int) -> np.ndarray:
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    table = []
    for byte in range(256):
        c = byte << (bits - 8)
        for _ in range(8):
            c = ((c << 1) ^ poly) & mask if c & top else (c << 1) & mask
        table.append(c)
    return np.array(table, np.uint32)


CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)
_LEADING = np.array([16 - int(i).bit_length() for i in range(1 << 16)], np.int64)


def _rows(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Spans of ``data`` as rows, aligned right; zeros on the left leave a CRC from 0 unchanged."""
    width = int(length.max(initial=0))
    at = (start + length - width)[:, None] + np.arange(width)
    return np.where(at >= start[:, None], data[np.maximum(at, 0)], 0)


def _crc8(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    c = np.zeros(len(start), np.uint32)
    for column in _rows(data, start, length).T:
        c = CRC8[c ^ column]
    return c


def _crc16(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    c = np.zeros(len(start), np.uint32)
    for column in np.ascontiguousarray(_rows(data, start, length).T):
        c = CRC16[(c >> 8) ^ column] ^ ((c << 8) & 0xFFFF)
    return c


# --- encoder


def _coded_number(n: int) -> bytes:
    """A frame number in FLAC's extended UTF-8."""
    if n < 0x80:
        return bytes([n])
    size = next(k for k in range(2, 8) if n < 1 << (5 * k + 1))
    tail = [0x80 | (n >> (6 * i)) & 0x3F for i in reversed(range(size - 1))]
    return bytes([(0xFF << (8 - size)) & 0xFF | n >> (6 * (size - 1)), *tail])


def linear_predictors(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients (ORDER, n), newest sample first, and shifts of the rows of ``x``."""
    w = x * WINDOW
    r = [np.einsum("ij,ij->i", w[:, k:], w[:, : BLOCK - k]).astype(np.float64) for k in range(ORDER + 1)]
    a, error = [], np.maximum(r[0], 1.0)
    for i in range(ORDER):
        k = (r[i + 1] - sum((c * r[i - j] for j, c in enumerate(a)), np.zeros(len(x)))) / error
        a = [c - k * a[i - 1 - j] for j, c in enumerate(a)] + [k]
        error = np.maximum(error * (1 - k * k), 1.0)
    c = np.stack(a)
    top = (1 << (PRECISION - 1)) - 1
    shift = np.clip(PRECISION - 1 - np.frexp(np.abs(c).max(axis=0))[1], 0, 15).astype(np.int64)
    return np.clip(np.rint(np.ldexp(c, shift)), -top - 1, top).astype(np.int64), shift


def _rice(u: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least bits of the folded residuals of each row, and the parameter that gives them."""
    rest, costs = u.astype(np.uint16), []
    for k in range(10):
        costs.append(rest.sum(axis=1, dtype=np.int64) + (k + 1) * live)
        rest >>= 1
    cost = np.stack(costs)
    return cost.min(axis=0), cost.argmin(axis=0)


def encode_frames(samples: np.ndarray, numbers: np.ndarray) -> list[bytes]:
    """Frames of an (n, 192) array of signed 8-bit samples."""
    n = len(samples)
    x = samples.astype(np.int32)
    residual = [x, np.zeros_like(x), np.zeros_like(x), np.zeros_like(x)]
    residual[1][:, 1:] = x[:, 1:] - x[:, :-1]
    residual[2][:, 2:] = x[:, 2:] - 2 * x[:, 1:-1] + x[:, :-2]
    size = np.stack([np.abs(r[:, k:]).sum(axis=1) for k, r in enumerate(residual[:3])])
    order = size.argmin(axis=0)
    weights, shift = linear_predictors(x)
    guess = sum(weights[j].astype(np.int32)[:, None] * x[:, ORDER - 1 - j : BLOCK - 1 - j] for j in range(ORDER))
    residual[3][:, ORDER:] = x[:, ORDER:] - (guess >> shift.astype(np.int32)[:, None])
    fold = lambda r, live: np.where(live, (r << 1) ^ (r >> 31), 0)
    place = np.arange(BLOCK)
    plain = fold(np.choose(order[:, None], residual[:3]), place >= order[:, None])
    straight = fold(residual[3], place >= ORDER)
    (cost, k), (linear_cost, linear_k) = _rice(plain, BLOCK - order), _rice(straight, BLOCK - ORDER)
    extra = 9 + PRECISION * ORDER
    linear = linear_cost + 8 * ORDER + extra < cost + 8 * order
    u = np.where(linear[:, None], straight, plain).astype(np.int64)
    order, k = np.where(linear, ORDER, order), np.where(linear, linear_k, k)[:, None]
    live = place >= order[:, None]

    heads = [b"\xff\xf8\x10\x02" + _coded_number(int(i)) for i in numbers]
    head_size = np.array([len(h) + 1 for h in heads])
    q = u >> k
    width = np.where(live, q + 1 + k, 0)
    ends = np.cumsum(width, axis=1)
    first = 8 + 8 * order + np.where(linear, extra, 0) + 10
    body = -(-(first + ends[:, -1]) // 8)
    frame_size = head_size + body + 2
    frame_at = np.cumsum(frame_size) - frame_size
    bits = np.zeros(int(frame_size.sum()) * 8, np.uint8)
    at = (frame_at + head_size) * 8

    def put(where: np.ndarray, value: np.ndarray, count: int) -> None:
        for b in range(count):
            bits[where + b] = (value >> (count - 1 - b)) & 1

    put(at, np.where(linear, 31 + ORDER, 8 | order) << 1, 8)
    for j in range(ORDER):
        rows = order > j
        put((at + 8 + 8 * j)[rows], x[rows, j], 8)
    rows = np.flatnonzero(linear)
    after = at[rows] + 8 + 8 * ORDER
    put(after, np.full(len(rows), PRECISION - 1), 4)
    put(after + 4, shift[rows], 5)
    for j in range(ORDER):
        put(after + 9 + PRECISION * j, weights[j, rows], PRECISION)
    put(at + first - 10, k[:, 0], 10)
    stop = ((at + first)[:, None] + ends - width + q)[live]
    bits[stop] = 1
    value, low = u[live], np.broadcast_to(k, u.shape)[live]
    for b in range(int(k.max(initial=0))):
        rows = low > b
        bits[stop[rows] + 1 + b] = (value[rows] >> (low[rows] - 1 - b)) & 1
    data = np.packbits(bits)
    for i, h in enumerate(heads):
        data[frame_at[i] : frame_at[i] + len(h)] = np.frombuffer(h, np.uint8)
    data[frame_at + head_size - 1] = _crc8(data, frame_at, head_size - 1)
    check = _crc16(data, frame_at, frame_size - 2)
    data[frame_at + frame_size - 2], data[frame_at + frame_size - 1] = check >> 8, check & 0xFF
    raw = data.tobytes()
    return [raw[a : a + s] for a, s in zip(frame_at.tolist(), frame_size.tolist(), strict=True)]


def _block(kind: int, body: bytes, last: bool) -> bytes:
    return bytes([kind | 0x80 * last]) + len(body).to_bytes(3, "big") + body


def _stream(samples: np.ndarray, frames: list[bytes]) -> bytes:
    sizes = [len(f) for f in frames]
    info = struct.pack(">HH", BLOCK, BLOCK) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big")
    info += (RATE << 44 | 0 << 41 | 7 << 36 | len(samples)).to_bytes(8, "big") + hashlib.md5(samples.tobytes()).digest()
    starts = np.cumsum([0, *sizes[:-1]]).tolist()
    seek = b"".join(struct.pack(">QQH", i * BLOCK, starts[i], BLOCK) for i in range(0, len(frames), SEEK_FRAMES))
    return b"".join([b"fLaC", _block(0, info, False), _block(3, seek, True), *frames])


def encode_streams(payloads: list[bytes]) -> list[bytes]:
    """A stream of each payload; a payload's length is a positive multiple of 192."""
    samples = [(np.frombuffer(p, np.uint8) ^ 0x80).view(np.int8) for p in payloads]
    counts = [len(s) // BLOCK for s in samples]
    grid = np.concatenate(samples).reshape(-1, BLOCK) if samples else np.empty((0, BLOCK), np.int8)
    numbers = np.concatenate([np.arange(c) for c in counts]) if counts else np.empty(0, np.int64)
    frames: list[bytes] = []
    for at in range(0, len(grid), LANES):
        frames += encode_frames(grid[at : at + LANES], numbers[at : at + LANES])
    out, at = [], 0
    for s, c in zip(samples, counts, strict=True):
        out.append(_stream(s, frames[at : at + c]))
        at += c
    return out


# --- decoder


@dataclass
class Decoded:
    """Samples (n, channels) of a stream and what its header says."""

    samples: np.ndarray
    rate: int
    bits: int
    seek: list[tuple[int, int, int]]


@dataclass
class _Head:
    first: int
    rate: int
    channels: int
    bits: int
    total: int
    md5: bytes
    seek: list[tuple[int, int, int]]


def read_head(stream: bytes) -> _Head:
    """STREAMINFO and seek table; first is the first frame's offset."""
    if stream[:4] != b"fLaC":
        raise FlacError("no FLAC mark")
    at, info, seek, last = 4, None, [], False
    while not last:
        if at + 4 > len(stream):
            raise FlacError("metadata ends early")
        last, kind, size = stream[at] >> 7, stream[at] & 0x7F, int.from_bytes(stream[at + 1 : at + 4], "big")
        body = stream[at + 4 : at + 4 + size]
        at += 4 + size
        if kind == 0 and size == 34:
            info = body
        elif kind == 3:
            seek = [p for p in struct.iter_unpack(">QQH", body) if p[0] != 2**64 - 1]
    if info is None:
        raise FlacError("no STREAMINFO")
    packed = int.from_bytes(info[10:18], "big")
    return _Head(at, packed >> 44, (packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1, packed & (1 << 36) - 1, info[18:34], seek)


class Bits:
    """Reads bit fields at many positions at a time, up to 57 bits."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(16, np.uint8)]).astype(np.uint64)
        n = len(data) + 8
        self.words = np.zeros(n, np.uint64)
        for i in range(8):
            self.words |= padded[i : i + n] << np.uint64(56 - 8 * i)

    def window(self, at: np.ndarray) -> np.ndarray:
        """Words whose top bits start at ``at``; positions past the end read as zeros."""
        return self.words[np.minimum(at >> 3, len(self.words) - 1)] << (at & 7).astype(np.uint64)

    def unsigned(self, at: np.ndarray, count: np.ndarray | int) -> np.ndarray:
        count = np.asarray(count, np.uint64)
        return ((self.window(at) >> np.uint64(1)) >> (np.uint64(63) - count)).astype(np.int64)

    def signed(self, at: np.ndarray, count: np.ndarray | int) -> np.ndarray:
        value, sign = self.unsigned(at, count), np.int64(1) << (np.maximum(np.asarray(count, np.int64), 1) - 1)
        return (value ^ sign) - sign

    def zeros(self, at: np.ndarray) -> np.ndarray:
        """Zero bits before the next one bit."""
        out = _LEADING[(self.window(at) >> np.uint64(48)).astype(np.int64)]
        more = np.flatnonzero(out == 16)
        while len(more):
            if (at[more] + out[more] > 8 * len(self.words)).any():
                raise FlacError("a unary code has no end")
            step = _LEADING[(self.window(at[more] + out[more]) >> np.uint64(48)).astype(np.int64)]
            out[more] += step
            more = more[step == 16]
        return out


def _headers(data: np.ndarray, start: np.ndarray) -> dict[str, np.ndarray]:
    """Fields of the frame headers at ``start``, and which of them hold their CRC."""
    padded = np.concatenate([data, np.zeros(20, np.uint8)])
    h = padded[start[:, None] + np.arange(16)].astype(np.int64)
    size_code, rate_code, channel, depth = h[:, 2] >> 4, h[:, 2] & 15, h[:, 3] >> 4, h[:, 3] >> 1 & 7
    lead = h[:, 4]
    number = np.select([lead < 0x80, lead < 0xC0, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC, lead < 0xFE], [1, 0, 2, 3, 4, 5, 6], 7)
    extra = np.select([size_code == 6, size_code == 7], [1, 2], 0)
    tail = np.select([rate_code == 12, rate_code >= 13], [1, 2], 0)
    after = np.minimum(4 + number, 12)
    row = np.arange(len(start))
    given = np.where(size_code == 6, h[row, after] + 1, h[row, after] * 256 + h[row, after + 1] + 1)
    block = np.select([size_code == 1, (size_code >= 2) & (size_code <= 5), (size_code == 6) | (size_code == 7), size_code >= 8], [192, 576 << np.maximum(size_code - 2, 0).clip(0, 3), given, 256 << np.maximum(size_code - 8, 0)], 0)
    size = 4 + number + extra + tail
    good = (block > 0) & (number > 0) & (rate_code != 15) & (channel <= 10) & (h[:, 3] & 1 == 0) & (depth != 3)
    good &= _crc8(padded, start, size) == padded[start + size]
    return {"size": size + 1, "block": block, "channel": channel, "depth": depth, "good": good}


def find_frames(data: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the frames from ``first`` on: every CRC holds and no byte is left over."""
    mark = np.flatnonzero((data[:-1] == 0xFF) & (data[1:] & 0xFE == 0xF8))
    mark = mark[mark >= first]
    if len(mark):
        mark = mark[_headers(data, mark)["good"]]
    if not len(mark) or mark[0] != first:
        raise FlacError("no frame where the first should be")
    ends = np.append(mark[1:], len(data))
    held = _frame_holds(data, mark, ends - mark)
    if held.all():
        return mark, ends - mark
    starts, lengths, i = [], [], 0
    while i < len(mark):  # a sync code inside a frame: the frame ends where its CRC holds
        j = i
        while j < len(mark) and not (held[i] if j == i else _frame_holds(data, mark[i : i + 1], ends[j : j + 1] - mark[i])[0]):
            j += 1
        if j == len(mark):
            raise FlacError("a frame's checksum does not hold")
        starts.append(mark[i])
        lengths.append(ends[j] - mark[i])
        i = j + 1
    return np.array(starts), np.array(lengths)


def find_all_frames(streams: list[bytes], heads: list[_Head]) -> list[tuple[np.ndarray, np.ndarray]]:
    """``find_frames`` of many streams in one pass; only a stream with a false sync code is searched alone."""
    data = np.frombuffer(b"".join(streams), np.uint8)
    ends = np.cumsum([len(s) for s in streams])
    base = ends - [len(s) for s in streams]
    first = base + [h.first for h in heads]
    mark = np.flatnonzero((data[:-1] == 0xFF) & (data[1:] & 0xFE == 0xF8))
    owner = np.searchsorted(ends, mark, side="right")
    inside = mark >= first[owner]
    mark, owner = mark[inside], owner[inside]
    good = _headers(data, mark)["good"] if len(mark) else np.empty(0, bool)
    mark, owner = mark[good], owner[good]
    close = np.minimum(np.append(mark[1:], len(data)), ends[owner])
    held = _frame_holds(data, mark, close - mark)
    lo, hi = np.searchsorted(owner, np.arange(len(streams))), np.searchsorted(owner, np.arange(len(streams)), side="right")
    out = []
    for i, (a, b) in enumerate(zip(lo.tolist(), hi.tolist(), strict=True)):
        if a < b and mark[a] == first[i] and held[a:b].all():
            out.append((mark[a:b] - base[i], close[a:b] - mark[a:b]))
        else:
            out.append(find_frames(np.frombuffer(streams[i], np.uint8), heads[i].first))
    return out


def _frame_holds(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    out = length > 8
    for at in range(0, len(start), LANES):
        s, n = start[at : at + LANES], np.maximum(length[at : at + LANES], 2)
        out[at : at + LANES] &= _crc16(data, s, n - 2) == data[s + n - 2].astype(np.uint32) * 256 + data[s + n - 1]
    return out


def _subframes(bits: Bits, at: np.ndarray, block: int, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Samples (lanes, block) of the subframes at ``at``, and the positions behind them."""
    n = len(at)
    kind = bits.unsigned(at, 8)
    if (kind >> 7).any():
        raise FlacError("a subframe's first bit is set")
    pos, kind, waste = at + 8, kind >> 1, np.where(kind & 1, 1, 0)
    wasted = np.flatnonzero(waste)
    if len(wasted):
        waste[wasted] = bits.zeros(pos[wasted]) + 1
        pos[wasted] += waste[wasted]
    depth = depth - waste
    x = np.zeros((n, block), np.int64)
    same, raw = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    x[same] = bits.signed(pos[same], depth[same])[:, None]
    pos[same] += depth[same]
    places = pos[raw, None] + np.arange(block) * depth[raw, None]
    x[raw] = bits.signed(places, np.broadcast_to(depth[raw, None], places.shape))
    pos[raw] += block * depth[raw]
    fixed, linear = (kind >= 8) & (kind <= 12), kind >= 32
    if not (fixed | linear | (kind <= 1)).all():
        raise FlacError("a subframe's type is reserved")
    live = np.flatnonzero(fixed | linear)
    if len(live):
        order = np.where(linear, kind - 31, kind - 8)[live]
        x[live], pos[live] = _predicted(bits, pos[live], block, depth[live], order, linear[live])
    return x << waste[:, None], pos


def _predicted(bits: Bits, pos: np.ndarray, block: int, depth: np.ndarray, order: np.ndarray, linear: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Warm-up samples, coefficients and Rice residuals of fixed and linear subframes."""
    n, most = len(pos), int(order.max())
    if most > block:
        raise FlacError("a predictor is longer than its block")
    # One row for each sample place, so that a step touches neighbouring memory.
    x = np.zeros((block, n), np.int64)
    for j in range(most):
        rows = np.flatnonzero(order > j)
        x[j, rows] = bits.signed(pos[rows], depth[rows])
        pos[rows] += depth[rows]
    weights, shift = np.zeros((most, n), np.int64), np.zeros(n, np.int64)
    for k in range(1, min(most, 4) + 1):
        weights[:k, ~linear & (order == k)] = np.array(FIXED[k])[:, None]
    rows = np.flatnonzero(linear)
    if len(rows):
        precision, shift[rows] = bits.unsigned(pos[rows], 4) + 1, bits.signed(pos[rows] + 4, 5)
        if (precision == 16).any() or (shift < 0).any():
            raise FlacError("a linear predictor's precision or shift is not allowed")
        pos[rows] += 9
        for j in range(most):
            more = order[rows] > j
            weights[j, rows[more]] = bits.signed(pos[rows[more]], precision[more])
            pos[rows[more]] += precision[more]
    method, split = bits.unsigned(pos, 2), bits.unsigned(pos + 2, 4)
    pos += 6
    part = block >> split
    if (method > 1).any() or (part << split != block).any() or (part < order).any():
        raise FlacError("a residual's method or partition is not allowed")
    wide, left = 4 + method, part - order
    fresh = np.ones(n, bool)
    k, escaped = np.zeros(n, np.int64), np.zeros(n, bool)
    plain = True
    for j in range(block):
        active = order <= j
        every = j >= most
        need = np.flatnonzero(active & (fresh | (left == 0)))
        while len(need):
            k[need] = bits.unsigned(pos[need], wide[need])
            pos[need] += wide[need]
            escaped[need] = k[need] == (1 << wide[need]) - 1
            raw = need[escaped[need]]
            k[raw] = bits.unsigned(pos[raw], 5)
            pos[raw] += 5
            left[need] = np.where(fresh[need], left[need], part[need])
            fresh[need] = False
            plain = not escaped.any()
            need = need[left[need] == 0]
        rows = slice(None) if every and plain else np.flatnonzero(active & ~escaped)
        at, low = pos[rows], k[rows]
        high = bits.zeros(at)
        u = high << low | bits.unsigned(at + high + 1, low)
        x[j, rows] = (u >> 1) ^ -(u & 1)
        pos[rows] = at + high + 1 + low
        if not plain:
            raw = np.flatnonzero(active & escaped)
            x[j, raw] = np.where(k[raw] > 0, bits.signed(pos[raw], k[raw]), 0)
            pos[raw] += k[raw]
        left[active] -= 1
        if most:
            guess = np.zeros(n, np.int64)
            for i in range(min(most, j)):
                guess += weights[i] * x[j - 1 - i]
            x[j] += np.where(active, guess >> shift, 0)
    return x.T, pos


def decode_frames(data: np.ndarray, start: np.ndarray, length: np.ndarray, bits: int) -> list[np.ndarray]:
    """Samples (block, channels) of every frame; ``bits`` is the stream's sample size."""
    head = _headers(data, start)
    if not head["good"].all():
        raise FlacError("a frame header's checksum does not hold")
    depth = np.array([0, 8, 12, 0, 16, 20, 24, 32])[head["depth"]]
    depth = np.where(depth == 0, bits, depth)
    out: list[np.ndarray] = [np.empty(0)] * len(start)
    reader = Bits(data)
    for block, channel in sorted(set(zip(head["block"].tolist(), head["channel"].tolist(), strict=True))):
        rows = np.flatnonzero((head["block"] == block) & (head["channel"] == channel))
        pos, parts = (start[rows] + head["size"][rows]) * 8, []
        for c in range(channel + 1 if channel < 8 else 2):
            side = (channel, c) in ((8, 1), (9, 0), (10, 1))
            x, pos = _subframes(reader, pos, block, depth[rows] + side)
            parts.append(x)
        if channel == 8:
            parts[1] = parts[0] - parts[1]
        elif channel == 9:
            parts[0] = parts[0] + parts[1]
        elif channel == 10:
            mid, side = parts[0] << 1 | parts[1] & 1, parts[1]
            parts = [(mid + side) >> 1, (mid - side) >> 1]
        if (-(-pos // 8) + 2 != start[rows] + length[rows]).any():
            raise FlacError("a frame's samples do not end at its checksum")
        for i, row in enumerate(rows):
            out[row] = np.stack([p[i] for p in parts], axis=1)
    return out


def decode_streams(streams: list[bytes]) -> list[Decoded]:
    """All streams, their frames decoded together, LANES at a time."""
    heads = [read_head(s) for s in streams]
    places = find_all_frames(streams, heads) if streams else []
    frames: list[list[np.ndarray]] = [[] for _ in streams]
    work: list[tuple[int, int, int]] = []

    def run() -> None:
        pieces, start, length, at = [], [], [], 0
        for i, a, b in work:
            s, n = places[i][0][a:b], places[i][1][a:b]
            pieces.append(np.frombuffer(streams[i], np.uint8)[s[0] : s[-1] + n[-1]])
            start.append(s - s[0] + at)
            length.append(n)
            at += len(pieces[-1])
        done = decode_frames(np.concatenate(pieces), np.concatenate(start), np.concatenate(length), heads[work[0][0]].bits)
        at = 0
        for i, a, b in work:
            frames[i] += done[at : at + b - a]
            at += b - a
        work.clear()

    lanes = 0
    for i, (start, _) in enumerate(places):
        for a in range(0, len(start), LANES):
            b = min(a + LANES, len(start))
            if work and (lanes + b - a > LANES or heads[work[0][0]].bits != heads[i].bits):
                run()
                lanes = 0
            work.append((i, a, b))
            lanes += b - a
    if work:
        run()
    out = []
    for head, parts in zip(heads, frames, strict=True):
        samples = np.concatenate(parts)
        if head.total and len(samples) != head.total or samples.shape[1] != head.channels:
            raise FlacError("the stream's samples are not those its header names")
        if head.md5 != bytes(16) and hashlib.md5(pcm_bytes(samples, head.bits)).digest() != head.md5:
            raise FlacError("the stream's MD5 does not hold")
        out.append(Decoded(samples, head.rate, head.bits, head.seek))
    return out


def pcm_bytes(samples: np.ndarray, bits: int) -> bytes:
    """Interleaved signed little-endian PCM."""
    width = (bits + 7) // 8
    return np.ascontiguousarray(samples.astype("<i4").reshape(-1, 1).view(np.uint8)[:, :width]).tobytes()


# --- DataFrame operators


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Length of the UTF-8 bytes, and these padded with spaces to a positive multiple of 192."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b" " * (-len(raw) % BLOCK if raw else BLOCK)


def encode_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media: every whole text as a FLAC stream."""
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "text", 1 << 20):
            made = [payload_of(t) for t in part.column(1).to_pylist()]
            media = encode_streams([p for _, p in made])
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array([n for n, _ in made], pa.int64()), pa.array(media, pa.binary())], schema=out)

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, n_bytes bigint, media binary")


BLOCKS = "row bigint, doc_id bigint, n_bytes bigint, flac_bytes bigint, flac_sha256 string, n_blocks int, block int, sample_offset bigint, n_samples int, channels int, bits int, pcm binary"


def _arrow(schema: str) -> pa.Schema:
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(p.split()[0], types[p.split()[1]]) for p in schema.split(", ")])


def decoded_blocks(media: DataFrame, block_samples: int = PCM_BLOCK) -> DataFrame:
    """Seekable blocks of every stream (doc_id, n_bytes, media): row number, the stream's size and digest, and the PCM."""
    out = _arrow(BLOCKS)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "media", 1 << 20):
            streams, rows = part.column(3).to_pylist(), []
            for row, doc_id, n_bytes, stream, d in zip(*(part.column(k).to_pylist() for k in range(3)), streams, decode_streams(streams), strict=True):
                whole = (row, doc_id, n_bytes, len(stream), hashlib.sha256(stream).hexdigest(), -(-len(d.samples) // block_samples))
                for k, at in enumerate(range(0, len(d.samples), block_samples)):
                    s = d.samples[at : at + block_samples]
                    rows.append((*whole, k, at, len(s), s.shape[1], d.bits, pcm_bytes(s, d.bits)))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    numbered = media.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("n_bytes") if "n_bytes" in media.columns else F.lit(None).cast("long").alias("n_bytes"), "media")
    return map_arrow(numbered, run, BLOCKS)


def pcm_blocks(media: DataFrame, block_samples: int = 65_536) -> DataFrame:
    """doc_id, block, sample_offset, n_samples, channels, bits and pcm: seekable blocks of every stream."""
    return decoded_blocks(media, block_samples).select("doc_id", "block", "sample_offset", "n_samples", "channels", "bits", "pcm")


class Signal:
    """Digests and whole-number features of mono 8-bit samples that come block by block."""

    def __init__(self) -> None:
        self.sha, self.stored, self.n, self.tail, self.last = hashlib.sha256(), hashlib.sha256(), 0, b"", None
        self.peak = self.energy = self.magnitude = self.sign_changes = self.variation = 0

    def add(self, samples: np.ndarray) -> None:
        """More signed samples."""
        stored = samples.astype(np.int8)
        payload = (stored.view(np.uint8) ^ 0x80).tobytes()
        self.sha.update(payload)
        self.stored.update(stored.tobytes())
        self.n, self.tail = self.n + len(payload), (self.tail + payload[-16:])[-16:]
        x = samples.astype(np.int64)
        joined = x if self.last is None else np.concatenate([[self.last], x])
        size = np.abs(x)
        self.peak = max(self.peak, int(size.max(initial=0)))
        self.energy += int((x * x).sum())
        self.magnitude += int(size.sum())
        self.sign_changes += int((np.signbit(joined[1:]) != np.signbit(joined[:-1])).sum())
        self.variation += int(np.abs(np.diff(joined)).sum())
        self.last = int(x[-1]) if len(x) else self.last

    def feature(self) -> str:
        """Peak, energy, sum of magnitudes, sign changes and first differences."""
        return f"peak={self.peak};energy={self.energy};magnitude={self.magnitude};sign_changes={self.sign_changes};variation={self.variation}"


def signal_features(samples: np.ndarray) -> str:
    """The features of all samples of a signal."""
    signal = Signal()
    signal.add(samples)
    return signal.feature()


DIGESTS = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, flac_bytes bigint, flac_sha256 string, feature string"


def block_digests(blocks: DataFrame) -> DataFrame:
    """Digests and features of every stream, from its PCM blocks (mono, 8 bits): media_* are those of the stored samples, flac_* those of the stream they were decoded from.

    A stream of one block is digested where it lies; longer ones meet by row
    number, in order, and are read block by block, one stream by one task, as a
    digest goes through its bytes in order.
    """
    ship_package(blocks.sparkSession)
    columns = ["row", "n_blocks", "block", "pcm", "doc_id", "n_bytes", "flac_bytes", "flac_sha256"]
    out = _arrow(DIGESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signal = Signal()
        for batch in batches:
            rows = []
            for _, n_blocks, block, pcm, doc_id, n_bytes, flac_bytes, flac_sha in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                signal = Signal() if block == 0 else signal
                signal.add(np.frombuffer(pcm, np.int8))
                if block == n_blocks - 1:
                    rows.append((doc_id, n_bytes, signal.n, signal.sha.hexdigest(), zlib.crc32(signal.tail), signal.n, signal.stored.hexdigest(), flac_bytes, flac_sha, signal.feature()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    single = blocks.where("n_blocks = 1").select(columns)
    several = blocks.where("n_blocks > 1").select(columns).repartition("row").sortWithinPartitions("row", "block")
    return single.mapInArrow(run, DIGESTS).union(several.mapInArrow(run, DIGESTS))


def media_digests(media: DataFrame, block_samples: int = PCM_BLOCK) -> DataFrame:
    """Digests and features of every stream, from its samples, written as PCM blocks and read back."""
    return block_digests(write_shared(decoded_blocks(media, block_samples), "pcm-blocks", "zstd"))
