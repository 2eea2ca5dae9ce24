import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from nephos.llm import flac as F
from tests.llm.helpers import docs, hard_rows, prose, with_clashing_columns


class Writer:
    """A plain bit writer for hand-made streams."""

    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [(value >> (n - 1 - i)) & 1 for i in range(n)]

    def rice(self, value, k):
        u = value << 1 if value >= 0 else (-value << 1) - 1
        self.bits += [0] * (u >> k) + [1]
        self.put(u & ((1 << k) - 1), k)

    def data(self):
        self.bits += [0] * (-len(self.bits) % 8)
        return bytes(int("".join(map(str, self.bits[i : i + 8])), 2) for i in range(0, len(self.bits), 8))


def crc(data, poly, bits):
    c, top, mask = 0, 1 << (bits - 1), (1 << bits) - 1
    for byte in data:
        c ^= byte << (bits - 8)
        for _ in range(8):
            c = ((c << 1) ^ poly) & mask if c & top else (c << 1) & mask
    return c


def residuals(x, order, weights, shift):
    return [x[i] - (sum(w * x[i - 1 - j] for j, w in enumerate(weights)) >> shift) for i in range(order, len(x))]


def subframe(w, x, bps, kind, split=0, method=0, waste=0):
    x, bps = [v >> waste for v in x], bps - waste
    code = {"constant": 0, "verbatim": 1}.get(kind[0], 8 + kind[1] if kind[0] == "fixed" else 31 + len(kind[1]) if kind[0] == "lpc" else None)
    w.put(0, 1)
    w.put(code, 6)
    w.put(1 if waste else 0, 1)
    if waste:
        w.put(1, waste)
    if kind[0] == "constant":
        return w.put(x[0] & ((1 << bps) - 1), bps)
    if kind[0] == "verbatim":
        return [w.put(v & ((1 << bps) - 1), bps) for v in x]
    weights, shift = (F.FIXED[kind[1]], 0) if kind[0] == "fixed" else (kind[1], kind[2])
    order = len(weights)
    for v in x[:order]:
        w.put(v & ((1 << bps) - 1), bps)
    if kind[0] == "lpc":
        w.put(11, 4)
        w.put(shift & 31, 5)
        for c in weights:
            w.put(c & 4095, 12)
    res = residuals(x, order, weights, shift)
    w.put(method, 2)
    w.put(split, 4)
    part, at = len(x) >> split, 0
    for p in range(1 << split):
        n = part - order if p == 0 else part
        block = res[at : at + n]
        at += n
        if p % 2 == 1:  # escaped
            need = max([max(v, -v - 1).bit_length() + 1 for v in block] + [1])
            w.put(15 if method == 0 else 31, 4 + method)
            w.put(need, 5)
            for v in block:
                w.put(v & ((1 << need) - 1), need)
        else:
            k = 3 + p % 4
            w.put(k, 4 + method)
            for v in block:
                w.rice(v, k)
    return None


def stream(frames, bps, channels, rate=44100):
    """frames: (channel code, block, [(samples, kind, options)])"""
    raw, total = [], 0
    for number, (code, block, subs) in enumerate(frames):
        head = bytes([0xFF, 0xF8, 0x70, code << 4]) + F._coded_number(number) + struct.pack(">H", block - 1)
        head += bytes([crc(head, 0x07, 8)])
        w = Writer()
        for c, (x, kind, options) in enumerate(subs):
            subframe(w, x, bps + ((code, c) in ((8, 1), (9, 0), (10, 1))), kind, **options)
        body = head + w.data()
        raw.append(body + struct.pack(">H", crc(body, 0x8005, 16)))
        total += block
    info = struct.pack(">HH", 16, 65535) + bytes(6) + (rate << 44 | (channels - 1) << 41 | (bps - 1) << 36 | total).to_bytes(8, "big") + bytes(16)
    return b"fLaC" + b"\x80" + (34).to_bytes(3, "big") + info + b"".join(raw)


def wave(n, bps, seed):
    rng, top = random.Random(seed), (1 << (bps - 1)) - 1
    x, out = 0, []
    for _ in range(n):
        x = max(-top, min(top, x + rng.randint(-60, 60)))
        out.append(x)
    return out


KINDS = [("verbatim",), *[("fixed", k) for k in range(5)], ("lpc", [1800, -700, 90], 10), ("lpc", [1000], 9), ("lpc", list(range(-4, 28)), 8)]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize(("split", "method"), [(0, 0), (2, 0), (1, 1)])
def test_every_subframe_kind(kind, split, method):
    x = wave(256, 16, 3)
    data = stream([(0, 256, [(x, kind, {"split": split, "method": method})])], 16, 1)
    (found,) = F.decode_streams([data])
    assert found.samples[:, 0].tolist() == x and (found.rate, found.bits) == (44100, 16)


def test_constant_and_wasted_bits():
    x = [v << 3 for v in wave(192, 12, 5)]
    data = stream([(0, 192, [([24] * 192, ("constant",), {"waste": 3})]), (0, 192, [(x, ("fixed", 2), {"waste": 3})])], 16, 1)
    assert F.decode_streams([data])[0].samples[:, 0].tolist() == [24] * 192 + x


@pytest.mark.parametrize("code", [1, 8, 9, 10])
def test_stereo(code):
    a, b = wave(128, 15, 1), wave(128, 15, 2)
    side = [p - q for p, q in zip(a, b, strict=True)]
    first, second = {1: (a, b), 8: (a, side), 9: (side, b), 10: ([(p + q) >> 1 for p, q in zip(a, b, strict=True)], side)}[code]
    data = stream([(code, 128, [(first, ("fixed", 1), {}), (second, ("fixed", 2), {})])], 16, 2)
    assert F.decode_streams([data])[0].samples.T.tolist() == [a, b]


def test_mixed_frames_decode_together():
    frames = [(0, 64 + 16 * i, [(wave(64 + 16 * i, 16, i), KINDS[i % 7], {})]) for i in range(12)]
    want = [x for _, _, subs in frames for x in subs[0][0]]
    assert F.decode_streams([stream(frames, 16, 1)] * 2)[1].samples[:, 0].tolist() == want


def test_encoder_round_trip_and_seek_table():
    rng = random.Random(1)
    payloads = [bytes(rng.randrange(256) for _ in range(192 * n)) for n in (1, 3, 130)] + [b"a" * 192, bytes(range(192)), b"\xff\xf8\x10\x02" * 48]
    streams = F.encode_streams(payloads)
    for p, s, d in zip(payloads, streams, F.decode_streams(streams), strict=True):
        assert (d.samples[:, 0].astype(np.int8).view(np.uint8) ^ 0x80).tobytes() == p
        head = F.read_head(s)
        for sample, offset, n in d.seek:
            start, length = F.find_frames(np.frombuffer(s, np.uint8), head.first)
            k = int(np.searchsorted(start, head.first + offset))
            (one,) = F.decode_frames(np.frombuffer(s, np.uint8), start[k : k + 1], length[k : k + 1], 8)
            assert n == 192 and (one[:, 0].astype(np.int8).view(np.uint8) ^ 0x80).tobytes() == p[sample : sample + 192]


def test_damage_is_found():
    (good,) = F.encode_streams([b"hello world " * 64])
    for at in (0, 30, 70, len(good) - 1, len(good) // 2):
        bad = bytearray(good)
        bad[at] ^= 0x10
        with pytest.raises(F.FlacError):
            F.decode_streams([bytes(bad)])
    with pytest.raises(F.FlacError):
        F.decode_streams([good[:-40]])


def test_frame_numbers():
    assert [F._coded_number(n) for n in (0x7F, 0x80, 0x7FF, 0x800, 0xFFFF, 0x10000)] == [chr(n).encode("utf-8", "surrogatepass") for n in (0x7F, 0x80, 0x7FF, 0x800, 0xFFFF, 0x10000)]


def test_columns_match_brute_force(spark):
    rows = hard_rows()
    media = F.encode_texts(with_clashing_columns(docs(spark, rows)))
    got = sorted(tuple(r)[:5] for r in F.media_digests(media).select(F_doc(), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32").collect())
    want = []
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        padded = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        want.append((doc_id or 0, len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:])))
    assert got == sorted(want)


def F_doc():
    from pyspark.sql import functions as fn

    return fn.coalesce("doc_id", fn.lit(0))


def test_pcm_blocks_are_seekable(spark):
    rows = [(1, "abc " * 400, "en", "s", 1), (2, None, "en", "s", 1)]
    blocks = F.pcm_blocks(F.encode_texts(docs(spark, rows)), 500).orderBy("doc_id", "block").collect()
    whole = b"".join(b["pcm"] for b in blocks if b["doc_id"] == 1)
    assert bytes(x ^ 0x80 for x in whole) == F.payload_of(rows[0][1])[1]
    assert [b["sample_offset"] for b in blocks if b["doc_id"] == 1] == [0, 500, 1000, 1500]


def test_empty_table(spark):
    assert F.media_digests(F.encode_texts(docs(spark, []))).count() == 0


def test_encoder_writes_linear_predictors_where_they_win():
    payload = F.payload_of(prose(3, 400))[1]
    stream = F.encode_streams([payload])[0]
    data, first = np.frombuffer(stream, np.uint8), F.read_head(stream).first
    start, _ = F.find_frames(data, first)
    kinds = (data[start + F._headers(data, start)["size"]] >> 1).tolist()
    assert 31 + F.ORDER in kinds and {k for k in kinds if k < 32} <= {8, 9, 10}
    x = (np.frombuffer(payload, np.uint8) ^ 0x80).view(np.int8).reshape(-1, 192).astype(np.int64)
    weights, shift = F.linear_predictors(x)
    assert np.abs(weights).max() <= 32 and shift.min() >= 0

    def bits(r, order, extra):
        u = [(v << 1) ^ (v >> 63) for v in r[order:].tolist()]
        return 8 + 8 * order + extra + 10 + min(sum((v >> k) + 1 + k for v in u) for k in range(10))

    for row in range(len(x)):
        guess = [sum(int(weights[j, row]) * int(x[row, t - 1 - j]) for j in range(F.ORDER)) >> int(shift[row]) if t >= F.ORDER else 0 for t in range(192)]
        linear = bits(x[row] - guess, F.ORDER, 9 + 6 * F.ORDER)
        orders = [x[row], np.diff(x[row], prepend=0), np.concatenate([[0, 0], np.diff(x[row], 2)])]
        fixed = min(range(3), key=lambda o: (np.abs(orders[o][o:]).sum(), o))
        assert kinds[row] == (31 + F.ORDER if linear < bits(orders[fixed], fixed, 0) else 8 + fixed)


def test_digests_come_from_stored_blocks_of_any_size(spark):
    rows = hard_rows() + [(100 + i, prose(i, 300 * i), "en", "s", 1) for i in range(4)] + [(7, prose(2, 200), "en", "s", 1)] * 2
    media = F.encode_texts(docs(spark, rows))
    whole = sorted(map(tuple, F.media_digests(media).collect()), key=str)
    assert whole == sorted(map(tuple, F.media_digests(media, 576).collect()), key=str) and len(whole) == len(rows)
    blocks = F.decoded_blocks(media, 576)
    assert blocks.where("n_blocks > 1").count() > 20
    want = []
    for _, text, *_ in rows:
        x = (np.frombuffer(F.payload_of(text)[1], np.uint8) ^ 0x80).view(np.int8).astype(np.int64)
        turns = sum((a < 0) != (b < 0) for a, b in zip(x.tolist(), x.tolist()[1:], strict=False))
        want.append(f"peak={abs(x).max()};energy={(x * x).sum()};magnitude={abs(x).sum()};sign_changes={turns};variation={abs(x[1:] - x[:-1]).sum()}")
    assert sorted(r[-1] for r in whole) == sorted(want)
