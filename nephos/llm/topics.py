"""Topics learnt from the texts: spherical k-means over hashed token counts.

Token ids fall into BUCKETS buckets; a text is the vector of log counts times
inverse document frequencies, scaled to length 1, less the mean of its language,
so that clusters tell contents and not languages.  Every document counts in every
figure: frequencies, languages' means, the start and each round are sums that tasks
make from their rows and that meet in two steps (``summed_states``), in the order of
the partitions.  At most SEEDS vectors of BUCKETS numbers reach the driver at once, or
one a language; a language needs one document in SHARE, so there are at most SHARE.

The start: documents are grouped by a hash of their heaviest bucket, and centres are
the groups' means that lie far apart, the first that of the largest group.

Defined cases: texts without ids have the topic OTHER; a null or rare language takes
the mean of all; equal texts of one language share a topic, and equal scores go to
the first topic; with fewer texts than topics there are fewer topics; an empty table
gives none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nephos.llm.common import SHARE, gather_states, map_arrow, summed_states
from nephos.llm.token_store import forget_words

OTHER = "other"
BUCKETS, TOPICS, SEEDS, ROUNDS = 2048, 8, 128, 4
STEP = 2.0**-20


def count_lists(ids: np.ndarray, sizes: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The buckets that the ids of each text fall into, and how many in each, as list columns; ``sizes`` of the texts' ids lie one after the other."""
    mixed = ((ids * np.uint32(2_654_435_761)) >> np.uint32(21)).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    at, n, filled = [np.empty(0, np.int16)], [np.empty(0, np.int32)], [np.zeros(1, np.int32)]
    for first in range(0, len(sizes), 64):  # texts whose counts stay small
        part = sizes[first : first + 64]
        row = np.repeat(np.arange(len(part)) * BUCKETS, part)
        counts = np.bincount(row + mixed[ends[first] : ends[first + len(part)]], minlength=len(part) * BUCKETS)
        found = np.flatnonzero(counts)
        at.append((found % BUCKETS).astype(np.int16))
        n.append(counts[found].astype(np.int32))
        filled.append(np.bincount(found // BUCKETS, minlength=len(part)).astype(np.int32))
    offsets = pa.array(np.cumsum(np.concatenate(filled), dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(at))), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(n)))


def packed(lists: pa.ListArray) -> pa.Array:
    """Lists of numbers as the bytes of each, which Spark carries without looking at every number."""
    numbers = lists.flatten().to_numpy()
    offsets = (lists.offsets.to_numpy() - lists.offsets[0].as_py()) * numbers.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(numbers.tobytes())])


def unpacked(column: pa.Array, kind: type) -> pa.ListArray:
    """The lists of ``packed``."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    numbers = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].tobytes()
    return pa.ListArray.from_arrays(pa.array(((offsets - offsets[0]) // np.dtype(kind).itemsize).astype(np.int32)), pa.array(np.frombuffer(numbers, kind)))


def stepped(x: np.ndarray) -> np.ndarray:
    """Rounded to whole STEPs, whose sums are exact and so do not depend on the order."""
    return np.rint(x / STEP) * STEP


class Rows:
    """Texts with ids as sparse vectors, flat: bucket and weight of each entry, where each row begins, and each row's language."""

    def __init__(self, at: pa.ListArray, n: pa.ListArray, langs: Sequence[str | None], idf: np.ndarray, means: dict[str, np.ndarray]):
        offsets = at.offsets.to_numpy()
        sizes = np.diff(offsets)
        self.m, self.start, self.row = len(sizes), (offsets[:-1] - offsets[0]).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
        self.at = at.flatten().to_numpy().astype(np.int64)  # flatten() keeps to a slice's own rows
        w = np.log1p(n.flatten().to_numpy()) * idf[self.at]
        norm = np.sqrt(np.add.reduceat(w * w, self.start)) if self.m else np.empty(0)
        self.w = w / np.maximum(norm, 1e-12)[self.row]
        names = list(means)
        code = {name: k for k, name in enumerate(names)}
        self.lang = np.array([code.get(x or OTHER, code[OTHER]) for x in langs], np.int64)
        self.means = np.stack([means[k] for k in names])

    def scores(self, centres: np.ndarray) -> np.ndarray:
        """Of each centre (columns) with each row less its language's mean."""
        if not self.m:
            return np.empty((0, len(centres)))
        table, w = np.ascontiguousarray(centres.T, np.float32), self.w.astype(np.float32)[:, None]
        out = np.empty((self.m, len(centres)), np.float32)
        for first in range(0, self.m, 512):  # entries times centres in pieces that stay small
            starts = self.start[first : first + 513]
            end = starts[512] if len(starts) > 512 else len(self.at)
            part = slice(starts[0], end)
            out[first : first + 512] = np.add.reduceat(table[self.at[part]] * w[part], starts[:512] - starts[0], axis=0)
        return out - (self.means @ centres.T)[self.lang]

    def summed(self, group: np.ndarray, groups: int) -> np.ndarray:
        """Of each group: its rows, their scales to length 1 by language, and their scaled sum, all but the count in whole STEPs."""
        flat = self.means.reshape(-1)
        along = np.add.reduceat(self.w * flat[(self.lang * BUCKETS)[self.row] + self.at], self.start)
        square = np.add.reduceat(self.w * self.w, self.start) - 2 * along + (self.means * self.means).sum(axis=1)[self.lang]
        scale = 1 / np.maximum(np.sqrt(np.maximum(square, 0)), 1e-12)
        scale[square < 1e-12] = 0.0
        sums = np.bincount((group * BUCKETS)[self.row] + self.at, stepped(self.w * scale[self.row]), groups * BUCKETS).reshape(groups, BUCKETS)
        weight = np.bincount(group * len(self.means) + self.lang, stepped(scale), groups * len(self.means)).reshape(groups, -1)
        return np.concatenate([np.bincount(group, minlength=groups)[:, None], weight, sums], axis=1)

    def heaviest(self) -> np.ndarray:
        """The bucket of each row's greatest weight, the first of equal ones."""
        most = np.maximum.reduceat(self.w, self.start)
        place = np.where(self.w == most[self.row], np.arange(len(self.w)), len(self.w))
        return self.at[np.minimum.reduceat(place, self.start)]


@dataclass(frozen=True)
class Topics:
    """Inverse document frequencies, centres and the languages' means."""

    idf: np.ndarray
    centres: np.ndarray
    means: dict[str, np.ndarray]

    def names(self, at: pa.ListArray, n: pa.ListArray, langs: Sequence[str | None]) -> list[str]:
        if not len(self.centres):
            return [OTHER] * len(langs)
        full = np.flatnonzero(np.diff(at.offsets.to_numpy()) > 0)
        kept = pa.array(full)
        best = Rows(at.take(kept), n.take(kept), [langs[k] for k in full.tolist()], self.idf, self.means).scores(self.centres).argmax(axis=1)
        out = [OTHER] * len(langs)
        for k, topic in zip(full.tolist(), best.tolist(), strict=True):
            out[k] = f"topic{topic}"
        return out

    def name(self, raw: bytes, lang: str | None) -> str:
        return self.names(*count_lists(np.frombuffer(raw, "<u4"), np.array([len(raw) // 4])), [lang])[0]


def with_topics(counted: DataFrame, topics: Topics) -> DataFrame:
    """``counted`` with _topic in the place of _at and _n."""
    names = [c for c in counted.columns if c not in ("_at", "_n")]
    rows = counted.select(*names, "_at", "_n")
    at = names.index("_lang")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            named = topics.names(unpacked(part.column(len(names)), np.int16), unpacked(part.column(len(names) + 1), np.int32), part.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(named, pa.string())], names=[*names, "_topic"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[: len(names)])
    return map_arrow(rows, run, f"{kept}, _topic string")


def fit_topics(counted: DataFrame, topics: int = TOPICS) -> Topics:
    """The topics of all rows of ``counted`` (_lang, and _at and _n packed)."""
    rows = counted.where("length(_at) > 0").select("_lang", "_at", "_n")

    def frequencies(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        forget_words()
        return {"": np.concatenate([[batch.num_rows], np.bincount(unpacked(batch.column(1), np.int16).flatten().to_numpy(), minlength=BUCKETS)])}

    found = summed_states(gather_states(rows, frequencies))
    if not found:
        return Topics(np.zeros(BUCKETS), np.zeros((0, BUCKETS)), {OTHER: np.zeros(BUCKETS)})
    n = found[""][0]
    idf = np.log((1 + n) / (1 + found[""][1:]))
    often = rows.groupBy("_lang").count().where((F.col("count") * SHARE >= n) & (F.col("_lang") != OTHER))
    langs = sorted(r[0] for r in often.collect())
    zero = np.zeros(BUCKETS)

    def batch_rows(batch: pa.RecordBatch, means: dict[str, np.ndarray]) -> Rows:
        return Rows(unpacked(batch.column(1), np.int16), unpacked(batch.column(2), np.int32), batch.column(0).to_pylist(), idf, means)

    def language_sums(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        r = batch_rows(batch, dict.fromkeys([OTHER, *langs], zero))
        groups = len(langs) + 1
        sums = np.bincount(r.lang[r.row] * BUCKETS + r.at, stepped(r.w), groups * BUCKETS).reshape(groups, BUCKETS)
        counts = np.bincount(r.lang, minlength=groups)
        return {k: np.concatenate([[counts[i]], sums[i]]) for i, k in enumerate([OTHER, *langs]) if counts[i]}

    found = summed_states(gather_states(rows, language_sums))
    every = sum(found.values())
    means = {OTHER: every[1:] / every[0]} | {k: found[k][1:] / found[k][0] for k in langs}

    table = np.stack(list(means.values()))

    def centred(found: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Counts and sums less the means."""
        return {k: np.concatenate([v[:1], v[1 + len(table) :] - v[1 : 1 + len(table)] @ table]) for k, v in found.items()}

    def by_group(r: Rows, group: np.ndarray, groups: int) -> dict[str, np.ndarray]:
        return {f"{k:04d}": v for k, v in enumerate(r.summed(group, groups)) if v[0]}

    def start(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        r = batch_rows(batch, means)
        return by_group(r, (r.heaviest() * 40_503 >> 3) % SEEDS, SEEDS)

    centres = far_apart(centred(summed_states(gather_states(rows, start))), topics)
    for _ in range(ROUNDS):

        def nearest(batch: pa.RecordBatch, centres: np.ndarray = centres) -> dict[str, np.ndarray]:
            r = batch_rows(batch, means)
            return by_group(r, r.scores(centres).argmax(axis=1), len(centres)) if len(centres) else {}

        centres = unit_vectors(centred(summed_states(gather_states(rows, nearest))))
    return Topics(idf, centres, means)


def unit_vectors(found: dict[str, np.ndarray]) -> np.ndarray:
    """The sums scaled to length 1, those of most rows first; empty ones go."""
    order = sorted(found, key=lambda k: (-found[k][0], k))
    sums = np.array([found[k][1:] for k in order]).reshape(-1, BUCKETS)
    norms = np.linalg.norm(sums, axis=1)
    return sums[norms > 1e-9] / norms[norms > 1e-9, None]


def far_apart(found: dict[str, np.ndarray], most: int) -> np.ndarray:
    """Up to ``most`` of the groups' means: each time that whose rows have most to gain from it."""
    order = sorted(found, key=lambda k: (-found[k][0], k))
    weight = np.array([found[k][0] for k in order])
    sums = np.array([found[k][1:] for k in order]).reshape(-1, BUCKETS)
    norms = np.linalg.norm(sums, axis=1)
    sums, weight = sums[norms > 1e-9] / norms[norms > 1e-9, None], weight[norms > 1e-9]
    if not len(sums):
        return sums
    chosen = [0]
    while len(chosen) < min(most, len(sums)):
        gain = weight * np.maximum(1 - (sums @ sums[chosen].T).max(axis=1), 0)
        if not gain.max() > 1e-6:
            break
        chosen.append(int(gain.argmax()))
    return sums[chosen]
