"""Toxicity: a convolutional text classifier trained in numpy.

Words are hashed into two buckets each, whose embeddings are added; filters of
several widths slide over the words, each filter's largest response is kept, and
a logistic layer turns these into a score.  Embeddings start from the buckets'
standardised log-odds in the training rows and are then trained with filters and
output layer (Adam, mini-batches, a fixed seed).  Only texts are inputs.

A quarter of the training rows is kept from the embeddings and the filters.  On
it scores are calibrated by one monotone map, so that 0.5 is the best cut; beside
it each language has its own threshold for callers who want to flag by language:
the best cut of those rows where the others' rows weigh OTHERS, so that a
language with few rows leans on all.  Languages never touch a score.

Training takes at most MOST_ROWS labelled rows, chosen by a hash of the id, and of
these as many in that order as hold MOST_WORDS words together; the executors hash
the words, and 4 bytes a word reach the driver.  Training and scoring read whole
texts.

Defined cases: a null text counts as empty and gets the score of no words; a very
long text takes memory in proportion to its words; repeated rows and copies get
equal scores; of several texts of a labelled id the least is learnt from, and of
several labels the greatest; where two places of a text answer a filter alike, the
first is taken; rows
with a null doc_id are scored and not held out; extra columns, whatever their
names, are ignored; an empty table gives no rows; without labels of both kinds
every score is the share of label 1.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephos.llm.common import map_arrow
from nephos.session import drop_shared, write_shared

MOST_ROWS, MOST_WORDS = 8_000, 16_000_000
#: Weight of the other languages' rows in a language's threshold.
OTHERS = 0.05
BUCKETS, DIMENSION, WIDTHS, FILTERS = 1 << 16, 8, (1, 2, 3), 6
FOLDS = 5
_WORD = re.compile(r"[^\W_]+")
CACHED_WORDS = 400_000


def held_out(doc_id: Column) -> Column:
    """The rows that training never sees: crc32 of the id's text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def buckets(hashes: np.ndarray) -> np.ndarray:
    """(words, 2) bucket numbers of word hashes."""
    h = hashes.astype(np.int64)
    return np.stack([h & 0xFFFF, BUCKETS + (h >> 16)], axis=1)


class Hasher:
    """Two bucket numbers of each lower-cased word, with a bounded memory."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        """(words, 2) bucket numbers, the second ones in the upper half of the table."""
        return buckets(self.hashes(text))

    def hashes(self, text: str | None) -> np.ndarray:
        """32-bit hashes of the words."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known, words = self.known, _WORD.findall((text or "").lower())
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w) & 0xFFFFFFFF
        return np.fromiter(map(known.__getitem__, words), np.uint32, len(words))


@dataclass
class Net:
    """Parameters of the classifier."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Largest response of every filter, where it is, and the padded embeddings."""
        most = max(WIDTHS) - 1
        x = np.zeros((max(len(ids), 1) + most, DIMENSION), np.float32)
        if len(ids):
            x[: len(ids)] = self.embedding[ids[:, 0]] + self.embedding[ids[:, 1]]
        best, places = [], []
        for width, w in zip(WIDTHS, self.filters, strict=True):
            n = max(len(ids), 1)
            y = sum(x[k : k + n] @ w[k] for k in range(width))
            at = y.argmax(axis=0)
            places.append(at)
            best.append(y[at, np.arange(FILTERS)])
        return np.concatenate(best) + self.bias, places, x

    def logit(self, ids: np.ndarray) -> float:
        return float(np.maximum(self.pooled(ids)[0], 0) @ self.out + self.out_bias)

    def score(self, ids: np.ndarray) -> float:
        z = self.scale * (self.logit(ids) - self.shift)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def initial_embedding(texts: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator, few: int = 3) -> np.ndarray:
    """Small noise, and in the first dimension the scaled log-odds of buckets that ``few`` rows or more have."""
    hits = np.zeros((2, 2 * BUCKETS))
    for ids, y in zip(texts, labels, strict=True):
        hits[int(y), np.unique(ids)] += 1
    totals = np.array([(labels == 0).sum(), (labels == 1).sum()])[:, None]
    a, b = hits[1] + 0.5, hits[0] + 0.5
    na, nb = totals[1] - hits[1] + 0.5, totals[0] - hits[0] + 0.5
    z = np.log(a / na * nb / b) / np.sqrt(1 / a + 1 / b + 1 / na + 1 / nb)
    table = rng.normal(0, 0.01, (2 * BUCKETS, DIMENSION)).astype(np.float32)
    table[:, 0] += np.where(hits.sum(axis=0) >= few, np.clip(z, -8, 8) / 8, 0)
    return table


def gradients(net: Net, ids: np.ndarray, label: float, weight: float = 1.0) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
    """Of ``weight`` times the logistic loss: by filters, bias, output layer and its bias; and (buckets, gradient) of each embedding that is touched."""
    pre, places, x = net.pooled(ids)
    on = np.maximum(pre, 0)
    error = weight * float(1 / (1 + np.exp(-np.clip(on @ net.out + net.out_bias, -30, 30))) - label)
    back = error * net.out * (pre > 0)
    grads, touched = [np.zeros_like(w) for w in net.filters], []
    for j, (width, w) in enumerate(zip(WIDTHS, net.filters, strict=True)):
        g, spot = back[j * FILTERS : (j + 1) * FILTERS], places[j]
        for k in range(width):
            grads[j][k] += x[spot + k].T * g
            touched += [(ids[spot[f] + k], g[f] * w[k, :, f]) for f in np.flatnonzero(g) if spot[f] + k < len(ids)]
    return [*grads, back, error * on, np.array([error], np.float32)], touched


def train(texts: list[np.ndarray], labels: np.ndarray, epochs: int = 4, batch: int = 32, rate: float = 0.02, seed: int = 5) -> Net:
    """Adam on the logistic loss; embeddings get plain gradient steps, as few rows are touched."""
    rng = np.random.default_rng(seed)
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3))
    filters = [rng.normal(0, 0.1, (w, DIMENSION, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w in filters:
        w[:, 0] += 2.0
    size = FILTERS * len(WIDTHS)
    net = Net(initial_embedding(texts, labels, rng), filters, np.full(size, -0.5, np.float32), np.full(size, 0.1, np.float32), float(np.log(share / (1 - share))))
    if len(set(labels.tolist())) < 2:
        net.out[:] = 0
        return net
    params = [*net.filters, net.bias, net.out, np.array([net.out_bias], np.float32)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            sums, step = [np.zeros_like(p) for p in params], step + 1
            for i in rows:
                grads, touched = gradients(net, texts[i], labels[i], 1 / len(rows))
                for total, g in zip(sums, grads, strict=True):
                    total += g
                for place, g in touched:
                    net.embedding[place] -= rate * g
            for p, g, m, v in zip(params, sums, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            net.out_bias = float(params[-1][0])
    return net


def best_cut(values: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> float:
    """The cut of least (weighted) training error, between two values; ties go to the middle one."""
    order = np.argsort(values, kind="stable")
    v, y, w = values[order], labels[order], np.ones(len(values)) if weights is None else weights[order]
    errors = np.concatenate([[0], np.cumsum(w * y)]) + np.concatenate([np.cumsum((w * (1 - y))[::-1])[::-1], [0]])
    errors[1:-1][v[1:] == v[:-1]] = w.sum() + 1
    least = np.flatnonzero(errors <= errors.min() + 1e-9)
    at = int(least[len(least) // 2])
    if at == 0:
        return float(v[0]) - 1
    return float(v[-1]) + 1 if at == len(v) else float(v[at - 1] + v[at]) / 2


def calibrate(net: Net, texts: list[np.ndarray], labels: np.ndarray, langs: list[str]) -> None:
    """Shift the scores so that 0.5 is the best cut; a threshold for each language, the others' rows weighing OTHERS."""
    if len(set(labels.tolist())) < 2:
        return
    logits = np.array([net.logit(t) for t in texts])
    net.shift = best_cut(logits, labels)
    net.scale = 4.0 / max(float(np.median(np.abs(logits - net.shift))), 1e-3)
    scores = 1 / (1 + np.exp(-np.clip(net.scale * (logits - net.shift), -30, 30)))
    for lang in sorted(set(langs)):
        mine = np.array([x == lang for x in langs])
        net.thresholds[lang] = best_cut(scores, labels, np.where(mine, 1.0, OTHERS))


def training_rows(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, most_words: int = MOST_WORDS) -> list[tuple[np.ndarray, str, int]]:
    """(word hashes, lang, toxic) of labelled rows outside the held-out fold, within both bounds; in the order of ids."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).join(F.broadcast(chosen), "doc_id")
    first = F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))).alias("d")
    one = rows.groupBy("doc_id", "toxic").agg(first).select("doc_id", F.xxhash64("doc_id").alias("place"), F.col("toxic").cast("int").alias("toxic"), "d.lang", "d.text")
    out = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("toxic", pa.int32()), ("lang", pa.string()), ("n", pa.int64()), ("words", pa.binary())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not _HASHERS:
            _HASHERS.append(Hasher())
        hashed = [_HASHERS[0].hashes(t) for t in batch.column(4).to_pylist()]
        counts, words = pa.array([len(h) for h in hashed], pa.int64()), pa.array([h.astype("<u4").tobytes() for h in hashed], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *batch.columns[1:4], counts, words], schema=out)

    table = write_shared(map_arrow(one, run, "doc_id bigint, place bigint, toxic int, lang string, n bigint, words binary"), "toxicity-words")
    held, last = 0, None
    for r in table.select("place", "doc_id", "n").orderBy("place", "doc_id").collect():
        held += r["n"]
        if held > most_words and last is not None:
            break
        last = (r["place"], r["doc_id"])
    if last is not None:
        table = table.where((F.col("place") < last[0]) | ((F.col("place") == last[0]) & (F.col("doc_id") <= last[1])))
    found = sorted(((r["doc_id"], r["words"], r["lang"], r["toxic"]) for r in table.toLocalIterator()), key=lambda r: r[0])
    drop_shared(table)
    return [(np.frombuffer(words, "<u4"), lang, toxic) for _, words, lang, toxic in found]


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Net:
    rows = training_rows(docs, labels, most_rows)
    return fit_arrays([buckets(h).astype(np.int32) for h, _, _ in rows], np.array([float(y) for *_, y in rows]), [lang for _, lang, _ in rows])


def fit_arrays(texts: list[np.ndarray], labels: np.ndarray, langs: list[str]) -> Net:
    """Train on three quarters of the rows, calibrate on the others, whose words the embeddings haven't seen."""
    order = np.random.default_rng(3).permutation(len(texts))
    fitted, cut = order[len(order) // 4 :], order[: len(order) // 4]
    net = train([texts[i] for i in fitted], labels[fitted])
    calibrate(net, [texts[i] for i in cut], labels[cut], [langs[i] for i in cut])
    return net


_HASHERS: list[Hasher] = []


def toxicity_scores(docs: DataFrame, net: Net) -> DataFrame:
    """doc_id, held_out, score, predicted, and flagged by the language's own threshold."""
    model = docs.sparkSession.sparkContext.broadcast(net)
    out = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("score", pa.float64())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not _HASHERS:
            _HASHERS.append(Hasher())
        scores = [model.value.score(_HASHERS[0](t)) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(scores, pa.float64())], schema=out)

    scored = map_arrow(docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text"), run, "doc_id bigint, lang string, score double")
    limit = F.lit(0.5)
    for lang, cut in net.thresholds.items():
        limit = F.when(F.col("lang") == lang, F.lit(cut)).otherwise(limit)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        (F.col("score") >= limit).cast("int").alias("flagged"),
    )


def crc_fold(doc_id: int) -> int:
    """The fold of an id in plain Python, as ``held_out`` computes it."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS
