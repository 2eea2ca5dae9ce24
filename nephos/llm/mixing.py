"""Mixing sources to target weights by iterative proportional fitting.

Token counts (ids of a tokenizer and the end id, or words where no tokenizer is
given) are summed by (source, language, topic).  A margin's targets are named
weights, where categories without a name count as OTHER, or a power: then every
category of the corpus aims at its token share raised to it.  Raking scales the
cells' keep rates, margin after margin, until each margin has its share of the
tokens to keep; a rate never passes 1.  Targets are never moved.  Where rates of at
most 1 can't meet all margins together, the cells go from there to the margins
nearest to those asked, by least squares, which are unique; what is asked and what
is reached stand beside each row, and the largest gap between them.  Documents are
then drawn independently with their cell's rate, by a hash of id and text, so a
rerun draws the same rows and any document may be decided alone.

Only the cells' sums reach the driver, MOST_CELLS at most: margins so fine that
there are more raise, and need named weights.

Topics are learnt from the texts (``topics``) where a tokenizer is given, else
they are the texts' forms.

Defined cases: null source or lang counts as OTHER; a null or very long text is
like any other, a text without words has no tokens and is not drawn; a margin
without tokens gets none and the others share its weight; a target over a
category's tokens keeps all of it, and the gap says so; equal rows are drawn alike,
a null id like any value; categories of equal size aim at equal shares; extra
columns pass through whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.llm.common import map_arrow, slices, word_count
from nephos.llm.token_store import SLICE_BYTES, encoder
from nephos.llm.topics import OTHER, count_lists, fit_topics, packed, with_topics
from nephos.session import drop_shared, write_shared

DIMENSIONS = ("source", "lang", "topic")
Cell = tuple[str, str, str]
Targets = dict[str, dict[str, float] | float]
#: Production targets of the registered query: powers of the corpus's own token shares.
TARGETS: Targets = {"source": 0.5, "lang": 0.7, "topic": 0.7}
KEEP_SHARE = 0.4
#: Cells that the driver takes; steps of the search for the nearest margins.
MOST_CELLS, MOST_STEPS = 1 << 20, 20_000


def topic_of(text: Column) -> Column:
    """The form of a text, a topic that needs no model: the first rule that holds."""
    has = lambda *marks: F.greatest(*[F.contains(text, F.lit(m)) for m in marks], F.lit(False))
    return (
        F.when(F.coalesce(F.trim(text), F.lit("")) == "", F.lit("empty"))
        .when(has("###", "$$$", "&&&", "%%%", "***"), F.lit("markup"))
        .when(has(" | "), F.lit("table"))
        .when(has("!! "), F.lit("shouting"))
        .when(has("@", "://"), F.lit("contact"))
        .otherwise(F.lit("prose"))
    )


def has_words(text: Column) -> Column:
    return F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def keyed(docs: DataFrame, *keep: Column, tokenizer: str | None = None) -> DataFrame:
    """``keep``, _source, _lang, _tokens, and _topic by form; with a tokenizer its ids and the end id count, and _at and _n hold the bucket counts, packed, instead of a topic."""
    text = F.col("text")
    names = [F.coalesce(F.col(c).cast("string"), F.lit(OTHER)).alias(f"_{c}") for c in ("source", "lang")]
    if tokenizer is None:
        return docs.select(*keep, *names, word_count(text).alias("_tokens"), topic_of(text).alias("_topic"))
    rows = docs.select(*keep, *names, F.when(has_words(text), text).alias("_text"))
    width = len(keep) + 2

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "_text", SLICE_BYTES):
            texts = part.column(width).to_pylist()
            ids, sizes = encoder(tokenizer).flat_ids(texts)
            counts = pa.array(np.where([t is None for t in texts], 0, sizes + 1), pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns[:width], counts, *map(packed, count_lists(ids, sizes))], names=[*part.schema.names[:width], "_tokens", "_at", "_n"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:width])
    return map_arrow(rows, run, f"{kept}, _tokens bigint, _at binary, _n binary")


def cell_tokens(docs: DataFrame, targets: Targets, tokenizer: str | None = None) -> dict[Cell, int]:
    """Tokens of each cell."""
    if tokenizer is None:
        return summed(keyed(docs), targets)
    counted = write_shared(keyed(docs, tokenizer=tokenizer), "mix-counts")
    tokens = summed(with_topics(counted, fit_topics(counted)), targets)
    drop_shared(counted)
    return tokens


def among(d: str, targets: Targets) -> Column:
    """The category of margin ``d``: OTHER if the margin has names and this is none of them."""
    asked = targets[d]
    if not isinstance(asked, dict):
        return F.col(f"_{d}")
    return F.when(F.col(f"_{d}").isin(*asked), F.col(f"_{d}")).otherwise(F.lit(OTHER)) if asked else F.lit(OTHER)


def summed(rows: DataFrame, targets: Targets) -> dict[Cell, int]:
    """Tokens of each cell of keyed rows."""
    sums = rows.groupBy(*[among(d, targets).alias(d) for d in DIMENSIONS]).agg(F.sum("_tokens").alias("n")).where("n > 0")
    found = sums.limit(MOST_CELLS + 1).collect()
    if len(found) > MOST_CELLS:
        raise ValueError(f"over {MOST_CELLS} cells of {DIMENSIONS}: give a margin named weights")
    return {(r["source"], r["lang"], r["topic"]): r["n"] for r in found}


@dataclass(frozen=True)
class Mix:
    """Keep rates of the cells; (dimension, category, asked share, reached share) of each margin; the largest gap between the two."""

    rates: dict[Cell, float]
    margins: list[tuple[str, str, float, float]]
    gap: float


def wanted_shares(tokens: dict[Cell, int], targets: Targets) -> list[dict[str, float]]:
    """The share that each present category of each margin aims at."""
    total = sum(tokens.values())
    out: list[dict[str, float]] = []
    for at, d in enumerate(DIMENSIONS):
        shares: dict[str, float] = {}
        for cell, n in tokens.items():
            shares[cell[at]] = shares.get(cell[at], 0.0) + n / total
        asked = targets[d]
        if isinstance(asked, dict):
            weights = {k: w for k, w in asked.items() if k in shares and w > 0}
            if OTHER in shares and OTHER not in weights:
                weights[OTHER] = shares[OTHER]
        else:
            weights = {k: s**asked for k, s in shares.items()}
        out.append({k: w / sum(weights.values()) for k, w in weights.items()})
    return out


def rake(tokens: dict[Cell, int], targets: Targets, keep_share: float = KEEP_SHARE, tolerance: float = 1e-9, most_rounds: int = 500) -> Mix:
    """Rates for ``targets``; what can't be met is as near as rates of at most 1 come, logged, and told by the margins."""
    if not tokens:
        return Mix({}, [], 0.0)
    cells = sorted(tokens)  # sums in one order, whatever order the cells came in
    wanted = wanted_shares({c: tokens[c] for c in cells}, targets)
    names = [sorted({c[at] for c in cells}) for at in range(len(DIMENSIONS))]
    places = [{k: i for i, k in enumerate(n)} for n in names]
    codes = [np.array([places[at][c[at]] for c in cells]) for at in range(len(DIMENSIONS))]
    asked = [np.array([w.get(k, 0.0) for k in n]) for w, n in zip(wanted, names, strict=True)]
    # Masses and their upper bounds in units of all tokens to keep, so that a margin sums to 1.
    most = np.array([tokens[c] for c in cells]) / (keep_share * sum(tokens.values()))
    mass = fitted(codes, asked, most, most * keep_share, tolerance, most_rounds)
    if missed(codes, asked, mass) > tolerance * 10:
        mass = nearest(codes, asked, most, mass)
    reached = [np.bincount(c, mass, len(a)) / (mass.sum() or 1.0) for c, a in zip(codes, asked, strict=True)]
    margins = [(d, k, float(a), float(r)) for d, ks, aa, rr in zip(DIMENSIONS, names, asked, reached, strict=True) for k, a, r in zip(ks, aa, rr, strict=True)]
    gap = max(abs(a - r) for *_, a, r in margins)
    if gap > 0.001:
        logging.getLogger(__name__).warning("mixture misses a target by %.4f: %s", gap, max(margins, key=lambda m: abs(m[2] - m[3])))
    return Mix(dict(zip(cells, np.minimum(mass / most, 1.0).tolist(), strict=True)), margins, gap)


def missed(codes: list[np.ndarray], asked: list[np.ndarray], mass: np.ndarray) -> float:
    return max(float(np.abs(np.bincount(c, mass, len(a)) - a).max()) for c, a in zip(codes, asked, strict=True))


def fitted(codes: list[np.ndarray], asked: list[np.ndarray], most: np.ndarray, mass: np.ndarray, tolerance: float, most_rounds: int) -> np.ndarray:
    """Iterative proportional fitting of masses, none over its bound."""
    for _ in range(most_rounds):
        before = mass
        for code, want in zip(codes, asked, strict=True):
            have = np.bincount(code, mass, len(want))
            mass = np.minimum(most, mass * np.divide(want, have, out=np.zeros_like(want), where=have > 0)[code])
        if np.abs((mass - before) / most).max() < tolerance:
            break
    return mass


def nearest(codes: list[np.ndarray], asked: list[np.ndarray], most: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Masses within their bounds, one in all, whose margins are nearest to those asked, by least squares, from ``mass`` on.

    Accelerated projected gradient steps, each cell's by the number of cells that
    share a category with it, which bounds the curvature.
    """
    step = 1.0 / sum(np.bincount(c, minlength=len(a))[c] for c, a in zip(codes, asked, strict=True))
    shift = 0.0
    x = y = _projected(mass, step, most, 0.0)[0]
    t = 1.0
    for _ in range(MOST_STEPS):
        slope = sum((np.bincount(c, y, len(a)) - a)[c] for c, a in zip(codes, asked, strict=True))
        new, shift = _projected(y - step * slope, step, most, shift)
        moved = new - x
        if ((y - new) * moved / step).sum() > 0:  # past the least point: start anew from here
            t = 1.0
        ahead = (1 + np.sqrt(1 + 4 * t * t)) / 2
        x, y, t = new, new + (t - 1) / ahead * moved, ahead
        if np.abs(moved).max() < 1e-15:
            break
    return x


def _projected(x: np.ndarray, step: np.ndarray, most: np.ndarray, shift: float) -> tuple[np.ndarray, float]:
    """The masses within their bounds, one in all, nearest to ``x`` in the steps' metric; and the shift that makes them so, begun at ``shift``."""
    low, high = float((-x / step).min()), float(((most - x) / step).max())  # none, or all at their bounds
    for _ in range(100):
        out = np.clip(x + step * shift, 0.0, most)
        over = out.sum() - 1.0
        if abs(over) < 1e-15:
            break
        low, high = (low, shift) if over > 0 else (shift, high)
        free = step[(out > 0) & (out < most)].sum()
        shift = shift - over / free if free else (low + high) / 2
        if not low < shift < high:
            shift = (low + high) / 2
    return np.clip(x + step * shift, 0.0, most), shift


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A uniform number in [0, 1) from the row's own content."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text), 11).cast("double") / F.lit(float(2**53))


def mix_rows(docs: DataFrame, mix: Mix, targets: Targets, seed: int = 11) -> DataFrame:
    """Every document with its cell by form, words, keep rate and whether it is drawn.

    Documents without tokens have no cell to weigh and are not drawn.
    """
    drawn = draw(F.col("doc_id"), F.col("text"), seed).alias("_draw")
    return rated(keyed(docs, F.col("doc_id"), drawn), mix, targets)


def mix_tokens(docs: DataFrame, targets: Targets, tokenizer: str, keep_share: float = KEEP_SHARE, seed: int = 11) -> DataFrame:
    """As mix_rows, by learnt topics and ids of the file ``tokenizer``; what is counted is written, so that each text is tokenized once."""
    drawn = draw(F.col("doc_id"), F.col("text"), seed).alias("_draw")
    counted = write_shared(keyed(docs, F.col("doc_id"), drawn, tokenizer=tokenizer), "mix-counts")
    rows = write_shared(with_topics(counted, fit_topics(counted)), "mix-rows")
    drop_shared(counted)
    return rated(rows, rake(summed(rows, targets), targets, keep_share), targets)


def cell_table(spark: SparkSession, mix: Mix) -> DataFrame:
    """The cells with their rates and, for each margin, what is asked and what is reached: MOST_CELLS rows at most."""
    shares = {(d, k): (a, r) for d, k, a, r in mix.margins}
    rows = [(*cell, rate, *[x for d, k in zip(DIMENSIONS, cell, strict=True) for x in shares[d, k]]) for cell, rate in mix.rates.items()]
    columns = ", ".join(f"{d} string" for d in DIMENSIONS) + ", _rate double, " + ", ".join(f"{d}_{x} double" for d in DIMENSIONS for x in ("asked", "reached"))
    return spark.createDataFrame(rows, columns)


def rated(keyed_rows: DataFrame, mix: Mix, targets: Targets) -> DataFrame:
    """doc_id, cell, tokens, keep rate, draw, what the cell's margins ask and reach, and the mixture's largest gap, of keyed rows with doc_id and _draw."""
    known = F.broadcast(cell_table(keyed_rows.sparkSession, mix))
    rows = keyed_rows.select("doc_id", *[among(d, targets).alias(d) for d in DIMENSIONS], "_tokens", "_draw").join(known, list(DIMENSIONS), "left")
    rate = F.when(F.col("_tokens") > 0, F.coalesce("_rate", F.lit(0.0))).otherwise(F.lit(0.0))
    return rows.withColumn("rate", rate).select(
        "doc_id",
        *DIMENSIONS,
        F.col("_tokens").alias("n_tokens"),
        "rate",
        (F.col("_draw") < F.col("rate")).alias("drawn"),
        *[f"{d}_{x}" for d in DIMENSIONS for x in ("asked", "reached")],
        F.lit(mix.gap).alias("largest_gap"),
    )


def margin_report(spark, mix: Mix) -> DataFrame:
    """The targets of every margin beside the token shares that the rates reach."""
    return spark.createDataFrame(mix.margins, "dimension string, category string, target double, reached double")


def mix_documents(
    docs: DataFrame,
    targets: Targets,
    keep_share: float = KEEP_SHARE,
    seed: int = 11,
    tokenizer: str | None = None,
) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns."""
    drawn = draw(F.col("doc_id"), F.col("text"), seed).alias("_draw")
    if tokenizer is None:
        mix = rake(cell_tokens(docs, targets), targets, keep_share)
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
        rows = keyed(docs, row, drawn).select("_row", "_draw", "_tokens", *[among(d, targets).alias(d) for d in DIMENSIONS])
        met = rows.join(F.broadcast(cell_table(docs.sparkSession, mix)), list(DIMENSIONS))
        return met.where((F.col("_tokens") > 0) & (F.col("_draw") < F.col("_rate"))).select("_row.*")
    counted = write_shared(keyed(docs, tokenizer=tokenizer), "mix-counts")
    topics = fit_topics(counted)
    mix = rake(summed(with_topics(counted, topics), targets), targets, keep_share)
    drop_shared(counted)
    rates, named = mix.rates, [set(targets[d]) if isinstance(targets[d], dict) else None for d in DIMENSIONS]
    at = {c: docs.columns.index(c) for c in ("text", "lang", "source")}
    width = len(docs.columns)

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, f"c{at['text']}", SLICE_BYTES):
            column = lambda c: pc.cast(part.column(at[c]), pa.string()).to_pylist()  # noqa: E731, B023
            found = encoder(tokenizer).flat_ids(column("text"))
            langs = [OTHER if x is None else x for x in column("lang")]
            cells = zip([OTHER if x is None else x for x in column("source")], langs, topics.names(*count_lists(*found), langs), strict=True)
            pooled = (tuple(k if n is None or k in n else OTHER for k, n in zip(cell, named, strict=True)) for cell in cells)
            kept = [w and u < rates.get(cell, 0.0) for cell, w, u in zip(pooled, part.column(width).to_pylist(), part.column(width + 1).to_pylist(), strict=True)]
            found = part.filter(pa.array(np.array(kept, bool)))
            if found.num_rows:
                yield pa.RecordBatch.from_arrays(found.columns[:width], names=docs_names)

    docs_names = docs.columns
    # Names with dots cannot be selected by mapInArrow, so columns go in by number.
    whole = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs_names)], has_words(F.col("text")).alias("_words"), drawn)
    return map_arrow(whole, keep, docs.schema)
