"""Quality rules: text statistics and a learned decision list, all in Spark expressions.

Sequential covering learns an ordered list of threshold conjunctions that mark
low-quality texts, from the statistics of labelled documents.  Growing and
pruning need only the few numbers of a bounded sample of labelled rows; the list
comes back as one ``CASE``-like Column, so scoring has no Python in it.

Defined cases: a null text counts as empty (no words, base_failed); a very long
text is measured whole; a null doc_id passes through; repeated rows give repeated
results; of several texts of a labelled id the least one is learnt from, and of
several labels the least; of tests with equal gains the first stays; extra columns, whatever their names, are ignored by
``quality_scores`` and kept by ``keep_good``; an empty table gives no rows;
without labelled rows the list is empty and only the base rule decides.
"""

from __future__ import annotations

import random
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephos.llm.common import SPACE_CLASS, let, words_of

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_bangs"]
#: Ratios that the rules may test, each a pair (numerator, denominator).
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "bangs_per_word": ("n_bangs", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_lines_per_word": ("n_dup_lines", "n_words"),
    "words": ("n_words", None),
}


def _without(text: Column, characters: str) -> Column:
    """``text`` less some ASCII characters; byte-level replacement, one character each."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in ``words``.

    Windows are 64-bit hashes.  Texts without an equal pair stop at the distinct
    count; the rest sort (hash, position) and walk the neighbours, so the cost is
    n log n however often one window repeats.
    """

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def repeated(s: Column) -> Column:
        return F.filter(
            s,
            lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]),
        )

    def count(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        at = let(pairs, lambda s: F.sort_array(F.transform(repeated(s), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(at, covered))

    def of(w: Column) -> Column:
        hashes = F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
        )
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(hashes, count))

    return let(words, of)


def text_stats(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and STATS of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    solid = F.length(_without(text, SPACES))
    long = lambda c, name: c.cast("long").alias(name)
    return docs.select(
        *keep,
        words_of(F.col("text")).alias("_words"),
        long(solid, "word_chars"),
        long(F.length(text) - F.length(_without(text, SYMBOLS)), "n_symbols"),
        long(let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), "n_dup_lines"),
        long(F.length(text) - F.length(F.regexp_replace(text, r"[A-Z]+", "")), "n_upper"),
        long(F.length(text) - F.length(_without(text, "!")), "n_bangs"),
    ).select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        _repeat_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        "n_upper",
        "n_bangs",
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    """``feature`` at least (above) or at most a threshold."""

    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, float]) -> bool:
        return values[self.feature] >= self.threshold if self.above else values[self.feature] <= self.threshold

    def column(self) -> Column:
        value = feature_column(self.feature)
        return value >= F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


@dataclass(frozen=True)
class Rule:
    """A conjunction of tests whose texts are of low quality."""

    tests: tuple[Test, ...]

    def holds(self, values: dict[str, float]) -> bool:
        return all(t.holds(values) for t in self.tests)

    def column(self) -> Column:
        out = self.tests[0].column()
        for t in self.tests[1:]:
            out = out & t.column()
        return out


def feature_column(name: str) -> Column:
    over, under = FEATURES[name]
    value = F.col(over).cast("double")
    return value if under is None else value / F.greatest(F.col(under), F.lit(1)).cast("double")


def feature_values(row: dict[str, int]) -> dict[str, float]:
    """The same features of one row of statistics, in plain Python."""
    return {n: float(row[a]) / float(1 if b is None else max(row[b], 1)) for n, (a, b) in FEATURES.items()}


def _thresholds(values: list[float], most: int) -> list[float]:
    """Midpoints between neighbouring distinct values, about ``most`` of them, evenly by rank."""
    distinct = sorted(set(values))
    cuts = [(a + b) / 2 for a, b in zip(distinct, distinct[1:], strict=False)]
    step = max(1, len(cuts) / most)
    return [cuts[int(i * step)] for i in range(int(len(cuts) / step))] if cuts else []


def _precision(bad: int, good: int) -> float:
    """Laplace estimate of the share of bad rows."""
    return (bad + 1) / (bad + good + 2)


def learn_decision_list(
    rows: list[tuple[dict[str, float], bool]],
    min_precision: float = 0.9,
    min_cover: int = 5,
    most_rules: int = 8,
    most_tests: int = 3,
    most_cuts: int = 64,
) -> list[Rule]:
    """Sequential covering over ``(feature values, is bad)`` rows.

    A third of the rows, drawn with a fixed seed, is held for pruning.  A rule grows by the test that raises
    FOIL's gain most, loses its last tests while that doesn't lower
    (bad - good) / (bad + good) on the held rows, and is kept if it is precise
    on both parts; its rows then go and the next rule is grown.
    """
    rows = random.Random(17).sample(rows, len(rows))
    grow, held = rows[len(rows) // 3 :], rows[: len(rows) // 3]
    rules: list[Rule] = []

    def counts(part: list, rule: tuple[Test, ...]) -> tuple[int, int]:
        flags = [bad for values, bad in part if all(t.holds(values) for t in rule)]
        return sum(flags), len(flags) - sum(flags)

    def best_test(part: list) -> tuple[float, Test] | None:
        bad, good = sum(b for _, b in part), sum(not b for _, b in part)
        before, best = log2(_precision(bad, good)), None
        for name in FEATURES:
            order = sorted((values[name], b) for values, b in part)
            total, upto, at = len(order), [0, 0], 0
            for cut in _thresholds([v for v, _ in order], most_cuts):
                while at < total and order[at][0] <= cut:
                    upto[order[at][1]] += 1
                    at += 1
                for above, (b, g) in ((True, (bad - upto[1], good - upto[0])), (False, (upto[1], upto[0]))):
                    if b >= min_cover and (gain := b * (log2(_precision(b, g)) - before)) > 1e-9 and (best is None or gain > best[0]):
                        best = (gain, Test(name, above, cut))
        return best

    while len(rules) < most_rules and sum(b for _, b in grow) >= min_cover:
        part, tests = grow, []
        while len(tests) < most_tests and any(not b for _, b in part) and (found := best_test(part)):
            tests.append(found[1])
            part = [r for r in part if found[1].holds(r[0])]
        if not tests:
            break

        def worth(rule: tuple[Test, ...]) -> float:
            bad, good = counts(held, rule)
            return (bad - good) / (bad + good) if bad + good else -1.0

        while len(tests) > 1 and worth(tuple(tests[:-1])) >= worth(tuple(tests)):
            tests.pop()
        rule = Rule(tuple(tests))
        bad, good = counts(grow, rule.tests)
        held_bad, held_good = counts(held, rule.tests)
        if bad < min_cover or _precision(bad + held_bad, good + held_good) < min_precision:
            break
        rules.append(rule)
        grow = [r for r in grow if not rule.holds(r[0])]
        held = [r for r in held if not rule.holds(r[0])]
    return rules


def labelled_rows(docs: DataFrame, labels: DataFrame, most_rows: int) -> list[tuple[dict[str, float], bool]]:
    """Features and labels of at most ``most_rows`` labelled documents, chosen by a hash of the id.

    The labelled side is cut before the texts are read, so its size, and with it
    the broadcast, is bounded by ``most_rows``.  Rows that the base rule fails
    leave on the driver: a filter on their statistics would be pushed below the
    join and measure every text.
    """
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )
    # One text of an id, so no more rows come back than were chosen.
    first = F.min(F.struct(F.col("text").isNull().alias("late"), "text"))["text"].alias("text")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(first)
    rows = sorted(text_stats(texts, "doc_id", "quality").withColumn("failed", base_failed()).collect())
    return [(feature_values(r.asDict()), r["quality"] == 0) for r in rows if not r["failed"]]


def fit_rules(docs: DataFrame, labels: DataFrame, most_rows: int = 4_000, **options) -> list[Rule]:
    """The decision list of ``labels.quality``, from at most ``most_rows`` labelled rows."""
    return learn_decision_list(labelled_rows(docs, labels, most_rows), **options)


def verdict(rules: list[Rule]) -> Column:
    """False for the first rule that holds, else true: the list as one conditional expression."""
    out = None
    for rule in rules:
        out = F.when(rule.column(), F.lit(False)) if out is None else out.when(rule.column(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def quality_scores(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the statistics, base_failed and kept of every document."""
    return (
        text_stats(docs, "doc_id")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & verdict(rules))
    )


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs``, all their columns, that the rules keep."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text"))
    kept = text_stats(row, "_row").where(~base_failed() & verdict(rules))
    return kept.select("_row.*")
