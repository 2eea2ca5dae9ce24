"""Ensemble diagnostics: rank histograms and what is drawn beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephos.functions.columns import standard_normal


def rank(obs: Column, members: Column) -> Column:
    """How many members lie below the observation."""
    return F.size(F.filter(members, lambda m: m < obs))


def dithered(obs: Column, variance: Column, seed: int | None, key: Column) -> Column:
    """The observation with noise of its own error, drawn from its key; unchanged without a seed."""
    return obs if seed is None else obs + standard_normal(key, seed) * F.sqrt(variance)


def rank_histogram(df: DataFrame, members: str = "prior", seed: int | None = None, key: str | None = None) -> DataFrame:
    """Counts of every rank from 0 to the number of members, the expected count and its 95 % band.

    With a seed observations are dithered, by ``key`` or by their own numbers.
    """
    drawn_by = F.to_json(F.struct("obs", members)) if key is None else F.col(key)
    ranked = df.select(rank(dithered(F.col("obs"), F.col("obs_variance"), seed, drawn_by), F.col(members)).alias("rank"), F.size(members).alias("_m"))
    counts = ranked.groupBy("rank").agg(F.count(F.lit(1)).alias("count"))
    whole = ranked.agg(F.count(F.lit(1)).alias("_n"), F.max("_m").alias("_m"))
    p = 1.0 / (F.col("_m") + 1)
    spine = whole.select("_n", "_m", F.explode(F.sequence(F.lit(0), F.col("_m"))).alias("rank"))
    band = 1.96 * F.sqrt(F.col("_n") * p * (1 - p))
    return spine.join(counts, "rank", "left").select(
        "rank", F.coalesce("count", F.lit(0)).alias("count"), (F.col("_n") * p).alias("expected"), (F.col("_n") * p - band).alias("low"), (F.col("_n") * p + band).alias("high")
    )


def rank_diagnostics(df: DataFrame, members: str = "prior", mean: str = "prior_mean", spread: str = "prior_spread") -> DataFrame:
    """The eight numbers beside a rank histogram; population deviations."""
    innovation = F.col("obs") - F.col(mean)
    norm = F.try_divide(innovation, F.sqrt(F.col(spread) * F.col(spread) + F.col("obs_variance")))
    return df.agg(
        F.count(F.lit(1)).alias("n_obs"),
        F.max(F.size(members)).alias("n_ensemble"),
        F.avg(innovation).alias("innovation_mean"),
        F.stddev_pop(innovation).alias("innovation_std"),
        F.avg(norm).alias("normalized_innov_mean"),
        F.stddev_pop(norm).alias("normalized_innov_std"),
        F.corr("obs", mean).alias("correlation"),
        F.sqrt(F.avg(innovation * innovation)).alias("rmse"),
    )


def with_array_stats(df: DataFrame, members: str, prefix: str) -> DataFrame:
    """Adds the mean and sample deviation of an array of members."""
    m = F.col(members)
    n = F.size(m).cast("double")
    mean = F.aggregate(m, F.lit(0.0), lambda a, x: a + x) / n
    out = df.withColumn(f"{prefix}_mean", mean)
    square = F.aggregate(m, F.lit(0.0), lambda a, x: a + (x - F.col(f"{prefix}_mean")) * (x - F.col(f"{prefix}_mean")))
    return out.withColumn(f"{prefix}_spread", F.when(n > 1, F.sqrt(square / (n - 1))))


def type_names(kind: Column, names: dict[int, str]) -> Column:
    """Names of observation types by number, ``unknown_N`` for others; white space normalised."""
    table = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.trim(F.regexp_replace(table[kind], r"\s+", " ")), F.concat(F.lit("unknown_"), kind.cast("string")))
