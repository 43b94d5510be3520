"""Descriptive statistics: frequencies, shares, profiles, histograms, group summaries, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarspark.operators.ranks import null_safe_join, prefix_sums


def frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of every level of several columns in one pass (long form).

    Each row is expanded into one (variable, level) pair per column on the map side and
    counted with a single partially-aggregated groupBy, i.e. a GROUPING SETS plan with one
    shuffle. The frequency rank is a distributed prefix count over (count desc, level)
    within each variable and the percentage uses per-variable totals joined back, so a
    variable with very many levels is never ranked inside one task.
    Output: variable, level (text, NULL kept as a level), n, pct, freq_rank.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level"))
                      for c in columns])
    counts = (df.select(F.inline(pairs))
              .groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))
              .withColumns({"neg_n": -F.col("n"), "one": F.lit(1)}))
    ranked = prefix_sums(counts, ["neg_n", "level"], ["one"], ["variable"])
    totals = ranked.groupBy("variable").agg(F.sum("n").alias("_total"))
    return ranked.join(totals, "variable").select(
        "variable", "level", "n", (F.col("n") * 100.0 / F.col("_total")).alias("pct"),
        (F.col("one_before") + 1).alias("freq_rank"))


def within_shares(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Count of each (outer, inner) pair and its percentage within ``outer`` (totals joined back)."""
    counts = df.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("n"))
    totals = df.groupBy(outer).agg(F.count(F.lit(1)).alias("_total"))
    return null_safe_join(counts, totals, [outer]).select(
        outer, inner, "n", (F.col("n") * 100.0 / F.col("_total")).alias("pct_within"))
