"""Exploratory statistics as Spark aggregations.

Every test statistic is an aggregate (one or two passes, partial aggregation before the
shuffle); only the final tail probabilities are evaluated in Python, on result rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholarspark.operators.ranks import exact_quantiles, mid_ranks, null_safe_join, quantile_name, value_counts
from scholarspark.session import reliable_checkpoint


def box_stats(df: DataFrame, value: str, group: str | list[str], coef: float = 1.5, approx: bool = False,
              accuracy: int = 10000) -> DataFrame:
    """Five numbers, mean, IQR, whiskers (most extreme values within coef x IQR) and outlier count.

    Exact: the source is reduced once to (group, value, count) and materialised; quartiles, moments and
    whiskers come from that table. ``approx=True`` never builds it: quartiles come from
    ``percentile_approx`` (a mergeable sketch of bounded size per group, rank error about 1/accuracy)
    with the moments in one pass, whiskers from a second pass. A NULL group is a group.
    """
    groups = [group] if isinstance(group, str) else list(group)
    q1, q2, q3 = (quantile_name(p) for p in (0.25, 0.5, 0.75))
    v = F.col(value)
    if approx:
        rows, c = df.where(v.isNotNull()).select(*groups, value), F.lit(1)
        qs = (rows.groupBy(*groups)
              .agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy).alias("_q"),
                   F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"))
              .select(*groups, "n", "min", "max", "mean", *[F.get("_q", i).alias(x) for i, x in enumerate((q1, q2, q3))]))
    else:
        rows, c = reliable_checkpoint(value_counts(df, value, groups)), F.col("c")
        moments = rows.groupBy(*groups).agg(F.min(value).alias("min"), F.max(value).alias("max"),
                                          (F.sum(v * c) / F.sum(c)).alias("mean"))
        qs = null_safe_join(exact_quantiles(None, value, [0.25, 0.5, 0.75], groups, counts=rows), moments, groups)
    fences = qs.select(*groups, (F.col(q1) - coef * (F.col(q3) - F.col(q1))).alias("lo_f"),
                       (F.col(q3) + coef * (F.col(q3) - F.col(q1))).alias("hi_f"))
    whisk = null_safe_join(rows, fences, groups).groupBy(*groups).agg(
        F.min(F.when(v >= F.col("lo_f"), v)).alias("whisker_low"),
        F.max(F.when(v <= F.col("hi_f"), v)).alias("whisker_high"),
        F.sum(F.when((v < F.col("lo_f")) | (v > F.col("hi_f")), c).otherwise(0)).alias("n_outliers"))
    return (null_safe_join(qs, whisk, groups)
            .select(*groups, "n", "min", F.col(q1).alias("q1"), F.col(q2).alias("median"), F.col(q3).alias("q3"),
                    "max", "mean", (F.col(q3) - F.col(q1)).alias("iqr"), "whisker_low", "whisker_high",
                    "n_outliers"))


def box_many(df: DataFrame, values: list[str], group_cols: list[str], **options) -> DataFrame:
    """Box statistics for every (numeric, categorical) combination: stacked in long form with a test key, so all
    share one reduction and one ranking. Levels are text; NULL levels are left out, as the other tests do."""
    return box_stats(_melt(df, values, group_cols), "value", ["test", "grp"], **options)


def welch_anova(df: DataFrame, value: str, group: str) -> DataFrame:
    """Welch's one-way ANOVA: F, df1, df2 from per-group (n, mean, variance), one pass."""
    return welch_many(df, [value], [group]).drop("test")


def kruskal(df: DataFrame, value: str, group: str) -> DataFrame:
    """Kruskal-Wallis H (tie-corrected) with numeric response ``value`` and groups ``group``."""
    return kruskal_many(df, [value], [group]).drop("test")


def _pair_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    pairs = list(combinations(columns, 2))
    arr = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                             F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
                    for a, b in pairs])
    return (df.select(F.inline(arr)).where(F.col("a").isNotNull() & F.col("b").isNotNull())
            .groupBy("var1", "var2", "a", "b").agg(F.count(F.lit(1)).alias("o")))


def contingency_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """Observed cells of every pair of categorical columns with expected counts and residuals.

    One pass over the data (each row expands to one tuple per pair, then a partial aggregation) gives
    the cells, written once; margins are aggregates of that table joined back, so no task holds all cells of
    a pair. Only non-empty cells are listed; NULL levels are left out, as a contingency table does.
    """
    cells = reliable_checkpoint(_pair_cells(df, columns), "cells")
    pair = ["var1", "var2"]
    rows = cells.groupBy(*pair, "a").agg(F.sum("o").alias("ra"), F.count(F.lit(1)).alias("cells_a"))
    cols = cells.groupBy(*pair, "b").agg(F.sum("o").alias("cb"), F.count(F.lit(1)).alias("cells_b"))
    total = cells.groupBy(*pair).agg(F.sum("o").alias("n"))
    e = F.col("ra") * F.col("cb") / F.col("n")
    return (cells.join(rows, [*pair, "a"]).join(cols, [*pair, "b"]).join(total, pair)
            .select("var1", "var2", "a", "b", "o", "n", e.alias("expected"),
                    ((F.col("o") - e) / F.sqrt(e)).alias("residual"),
                    (F.col("o") * 100.0 / F.col("ra")).alias("pct_of_row"), "ra", "cb", "cells_a", "cells_b"))


def chi2_pairs(df: DataFrame, columns: list[str], yates: bool = True) -> DataFrame:
    """Pearson chi-squared for every pair: sum((o-e)^2/e) over the observed cells, and for the empty ones, whose
    term is e, the total of n minus the expected counts of the observed: nothing large cancels.

    2x2 tables get Yates' continuity correction (as R's default), computed from the common
    absolute deviation |o - e| of a 2x2 table and the margins: sum over cells of 1/e equals
    n * sum_a(1/ra) * sum_b(1/cb); each margin is counted once by weighting a cell with
    1 / (cells sharing that margin), which also counts the levels.
    """
    cells = contingency_cells(df, columns)
    dev = F.col("o") - F.col("expected")
    n = F.first("n")
    empty = F.when(F.count(F.lit(1)) < F.round(F.sum(1.0 / F.col("cells_a"))) * F.round(F.sum(1.0 / F.col("cells_b"))),
                   n - F.sum("expected")).otherwise(0.0)
    stat = cells.groupBy("var1", "var2").agg(
        n.alias("n"), (F.sum(dev ** 2 / F.col("expected")) + empty).alias("pearson"), F.max(F.abs(dev)).alias("dev"),
        F.round(F.sum(1.0 / F.col("cells_a"))).cast("bigint").alias("r"),
        F.round(F.sum(1.0 / F.col("cells_b"))).cast("bigint").alias("c"),
        F.sum(1.0 / (F.col("ra") * F.col("cells_a"))).alias("inv_r"),
        F.sum(1.0 / (F.col("cb") * F.col("cells_b"))).alias("inv_c"))
    two = (F.col("r") == 2) & (F.col("c") == 2) & F.lit(yates)
    corrected = ((F.col("dev") - F.least(F.lit(0.5), F.col("dev"))) ** 2
                 * F.col("n") * F.col("inv_r") * F.col("inv_c"))
    return stat.select("var1", "var2", "n",
                       F.when(two, corrected).otherwise(F.col("pearson")).alias("chi2"),
                       ((F.col("r") - 1) * (F.col("c") - 1)).alias("df"),
                       two.alias("yates"))


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r for every pair (pairwise-complete), its n and t statistic, from one aggregation."""
    pairs = list(combinations(columns, 2))
    aggs = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        aggs += [F.corr(a, b).alias(f"r{i}"), F.count_if(both).alias(f"n{i}")]
    one = df.agg(*aggs)
    long = one.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n"))
        for i, (a, b) in enumerate(pairs)])))
    return long.withColumn("t_stat", F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") ** 2)))


def scatter_stats(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.corr(x, y).alias("r"), F.regr_count(y, x).alias("n"),
                  F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_r2(y, x).alias("r2"))


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over [min, max] with density n / (N * width); empty bins are omitted."""
    v = df.where(F.col(value).isNotNull())
    st = v.select(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"),
                           F.count(F.lit(1)).alias("n")).alias("s")).scalar()
    lo, hi, n = st.getField("lo"), st.getField("hi"), st.getField("n")
    w = (hi - lo) / bins
    b = F.when(w > 0, F.least(F.floor((F.col(value) - lo) / w), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = v.select(b.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    return counts.select("bin", (lo + F.col("bin") * w).alias("bin_lo"), (lo + (F.col("bin") + 1) * w).alias("bin_hi"),
                         "count", F.when(w > 0, F.col("count") / (n * w)).alias("density"))


def log10_mean(df: DataFrame, value: str, group: str) -> DataFrame:
    """Mean on a log10 scale per group (non-positive values fall out, as on a log axis)."""
    pos = df.where(F.col(value) > 0)
    return pos.groupBy(group).agg(F.count(F.lit(1)).alias("n_pos"), F.avg(F.log10(value)).alias("mean_log10")) \
        .withColumn("geo_mean", F.pow(F.lit(10.0), F.col("mean_log10")))


def group_sample(df: DataFrame, group: str, id_col: str, k: int) -> DataFrame:
    """``k`` rows per group chosen by hash order of the id (deterministic, bounded per group).

    ``row_number() <= k`` is planned with a partial per-group limit before the shuffle, so a
    large group sends at most k rows per task.
    """
    h = F.md5(F.col(id_col).cast("string"))
    w = Window.partitionBy(group).orderBy(h)
    return df.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= k)


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Profile of numeric columns, long form: rows, nulls, distinct values, min, max, mean, sd,
    skewness, excess kurtosis (population moments) and exact median.

    The source is read once: every row is melted into (column, value) pairs and reduced to
    distinct (column, value, count) rows (partial aggregation), which are materialised. All
    statistics come from that table: exact distinct counts without a per-column
    ``count(DISTINCT)`` expansion, two-pass central moments, and medians from one
    distributed ranking.
    """
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                        for c in columns])))
    vc_all = reliable_checkpoint(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("c")), "profile")
    v, c = F.col("value"), F.col("c")
    present = v.isNotNull()
    basic = vc_all.groupBy("column").agg(
        F.sum(c).alias("n_rows"), F.sum(F.when(~present, c).otherwise(0)).alias("n_null"),
        F.count_if(present).alias("n_distinct"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.sum(F.when(present, c)).alias("_n"), (F.sum(F.when(present, c * v)) / F.sum(F.when(present, c))).alias("mean"))
    vc = vc_all.where(present)
    d = v - F.col("mean")
    mom = vc.join(basic.select("column", "mean", "_n"), "column").groupBy("column").agg(
        (F.sum(c * d ** 2) / F.first("_n")).alias("_m2"), (F.sum(c * d ** 3) / F.first("_n")).alias("_m3"),
        (F.sum(c * d ** 4) / F.first("_n")).alias("_m4"))
    med = exact_quantiles(None, "value", [0.5], ["column"], counts=vc).select("column", F.col("q_0_5").alias("median"))
    n = F.col("_n")
    return (basic.join(mom, "column", "left").join(med, "column", "left")
            .select("column", "n_rows", "n_null", "n_distinct", "min", "max", "mean",
                    F.sqrt(F.try_divide(F.col("_m2") * n, n - 1)).alias("stddev"),
                    F.try_divide(F.col("_m3"), F.col("_m2") ** 1.5).alias("skewness"),
                    (F.try_divide(F.col("_m4"), F.col("_m2") ** 2) - 3).alias("kurtosis"),
                    "median"))


def profile_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Profile of text columns in one aggregation: rows, nulls, distinct, min/max value and length."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"z{i}"), F.count_distinct(c).alias(f"d{i}"),
                 F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"),
                 F.min(F.length(c)).alias(f"ll{i}"), F.max(F.length(c)).alias(f"lh{i}")]
    one = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("rows").alias("n_rows"), F.col(f"z{i}").alias("n_null"),
                 F.col(f"d{i}").alias("n_distinct"), F.col(f"lo{i}").alias("min_value"),
                 F.col(f"hi{i}").alias("max_value"), F.col(f"ll{i}").alias("min_length"),
                 F.col(f"lh{i}").alias("max_length"))
        for i, c in enumerate(columns)])))


def density_grid(df: DataFrame, value: str, grid: int = 512, bins: int = 1024, cut: float = 3.0,
                 approx: bool = False) -> DataFrame:
    """Gaussian kernel density on ``grid`` points over [min - cut*h, max + cut*h].

    Bandwidth: Silverman's rule of thumb, 0.9 * min(sd, IQR / 1.34) * n^(-1/5) (quartiles exact, or with
    ``approx`` from a sketch in the pass that takes the moments, without ranking). The data are first counted into ``bins`` equal bins over [min - 4h, max + 4h]
    (one partially aggregated pass, as kernel density estimators commonly do); every
    non-empty bin then adds its kernel mass to all grid points through an array expression
    of fixed length, and the grid is summed. Work after the first pass is bins x grid,
    whatever the number of rows.
    """
    v = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("x"))
    sketch = F.percentile_approx("x", [0.25, 0.75])
    st = v.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"),
               F.max("x").alias("hi"), *([(F.get(sketch, 1) - F.get(sketch, 0)).alias("iqr")] if approx else []))
    s = st.select(F.struct(*st.columns).alias("s")).scalar()
    if approx:
        iqr = s.getField("iqr")
    else:
        q = exact_quantiles(v, "x", [0.25, 0.75])
        iqr = q.select(F.struct((F.col("q_0_75") - F.col("q_0_25")).alias("iqr")).alias("q")).scalar().getField("iqr")
    n, sd, lo, hi = s.getField("n"), s.getField("sd"), s.getField("lo"), s.getField("hi")
    spread = F.least(sd, iqr / 1.34)
    spread = F.when(spread > 0, spread).otherwise(F.when(sd > 0, sd).otherwise(F.lit(1.0)))
    h = 0.9 * spread * F.pow(n.cast("double"), F.lit(-0.2))
    b_lo, b_hi = lo - 4 * h, hi + 4 * h
    bw = (b_hi - b_lo) / bins
    counted = v.select(F.least(F.floor((F.col("x") - b_lo) / bw), F.lit(bins - 1)).cast("int").alias("b")) \
        .groupBy("b").agg(F.count(F.lit(1)).alias("c"))
    g_lo, g_hi = lo - cut * h, hi + cut * h
    step = (g_hi - g_lo) / (grid - 1)
    # scalar subqueries cannot sit inside a lambda: project them onto the (small) bin table first
    binned = counted.select("c", (b_lo + (F.col("b") + 0.5) * bw).alias("_centre"), g_lo.alias("_glo"),
                            step.alias("_step"), h.alias("_h"))
    contrib = F.transform(F.sequence(F.lit(0), F.lit(grid - 1)), lambda g: F.struct(
        g.alias("g"), (F.col("c") * F.exp(-0.5 * F.pow((F.col("_glo") + g * F.col("_step") - F.col("_centre"))
                                                      / F.col("_h"), 2))).alias("w")))
    summed = binned.select(F.inline(contrib)).groupBy("g").agg(F.sum("w").alias("w"))
    return summed.select(F.col("g").alias("grid_index"), (g_lo + F.col("g") * step).alias("x"),
                         (F.col("w") / (n * h * F.lit(float(np.sqrt(2 * np.pi))))).alias("density"),
                         h.alias("bandwidth"))


ZERO_VARIANCE = 1e-12


def _melt(df: DataFrame, values: list[str], groups: list[str]) -> DataFrame:
    """(test, value, grp) rows for every numeric x categorical combination (map-side expansion)."""
    arr = F.array(*[F.struct(F.lit(f"{v} ~ {g}").alias("test"), F.col(v).cast("double").alias("value"),
                             F.col(g).cast("string").alias("grp"))
                    for v in values for g in groups])
    return df.select(F.inline(arr)).where(F.col("value").isNotNull() & F.col("grp").isNotNull())


def kruskal_many(df: DataFrame, values: list[str], groups: list[str]) -> DataFrame:
    """Kruskal-Wallis H for every (numeric, categorical) combination in one ranking pass.

    The combinations are stacked in long form with a test key; mid-ranks are computed per
    test by the partitioned prefix sum, so all tests share one shuffle and one checkpoint.
    """
    long = _melt(df, values, groups)
    vc = long.groupBy("test", "grp", "value").agg(F.count(F.lit(1)).alias("c"))
    r = mid_ranks(vc, "value", "grp", ["test"])
    per_group = r.groupBy("test", "grp").agg(F.sum(F.col("c") * F.col("midrank")).alias("R"), F.sum("c").alias("n"))
    ties = (r.select("test", "value", "t").distinct().groupBy("test")
            .agg(F.sum(F.col("t") ** 3 - F.col("t")).alias("tie")))
    tot = per_group.groupBy("test").agg(F.sum("n").cast("double").alias("N"),
                                        F.sum(F.col("R") ** 2 / F.col("n")).alias("s"), F.count(F.lit(1)).alias("k"))
    j = tot.join(ties, "test")
    n = F.col("N")
    return j.select("test", F.try_divide(12.0 / (n * (n + 1)) * F.col("s") - 3 * (n + 1),
                                         1 - F.try_divide(F.col("tie"), n ** 3 - n)).alias("h_stat"),
                    (F.col("k") - 1).alias("df"), n.cast("bigint").alias("n"))


def welch_many(df: DataFrame, values: list[str], groups: list[str]) -> DataFrame:
    """Welch's ANOVA for every (numeric, categorical) combination; per-group moments in one pass."""
    g = (_melt(df, values, groups).groupBy("test", "grp")
         .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"), F.var_samp("value").alias("s2"))
         # a variance at rounding-noise level (merging partial sums of equal values) counts as zero
         .where((F.col("n") > 1) & (F.col("s2") > ZERO_VARIANCE * F.greatest(F.lit(1.0), F.col("m") ** 2)))
         .withColumn("w", F.col("n") / F.col("s2")))
    per_test = Window.partitionBy("test")   # over per-group rows only
    g = g.withColumns({"wsum": F.sum("w").over(per_test),   # not "W": column names are case-insensitive
                       "mw": F.sum(F.col("w") * F.col("m")).over(per_test) / F.sum("w").over(per_test),
                       "k": F.count(F.lit(1)).over(per_test)})
    t = g.groupBy("test").agg(F.sum(F.col("w") * (F.col("m") - F.col("mw")) ** 2).alias("A"),
                              F.sum((1 - F.col("w") / F.col("wsum")) ** 2 / (F.col("n") - 1)).alias("B"),
                              F.first("k").alias("k"))
    k = F.col("k")
    return t.select("test",
                    F.try_divide(F.try_divide(F.col("A"), k - 1),
                                 1 + F.try_divide(2 * (k - 2), k ** 2 - 1) * F.col("B")).alias("f_stat"),
                    (k - 1).cast("double").alias("df1"),
                    F.try_divide(k ** 2 - 1, 3 * F.col("B")).alias("df2"))
