"""Named exploratory-statistics queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholarspark.functions.distributions import chi2_pvalue, f_pvalue, t_pvalue
from scholarspark.operators import sketches, stats
from scholarspark.plans.common import tidy
from scholarspark.session import shared_path
from scholarspark.sources.tables import read_table

LINE_NUMERICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORDER_CATEGORICALS = ["o_orderstatus", "o_orderpriority", "c_mktsegment"]
SAMPLE_K = 5


def _events(spark, sf_dir, cols=("event_id", "event_type", "value")):
    return read_table(spark, sf_dir, "events", list(cols))


def _orders_customers(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderstatus", "o_orderpriority"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return o.join(c, o.o_custkey == c.c_custkey)


def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.box_stats(_events(spark, sf_dir), "value", "event_type"))


def box_stats_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box statistics with sketch-based quartiles (the option for very large groups; rows only)."""
    return tidy(stats.box_stats(_events(spark, sf_dir), "value", "event_type", approx=True))


def welch_anova(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.welch_anova(_events(spark, sf_dir), "value", "event_type"))


def kruskal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.kruskal(_events(spark, sf_dir), "value", "event_type"))


def chi2_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.chi2_pairs(_orders_customers(spark, sf_dir), ORDER_CATEGORICALS))


def chi2_2x2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.chi2_pairs(read_table(spark, sf_dir, "labels"), ["quality", "toxic"]))


def mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", ["doc_id", "lang"])
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    cells = stats.contingency_cells(d.join(lab, "doc_id"), ["lang", "quality"])
    return tidy(cells.select("var1", "var2", "a", "b", "o", "n", "expected", "residual", "pct_of_row"))


def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.corr_matrix(read_table(spark, sf_dir, "lineitem", LINE_NUMERICS), LINE_NUMERICS))


def scatter_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_extendedprice", "l_quantity"])
    return tidy(stats.scatter_stats(li, "l_quantity", "l_extendedprice"))


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.histogram(_events(spark, sf_dir, ["value"]), "value", 30))


def log_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.log10_mean(_events(spark, sf_dir), "value", "event_type"))


def group_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.group_sample(_events(spark, sf_dir), "event_type", "event_id", SAMPLE_K))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = LINE_NUMERICS + ["l_orderkey", "l_linenumber"]
    return tidy(stats.profile(read_table(spark, sf_dir, "lineitem", cols), cols))


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of the profiled columns, kept batch by batch (four parts of the line items)."""
    cols = LINE_NUMERICS + ["l_orderkey", "l_linenumber"]
    li = read_table(spark, sf_dir, "lineitem", cols)
    path = shared_path(spark, "profile-sketches")
    for k in range(4):
        table = sketches.append_sketches(li.where(F.col("l_orderkey") % 4 == k), cols, path)
    return table


def profile_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and moments merged from the kept rows of four batches."""
    return tidy(sketches.merged_moments(_batches(spark, sf_dir)))


def profile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts and quartiles estimated from the merged sketches of four batches."""
    return tidy(sketches.merged_estimates(_batches(spark, sf_dir)))


def profile_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["l_returnflag", "l_linestatus"]
    return tidy(stats.profile_text(read_table(spark, sf_dir, "lineitem", cols), cols))


def test_pvalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tail probabilities of every test above, Holm-adjusted within each family (rows only)."""
    chi = stats.chi2_pairs(_orders_customers(spark, sf_dir), ORDER_CATEGORICALS).select(
        F.lit("chi2").alias("family"), F.concat_ws(" x ", "var1", "var2").alias("test"),
        F.col("chi2").alias("statistic"), F.col("df").cast("double").alias("df"),
        chi2_pvalue(F.col("chi2"), F.col("df")).alias("p_value"))
    kw = stats.kruskal(_events(spark, sf_dir), "value", "event_type").select(
        F.lit("kruskal").alias("family"), F.lit("value ~ event_type").alias("test"),
        F.col("h_stat").alias("statistic"), F.col("df").cast("double").alias("df"),
        chi2_pvalue(F.col("h_stat"), F.col("df")).alias("p_value"))
    we = stats.welch_anova(_events(spark, sf_dir), "value", "event_type").select(
        F.lit("welch").alias("family"), F.lit("value ~ event_type").alias("test"),
        F.col("f_stat").alias("statistic"), F.col("df1").alias("df"),
        f_pvalue(F.col("f_stat"), F.col("df1"), F.col("df2")).alias("p_value"))
    co = stats.corr_matrix(read_table(spark, sf_dir, "lineitem", LINE_NUMERICS), LINE_NUMERICS).select(
        F.lit("pearson").alias("family"), F.concat_ws(" x ", "var1", "var2").alias("test"),
        F.col("t_stat").alias("statistic"), (F.col("n") - 2).cast("double").alias("df"),
        t_pvalue(F.col("t_stat"), F.col("n") - 2).alias("p_value"))
    return tidy(holm(chi.unionByName(kw).unionByName(we).unionByName(co)), rounded=False)


def holm(tests: DataFrame) -> DataFrame:
    """Holm step-down adjustment within each family (a window over the small result table).

    Tests without a p-value (an undefined statistic) take no part: they sort last, are not
    counted in m, and keep a NULL adjusted value.
    """
    p = F.col("p_value")
    w = Window.partitionBy("family").orderBy(F.asc_nulls_last("p_value"), "test")
    m = F.count("p_value").over(Window.partitionBy("family"))
    step = F.when(p.isNotNull(), F.least(F.lit(1.0), (m - F.row_number().over(w) + 1) * p))
    return tests.withColumn("_s", step).withColumn(
        "p_holm", F.when(p.isNotNull(), F.max("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)))).drop("_s")


def export_pvalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-values of the project's exploratory tests (chi-squared pairs, Kruskal-Wallis, Welch,
    Pearson) on one materialised analysis frame, Holm-adjusted within each family (rows only)."""
    af = analysis_frame(spark, sf_dir)
    chi = stats.chi2_pairs(af, EXPORT_CATEGORICAL).select(
        F.lit("chi2").alias("family"), F.concat_ws(" x ", "var1", "var2").alias("test"),
        F.col("chi2").alias("statistic"), F.col("df").cast("double").alias("df"),
        chi2_pvalue(F.col("chi2"), F.col("df")).alias("p_value"))
    kw = stats.kruskal_many(af, EXPORT_NUMERIC, EXPORT_CATEGORICAL).select(
        F.lit("kruskal").alias("family"), "test", F.col("h_stat").alias("statistic"),
        F.col("df").cast("double").alias("df"), chi2_pvalue(F.col("h_stat"), F.col("df")).alias("p_value"))
    we = stats.welch_many(af, EXPORT_NUMERIC, EXPORT_CATEGORICAL).select(
        F.lit("welch").alias("family"), "test", F.col("f_stat").alias("statistic"), F.col("df1").alias("df"),
        f_pvalue(F.col("f_stat"), F.col("df1"), F.col("df2")).alias("p_value"))
    co = stats.corr_matrix(af, EXPORT_CORR).select(
        F.lit("pearson").alias("family"), F.concat_ws(" x ", "var1", "var2").alias("test"),
        F.col("t_stat").alias("statistic"), (F.col("n") - 2).cast("double").alias("df"),
        t_pvalue(F.col("t_stat"), F.col("n") - 2).alias("p_value"))
    return tidy(holm(chi.unionByName(kw).unionByName(we).unionByName(co)), rounded=False)


# The project's exploratory variables, on the recoded export frame.
EXPORT_NUMERIC = ["titleLength", "abstractLength", "numberAuthors", "cit1year"]
EXPORT_CORR = ["titleLength", "abstractLength", "numberAuthorsLog", "cit1year"]
EXPORT_CATEGORICAL = ["category_grouped", "server", "publiStatus_binary", "month_upload"]


def analysis_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recoded export rows minus those at the maximum abstract length, with log author counts.

    The frame is read twice (for the global maximum, then for the statistics), so its few
    analysis columns are materialised once in the shared folder instead of re-running the
    record pipeline for each read.
    """
    from scholarspark.functions.recode import ln_or_null
    from scholarspark.plans.common import recoded_export
    from scholarspark.session import reliable_checkpoint
    df = recoded_export(spark, sf_dir, ["server", "category", "published", "publiDate", "title", "abstract",
                                        "authors", "citations"])
    cols = list(dict.fromkeys(EXPORT_NUMERIC + EXPORT_CATEGORICAL + ["abstractLength"]))
    df = reliable_checkpoint(df.select(*cols), "analysis")
    mx = df.select(F.max("abstractLength")).scalar()
    return df.where(F.col("abstractLength") != mx).withColumn("numberAuthorsLog", ln_or_null("numberAuthors"))


def export_chi2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.chi2_pairs(analysis_frame(spark, sf_dir), EXPORT_CATEGORICAL))


def export_kruskal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.kruskal_many(analysis_frame(spark, sf_dir), EXPORT_NUMERIC, EXPORT_CATEGORICAL))


def export_welch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.welch_many(analysis_frame(spark, sf_dir), EXPORT_NUMERIC, EXPORT_CATEGORICAL))


def export_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.corr_matrix(analysis_frame(spark, sf_dir), EXPORT_CORR))


def export_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box statistics of the project's 16 numeric x categorical combinations."""
    return tidy(stats.box_many(analysis_frame(spark, sf_dir), EXPORT_NUMERIC, EXPORT_CATEGORICAL))


QUERIES = {
    "export_box": export_box,
    "box_stats": box_stats,
    "box_stats_approx": box_stats_approx,
    "welch_anova": welch_anova,
    "kruskal": kruskal,
    "chi2_pairs": chi2_pairs,
    "chi2_2x2": chi2_2x2,
    "mosaic": mosaic,
    "corr_matrix": corr_matrix,
    "scatter_stats": scatter_stats,
    "histogram": histogram,
    "log_mean": log_mean,
    "group_sample": group_sample,
    "profile": profile,
    "profile_text": profile_text,
    "profile_batches": profile_batches,
    "profile_sketches": profile_sketches,
    "test_pvalues": test_pvalues,
    "export_chi2": export_chi2,
    "export_kruskal": export_kruskal,
    "export_welch": export_welch,
    "export_corr": export_corr,
    "export_pvalues": export_pvalues,
}
