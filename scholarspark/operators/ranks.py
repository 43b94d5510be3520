"""Global order statistics without a single-task window.

``prefix_sums`` is the two-level running sum used by exact quantiles, mid-ranks
(Kruskal-Wallis, Mann-Whitney AUC) and ROC curves:

1. the input is first shrunk to distinct sort keys with their weights (a partial
   aggregation done by the caller);
2. it is range-partitioned on (group, key) and each row is tagged with its partition id;
   the tagged table is written as a table in the shared checkpoint folder so that the tags
   and the partition totals come from one and the same layout (range bounds are sampled,
   so a recomputation could otherwise move rows between partitions);
3. a running sum inside each (partition, group) - a window that clusters the distinct
   table by partition id, i.e. one hash shuffle of it - plus per-(partition, group) totals
   turned into offsets (a table of at most partitions x groups rows);
4. the offsets are joined back (AQE broadcasts them when small) and added.

No step holds more than one range partition of distinct keys in a task, so a group
holding a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholarspark.session import reliable_checkpoint


def prefix_sums(df: DataFrame, order_cols: list[str], weight_cols: list[str],
                group_cols: list[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``<w>_before``: the sum of ``w`` over rows strictly before this row in its group.

    ``df`` must be distinct on ``group_cols + order_cols`` and hold no NULL sort keys.
    """
    group_cols = list(group_cols or [])
    spark = df.sparkSession
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = reliable_checkpoint(
        df.repartitionByRange(n, *[F.col(c).asc() for c in group_cols + order_cols])
          .withColumn("_pid", F.spark_partition_id()))
    totals = ranged.groupBy("_pid", *group_cols).agg(*[F.sum(w).alias(f"_t_{w}") for w in weight_cols])
    earlier = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *group_cols,
                            *[F.coalesce(F.sum(f"_t_{w}").over(earlier), F.lit(0)).alias(f"_o_{w}")
                              for w in weight_cols])
    inside = (Window.partitionBy("_pid", *group_cols).orderBy(*order_cols)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.select("*", *[F.coalesce(F.sum(w).over(inside), F.lit(0)).alias(f"_i_{w}")
                                 for w in weight_cols])
    out = null_safe_join(local, offsets, ["_pid", *group_cols])
    return out.select(*df.columns, *[(F.col(f"_o_{w}") + F.col(f"_i_{w}")).alias(f"{w}_before")
                                     for w in weight_cols])


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys in which a NULL group meets the NULL group; keys appear once, from the left."""
    renamed = right.select(*[F.col(k).alias(f"_j_{k}") if k in keys else F.col(k) for k in right.columns])
    on = [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys]
    return left.join(renamed, on).drop(*[f"_j_{k}" for k in keys])


def value_counts(df: DataFrame, value_col: str, group_cols: list[str] | None = None) -> DataFrame:
    """(group..., value, c): distinct non-null values with their multiplicity (partial aggregation)."""
    group_cols = list(group_cols or [])
    return (df.where(F.col(value_col).isNotNull())
              .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("c")))


def exact_quantiles(df: DataFrame | None, value_col: str, probs: list[float],
                    group_cols: list[str] | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Exact continuous quantiles (linear interpolation, h = (n-1)p + 1) per group.

    Output: group..., n, and one column ``q_<p>`` per probability. Equal to SQL
    ``quantile_cont`` / Spark ``percentile`` but without gathering a group's values.
    ``counts`` may supply the (group..., value, c) table when the caller already has it.
    """
    group_cols = list(group_cols or [])
    vc = counts if counts is not None else value_counts(df, value_col, group_cols)
    ranked = prefix_sums(vc, [value_col], ["c"], group_cols)
    # group sizes from the ranked table (read from the checkpoint), not from the source again;
    # a small per-group table joined back (AQE broadcasts it), never a window over a whole group
    if group_cols:
        rows = null_safe_join(ranked, ranked.groupBy(*group_cols).agg(F.sum("c").alias("n")), group_cols)
    else:
        rows = ranked.withColumn("n", ranked.select(F.sum("c")).scalar())
    v, before, c, n = F.col(value_col), F.col("c_before"), F.col("c"), F.col("n")
    aggs, finals = [], []
    for i, p in enumerate(probs):
        h = (n - 1) * F.lit(float(p)) + 1
        lo = F.floor(h)
        hi = F.least(lo + 1, n)
        aggs += [F.max(F.when((before < lo) & (lo <= before + c), v)).alias(f"_lo{i}"),
                 F.max(F.when((before < hi) & (hi <= before + c), v)).alias(f"_hi{i}"),
                 F.max(h - lo).alias(f"_fr{i}")]
    per = rows.groupBy(*group_cols, "n").agg(*aggs)
    for i, p in enumerate(probs):
        finals.append((F.col(f"_lo{i}") + F.col(f"_fr{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}")))
                      .alias(quantile_name(p)))
    return per.select(*group_cols, "n", *finals)


def quantile_name(p: float) -> str:
    return "q_" + f"{p:g}".replace(".", "_")


def mid_ranks(vc: DataFrame, value_col: str, group_col: str, partition_cols: list[str] | None = None) -> DataFrame:
    """Mid-ranks of values pooled over all groups, for a (partition..., group, value, c) table.

    Output: partition..., group, value, c, t (multiplicity of the value over all groups),
    midrank. Ranks run over all groups of a partition; ties share the average rank.
    """
    parts = list(partition_cols or [])
    ranked = prefix_sums(vc, [value_col, group_col], ["c"], parts)
    per_value = Window.partitionBy(*parts, value_col)   # at most one row per group for a value
    return ranked.select(
        *parts, group_col, value_col, "c",
        F.sum("c").over(per_value).alias("t"),
        F.min("c_before").over(per_value).alias("v_before")
    ).withColumn("midrank", F.col("v_before") + (F.col("t") + 1) / 2.0).drop("v_before")
