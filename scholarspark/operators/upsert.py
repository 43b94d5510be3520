"""Keyed upsert (merge) and table replacement on plain files.

``upsert`` is a full outer join on the key. For a matched key every column the source
carries is taken from the source, even when that value is NULL (presence, not
coalesce); columns only the target has are kept; unmatched rows of either side pass
through. The result is written to a new path, never over the path being read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, key: str | list[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    t = target.withColumn("_in_t", F.lit(True))
    s = source.withColumn("_in_s", F.lit(True))
    t_cols = [c for c in target.columns if c not in keys]
    s_cols = [c for c in source.columns if c not in keys]
    ta, sa = t.alias("t"), s.alias("s")
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    j = ta.join(sa, cond, "full_outer")
    from_s = F.col("s._in_s").isNotNull()
    out = [F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")).alias(k) for k in keys]
    for c in t_cols:
        out.append((F.when(from_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in s_cols
                    else F.col(f"t.{c}")).alias(c))
    out += [F.col(f"s.{c}").alias(c) for c in s_cols if c not in t_cols]
    out.append(F.when(F.col("t._in_t").isNull(), F.lit("inserted"))
               .when(from_s, F.lit("updated")).otherwise(F.lit("unchanged")).alias("merge_action"))
    return j.select(*out)


def replace_table(df: DataFrame, new_path: str, fmt: str = "parquet") -> str:
    """Materialise a query result at a new path (the caller swaps the pointer afterwards)."""
    df.write.mode("errorifexists").format(fmt).save(new_path)
    return new_path
