"""Landed API pages: ``{messages: [{count_new_papers, total}], collection: [record, ...]}``.

Pages are read with a declared schema (no inference pass), the record list is exploded
(a missing list counts as empty), and page metadata is parsed tolerantly. A
completeness check compares what each page declares with what was loaded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from scholarspark.schemas import PAGE


def read_pages(spark: SparkSession, path: str, extra: StructType | None = None) -> DataFrame:
    """One row per landed page (JSON lines), with the file it came from."""
    schema = StructType(PAGE.fields + (extra.fields if extra else []))
    return spark.read.schema(schema).json(path).withColumn("source_file", F.input_file_name())


def _meta_int(pages: Column, field: str) -> Column:
    return F.coalesce(F.get(pages, 0)[field].try_cast("int"), F.lit(0))


def page_records(pages: DataFrame) -> DataFrame:
    """The records of every page (``explode`` of the collection; no collection -> no rows)."""
    recs = pages.select(*[c for c in pages.columns if c not in ("messages", "collection")],
                        F.explode(F.coalesce(F.col("collection"), F.array())).alias("rec"))
    return recs.where(F.col("rec").isNotNull()).select(*[c for c in recs.columns if c != "rec"], "rec.*")


def page_completeness(pages: DataFrame, page_key: str) -> DataFrame:
    """Declared total / new-paper count versus loaded records, per page."""
    return pages.select(page_key,
                        _meta_int(F.col("messages"), "total").alias("declared_total"),
                        _meta_int(F.col("messages"), "count_new_papers").alias("declared_new"),
                        F.size(F.coalesce(F.col("collection"), F.array())).alias("loaded"))


def _extents(pages: DataFrame, keys: list[str], cursor: str, loaded: str) -> DataFrame:
    """Each distinct page of a harvest as (keys, start, end, times) with ``reached``, where the pages that begin before it end."""
    distinct = pages.where(F.col(cursor).isNotNull()).groupBy(*keys, F.col(cursor).cast("bigint").alias("start")).agg(
        F.max(F.coalesce(F.col(loaded), F.lit(0))).cast("bigint").alias("loaded"), F.count(F.lit(1)).alias("times"))
    before = Window.partitionBy(*keys).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("loaded")
    return distinct.select(*keys, "start", end.alias("end"), "times").withColumn(
        "reached", F.coalesce(F.max("end").over(before), F.lit(0)))


def harvest_gaps(pages: DataFrame, keys: list[str], cursor: str = "cursor", loaded: str = "loaded", total: str = "total") -> DataFrame:
    """(keys, missing_from, missing_to): record positions that no page of a harvest covers, the last one exclusive; what is to be
    fetched again. ``pages`` has for each landed page where it begins, how many records it has and the total it declares."""
    extents = _extents(pages, keys, cursor, loaded)
    inner = extents.where(F.col("start") > F.col("reached")).select(*keys, F.col("reached").alias("missing_from"), F.col("start").alias("missing_to"))
    ends = extents.groupBy(*keys).agg(F.max("end").alias("missing_from"))
    declared = pages.groupBy(*keys).agg(F.max(total).cast("bigint").alias("missing_to"))
    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys]
    tail = declared.alias("d").join(ends.alias("e"), same, "left").select(
        *[F.col(f"d.{k}").alias(k) for k in keys], F.coalesce("e.missing_from", F.lit(0)).cast("bigint").alias("missing_from"), "d.missing_to")
    return inner.union(tail.where(F.col("missing_to") > F.col("missing_from")))


def harvest_completeness(pages: DataFrame, keys: list[str], cursor: str = "cursor", loaded: str = "loaded", total: str = "total") -> DataFrame:
    """One row for each harvest (the pages of equal ``keys``): pages, pages landed again, ranges and records missing, records
    that an earlier page already has, the declared total (the largest, if pages disagree) and whether it is complete."""
    extents = _extents(pages, keys, cursor, loaded)
    again = F.greatest(F.lit(0), F.least(F.col("end"), F.col("reached")) - F.col("start"))
    per = extents.groupBy(*keys).agg(F.sum("times").alias("n_pages"), F.sum(F.col("times") - 1).alias("repeated_pages"),
                                     F.sum(again).alias("overlapping_records"))
    gaps = harvest_gaps(pages, keys, cursor, loaded, total).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_gaps"), F.sum(F.col("missing_to") - F.col("missing_from")).alias("missing_records"))
    declared = pages.groupBy(*keys).agg(F.max(total).cast("bigint").alias("declared_total"))
    out = declared.alias("d")
    for other, name in ((per, "p"), (gaps, "g")):
        out = out.join(other.alias(name), [F.col(f"d.{k}").eqNullSafe(F.col(f"{name}.{k}")) for k in keys], "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_pages", "repeated_pages", "overlapping_records", "n_gaps", "missing_records")}
    return out.select(*[F.col(f"d.{k}").alias(k) for k in keys], "declared_total", *zero.values()).withColumn(
        "complete", F.col("n_gaps") == 0)


def to_pages(records: DataFrame, page_no: Column, record_cols: list[str]) -> DataFrame:
    """Group records into pages (bounded by the page size) shaped like the API response."""
    grouped = records.groupBy(page_no.alias("page_no")).agg(
        F.collect_list(F.struct(*record_cols)).alias("collection"))
    n = F.size("collection").cast("string")
    return grouped.select("page_no", F.array(F.struct(n.alias("count_new_papers"), n.alias("total"))).alias("messages"),
                          "collection")


def land_pages(pages: DataFrame, path: str) -> None:
    """Write pages as JSON lines (one page per line), the landing format read by ``read_pages``."""
    pages.write.mode("overwrite").json(path)
