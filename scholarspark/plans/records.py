"""Named queries over preprint records: dedup, derived fields, enrichment, export, upsert, recoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholarspark.functions.dates import days_between, month_label
from scholarspark.functions.recode import category_group, ln_or_null
from scholarspark.operators.profile import frequencies
from scholarspark.operators.records import (apply_lookups, export_filter, export_table, needs_enrichment,
                                            normalise_dates, unique_violations)
from scholarspark.operators.upsert import upsert
from scholarspark.plans.common import (derived_preprints, latest_preprints, r6, raw_preprints,
                                       recoded_export, tidy)
from scholarspark.session import reliable_checkpoint
from scholarspark.sources.lookups import lookup_table
from scholarspark.sources.tables import read_table


def published_share_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of records published within a year, per category group, largest group first.

    On the analysis frame of the project: exported records without those at the maximum
    abstract length. The few columns needed are materialised once, since the frame is read
    twice (for the maximum, then for the shares).
    """
    from scholarspark.session import reliable_checkpoint
    df = recoded_export(spark, sf_dir, ["category", "published", "publiDate", "abstract"])
    df = reliable_checkpoint(df.select("category_grouped", "publiStatus_binary", "abstractLength"), "share")
    df = df.where(F.col("abstractLength") != df.select(F.max("abstractLength")).scalar())
    agg = df.groupBy("category_grouped").agg(
        F.count(F.lit(1)).alias("n_items"),
        r6(F.avg((F.col("publiStatus_binary") == "Published_year1").cast("double"))).alias("proportion_published"))
    # the ranking window runs on the aggregated table (one row per group)
    w = Window.orderBy(F.desc("n_items"), F.asc_nulls_first("category_grouped"))
    return tidy(agg.withColumn("size_rank", F.row_number().over(w)))


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = latest_preprints(spark, sf_dir, ["_id", "published", "publiDate", "citations"])
    return tidy(df.select("doi", "_id", "version", "date", "published", "publiDate",
                          F.when(F.col("citations").isNotNull(), F.size("citations")).alias("n_citations")))


def replace_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The de-duplicated records written as a new table version (never over the input) and read back."""
    from scholarspark.operators.upsert import replace_table
    from scholarspark.session import shared_path
    df = latest_preprints(spark, sf_dir, ["_id", "published", "publiDate", "citations"])
    path = replace_table(df, shared_path(spark, "preprints-latest"))
    back = spark.read.parquet(path)
    return tidy(back.select("doi", "_id", "version", "date", "published", "publiDate",
                            F.when(F.col("citations").isNotNull(), F.size("citations")).alias("n_citations")))


def stored_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived records stored as a table, then exported: the export filter runs at the scan
    (parquet ``PushedFilters`` on ``published`` / ``publiStatus``), reading only export columns."""
    from scholarspark.operators.upsert import replace_table
    from scholarspark.schemas import EXPORT_COLUMNS
    from scholarspark.session import shared_path
    derived = derived_preprints(spark, sf_dir)
    keep = [c for c in EXPORT_COLUMNS if c in derived.columns] + ["published"]
    path = replace_table(derived.select(*dict.fromkeys(keep)), shared_path(spark, "preprints-derived"))
    return tidy(export_table(spark.read.parquet(path)))


def derived_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived_preprints(spark, sf_dir, ["title", "abstract", "authors", "published", "publiDate"])
    # the length of the merged text: both and the blank between them, NULL if either is
    return tidy(df.select("doi", "titleLength", "abstractLength", "numberAuthors",
                          (F.col("titleLength") + F.col("abstractLength") + 1).alias("mergedLength")))


def publication_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived_preprints(spark, sf_dir, ["published", "publiDate"])
    return tidy(df.select("doi", F.col("dateConverted").alias("date_converted"),
                          F.col("publiDateConverted").alias("publi_date_converted"),
                          days_between("dateConverted", "publiDateConverted").alias("days_to_publication"),
                          "publiStatus"))


def citation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived_preprints(spark, sf_dir, ["published", "publiDate", "citations"])
    return tidy(df.where(F.col("citTotal").isNotNull()).select("doi", "citTotal", "cit1year", "cit2years"))


def stripped_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records whose versions share their published DOI (every 31st has none); every fourth record
    has lost its publication date and citations."""
    raw = normalise_dates(raw_preprints(spark, sf_dir))
    strip = F.col("_id") % 4 == 0
    shared = F.when(F.col("published") == "NA", F.lit("NA")).when(F.col("_id") % 31 != 0, _shared_doi())
    return raw.withColumns({"published": shared, "publiDate": F.when(~strip, F.col("publiDate")),
                            "citations": F.when(~strip, F.col("citations"))})


def _shared_doi():
    return F.concat(F.lit("10.9/"), F.expr("_id div 3").cast("string"))


def lookup_responses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Citation and metadata responses, one of each for every published record, so several per DOI. Some DOIs never
    got a citation response, some no metadata response; an empty date is a failed metadata lookup."""
    raw = raw_preprints(spark, sf_dir).where(F.col("published") != "NA").select(
        _shared_doi().alias("doi"), "citations", "publiDate", F.col("_id").alias("landed_at"), F.expr("_id div 3").alias("g"))
    meta = F.when(F.col("publiDate") != "", F.array(F.struct(F.col("publiDate").alias("pub_date")))).when(
        F.col("publiDate").isNull(), F.array(F.struct(F.col("publiDate").alias("pub_date"))))
    return (raw.where("g % 17 <> 0").select("doi", "citations", "landed_at"),
            raw.where("g % 11 <> 0").select("doi", meta.alias("metadata"), "landed_at"))


def needs_enrichment_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stripped_target(spark, sf_dir)
    return tidy(df.where(needs_enrichment(df)).select("_id", "doi", "published"))


def enrich_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = reliable_checkpoint(stripped_target(spark, sf_dir), "target")
    out = apply_lookups(target, lookup_table(*lookup_responses(spark, sf_dir)))
    return tidy(out.select("_id", "doi", "publiDate",
                           F.when(F.col("citations").isNotNull(), F.size("citations")).alias("n_citations"),
                           "enriched"))


def export_filter_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived_preprints(spark, sf_dir, ["published", "publiDate"])
    return tidy(export_filter(df).select("doi", "publiStatus"))


def export_table_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(export_table(derived_preprints(spark, sf_dir)))


def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders split into two overlapping halves; the second is merged into the first by key."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    target = o.where(F.col("o_orderkey") % 4 != 3)
    source = (o.where(F.col("o_orderkey") % 4 != 0)
              .select("o_orderkey",
                      F.lower("o_orderstatus").alias("o_orderstatus"),
                      (F.col("o_totalprice") * 2).alias("o_totalprice"),
                      F.when(F.col("o_orderkey") % 4 != 2, F.col("o_orderpriority")).alias("o_orderpriority")))
    out = upsert(target, source, "o_orderkey")
    return tidy(out.withColumn("o_totalprice", r6(F.col("o_totalprice"))))


def unique_violations_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(unique_violations(raw_preprints(spark, sf_dir), "doi"))


def category_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = latest_preprints(spark, sf_dir, ["category"])
    return tidy(df.select("doi", "category", category_group("category").alias("category_grouped")))


def month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderdate"])
    d = F.to_date("o_orderdate")
    return tidy(o.groupBy(F.month(d).alias("month_num"), month_label(d).alias("month_label"))
                .agg(F.count(F.lit(1)).alias("n_orders")))


def log_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived_preprints(spark, sf_dir)
    return tidy(df.select("doi",
                          r6(ln_or_null("numberAuthors")).alias("numberAuthorsLog"),
                          r6(ln_or_null("cit1year")).alias("cit1yearLog"),
                          r6(F.log1p(F.col("cit1year").cast("double"))).alias("log_cit1year")))


def drop_global_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents except those at the global maximum length (all ties dropped).

    The maximum is a scalar subquery: one small aggregate job, then a plain filter.
    """
    d = read_table(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    mx = d.select(F.max("n_chars")).scalar()
    return tidy(d.where(F.col("n_chars") != mx))


def freq_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = recoded_export(spark, sf_dir, ["server", "category", "published", "publiDate"])
    return tidy(frequencies(df, ["publiStatus", "server", "month_upload", "category_grouped"]))


def freq_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", ["lang", "source"])
    return tidy(frequencies(d, ["lang", "source"]))


def freq_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequencies of the export variables and of the document variables, one long table."""
    return freq_export(spark, sf_dir).unionByName(freq_docs(spark, sf_dir))


def freq_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each source within each language (stacked-bar statistics)."""
    from scholarspark.operators.profile import within_shares
    d = read_table(spark, sf_dir, "documents", ["lang", "source"])
    return tidy(within_shares(d, "lang", "source"))


def citation_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations sorted by descending timespan: the longest and shortest span per record, in months."""
    from scholarspark.functions.citations import sort_by_span_desc, span_months
    df = latest_preprints(spark, sf_dir, ["published", "citations"])
    s = df.where(F.col("citations").isNotNull() & (F.size("citations") > 0)) \
        .select("doi", sort_by_span_desc("citations").alias("sorted"))
    months = F.transform("sorted", lambda c: span_months(c["timespan"]))
    return tidy(s.select("doi", F.size("sorted").alias("n_citations"),
                         span_months(F.get("sorted", 0)["timespan"]).alias("longest_span_months"),
                         F.array_min(months).alias("shortest_span_months")))


QUERIES = {
    "published_share_by_category": published_share_by_category,
    "dedup_latest": dedup_latest,
    "replace_latest": replace_latest,
    "stored_export": stored_export,
    "derived_lengths": derived_lengths,
    "publication_status": publication_status,
    "citation_counts": citation_counts,
    "needs_enrichment": needs_enrichment_q,
    "enrich_lookup": enrich_lookup,
    "export_filter": export_filter_q,
    "export_table": export_table_q,
    "upsert_by_key": upsert_by_key,
    "unique_violations": unique_violations_q,
    "category_regroup": category_regroup,
    "month_counts": month_counts,
    "log_features": log_features,
    "drop_global_max": drop_global_max,
    "freq_export": freq_export,
    "freq_docs": freq_docs,
    "freq_within": freq_within,
    "freq_all": freq_all,
    "citation_spans": citation_spans,
}
