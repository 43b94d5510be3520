"""Named ingest queries: JSON decoding, landed pages, landed lookups, streaming keep-latest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarspark.operators.records import apply_lookups, normalise_dates, version_number
from scholarspark.plans.common import WIDE, raw_preprints, tidy
from scholarspark.plans.records import lookup_responses, stripped_target
from scholarspark.schemas import PAGE
from scholarspark.session import reliable_checkpoint, shared_path
from scholarspark.sources.lookups import lookup_table, read_citation_responses, read_metadata_responses
from scholarspark.sources.pages import harvest_completeness, harvest_gaps, land_pages, page_completeness, page_records, read_pages, to_pages
from scholarspark.sources.tables import read_table
from scholarspark.streaming.latest import current_view, keep_latest_stream

PAGE_SIZE = 100
RECORD_COLS = ["doi", "version", "server", "category", "title", "abstract", "authors",
               "author_corresponding_institution", "date", "published", "publiDate", "citations"]
PAGE_NO = T.StructType([T.StructField("page_no", T.LongType(), True)])


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode a JSON text column with a declared schema."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "props"])
    return tidy(ev.select("event_id", F.from_json("props", "k bigint")["k"].alias("k")))


def _landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = raw_preprints(spark, sf_dir)
    path = shared_path(spark, "pages")
    land_pages(to_pages(recs, F.expr(f"_id div {PAGE_SIZE}"), RECORD_COLS), path)
    return read_pages(spark, path, PAGE_NO)


def json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records landed as API pages and read back: one row per record."""
    recs = page_records(_landed_pages(spark, sf_dir))
    return tidy(recs.select("page_no", "doi", "version", "server", "published", "publiDate",
                            F.when(F.col("citations").isNotNull(), F.size("citations")).alias("n_citations")))


def page_completeness_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(page_completeness(_landed_pages(spark, sf_dir), "page_no"))


def _harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages of one harvest for each server and year, with every defect: pages that are lacking, that came twice, and that
    begin too early."""
    recs = raw_preprints(spark, sf_dir).select("server", F.substring("date", 1, 4).alias("interval"), "_id")
    w = Window.partitionBy("server", "interval")
    page = F.floor((F.row_number().over(w.orderBy("_id")) - 1) / PAGE_SIZE).alias("page")
    pages = recs.select("server", "interval", page, F.count(F.lit(1)).over(w).alias("total")).groupBy("server", "interval", "page", "total").agg(
        F.count(F.lit(1)).alias("loaded")).where("page % 7 <> 3")
    pages = pages.withColumn("cursor", F.col("page") * PAGE_SIZE - F.when(F.col("page") % 11 == 4, 30).otherwise(0))
    return pages.select("*", F.explode(F.sequence(F.lit(1), F.when(F.col("page") % 5 == 2, 2).otherwise(1))).alias("time"))


def harvest_completeness_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each harvest lacks, has twice and overlaps, against the total it declares."""
    return tidy(harvest_completeness(_harvest(spark, sf_dir), ["server", "interval"]))


def harvest_gaps_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record ranges to fetch again."""
    return tidy(harvest_gaps(_harvest(spark, sf_dir), ["server", "interval"]))


def landed_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup responses landed as JSON, read back and applied to stripped records."""
    target = reliable_checkpoint(stripped_target(spark, sf_dir), "target")
    out = apply_lookups(target, _land_lookups(spark, sf_dir))
    return tidy(out.select("_id", "doi", "publiDate",
                           F.when(F.col("citations").isNotNull(), F.size("citations")).alias("n_citations"),
                           "enriched"))


def _land_lookups(spark: SparkSession, sf_dir: str):
    cit_path, meta_path = shared_path(spark, "cit"), shared_path(spark, "meta")
    citations, metadata = lookup_responses(spark, sf_dir)
    citations.write.json(cit_path)
    metadata.write.json(meta_path)
    return lookup_table(read_citation_responses(spark, cit_path), read_metadata_responses(spark, meta_path))


def landed_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From landed files to the export table in one plan: records read from landed API pages
    (every fourth without date and citations), landed lookup responses applied to every version,
    latest version kept, fields derived, export filter and columns applied."""
    from scholarspark.operators.records import derive_fields, export_table, keep_latest
    pages_path = shared_path(spark, "pages-stripped")
    land_pages(to_pages(stripped_target(spark, sf_dir), F.expr(f"_id div {PAGE_SIZE}"), RECORD_COLS), pages_path)
    records = reliable_checkpoint(page_records(read_pages(spark, pages_path)).select(*RECORD_COLS), "target")
    enriched = apply_lookups(records, _land_lookups(spark, sf_dir)).drop("enriched")
    return tidy(export_table(keep_latest(derive_fields(enriched).drop(*WIDE))))


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def stream_latest(spark: SparkSession, sf_dir: str, batches: int = 4) -> DataFrame:
    """Events landed as files, consumed by the streaming keep-latest job in about ``batches``
    micro-batches; returns the current view.

    The landing write uses as many files as shuffle partitions (it scales with the cluster),
    and the trigger size is derived from the landed file count.
    """
    landing, table = shared_path(spark, "landing"), shared_path(spark, "latest")
    ev = read_table(spark, sf_dir, "events")
    n_files = max(batches, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ev.repartition(n_files, "event_id").write.parquet(landing)
    landed = len(spark.read.parquet(landing).inputFiles())     # file listing only
    q = keep_latest_stream(spark, landing, EVENT_SCHEMA, "user_id", ["ts", "event_id"], table,
                           shared_path(spark, "stream-ckpt"), files_per_trigger=max(1, -(-landed // batches)))
    q.awaitTermination()
    view = current_view(spark, table, "user_id", ["ts", "event_id"])
    return tidy(view.select("user_id", "event_id", "event_type", "value"))


def stream_pages(spark: SparkSession, sf_dir: str, batches: int = 4) -> DataFrame:
    """Records landed as API pages (JSON), consumed by the streaming job page file by page file; the latest
    version of each record."""
    landing, table = shared_path(spark, "page-landing"), shared_path(spark, "page-latest")
    pages = to_pages(raw_preprints(spark, sf_dir), F.expr(f"_id div {PAGE_SIZE}"), RECORD_COLS)
    land_pages(pages.repartition(max(batches, int(spark.conf.get("spark.sql.shuffle.partitions"))), "page_no"), landing)
    landed = len(spark.read.text(landing).inputFiles())        # file listing only

    def records(pages: DataFrame) -> DataFrame:
        return normalise_dates(page_records(pages)).withColumn("_version", version_number("version"))

    order = ["_version", "date"]
    q = keep_latest_stream(spark, landing, PAGE, "doi", order, table, shared_path(spark, "page-ckpt"), fmt="json",
                           files_per_trigger=max(1, -(-landed // batches)), prepare=records)
    q.awaitTermination()
    view = current_view(spark, table, "doi", order)
    return tidy(view.select("doi", "version", "date", "published", "publiDate",
                            F.when(F.col("citations").isNotNull(), F.size("citations")).alias("n_citations")))


QUERIES = {
    "stream_pages": stream_pages,
    "json_props": json_props,
    "json_pages": json_pages,
    "page_completeness": page_completeness_q,
    "harvest_completeness": harvest_completeness_q,
    "harvest_gaps": harvest_gaps_q,
    "landed_lookups": landed_lookups,
    "landed_export": landed_export,
    "stream_latest": stream_latest,
}
