"""Named full-text search queries over ``documents`` (phrases from ``benchmark`` or a fixed query)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholarspark.operators.search import bm25, bm25_phrases, phrase_join, phrase_query, subset_by_hits, top_k
from scholarspark.plans.common import r6, tidy
from scholarspark.sources.tables import read_table

# A thematic query in the form the project uses: any of several phrases on one text field
# (one clause is hyphenated, which analysis turns into a two-token phrase).
BOOL_PHRASES = ["anea eriner thanea", "attion-to thanedble", "in the", "de la", "der die", "genetic engineering"]
BM25_QUERY = "thanedble eriner anea attion genetic"
#: The project's ranked queries return up to this many hits.
TOP_K = 10_000


def phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage (as a phrase) found in every document, with occurrence counts."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    bench = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    return tidy(phrase_join(docs, "doc_id", "text", bench, "item_id", "text"))


def bool_should(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return tidy(phrase_query(docs, "text", BOOL_PHRASES).select("doc_id", "n_clauses_matched"))


def indexed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thematic query against a search index table built from the documents (analysis at
    indexing time, plain substring tests at query time); same hits as ``bool_should``."""
    from scholarspark.operators.search import build_index, indexed_phrase_query
    from scholarspark.session import shared_path
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    index = build_index(docs, "doc_id", ["text"], shared_path(spark, "search-index"))
    return tidy(indexed_phrase_query(index, "text", BOOL_PHRASES).select("doc_id", "n_clauses_matched"))


def search_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact number of hits of the boolean query (no 10,000 cap)."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return tidy(phrase_query(docs, "text", BOOL_PHRASES).agg(F.count(F.lit(1)).alias("n_hits")))


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    best = top_k(bm25(docs, "doc_id", "text", BM25_QUERY), TOP_K)
    w = Window.orderBy(F.desc(F.round("score", 9)), F.asc("doc_id"))   # over the k rows only
    return tidy(best.select("doc_id", r6(F.col("score")).alias("score"), F.row_number().over(w).alias("rank")))


def bm25_phrases_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thematic phrase query with relevance: the best 10,000 documents."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    best = top_k(bm25_phrases(docs, "doc_id", "text", BOOL_PHRASES), TOP_K)
    return tidy(best.select("doc_id", "n_clauses_matched", r6(F.col("score")).alias("score")))


def subset_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled records restricted to the documents the thematic query finds."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = read_table(spark, sf_dir, "labels")
    hits = phrase_query(docs, "text", BOOL_PHRASES)
    return tidy(subset_by_hits(labels, hits, "doc_id"))


# Text fields of a record that the index holds, and a thematic query on two of them.
RECORD_FIELDS = ["title", "abstract", "authors", "category", "server", "published"]
THEME = ["1-urgent", "customer 12 é", "order 7", "genetic engineering"]


def thematic_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of the records indexed by DOI (six fields, the last version wins), the thematic query run on title
    and abstract, and its hits merged by DOI with the latest records into a table of their own."""
    from scholarspark.operators.records import version_number
    from scholarspark.operators.search import build_index, indexed_fields_query
    from scholarspark.plans.common import latest_preprints, raw_preprints
    from scholarspark.session import reliable_checkpoint, shared_path
    raw = raw_preprints(spark, sf_dir).withColumn("_version", version_number("version"))
    index = build_index(raw, "doi", RECORD_FIELDS, shared_path(spark, "record-index"), order_col="_version")
    hits = indexed_fields_query(index, ["title", "abstract"], THEME).select(F.col("doc_id").alias("doi"), "n_clauses_matched")
    latest = latest_preprints(spark, sf_dir, ["category", "published"])
    return tidy(reliable_checkpoint(latest.join(hits, "doi"), "subset").select(
        "doi", "version", "category", "published", "n_clauses_matched"))


QUERIES = {
    "thematic_subset": thematic_subset,
    "phrase_search": phrase_search,
    "bool_should": bool_should,
    "indexed_search": indexed_search,
    "search_count": search_count,
    "bm25_topk": bm25_topk,
    "bm25_phrases": bm25_phrases_topk,
    "subset_semi": subset_semi,
}
