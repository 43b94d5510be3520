"""Declared schemas (no inference) for the preprint record and its landed JSON shapes."""

from __future__ import annotations

from pyspark.sql import types as T

CITATION = T.StructType([T.StructField("timespan", T.StringType(), True)])

# One preprint as it is stored after landing and enrichment (union of every field used).
PREPRINT = T.StructType([
    T.StructField("doi", T.StringType(), False),
    T.StructField("version", T.StringType(), True),
    T.StructField("server", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("abstract", T.StringType(), True),
    T.StructField("authors", T.StringType(), True),
    T.StructField("author_corresponding_institution", T.StringType(), True),
    T.StructField("date", T.StringType(), True),
    T.StructField("published", T.StringType(), True),
    T.StructField("publiDate", T.StringType(), True),
    T.StructField("citations", T.ArrayType(CITATION), True),
])

# API page: {"messages": [{"count_new_papers": "..", "total": ".."}], "collection": [preprint, ...]}
PAGE_MESSAGE = T.StructType([
    T.StructField("count_new_papers", T.StringType(), True),
    T.StructField("total", T.StringType(), True),
])
PAGE = T.StructType([
    T.StructField("messages", T.ArrayType(PAGE_MESSAGE), True),
    T.StructField("collection", T.ArrayType(PREPRINT), True),
])

# Lookup responses landed per DOI (citation list, metadata with pub_date).
CITATION_RESPONSE = T.StructType([
    T.StructField("doi", T.StringType(), False),
    T.StructField("citations", T.ArrayType(CITATION), True),
    T.StructField("landed_at", T.LongType(), True),
])
METADATA_RESPONSE = T.StructType([
    T.StructField("doi", T.StringType(), False),
    T.StructField("metadata", T.ArrayType(T.StructType([T.StructField("pub_date", T.StringType(), True)])), True),
    T.StructField("landed_at", T.LongType(), True),
])

# Export row (fixed column list of the CSV export).
EXPORT_COLUMNS = ["doi", "server", "version", "category", "publiStatus", "date",
                  "author_corresponding_institution", "titleLength", "abstractLength",
                  "numberAuthors", "cit1year"]

EXPORT = T.StructType([
    T.StructField("doi", T.StringType(), False),
    T.StructField("server", T.StringType(), True),
    T.StructField("version", T.IntegerType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("publiStatus", T.StringType(), True),
    T.StructField("date", T.StringType(), True),
    T.StructField("author_corresponding_institution", T.StringType(), True),
    T.StructField("titleLength", T.IntegerType(), True),
    T.StructField("abstractLength", T.IntegerType(), True),
    T.StructField("numberAuthors", T.IntegerType(), True),
    T.StructField("cit1year", T.IntegerType(), True),
])
