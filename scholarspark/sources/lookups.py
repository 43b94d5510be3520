"""Landed lookup responses per DOI (citation list; metadata with a publication date).

A failed lookup lands as a NULL list; the first metadata element's ``pub_date`` is the publication
date (it may be NULL on success). ``landed_at`` (optional) orders responses of the same DOI.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarspark.schemas import CITATION_RESPONSE, METADATA_RESPONSE


def read_citation_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CITATION_RESPONSE).json(path)


def read_metadata_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA_RESPONSE).json(path)


def lookup_table(citations: DataFrame, metadata: DataFrame) -> DataFrame:
    """(doi, pub_date, date_ok, citations, cit_ok), one row per published DOI that has any response.

    A DOI may have several responses of a kind (versions that share it are looked up one by one): the
    successful one landed last counts, else a failed one. ``date_ok`` / ``cit_ok`` say whether such
    a response landed and succeeded; a response that never landed is not a success. Each side is reduced on the DOI
    before the join, which then needs no further shuffle.
    """
    def one(df: DataFrame, value, ok) -> DataFrame:
        landed = F.col("landed_at") if "landed_at" in df.columns else F.lit(None).cast("long")
        row = F.struct(ok.alias("ok"), value.alias("value"))
        return df.groupBy("doi").agg(F.max_by(row, F.struct(ok, landed, F.xxhash64(value))).alias("r")).select(
            "doi", "r.ok", "r.value")

    meta = one(metadata, F.get(F.col("metadata"), 0)["pub_date"], F.col("metadata").isNotNull())
    cit = one(citations, F.col("citations"), F.col("citations").isNotNull())
    return (meta.select("doi", F.col("value").alias("pub_date"), F.col("ok").alias("date_ok"))
                .join(cit.select("doi", F.col("value").alias("citations"), F.col("ok").alias("cit_ok")), "doi", "full_outer")
                .withColumns({"date_ok": F.coalesce("date_ok", F.lit(False)), "cit_ok": F.coalesce("cit_ok", F.lit(False))}))
