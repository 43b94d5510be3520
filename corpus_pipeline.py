"""Corpus preparation: stages applied one after the other to ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again
as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarspark.llm import bpe, decontaminate, lsh_forest, suffix_dedup, toxicity
from scholarspark.llm.common import table
from scholarspark.session import reliable_checkpoint

#: Documents at or above this toxicity go.
TOXIC = 0.7
#: Passages at least this long that occur twice go; fifty words of prose are longer.
PASSAGE_BYTES = 240


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the labels of the documents given; rejected documents go."""
    weights, bias = toxicity.train_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, weights, bias).where(F.col("score") < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, that of least id."""
    return lsh_forest.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long repeated passages are cut out of the texts; every document stays."""
    marked = suffix_dedup.mark_repeats(docs, length=PASSAGE_BYTES)
    kept = suffix_dedup.remove_spans(marked, as_text=True)
    out = kept.withColumn("text", F.col("kept")).withColumn("n_chars", F.length("kept").cast("long"))
    return out.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    marked = decontaminate.mark_contamination(docs, table(spark, sf_dir, "benchmark"))
    return marked.where(F.size("hits") == 0).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text that is left, decoded again; fails if a text does not come back."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)          # the text itself travels once
    rows = docs.select(F.struct("doc_id", digest.alias("digest")).alias("row"), "text")
    out = bpe.encode_documents(rows, path, public_tokenizers.PATTERN, id_col="row", decoded=True)
    same = F.sha2(F.col("decoded").cast("binary"), 256) == F.col("row.digest")
    checked = F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("a text differs after encoding and decoding")))
    return out.select("row.doc_id", "n_tokens", checked.alias("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("byte_level_bpe", encode),
]

#: The stages hold trained models and exact suffix matching, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = reliable_checkpoint(docs, f"pipeline-{name}")
    return docs
