"""Named text-processing and embedding queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarspark.functions.text import clean_text, normalised_tokens, sentence_split, whitespace_tokens
from scholarspark.operators.embed import embed_text as embed
from scholarspark.operators.embed import long_vectors, mean_vectors, sentence_vectors as sentence_vecs, vector_sizes
from scholarspark.plans.common import tidy
from scholarspark.sources.tables import read_table


def tokenise(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return tidy(d.select("doc_id", F.length(clean_text("text")).alias("clean_chars"),
                         F.size(whitespace_tokens("text")).alias("n_tokens"),
                         F.size(normalised_tokens("text")).alias("n_norm_tokens")))


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    s = d.select("doc_id", sentence_split("text").alias("s"))
    return tidy(s.select("doc_id", F.size("s").alias("n_sentences"),
                         F.length(F.get("s", 0)).alias("first_sentence_chars")))


def mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings", ["label", "embedding"])
    return tidy(long_vectors(mean_vectors(e, "embedding", ["label"]), ["label"], "mean_vec", "mean"))


def vector_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(vector_sizes(read_table(spark, sf_dir, "embeddings", ["embedding"]), "embedding"))


def first_sentence_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding of each document's first sentence (the default pooling), long form: the first slot and all that are not zero."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    e = embed(d, "doc_id", ["text"], pooling="first_sentence")
    return tidy(long_vectors(e, ["doc_id"], "embedding").where((F.col("value") != 0) | (F.col("dim") == 0)))


def embed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-text embedding of every document: token count and vector norm/sum per document."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    e = embed(d, "doc_id", ["text"], pooling="document")
    return tidy(e.select("doc_id", "n_tokens",
                         F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")).alias("vec_sum"),
                         F.sqrt(F.aggregate("embedding", F.lit(0.0),
                                            lambda a, x: a + x.cast("double") * x.cast("double"))).alias("vec_norm")))


def _vec_sum(c: str = "embedding"):
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double"))


def _vec_norm(c: str = "embedding"):
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def sentence_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every document embedded: token count, vector sum and norm per sentence."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    e = sentence_vecs(d, "doc_id", ["text"])
    return tidy(e.select("doc_id", "sentence_idx", "n_tokens", _vec_sum().alias("vec_sum"),
                         _vec_norm().alias("vec_norm")))


QUERIES = {
    "tokenise": tokenise,
    "sentences": sentences,
    "mean_pool": mean_pool,
    "vector_size": vector_size,
    "first_sentence_vec": first_sentence_vec,
    "embed_text": embed_text,
    "sentence_vectors": sentence_vectors,
}
