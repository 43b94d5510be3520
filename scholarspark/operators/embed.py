"""Text to vector: merge, clean, sentence split, tokenise, normalise, embed, pool.

Text preparation is all built-in Spark expressions. The model call is a pluggable,
batched ``predict_batch_udf`` (Arrow batches, the model loaded once per Python worker).
The model sees one normalised sentence (or the whole normalised text) per row, tokens
separated by single spaces, and returns one vector per row (mean of token vectors).

``HashingEmbedder`` is the built-in deterministic stand-in (no weights, no network): each
token is md5-hashed to one of ``dim`` slots with a sign; a text's vector is the mean of its
token vectors. It is reproducible in SQL, which is how the pipeline is checked. Any model
with the same ``__call__(list[str]) -> np.ndarray`` contract can be passed instead.
"""

from __future__ import annotations

import sys

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarspark.functions.text import clean_text, merged_text, normalised_tokens, sentence_split
from scholarspark.operators.search import with_once

# UDF code from this module is shipped to Python workers by value, so executors do not
# need the package installed (the driver may run from anywhere).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_DIM = 64


class HashingEmbedder:
    """Deterministic signed feature hashing of tokens (md5), mean-pooled."""

    def __init__(self, dim: int = DEFAULT_DIM):
        self.dim = dim

    def token_slot(self, token: str) -> tuple[int, float]:
        h = hashlib.md5(token.encode("utf-8")).hexdigest()
        return int(h[:8], 16) % self.dim, (1.0 if int(h[8], 16) % 2 == 0 else -1.0)

    def __call__(self, texts) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float64)
        cache: dict[str, tuple[int, float]] = {}
        for r, text in enumerate(texts):
            if not text:
                continue
            toks = text.split(" ")
            acc = np.zeros(self.dim, dtype=np.float64)
            for t in toks:
                slot = cache.get(t)
                if slot is None:
                    slot = cache[t] = self.token_slot(t)
                acc[slot[0]] += slot[1]
            out[r] = acc / len(toks)
        return out


def model_udf(loader: Callable[[], Callable], dim: int, batch_size: int = 256):
    """Wrap a model loader as a batched UDF: string column -> array<double>(dim)."""
    def make_predict_fn():
        model = loader()

        def predict(texts: np.ndarray) -> np.ndarray:
            return np.asarray(model(list(texts)), dtype=np.float64).reshape(len(texts), dim)
        return predict
    return predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)


def prepared_text(text: Column, pooling: str = "first_sentence") -> Column:
    """Normalised tokens joined by spaces: of the first sentence, or of the whole text."""
    if pooling == "first_sentence":
        first = F.get(sentence_split(text), 0)
        return F.array_join(normalised_tokens(first), " ")
    if pooling == "document":
        return F.array_join(normalised_tokens(clean_text(text)), " ")
    raise ValueError(f"unknown pooling {pooling!r}")


def embed_text(df: DataFrame, id_col: str, text_cols: list[str], embedder: Callable[[], Callable] | None = None,
               dim: int = DEFAULT_DIM, pooling: str = "first_sentence", out_col: str = "embedding",
               batch_size: int = 256) -> DataFrame:
    """(id, n_tokens, embedding array<double>) for every row; NULL text gives a NULL vector.

    ``text_cols`` of two columns are merged as ``a + ' ' + b`` (NULL if either is NULL).
    """
    text = F.col(text_cols[0]) if len(text_cols) == 1 else merged_text(text_cols[0], text_cols[1])
    loader = embedder or (lambda: HashingEmbedder(dim))
    udf = model_udf(loader, dim, batch_size)
    prepped = with_once(df.select(F.col(id_col), text.alias("_raw")), prepared_text(F.col("_raw"), pooling), "_txt")
    n_tok = F.when(F.col("_txt").isNull(), None).when(F.col("_txt") == "", 0) \
        .otherwise(F.size(F.split("_txt", " ")))
    scored = prepped.select(id_col, n_tok.alias("n_tokens"), F.col("_txt").isNotNull().alias("_some"),
                            udf(F.coalesce("_txt", F.lit(""))).alias("_vec"))
    # behind the barrier the vector is a column like any other: what uses it does not call the model again
    return with_once(scored, F.when(F.col("_some"), F.col("_vec")), out_col).select(id_col, "n_tokens", out_col)


def sentence_vectors(df: DataFrame, id_col: str, text_cols: list[str], embedder: Callable[[], Callable] | None = None,
                     dim: int = DEFAULT_DIM, out_col: str = "embedding", batch_size: int = 256) -> DataFrame:
    """One vector per sentence: (id, sentence_idx, n_tokens, embedding), sentences in text order.

    Every sentence of every text is embedded (mean of its token vectors); ``first_sentence``
    pooling is the row with ``sentence_idx = 0``, and a document vector is the mean over its
    sentences (``mean_vectors`` grouped by id).
    """
    text = F.col(text_cols[0]) if len(text_cols) == 1 else merged_text(text_cols[0], text_cols[1])
    loader = embedder or (lambda: HashingEmbedder(dim))
    udf = model_udf(loader, dim, batch_size)
    sent = df.select(F.col(id_col), F.posexplode(sentence_split(text)).alias("sentence_idx", "_s"))
    prepped = with_once(sent, F.array_join(normalised_tokens(F.col("_s")), " "), "_txt")
    n_tok = F.when(F.col("_txt") == "", 0).otherwise(F.size(F.split("_txt", " ")))
    scored = prepped.select(id_col, "sentence_idx", n_tok.alias("n_tokens"), udf(F.col("_txt")).alias("_vec"))
    return with_once(scored, F.col("_vec"), out_col).select(id_col, "sentence_idx", "n_tokens", out_col)


def mean_vectors(df: DataFrame, vec_col: str, group_cols: list[str]) -> DataFrame:
    """Mean vector per group with partial aggregation of whole vectors (no per-dimension explode)."""
    v = array_to_vector(F.col(vec_col))
    return df.groupBy(*group_cols).agg(vector_to_array(Summarizer.mean(v)).alias("mean_vec"))


def long_vectors(df: DataFrame, key_cols: list[str], vec_col: str, value_name: str = "value") -> DataFrame:
    """(keys..., dim, value) rows of an array column."""
    return df.select(*key_cols, F.posexplode(vec_col).alias("dim", value_name))


def vector_sizes(df: DataFrame, vec_col: str) -> DataFrame:
    """Distinct vector sizes and their row counts (one row means a constant size)."""
    return df.groupBy(F.size(vec_col).alias("vector_size")).agg(F.count(F.lit(1)).alias("n_rows"))
