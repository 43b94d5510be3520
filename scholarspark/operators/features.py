"""Feature engineering for the classification and regression models.

``prepare`` is a pure function (no session, no action). The fitted stages are a Spark ML
``Pipeline`` that is fitted on the training split only (indexers, encoders and the scaler
never see test rows).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarspark.functions.recode import binary_status, category_group, ln_or_null, publication_label
from scholarspark.operators.records import export_filter

NUMERIC = ["titleLength", "abstractLength", "numberAuthorsLog"]


def prepare(derived: DataFrame) -> DataFrame:
    """Export filter, recoding and log transform on derived records (one projection)."""
    df = export_filter(derived)
    return df.withColumns({
        "numberAuthorsLog": ln_or_null("numberAuthors"),
        "month_upload": F.coalesce(F.month("dateConverted"), F.lit(0)),      # 0: unknown, a slot of its own
        "category_grouped": category_group("category"),
        "publiStatus_binary": binary_status("publiStatus"),
    }).withColumns({"authors_missing": F.col("numberAuthorsLog").isNull().cast("double"),
                    "titleLength": F.col("titleLength").cast("double"), "abstractLength": F.col("abstractLength").cast("double")})


def attach_vectors(df: DataFrame, vectors: DataFrame, key: Column, vec_key: str, vec_col: str, dim: int,
                   out_col: str = "text_vec") -> DataFrame:
    """Left join of an embedding table (one vector per key); the array becomes an ML vector, all zero for a
    record that has none, so no record is lost."""
    v = vectors.select(F.col(vec_key).alias("_vk"), F.col(vec_col).alias("_vec"))
    zero = F.array_repeat(F.lit(0.0), dim)
    return (df.withColumn("_key", key).join(v, F.col("_key") == F.col("_vk"), "left")
              .withColumn(out_col, array_to_vector(F.coalesce("_vec", zero))).drop("_key", "_vk", "_vec"))


def hash_bucket(id_col: str, buckets: int = 100) -> Column:
    """Deterministic bucket of an id: first 32 bits of md5(text of id) modulo ``buckets``."""
    h = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("bigint")
    return h % buckets


def split_by_key(df: DataFrame, id_col: str, train_pct: int = 80) -> DataFrame:
    """'train'/'test' by a hash of the key: the same rows whatever the partitioning."""
    return df.withColumn("split", F.when(hash_bucket(id_col) < train_pct, F.lit("train")).otherwise(F.lit("test")))


def classification_frame(prepared: DataFrame) -> DataFrame:
    return prepared.withColumn("label", publication_label("publiStatus"))


def regression_frame(prepared: DataFrame) -> DataFrame:
    return prepared.where(F.col("cit1year").isNotNull()).withColumn("cit1year", F.col("cit1year").cast("double"))


def feature_pipeline(kind: str = "classification", vec_col: str | None = "text_vec") -> Pipeline:
    """Indexers -> one-hot -> imputer -> numeric assembler -> scaler -> final assembler.

    ``month_upload`` (1-12, 0 unknown) is encoded as given: 12 slots, December all zero. No row is
    dropped: a NULL numeric takes the mean of the rows fitted on, and a missing author count sets a slot.
    """
    cats = ["server", "category_grouped"] + (["publiStatus"] if kind == "regression" else [])
    idx = StringIndexer(inputCols=cats, outputCols=[f"{c}_index" for c in cats], handleInvalid="keep")
    enc_in = [f"{cats[0]}_index", "month_upload"] + [f"{c}_index" for c in cats[1:]]
    enc_out = [f"{cats[0]}_encoded", "month_upload_encoded"] + [f"{c}_encoded" for c in cats[1:]]
    enc = OneHotEncoder(inputCols=enc_in, outputCols=enc_out)   # unseen levels: the indexer's extra slot
    filled = [f"{c}_filled" for c in NUMERIC]
    fill = Imputer(inputCols=NUMERIC, outputCols=filled, strategy="mean")
    num = VectorAssembler(inputCols=filled, outputCol="numeric_raw")
    scaler = StandardScaler(inputCol="numeric_raw", outputCol="numeric_scaled", withMean=True, withStd=True)
    final_in = enc_out + ["numeric_scaled", "authors_missing"] + ([vec_col] if vec_col else [])
    final = VectorAssembler(inputCols=final_in, outputCol="features")
    return Pipeline(stages=[idx, enc, fill, num, scaler, final])
