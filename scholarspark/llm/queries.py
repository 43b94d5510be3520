"""The registered queries opN_<name>: thin, each applies its operator to the whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarspark.llm import bpe, collocations, decontaminate, fingerprints, langid, lsh_forest, runs, sharding, suffix_dedup, token_counts, token_files, toxicity, url_filter
from scholarspark.llm.common import literal_table, table
from scholarspark.session import shared_path

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))


ORACLE_SQL["op1_fingerprints"] = fingerprints.ORACLE


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_contamination(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.inline("hits")).select("doc_id", "item_id", "cosine", "lcs", "answer")


def fold(col, k: int):
    """crc32 of an id as text, modulo k (null id: of the empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % k


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 3) != 1)
    weights, bias = toxicity.train_model(docs, labels)
    scored = toxicity.score_documents(docs, weights, bias, columns=["doc_id"])
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"),
                         F.size("offending").alias("n_offending"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op5_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 8)


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id")
    profiles = langid.learn_profiles(rows.select("id", "text"), rows.where(fold(F.col("id"), 4) != 2).select("id", "lang"))
    found = langid.identify(rows.select("id", "text"), profiles)
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", "class_id", "n_links")


@query
def op8_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decoded=True)
    return ids.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.PATTERN)
    return token_files.ids_crc32(token_files.read_tokens(spark, path))


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = suffix_dedup.mark_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = suffix_dedup.remove_spans(marked)
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE_SQL["op11_collocations"] = collocations.ORACLE


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one text in ten, by its id, repeats itself from some word on."""
    docs = docs.select("doc_id", "text", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs.select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), F.when(F.col("h") % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.coalesce(F.size("words"), F.lit(0))).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.transform(F.sequence(F.lit(0), F.col("n") - F.col("a") - 1), lambda i: F.element_at("words", F.col("a") + i % F.col("p") + 1))
    repeated = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(with_repeats(table(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, lambda top, r: F.when(
        top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


#: The stated rules.
URL_RULES = [
    {"host": "com", "path": "/", "verdict": "allow"}, {"host": "example.com", "path": "/en/", "verdict": "block"},
    {"host": "www.example.com", "path": "/en/", "verdict": "allow"}, {"host": "net", "path": "/es/", "verdict": "block"},
    {"host": "net", "path": "/fr/", "verdict": "block"},
]


@query
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = literal_table(spark, URL_RULES, "host string, path string, verdict string")
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")
