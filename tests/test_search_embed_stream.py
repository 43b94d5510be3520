"""Phrase search vs brute force, embedding determinism/pluggability, streaming = batch."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF01
from scholarspark.operators.embed import HashingEmbedder, embed_text
from scholarspark.operators.search import bm25_phrases, phrase_anchors, phrase_join, phrase_query
from scholarspark.plans import ingest
from scholarspark.plans.common import tidy


def test_phrase_join_equals_brute_force(spark):
    docs = spark.createDataFrame([(1, "The gene-editing tool. Gene editing, again: gene editing!"),
                                  (2, "a a a b"), (3, "nothing here"), (4, "")], "doc_id long, text string")
    phrases = spark.createDataFrame([(10, "Gene editing"), (11, "a a"), (12, "b"), (13, "here nothing"),
                                     (14, "...")], "pid long, text string")
    for inline in (5000, 0):
        got = sorted(tuple(r) for r in phrase_join(docs, "doc_id", "text", phrases, "pid", "text", inline=inline).collect())
        assert got == [(1, 10, 3), (2, 11, 2), (2, 12, 1)]
    assert phrase_join(docs, "doc_id", "text", phrases.where("pid = 14"), "pid", "text").count() == 0


def test_phrases_are_anchored_at_their_rarest_bigram(spark):
    rng = np.random.default_rng(3)
    words = ["of", "the", "in", "gene", "cell", "map", "x1", "x2", "x3"]
    docs = [(i, " ".join(rng.choice(words, 60, p=[.2, .2, .2, .1, .1, .1, .04, .03, .03]))) for i in range(60)]
    phrases = [(i, " ".join(rng.choice(words, int(rng.integers(1, 5))))) for i in range(40)] + [(98, "of the gene of the"), (99, "of the cell")]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(phrases, "pid long, text string")
    want = []
    for d, text in docs:
        toks = text.split()
        for p, phrase in phrases:
            m = phrase.split()
            n = sum(toks[i:i + len(m)] == m for i in range(len(toks) - len(m) + 1))
            if n:
                want.append((d, p, n))
    for inline in (5000, 3):
        assert sorted(map(tuple, phrase_join(frames[0], "doc_id", "text", frames[1], "pid", "text", inline=inline).collect())) == want
    anchors = {r["phrase_id"]: r["gram"] for r in phrase_anchors(frames[1], "pid", "text").collect()}
    assert anchors[98] != "of the" and anchors[99] != "of the"


def test_phrase_relevance(spark):
    """A clause weighs the idf of its terms and counts overlapping places; by hand for one document."""
    import math
    docs = spark.createDataFrame([(1, "a a a b"), (2, "a b"), (3, "c"), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in bm25_phrases(docs, "doc_id", "text", ["a a", "...", "C"]).collect()}

    def idf(df):
        return math.log(1 + (4 - df + 0.5) / (df + 0.5))
    avg = (4 + 2 + 1) / 3
    assert got.keys() == {1, 3}
    assert abs(got[1] - 2 * idf(2) * 2 * 2.2 / (2 + 1.2 * (0.25 + 0.75 * 4 / avg))) < 1e-9
    assert abs(got[3] - idf(1) * 2.2 / (1 + 1.2 * (0.25 + 0.75 / avg))) < 1e-9


def test_bool_query_counts_clauses(spark):
    docs = spark.createDataFrame([(1, "CRISPR-Cas9 based gene editing"), (2, "prime editing"), (3, "crisp")],
                                 "doc_id long, text string")
    got = sorted(tuple(r) for r in phrase_query(docs, "text", ["CRISPR", "gene editing", "prime editing"])
                 .select("doc_id", "n_clauses_matched").collect())
    assert got == [(1, 2), (2, 1)]


def test_hashing_embedder_is_deterministic_and_pluggable(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(50)
    a = embed_text(docs, "doc_id", ["text"]).orderBy("doc_id").collect()
    b = embed_text(docs.repartition(7), "doc_id", ["text"]).orderBy("doc_id").collect()
    assert [tuple(r.embedding) for r in a] == [tuple(r.embedding) for r in b]
    assert len(a[0].embedding) == 64

    class Ones:
        def __call__(self, texts):
            return np.ones((len(texts), 8))
    c = embed_text(docs, "doc_id", ["text"], embedder=lambda: Ones(), dim=8).first()
    assert list(c.embedding) == [1.0] * 8
    h = HashingEmbedder(4)
    assert np.allclose(h(["x x", ""])[1], 0)


def test_stream_equals_batch(spark):
    streamed = sorted(tuple(r) for r in ingest.stream_latest(spark, SF01, batches=5).collect())
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    from scholarspark.operators.records import keep_latest
    batch = keep_latest(ev.withColumn("version", F.lit("1")), key="user_id", tiebreak=("ts", "event_id"))
    expect = sorted(tuple(r) for r in tidy(batch.select("user_id", "event_id", "event_type", "value")).collect())
    assert streamed == expect


def test_stream_restart_reads_only_new_files(spark):
    from scholarspark.operators.records import keep_latest
    from scholarspark.plans.ingest import EVENT_SCHEMA
    from scholarspark.session import shared_path
    from scholarspark.streaming.latest import current_view, keep_latest_stream
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    first, second = ev.where(F.col("event_id") % 2 == 0), ev.where(F.col("event_id") % 2 == 1)
    landing, table, ckpt = shared_path(spark, "t-land"), shared_path(spark, "t-tab"), shared_path(spark, "t-ck")
    first.repartition(3).write.parquet(landing)
    keep_latest_stream(spark, landing, EVENT_SCHEMA, "user_id", ["ts", "event_id"], table, ckpt,
                       files_per_trigger=1).awaitTermination()
    batches_before = spark.read.parquet(table).select("_batch").distinct().count()
    second.repartition(3).write.mode("append").parquet(landing)
    keep_latest_stream(spark, landing, EVENT_SCHEMA, "user_id", ["ts", "event_id"], table, ckpt,
                       files_per_trigger=1).awaitTermination()
    log = spark.read.parquet(table)
    assert log.select("_batch").distinct().count() == batches_before + 3   # three new files, one batch each
    got = sorted(tuple(r) for r in current_view(spark, table, "user_id", ["ts", "event_id"])
                 .select("user_id", "event_id").collect())
    batch = keep_latest(ev.withColumn("version", F.lit("1")), key="user_id", tiebreak=("ts", "event_id"))
    assert got == sorted(tuple(r) for r in batch.select("user_id", "event_id").collect())


def test_compacted_log_gives_the_same_view(spark):
    from scholarspark.plans.ingest import EVENT_SCHEMA
    from scholarspark.session import shared_path
    from scholarspark.streaming.latest import compact, current_view, keep_latest_stream
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    landing, table, ckpt = shared_path(spark, "c-land"), shared_path(spark, "c-tab"), shared_path(spark, "c-ck")
    ev.repartition(4).write.parquet(landing)
    keep_latest_stream(spark, landing, EVENT_SCHEMA, "user_id", ["ts", "event_id"], table, ckpt,
                       files_per_trigger=1).awaitTermination()
    before = sorted(tuple(r) for r in current_view(spark, table, "user_id", ["ts", "event_id"]).collect())
    new = compact(spark, table, shared_path(spark, "c-compact"), "user_id", ["ts", "event_id"])
    after = sorted(tuple(r) for r in current_view(spark, new, "user_id", ["ts", "event_id"]).collect())
    assert before == after
    assert spark.read.parquet(new).count() == len(after)


def test_index_keeps_the_last_write_per_key(spark):
    from scholarspark.operators.search import build_index, indexed_phrase_query
    from scholarspark.session import shared_path
    docs = spark.createDataFrame([(1, 1, "old gene-editing text"), (1, 2, "new text"), (2, 1, "Gene editing!")],
                                 "doc_id long, written long, text string")
    idx = build_index(docs, "doc_id", ["text"], shared_path(spark, "t-index"), order_col="written")
    assert sorted(tuple(r) for r in idx.collect()) == [(1, " new text "), (2, " gene editing ")]
    hits = sorted(r.doc_id for r in indexed_phrase_query(idx, "text", ["gene editing"]).collect())
    assert hits == [2]
