"""Fingerprints, shards, toxicity and languages."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_tables import no_docs, odd_docs  # noqa: F401
from scholarspark.llm import fingerprints, langid, sharding, toxicity


def test_fingerprints_of_odd_rows(odd_docs, no_docs):
    rows = fingerprints.document_fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    same = {r["fingerprint"] for r in rows if r["n_chars"] == len("Hello, world!")}
    assert len(same) == 1
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert fingerprints.document_fingerprints(no_docs).count() == 0


def test_next_row_wraps_and_skips_gaps(spark):
    ids = [1, 2, 3, 50, 51, 5000, 5001, 9000]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string").repartition(4)
    for bucket in (1, 2, 512):
        got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(df, "doc_id", ["text"], bucket).collect()}
        assert got == {i: f"text {ids[k - 1]}" for k, i in enumerate(ids)}


def test_edited_text(spark):
    df = spark.createDataFrame([(2, "abcdefgé"), (1, "xy"), (0, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.document_fingerprints(df).collect()}
    want = {2: "abcdef" + "xy", 1: "xy", 0: ""}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}


def test_differing_paragraphs_locate_the_edit(spark):
    a = "\n".join(f"paragraph {i} says something, then more." for i in range(60))
    b = a.replace("paragraph 37 says", "paragraph 37 denies")
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = fingerprints.add_fingerprint(fingerprints.add_fingerprint(df, F.col("a"), "fa"), F.col("b"), "fb")
    row = fingerprints.add_likeness(df, "fa", "fb", "near").select(
        "near", fingerprints.differing_paragraphs(F.col("fa"), F.col("fb")).alias("d")).first()
    assert row["d"] == [hashlib.sha256(b"paragraph 37 says something, then more.").hexdigest()[:10]]
    assert 0.9 < row["near"] < 1


def test_fingerprints_are_native(odd_docs):
    for df in (fingerprints.document_fingerprints(odd_docs), sharding.assign_shards(odd_docs, 8)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def brute_shards(rows, shards):
    """The ring settled row by row: every round each row asks its next shard, in ring and hash order."""
    cells = defaultdict(list)
    for doc_id, text in rows:
        h = int(hashlib.md5(str(doc_id if doc_id is not None else "").encode()).hexdigest()[:8], 16)
        cells[h % sharding.CELLS].append((h, doc_id is not None, doc_id or 0, zlib.crc32((text or "").encode()),
                                          len((text or "").encode()) + 1))
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    orders, out = sharding.ring(shards), []
    waiting = [(c, r) for c in sorted(cells) for r in sorted(cells[c])]
    for k in range(shards):
        rest = []
        for cell, row in waiting:
            s = orders[cell][k]
            if room[s]:
                room[s] -= 1
                out.append((row[2] if row[1] else None, row[4], row[3], s))
            else:
                rest.append((cell, row))
        waiting = rest
    return Counter(out)


def test_shards(spark, odd_docs, no_docs):
    many = odd_docs.select("doc_id", "text").union(
        spark.createDataFrame([(i, "t" * (i % 7)) for i in range(100, 800)], "doc_id long, text string"))
    rows = sharding.assign_shards(many, 8).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == many.count() and set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in rows) == brute_shards(
        [tuple(r) for r in many.collect()], 8)
    assert sharding.assign_shards(no_docs, 8).count() == 0


def test_ring_moves_little_when_it_grows():
    before, after = sharding.ring(8), sharding.ring(9)
    moved = [c for c in range(sharding.CELLS) if before[c][0] != after[c][0]]
    assert len(moved) < sharding.CELLS // 4


@pytest.fixture(scope="module")
def bags(spark):
    rng = np.random.default_rng(1)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        sentences = [" ".join(rng.choice(plain, 8)) for _ in range(rng.integers(1, 12))]
        y = int(rng.random() < 0.3)
        if y:
            sentences[rng.integers(len(sentences))] += " " + ("vilething" if i % 2 else "vileperson")
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, y))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_toxicity_finds_documents_and_sentences(bags):
    docs, labels = bags
    weights, bias = toxicity.train_model(docs, labels.where("doc_id < 600"), steps=20)
    rows = toxicity.score_documents(docs, weights, bias).join(labels, "doc_id").where("doc_id >= 600").collect()
    assert np.mean([(r["score"] >= 0.7) == (r["toxic"] == 1) for r in rows]) > 0.97
    for r in rows:
        if r["toxic"] == 1 and r["score"] >= 0.7:
            assert any("vile" in r["text"][s["start"]:s["end"]] for s in r["offending"])


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs, bags):
    weights, bias = {"idiot": 9.0}, -6.0
    rows = toxicity.score_documents(odd_docs, weights, bias).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["score"] == 0 for r in rows if not r["text"] or not any(c.isalnum() for c in r["text"]))
    assert all(r["score"] > 0.9 for r in rows if r["doc_id"] == 10)
    labels = spark.createDataFrame([(3, None), (None, 1)], "doc_id long, toxic int")
    weights, bias = toxicity.train_model(odd_docs, labels)
    assert weights == {} and bias < -5
    assert toxicity.train_model(no_docs, labels)[0] == {}
    assert toxicity.score_documents(no_docs, weights, bias).count() == 0


def test_languages(spark, odd_docs, no_docs):
    words = {"aa": ["the", "and", "thing", "other", "with"], "bb": ["der", "und", "schon", "nicht", "ich"]}
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(words[x], 40)), x) for i, x in enumerate(["aa", "bb"] * 40)]
    train = spark.createDataFrame(rows, "id long, text string, lang string")
    profiles = langid.learn_profiles(train.select("id", "text"), train.select("id", "lang"), per_language=20)
    got = langid.identify(train, profiles).collect()
    assert all(r["lang_pred"] == rows[r["doc_id"]][2] and 0 < r["score"] <= 1 for r in got)
    odd = langid.identify(odd_docs.select(F.col("doc_id").alias("id"), "text"), profiles).collect()
    assert len(odd) == odd_docs.count()
    unknown = [t for t in (r["text"] for r in odd_docs.collect()) if not t or not any(c.isalpha() for c in t)]
    assert sum(r["lang_pred"] == "und" for r in odd) == len(unknown)
    assert langid.identify(no_docs, profiles).count() == 0
    assert {r["lang_pred"] for r in langid.identify(train, {}).collect()} == {"und"}


def test_blocks_count_as_the_whole_text():
    letter, text = langid._letters(), "some words and others " * 300
    whole = langid.gram_counts(text, letter)
    langid.BLOCK, kept = 1000, langid.BLOCK
    try:
        parts = langid.gram_counts(text, letter)
    finally:
        langid.BLOCK = kept
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
