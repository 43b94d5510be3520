"""The double-array trie against a dict, collocations against SQL with every bound narrowed, odd tables."""

import duckdb
import numpy as np
import pytest
from odd_tables import no_docs, odd_docs  # noqa: F401

from scholarspark.llm import collocations
from scholarspark.llm.double_array import DoubleArray

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("seed,words,phrases", [(1, 5, 12), (2, 3000, 20_000), (3, 400_000, 30_000), (4, 1, 1)])
def test_trie_equals_dict(seed, words, phrases):
    rng = np.random.default_rng(seed)
    trie = DoubleArray(words)
    heads = list(range(1, words + 1))
    for _ in range(2):                                            # two and three words
        zipf = np.minimum(rng.zipf(1.3, phrases), words).astype(np.int32)
        pairs = np.unique(np.stack([np.array(heads, np.int32)[np.minimum(rng.zipf(1.3, phrases) - 1, len(heads) - 1)], zipf]), axis=1)
        states = trie.add(pairs[0], pairs[1])
        kept = {(int(h), int(c)): int(s) for h, c, s in zip(*pairs, states)}
        heads = states.tolist()
        assert len(set(heads)) == len(heads) and min(heads) > words
        s, c = rng.choice(pairs[0], 5000), rng.integers(0, words + 1, 5000).astype(np.int32)
        s, c = np.append(s, pairs[0]), np.append(c, pairs[1])
        assert trie.step(s, c).tolist() == [kept.get((int(a), int(b)), 0) for a, b in zip(s, c)]


def oracle(df, tmp_path):
    df.write.mode("overwrite").parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    return sorted(con.sql(collocations.ORACLE).fetchall())


@pytest.mark.parametrize("vocabulary,nodes", [(10**6, 10**6), (100, 10**6), (10**6, 15), (60, 5), (0, 0)])
def test_bounds_change_nothing(spark, tmp_path, vocabulary, nodes):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = collocations.collocations(docs, vocabulary=vocabulary, nodes=nodes)
    want = oracle(docs, tmp_path)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50


def test_pieces_cuts_and_parts(spark, tmp_path):
    rows = [("en", "New  York\tCity. new york city; a b c d")] * 12 + [("en", "new york")] * 30 + [(None, "x y z w\x0bv x y Z")] * 30
    rows += [("fr", "é É. le a\x0cthe " + "w" * 100 + " le")] * 11 + [("en", None), ("en", ""), (None, " .,;\n"), ("de", "one two")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(map(tuple, collocations.collocations(docs).collect()))
    assert got == oracle(docs, tmp_path)
    phrases = {(r[0], r[2]) for r in got}
    assert ("en", "new york city") in phrases and ("en", "new york") in phrases and ("en", "york city") not in phrases
    assert ("und", "x y z") in phrases and ("fr", "le a") in phrases and ("fr", "é É") in phrases and not any("w v" in p for _, p in phrases)


def test_longer_phrases(spark):
    docs = spark.createDataFrame([("en", "a b c d e, a b c d")] * 10, "lang string, text string")
    got = {r["phrase"]: (r["a"], r["l"], r["r"]) for r in collocations.collocations(docs, longest=5, explains=60).collect()}
    assert got == {"a b c d": (20, 20, 20), "a b c d e": (10, 20, 10)}


def test_odd_tables(spark, odd_docs, no_docs, tmp_path):
    docs = odd_docs.selectExpr("*", "CASE WHEN doc_id > 5 THEN 'en' END AS lang", "'x' AS phrase", "'x' AS words")
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == oracle(docs.select("lang", "text"), tmp_path)
    assert collocations.collocations(no_docs.selectExpr("*", "'en' AS lang")).count() == 0
