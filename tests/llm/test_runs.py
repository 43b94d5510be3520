"""Periodic runs against a brute-force search, the query against plain Python, odd tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from odd_tables import no_docs, odd_docs  # noqa: F401

from scholarspark.llm import runs
from scholarspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(x):
    """Every stretch of smallest period q, at least max(6, 4q) long, that no neighbour extends."""
    n, out = len(x), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            b = i + q
            if b - a >= max(6, 4 * q) and not any(x[a:b - p] == x[a + p:b] for p in range(1, q)):
                out.append((a, b - a, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def make(rnd):
    x = [rnd.randrange(rnd.choice([1, 2, 3, 50])) for _ in range(rnd.randrange(60))]
    for _ in range(rnd.randrange(4)):
        root = [rnd.randrange(rnd.choice([2, 3, 9])) for _ in range(rnd.randint(1, 70))]
        if rnd.random() < 0.3:
            root = root[:3] * 4 + [5] + root                      # periodic inside the period
        x += root * rnd.randint(1, 9) + root[:rnd.randrange(len(root))] + [rnd.randrange(9) for _ in range(rnd.randrange(5))]
    return x


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rnd, n = random.Random(seed), 0
    for _ in range(40):
        texts = [make(rnd) for _ in range(rnd.randint(1, 5))]
        want = [brute(t) for t in texts]
        assert runs.Finder([np.array(t, np.int64) for t in texts]).runs() == want
        n += sum(map(len, want))
    assert n > 100


def test_long_periods_and_nested_roots():
    rnd = random.Random(5)
    for period in (8, 9, 15, 16, 17, 31, 64, 100, 333, 1024):
        root = [rnd.randrange(10_000) for _ in range(period)]
        x = [20_000 + i for i in range(50)] + root * 4 + [20_001] + root * 3 + root[:-1] + [1]
        assert runs.Finder([np.array(x, np.int64)]).runs() == [[(50, 4 * period, period)]]
    fib, prev = [0], [0, 1]
    while len(prev) < 1500:
        fib, prev = prev, prev + fib
    assert runs.Finder([np.array(prev * 5, np.int64)]).runs()[0] == brute(prev * 5)


def test_query_equals_plain_python(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    for k, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        h, n = zlib.crc32(str(k).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute(words) if n < 4000 else [tuple(r) for r in runs.Finder([np.unique(words, return_inverse=True)[1]]).runs()[0]]
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        drop = {i for s, m, q in found for i in range(s + q, s + m)}
        r = got[k]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *best)
        assert r["exponent_milli"] == (best[0] is not None and 1000 * best[1] // best[2] or None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        kept = " ".join(w for i, w in enumerate(words) if i not in drop)
        assert (r["runs_sha256"], r["collapsed_sha256"]) == tuple(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))


def test_odd_tables(spark, odd_docs, no_docs):
    out = runs.find_runs(odd_docs.withColumn("runs", odd_docs["kept"])).collect()
    assert len(out) == odd_docs.count() and "kept" in out[0].asDict()
    assert all(r["collapsed"] == "" and r["runs"] == [] for r in out if r["n_words"] == 0)
    long = [r for r in out if r["n_words"] > 3000]
    assert {tuple(x) for r in long for x in r["runs"]} == {(0, 4000, 10)} and {r["collapsed"].count(" ") for r in long} == {9, 10}
    assert runs.find_runs(no_docs).count() == 0


def test_numbers_of_words_differ(spark):
    """Texts of a batch share the numbering of words; new words after repeated ones get numbers of their own."""
    df = spark.createDataFrame([(1, "a a a b"), (2, "b c b c b d"), (3, "x x x x x x")], "doc_id int, text string").coalesce(1)
    assert {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in runs.find_runs(df).collect()} == {1: [], 2: [], 3: [(0, 6, 1)]}
