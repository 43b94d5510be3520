"""Prefix sums, exact quantiles, mid-ranks, AUC and the test statistics against brute force."""

import math
import random

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import SF01
from scholarspark.functions.distributions import chi2_sf, f_sf, t_two_sided
from scholarspark.operators import stats
from scholarspark.operators.evaluate import auc, roc_points
from scholarspark.operators.ranks import exact_quantiles, prefix_sums


def test_prefix_sums_match_cumsum(spark):
    rnd = random.Random(7)
    rows = [(g, float(v), rnd.randint(1, 5)) for g in ("a", "b", "c") for v in rnd.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    got = {(r.g, r.v): r.w_before for r in prefix_sums(df, ["v"], ["w"], ["g"], num_partitions=7).collect()}
    for g in ("a", "b", "c"):
        acc = 0
        for _, v, w in sorted(x for x in rows if x[0] == g):
            assert got[(g, v)] == acc
            acc += w


def test_exact_quantiles_equal_numpy_linear(spark):
    rnd = random.Random(3)
    vals = [round(rnd.gauss(0, 10), 1) for _ in range(1001)]   # many ties
    df = spark.createDataFrame([(("hot" if i % 3 else "x"), v) for i, v in enumerate(vals)], "g string, v double")
    q = {r.g: r for r in exact_quantiles(df, "v", [0.25, 0.5, 0.75], ["g"]).collect()}
    for g in ("hot", "x"):
        arr = np.array([v for i, v in enumerate(vals) if ("hot" if i % 3 else "x") == g])
        exp = np.quantile(arr, [0.25, 0.5, 0.75])
        assert math.isclose(q[g].q_0_25, exp[0], abs_tol=1e-9)
        assert math.isclose(q[g].q_0_5, exp[1], abs_tol=1e-9)
        assert math.isclose(q[g].q_0_75, exp[2], abs_tol=1e-9)


def test_auc_equals_spark_evaluator_and_pair_count(spark):
    rnd = random.Random(11)
    rows = [(float(rnd.random() < 0.4), float(rnd.randint(0, 20)) / 20) for _ in range(400)]
    df = spark.createDataFrame(rows, "label double, score double")
    ours = auc(df).first()["auc"]
    pos = [s for lab, s in rows if lab == 1]
    neg = [s for lab, s in rows if lab == 0]
    pairs = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert math.isclose(ours, pairs, abs_tol=1e-12)
    vec = spark.createDataFrame([(lab, Vectors.dense([1 - s, s])) for lab, s in rows], ["label", "rawPrediction"])
    spark_auc = BinaryClassificationEvaluator(numBins=0).evaluate(vec)
    assert math.isclose(ours, spark_auc, abs_tol=1e-9)


def test_roc_points_end_at_one(spark):
    rows = [(1.0, 0.9), (0.0, 0.8), (1.0, 0.8), (0.0, 0.1)]
    df = spark.createDataFrame(rows, "label double, score double")
    pts = sorted((r.score, r.tpr, r.fpr) for r in roc_points(df).collect())
    assert pts == [(0.1, 1.0, 1.0), (0.8, 1.0, 0.5), (0.9, 0.5, 0.0)]


def test_chi2_2x2_yates_and_plain(spark):
    cells = [("a", "x", 10), ("a", "y", 20), ("b", "x", 25), ("b", "y", 15)]
    df = spark.createDataFrame([(r, c) for r, c, n in cells for _ in range(n)], "r string, c string")
    plain = stats.chi2_pairs(df, ["r", "c"], yates=False).first()
    assert math.isclose(plain.chi2, 5.833333333, rel_tol=1e-8)
    corrected = stats.chi2_pairs(df, ["r", "c"]).first()
    # by hand: expected 15, 15, 20, 20; |o - e| = 5 everywhere -> (5 - 0.5)^2 * (2/15 + 2/20) = 4.725
    assert math.isclose(corrected.chi2, 4.725, rel_tol=1e-9) and corrected.yates


def test_kruskal_against_brute_force(spark):
    rnd = random.Random(5)
    rows = [(g, float(rnd.randint(0, 30))) for g in ("a", "b", "c") for _ in range(60 + 10 * ord(g) % 7)]
    df = spark.createDataFrame(rows, "g string, v double")
    h = stats.kruskal(df, "v", "g").first()
    vals = sorted(v for _, v in rows)
    rank = {}
    i = 0
    while i < len(vals):
        j = i
        while j < len(vals) and vals[j] == vals[i]:
            j += 1
        rank[vals[i]] = (i + 1 + j) / 2.0
        i = j
    n = len(rows)
    rs = {g: sum(rank[v] for gg, v in rows if gg == g) for g in ("a", "b", "c")}
    ns = {g: sum(1 for gg, _ in rows if gg == g) for g in ("a", "b", "c")}
    hh = 12 / (n * (n + 1)) * sum(rs[g] ** 2 / ns[g] for g in rs) - 3 * (n + 1)
    ties = sum(t ** 3 - t for t in (vals.count(v) for v in set(vals)))
    assert math.isclose(h.h_stat, hh / (1 - ties / (n ** 3 - n)), rel_tol=1e-9)


def test_pvalues_known_points():
    assert math.isclose(chi2_sf(3.841458820694124, 1), 0.05, rel_tol=1e-9)
    assert math.isclose(t_two_sided(2.228138851986274, 10), 0.05, rel_tol=1e-9)
    assert math.isclose(f_sf(4.102821015130402, 2, 10), 0.05, rel_tol=1e-7)


def test_box_stats_hot_group(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    hot = ev.withColumn("event_type", F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("event_type")))
    b = {r.event_type: r for r in stats.box_stats(hot, "value", "event_type").collect()}
    arr = np.array([r.value for r in hot.where("event_type = 'hot'").select("value").collect()])
    assert math.isclose(b["hot"].median, float(np.quantile(arr, 0.5)), abs_tol=1e-9)
    assert b["hot"].n == len(arr)


def test_holm_adjustment_skips_missing_pvalues(spark):
    from scholarspark.plans.stats import holm
    df = spark.createDataFrame([("f", "a", 0.01), ("f", "b", 0.04), ("f", "c", 0.03), ("f", "d", None)],
                               "family string, test string, p_value double")
    got = {r.test: r.p_holm for r in holm(df).collect()}
    # m = 3: 0.01*3 = 0.03; 0.03*2 = 0.06; max(0.06, 0.04*1) = 0.06
    assert got["d"] is None
    assert abs(got["a"] - 0.03) < 1e-12 and abs(got["c"] - 0.06) < 1e-12 and abs(got["b"] - 0.06) < 1e-12


def test_approximate_box_stats_close_to_exact(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    exact = {r.event_type: r for r in stats.box_stats(ev, "value", "event_type").collect()}
    approx = {r.event_type: r for r in stats.box_stats(ev, "value", "event_type", approx=True).collect()}
    for g, e in exact.items():
        a = approx[g]
        assert a.n == e.n and a.min == e.min and a.max == e.max
        vals = sorted(r.value for r in ev.where(F.col("event_type") == g).select("value").collect())
        for q, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")):
            # the sketch returns an observed value within ~1/accuracy of the target rank
            rank = sum(1 for v in vals if v <= getattr(a, name)) / len(vals)
            assert abs(rank - q) < 0.01


def test_null_groups_are_kept(spark):
    from scholarspark.operators import stats
    from scholarspark.operators.profile import within_shares
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0), (None, 5.0), (None, 7.0)], "g string, v double")
    for approx in (False, True):
        rows = {r["g"]: r for r in stats.box_stats(df, "v", "g", approx=approx).collect()}
        assert set(rows) == {"a", None} and rows[None]["n"] == 3 and rows[None]["median"] == 5.0
    shares = within_shares(df.selectExpr("g", "cast(v > 2 as string) as w"), "g", "w").collect()
    assert {(r["g"], r["pct_within"]) for r in shares} == {("a", 100.0), (None, 100.0)}


def test_tail_probabilities_for_large_parameters():
    from scholarspark.functions.distributions import chi2_sf, f_sf, t_two_sided
    assert abs(chi2_sf(1e8, 1e8) - 0.5) < 1e-4 and abs(chi2_sf(3.841458820694124, 1) - 0.05) < 1e-12
    assert abs(t_two_sided(2.0, 10) - 0.07338803477074045) < 1e-12 and abs(f_sf(1.0, 1e6, 1e6) - 0.5) < 1e-6
