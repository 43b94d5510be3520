"""Sketch profiles against exact ones within their error bounds, over one or many batches; harvests with every defect."""

import math

from pyspark.sql import functions as F

from conftest import SF01
from scholarspark.operators import sketches, stats
from scholarspark.session import shared_path
from scholarspark.sources.pages import harvest_completeness, harvest_gaps

COLS = ["l_quantity", "l_extendedprice", "l_orderkey"]


def test_sketches_merge_to_the_exact_profile(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select(*COLS)
    exact = {r["column"]: r for r in stats.profile(li, COLS).collect()}
    ranked = {c: sorted(r[0] for r in li.select(F.col(c).cast("double")).collect()) for c in COLS}
    for parts in (1, 5):
        path = shared_path(spark, "sketch-test")
        for k in range(parts):
            table = sketches.append_sketches(li.where(F.col("l_orderkey") % parts == k), COLS, path)
        assert table.count() == parts * len(COLS)
        for r in sketches.merged_moments(table).collect():
            e = exact[r["column"]]
            for f in ("n_rows", "n_null", "min", "max"):
                assert r[f] == e[f]
            for f in ("mean", "stddev", "skewness", "kurtosis"):
                assert math.isclose(r[f], e[f], rel_tol=1e-7, abs_tol=1e-9), (r["column"], f)
        for r in sketches.merged_estimates(table).collect():
            values, n = ranked[r["column"]], exact[r["column"]]["n_rows"]
            assert abs(r["n_distinct"] / exact[r["column"]]["n_distinct"] - 1) < 4 * 1.04 / math.sqrt(2 ** sketches.LOG_K)
            for q in (0.25, 0.5, 0.75):
                v = r[f"q_{q:g}".replace(".", "_")]
                low, high = sum(x < v for x in values) / n, sum(x <= v for x in values) / n
                assert low - 0.012 <= q <= high + 0.012


def test_sketches_are_one_aggregate(spark):
    plan = sketches.sketch_columns(spark.read.parquet(f"{SF01}/lineitem.parquet"), COLS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan and plan.split("Generate")[-1].count("partial_count") and "Expand" not in plan


def test_sketches_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, None, 5.0)] * 3 + [(None, None, 5.0)], "a double, b double, c double")
    table = sketches.sketch_columns(df, ["a", "b", "c"]).unionAll(sketches.sketch_columns(df.limit(0), ["a", "b", "c"]))
    rows = {r["column"]: r for r in sketches.merged_moments(table).collect()}
    assert (rows["a"]["n_null"], rows["a"]["mean"], rows["a"]["stddev"]) == (1, 1.0, 0.0) and rows["c"]["n_rows"] == 4
    assert (rows["b"]["n_null"], rows["b"]["mean"], rows["b"]["min"], rows["b"]["stddev"]) == (4, None, None, None)
    assert rows["c"]["skewness"] is None and rows["c"]["kurtosis"] is None
    est = {r["column"]: r for r in sketches.merged_estimates(table).collect()}
    assert est["a"]["n_distinct"] == 1 and est["c"]["q_0_5"] == 5.0 and est["b"]["n_distinct"] is None


def test_harvest_defects(spark):
    rows = [("whole", 0, 100, 230), ("whole", 100, 100, 230), ("whole", 200, 30, 230),
            ("gap", 0, 100, 300), ("gap", 200, 100, 300), ("tail", 0, 100, 150), ("head", 100, 100, 200),
            ("twice", 0, 100, 100), ("twice", 0, 100, 100), ("overlap", 0, 100, 150), ("overlap", 70, 80, 150),
            ("inside", 0, 100, 120), ("inside", 20, 10, 120), ("inside", 100, 20, 120),
            ("empty", 0, 0, 0), ("nothing", None, None, 40), (None, 0, 10, 20)]
    pages = spark.createDataFrame(rows, "server string, cursor long, loaded int, total int").withColumn("interval", F.lit("2020"))
    got = {r["server"]: tuple(r)[2:] for r in harvest_completeness(pages, ["server", "interval"]).collect()}
    #                      total pages again overlap gaps missing complete
    assert got["whole"] == (230, 3, 0, 0, 0, 0, True)
    assert got["gap"] == (300, 2, 0, 0, 1, 100, False)
    assert got["tail"] == (150, 1, 0, 0, 1, 50, False)
    assert got["head"] == (200, 1, 0, 0, 1, 100, False)
    assert got["twice"] == (100, 2, 1, 0, 0, 0, True)
    assert got["overlap"] == (150, 2, 0, 30, 0, 0, True)
    assert got["inside"] == (120, 3, 0, 10, 0, 0, True)
    assert got["empty"] == (0, 1, 0, 0, 0, 0, True)
    assert got["nothing"] == (40, 0, 0, 0, 1, 40, False)
    assert got[None] == (20, 1, 0, 0, 1, 10, False)
    gaps = {(r["server"], r["missing_from"], r["missing_to"]) for r in harvest_gaps(pages, ["server", "interval"]).collect()}
    assert gaps == {("gap", 100, 200), ("tail", 100, 150), ("head", 0, 100), ("nothing", 0, 40), (None, 10, 20)}
    assert harvest_completeness(pages.limit(0), ["server", "interval"]).count() == 0
