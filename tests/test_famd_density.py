"""FAMD against numpy on the collected table, with many levels, supplementary variables and ellipses; density sanity."""

import math

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from scholarspark.operators import famd, stats

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CAT = ["l_returnflag", "l_linestatus"]


def indicator_matrix(pdf, num, cat):
    cols = [(pdf[c] - pdf[c].mean()) / (pdf[c].std(ddof=0) or 1.0) for c in num]
    for c in cat:
        for level in sorted(pdf[c].astype(str).unique()):
            p = (pdf[c].astype(str) == level).mean()
            cols.append(((pdf[c].astype(str) == level).astype(float) - p) / np.sqrt(p))
    return np.column_stack(cols)


def test_famd_eigenvalues_match_numpy(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select(*NUM, *CAT)
    model = famd.fit_famd(li, NUM, CAT)
    z = indicator_matrix(li.toPandas().dropna(), NUM, CAT)
    expect = np.sort(np.linalg.eigvalsh(z.T @ z / len(z)))[::-1]
    assert np.allclose(model.eigenvalues, np.clip(expect, 0, None), atol=1e-8)
    assert abs(model.inertia - expect.sum()) < 1e-9
    contrib = famd.contributions(spark, model, 2).collect()
    for axis in (1, 2):
        assert abs(sum(r.contribution for r in contrib if r.axis == axis) - 100.0) < 1e-6


def frame(spark, n, levels):
    rows = spark.range(n).select(
        "id", F.round(F.rand(1) * 10, 3).alias("x"), (F.rand(2) * 3).alias("y"), F.floor(F.pow(F.rand(3), 3) * levels).cast("string").alias("a"),
        F.floor(F.rand(4) * levels / 2).cast("string").alias("b"), (F.col("id") % 3).alias("c"))
    return rows.withColumn("y", F.col("y") + F.col("c") + F.col("a").cast("int") % 5)


def test_krylov_axes_match_numpy(spark, monkeypatch):
    """Levels enough that the matrix is not formed: leading axes, coordinates and supplementary variables as numpy has them."""
    monkeypatch.setattr(famd, "WHOLE", 20)
    df = frame(spark, 1500, 60).cache()
    model = famd.fit_famd(df, ["x", "y"], ["a", "b", "c"], ncp=4)
    pdf = df.toPandas()
    z = indicator_matrix(pdf, ["x", "y"], ["a", "b", "c"])
    values, vectors = np.linalg.eigh(z.T @ z / len(z))
    assert z.shape[1] > 60 and np.allclose(model.eigenvalues[:4], values[::-1][:4], rtol=1e-7)
    for k in range(4):
        assert abs(abs(model.vectors[:, k] @ vectors[:, -1 - k]) - 1) < 1e-5
    got = {r["id"]: r for r in famd.coordinates(df, model, ["id"], 2).collect()}
    want = z @ model.vectors[:, :2]
    assert len(got) == len(pdf)
    assert all(abs(got[i]["dim1"] - w[0]) < 1e-8 and abs(got[i]["dim2"] - w[1]) < 1e-8 for i, w in zip(pdf["id"], want))
    coords = famd.coordinates(df.withColumn("s", F.col("x") * 2 + F.col("id") % 7), model, ["s", "c"], 2)
    sup = {(r["variable"], r["level"], r["axis"]): r["value"] for r in famd.supplementary(coords, ["s"], ["c"], 2).collect()}
    s = pdf["x"] * 2 + pdf["id"] % 7
    assert abs(sup["s", None, 1] - np.corrcoef(s, want[:, 0])[0, 1]) < 1e-8
    assert all(abs(sup["c", str(c), k + 1] - want[pdf["c"] == c, k].mean()) < 1e-8 for c in range(3) for k in range(2))


def test_gram_cells_make_the_matrix(spark):
    df = frame(spark, 300, 8)
    z = indicator_matrix(df.toPandas(), ["x", "y"], ["a", "c"])
    m = z.T @ z / len(z)
    pdf = df.toPandas()
    names = [("x", None), ("y", None), *[("a", lv) for lv in sorted(pdf["a"].unique())], *[("c", lv) for lv in "012"]]
    for r in famd.gram_cells(df, ["x", "y"], ["a", "c"]).collect():
        i, j = names.index((r["var1"], r["level1"])), names.index((r["var2"], r["level2"]))
        assert abs(m[i, j] - r["value"]) < 1e-9


def test_twenty_thousand_levels(spark):
    rows = spark.range(60_000).select((F.col("id") % 7 + F.rand(5)).alias("x"), F.concat(F.lit("l"), F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("a"),
                                      (F.col("id") % 7).cast("string").alias("b"))
    model = famd.fit_famd(rows, ["x"], ["a", "b"], ncp=3)
    assert len(model.levels) > 18_000 and model.vectors.shape[0] == 1 + len(model.levels)
    v = model.vectors[:, :3]
    assert np.allclose(v.T @ v, np.eye(3), atol=1e-8) and model.eigenvalues[0] >= model.eigenvalues[1] > 1


def test_no_categorical_or_no_numeric(spark):
    df = frame(spark, 200, 6)
    z = indicator_matrix(df.toPandas(), ["x", "y"], [])
    assert np.allclose(famd.fit_famd(df, ["x", "y"], []).eigenvalues, np.sort(np.linalg.eigvalsh(z.T @ z / len(z)))[::-1])
    z = indicator_matrix(df.toPandas(), [], ["a", "c"])
    values = famd.fit_famd(df, [], ["a", "c"]).eigenvalues
    assert np.allclose(values, np.clip(np.sort(np.linalg.eigvalsh(z.T @ z / len(z)))[::-1], 0, None), atol=1e-9)


def test_ellipses(spark):
    rng = np.random.default_rng(4)
    pts = rng.multivariate_normal([1, 2], [[3, 1.2], [1.2, 2]], 400)
    rows = [("g", float(a), float(b)) for a, b in pts] + [("one", 1.0, 1.0), (None, 1.0, 1.0), ("g", None, 1.0)]
    got = {r["level"]: r for r in famd.confidence_ellipses(spark.createDataFrame(rows, "g string, dim1 double, dim2 double"), ["g"]).collect()}
    cov = np.cov(pts.T)
    values, vectors = np.linalg.eigh(cov)
    r = got["g"]
    assert set(got) == {"g", "one"} and r["n"] == 400 and got["one"]["axis_major"] is None
    assert np.allclose([r["axis_minor"], r["axis_major"]], np.sqrt(values / 400) * math.sqrt(-2 * math.log(0.05)))
    assert abs(abs(math.cos(r["angle"]) * vectors[0, 1] + math.sin(r["angle"]) * vectors[1, 1]) - 1) < 1e-9


def test_density_integrates_to_about_one(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    d = stats.density_grid(ev, "value").orderBy("grid_index").collect()
    xs = np.array([r.x for r in d])
    ys = np.array([r.density for r in d])
    area = float(np.sum((ys[1:] + ys[:-1]) / 2 * np.diff(xs)))
    assert len(d) == 512 and 0.97 < area < 1.01
