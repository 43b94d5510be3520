"""Factor analysis of mixed data (FAMD) with Spark doing the data passes.

Numeric columns are standardised (population sd), each categorical level becomes an indicator column
``(1{x = level} - p) / sqrt(p)``. The matrix to decompose, Z'Z / n, is never formed. What Spark makes of the rows
are the numbers' covariances, their sums by level and the cells of the pairwise cross-tables; the cells stay in
Spark, and a product of the matrix with some vectors is a job over them, in which each task answers for the levels
it holds. The driver has what grows with the number of levels alone (counts, sums and vectors; at most
``MOST_LEVELS``) and finds the first axes in a block Krylov space with full reorthogonalisation.

Supplementary variables take no part in the axes: numeric ones are correlated with them, categorical ones have the mean
coordinates of their levels.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations, combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarspark.session import reliable_checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Levels of all categorical columns together; the driver holds some 200 numbers for each.
MOST_LEVELS = 200_000
#: Up to so many columns and levels all axes come from the matrix itself, by one product with the identity.
WHOLE = 300


@dataclass
class FamdModel:
    numeric: list[str]
    means: np.ndarray
    sds: np.ndarray
    levels: list[tuple[str, str]]                # (variable, level), codes from 0
    props: np.ndarray
    eigenvalues: np.ndarray
    vectors: np.ndarray                          # rows: numeric columns, then levels; columns: axes
    inertia: float                               # sum of all eigenvalues

    @property
    def variables(self) -> list[str]:
        return [*self.numeric, *dict.fromkeys(v for v, _ in self.levels)]


def _stacked(rows: DataFrame, categorical: list[str], *others: Column) -> DataFrame:
    """A row for each categorical column of each row: (var, level, *others)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("var"), F.col(c).cast("string").alias("level")) for c in categorical])
    return rows.select(*others, F.inline(pairs))


def gram_cells(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(var1, level1, var2, level2, value): the entries of Z'Z / n that data decide, each pair once: numeric with numeric,
    numeric with level, and levels that occur together. (Other pairs of levels of two variables have -sqrt(p q).)"""
    rows = df.select(*numeric, *categorical).dropna()
    stats = rows.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{k}_{c}") for c in numeric for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    z = {c: (F.col(c) - stats[f"m_{c}"]) / (stats[f"s_{c}"] or 1.0) for c in numeric}
    n = stats["n"]
    pairs = list(combinations_with_replacement(numeric, 2))
    null = F.lit(None).cast("string")
    sums = rows.agg(*[F.avg(z[a] * z[b]).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    out = sums.select(F.inline(F.array(*[F.struct(F.lit(a).alias("var1"), null.alias("level1"), F.lit(b).alias("var2"), null.alias("level2"),
                                                  F.col(f"p{i}").alias("value")) for i, (a, b) in enumerate(pairs)])))
    if not categorical:
        return out
    by_level = _stacked(rows, categorical, *[z[c].alias(c) for c in numeric]).groupBy("var", "level").agg(
        (F.count(F.lit(1)) / n).alias("p"), *[(F.sum(c) / n).alias(c) for c in numeric])
    by_level = reliable_checkpoint(by_level, "famd-levels")
    if numeric:
        out = out.union(by_level.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("var1"), null.alias("level1"), F.col("var").alias("var2"), F.col("level").alias("level2"),
                     (F.col(c) / F.sqrt("p")).alias("value")) for c in numeric]))))
    out = out.union(by_level.select("var", "level", F.col("var").alias("var2"), F.col("level").alias("level2"), (1 - F.col("p")).alias("value")))
    if len(categorical) > 1:
        cells = _crossed(rows, categorical)
        p1, p2 = (by_level.select(F.col("var").alias(f"var{i}"), F.col("level").alias(f"level{i}"), F.col("p").alias(f"p{i}")) for i in (1, 2))
        joined = cells.join(p1, ["var1", "level1"]).join(p2, ["var2", "level2"])
        root = F.sqrt(F.col("p1") * F.col("p2"))
        out = out.union(joined.select("var1", "level1", "var2", "level2", F.col("n") / n / root - root))
    return out


def _crossed(rows: DataFrame, categorical: list[str]) -> DataFrame:
    """(var1, level1, var2, level2, n): cells of the pairwise cross-tables that are not empty."""
    cells = [F.struct(F.lit(a).alias("var1"), F.col(a).cast("string").alias("level1"), F.lit(b).alias("var2"),
                      F.col(b).cast("string").alias("level2")) for a, b in combinations(categorical, 2)]
    return rows.select(F.inline(F.array(*cells))).groupBy("var1", "level1", "var2", "level2").agg(F.count(F.lit(1)).alias("n"))


def _cell_product(cells: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """Product of the symmetric matrix of the cells (i, j, value) with vectors, a job; each task sends the rows it has."""
    def product(v: np.ndarray) -> np.ndarray:
        shared = cells.sparkSession.sparkContext.broadcast(v)           # one number a level and vector

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                i, j, x = (batch.column(k).to_numpy() for k in range(3))
                owners, at = np.unique(i, return_inverse=True)
                out = np.zeros((len(owners), shared.value.shape[1]))
                np.add.at(out, at, x[:, None] * shared.value[j])
                yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array(list(out), pa.list_(pa.float64()))], ["i", "w"])

        out = np.zeros(v.shape)
        for row in cells.mapInArrow(run, "i int, w array<double>").toLocalIterator():
            out[row["i"]] += row["w"]
        shared.unpersist()
        return out

    return product


def _leading(product: Callable[[np.ndarray], np.ndarray], size: int, count: int, steps: int = 30, tolerance: float = 1e-10) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues and their vectors: the matrix itself if it is small, else a block Krylov space, widened until the
    eigenvalues stand still."""
    if size <= WHOLE:
        values, vectors = np.linalg.eigh(product(np.eye(size)))
        return values[::-1], vectors[:, ::-1]
    width = min(size, count + 5)
    block = np.linalg.qr(np.random.default_rng(3).standard_normal((size, width)))[0]
    basis, images, before = block, np.zeros((size, 0)), None
    for _ in range(steps):
        image = product(block)
        images = np.hstack([images, image])
        values, turn = np.linalg.eigh(basis.T @ images)
        values, turn = values[::-1][:count], turn[:, ::-1][:, :count]
        if before is not None and np.all(np.abs(values - before) <= tolerance * np.maximum(1.0, values)):
            break
        before = values
        for _ in range(2):                                        # twice is enough
            image = image - basis @ (basis.T @ image)
        block, rest = np.linalg.qr(image)
        block = block[:, np.abs(np.diag(rest)) > 1e-12 * max(1.0, float(np.abs(rest).max()))]
        if not block.shape[1] or basis.shape[1] + block.shape[1] > size:
            break
        basis = np.hstack([basis, block])
    return values, basis[:, :turn.shape[0]] @ turn


def fit_famd(df: DataFrame, numeric: list[str], categorical: list[str], ncp: int = 5) -> FamdModel:
    """Fit FAMD on complete rows; at least the first ``ncp`` axes."""
    rows = df.select(*numeric, *categorical).dropna()
    mom = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{c}") for c in numeric],
                   *[F.stddev_pop(c).alias(f"s_{c}") for c in numeric]).first()
    n = mom["n"]
    means = np.array([float(mom[f"m_{c}"]) for c in numeric])
    sds = np.array([float(mom[f"s_{c}"]) or 1.0 for c in numeric])
    z = {c: (F.col(c) - float(m)) / float(s) for c, m, s in zip(numeric, means, sds)}
    q = len(numeric)
    c = np.zeros((q, q))
    if q:
        pairs = list(combinations_with_replacement(range(q), 2))
        products = rows.agg(*[F.avg(z[numeric[a]] * z[numeric[b]]).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]).first()
        for i, (a, b) in enumerate(pairs):
            c[a, b] = c[b, a] = products[f"p{i}"]
    levels, props, b, cross = [], np.zeros(0), np.zeros((q, 0)), None
    if categorical:
        table = reliable_checkpoint(_stacked(rows, categorical, *[z[x].alias(x) for x in numeric]).groupBy("var", "level").agg(
            F.count(F.lit(1)).alias("c"), *[F.sum(x).alias(f"z_{x}") for x in numeric]), "famd-levels")
        p = table.count()
        if p > MOST_LEVELS:
            raise ValueError(f"{p} levels; at most {MOST_LEVELS}")
        found = sorted(table.collect(), key=lambda r: (categorical.index(r["var"]), r["level"]))
        levels = [(r["var"], r["level"]) for r in found]
        props = np.array([r["c"] / n for r in found])
        b = np.array([[r[f"z_{x}"] for r in found] for x in numeric]).reshape(q, p) / n / np.sqrt(props)
        if len(categorical) > 1:
            spark = df.sparkSession
            codes = spark.createDataFrame([(v, lv, i, float(x)) for i, ((v, lv), x) in enumerate(zip(levels, props))], "v string, l string, code int, p double")
            one, two = (codes.select(F.col("v").alias(f"var{k}"), F.col("l").alias(f"level{k}"), F.col("code").alias(f"c{k}"), F.col("p").alias(f"p{k}")) for k in (1, 2))
            cells = _crossed(rows, categorical).join(one, ["var1", "level1"]).join(two, ["var2", "level2"])
            value = (F.col("n") / n / F.sqrt(F.col("p1") * F.col("p2"))).alias("value")
            both = cells.select(F.col("c1").alias("i"), F.col("c2").alias("j"), value).union(cells.select("c2", "c1", value))
            cross = _cell_product(reliable_checkpoint(both.repartitionByRange("i", "j"), "famd-cells"))
    r = np.sqrt(props)

    def product(v: np.ndarray) -> np.ndarray:
        num, lev = v[:q], v[q:]
        own = b.T @ num + lev - np.outer(r, r @ lev)
        return np.vstack([c @ num + b @ lev, own + cross(lev) if cross else own])

    values, vectors = _leading(product, q + len(levels), ncp)
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    inertia = float(np.trace(c) + np.sum(1.0 - props))
    return FamdModel(numeric, means, sds, levels, props, np.clip(values, 0.0, None), vectors, inertia)


def eigen_table(spark: SparkSession, model: FamdModel, ncp: int = 5) -> DataFrame:
    ev = model.eigenvalues
    rows = [(i + 1, float(ev[i]), float(100 * ev[i] / model.inertia), float(100 * ev[: i + 1].sum() / model.inertia))
            for i in range(min(ncp, len(ev)))]
    return spark.createDataFrame(rows, "component bigint, eigenvalue double, pct_variance double, cum_pct double")


def contributions(spark: SparkSession, model: FamdModel, axes: int = 3) -> DataFrame:
    """Contribution (percent) of each variable to each axis."""
    names = np.array([*model.numeric, *(v for v, _ in model.levels)])
    rows = [(v, a + 1, float(100 * np.sum(model.vectors[names == v, a] ** 2)))
            for v in model.variables for a in range(min(axes, model.vectors.shape[1]))]
    return spark.createDataFrame(rows, "variable string, axis bigint, contribution double")


def coordinates(df: DataFrame, model: FamdModel, keep: list[str], ncp: int = 2) -> DataFrame:
    """``keep`` and the coordinates dim1.. of complete rows. A level's part is joined from a table of one row a level, which
    adaptive execution broadcasts while it is small."""
    spark, q = df.sparkSession, len(model.numeric)
    k = min(ncp, model.vectors.shape[1])
    variables = [v for v in model.variables if v not in model.numeric]
    rows = df.dropna(subset=model.variables).select(F.struct(*keep).alias("kept"), *[F.col(x).alias(f"n{i}") for i, x in enumerate(model.numeric)],
                                                    *[F.col(x).cast("string").alias(f"v{i}") for i, x in enumerate(variables)])
    weights = model.vectors[q:, :k] / np.sqrt(model.props)[:, None]
    for i, v in enumerate(variables):
        own = [(lv, [float(x) for x in w]) for (var, lv), w in zip(model.levels, weights) if var == v]
        rows = rows.join(spark.createDataFrame(own, f"v{i} string, w{i} array<double>"), f"v{i}")
    const = -(np.sqrt(model.props) @ model.vectors[q:, :k]) if len(model.levels) else np.zeros(k)
    dims = []
    for a in range(k):
        parts = [(F.col(f"n{j}") - float(model.means[j])) / float(model.sds[j]) * float(model.vectors[j, a]) for j in range(q)]
        parts += [F.get(f"w{i}", a) for i in range(len(variables))]
        dims.append(sum(parts, F.lit(float(const[a]))).alias(f"dim{a + 1}"))
    return rows.select("kept.*", *dims)


def supplementary(coords: DataFrame, numeric: list[str], categorical: list[str], ncp: int = 2) -> DataFrame:
    """(variable, level, axis, value): correlation of a numeric variable with each axis (level null), mean coordinate of each
    level of a categorical one. Variables must be among the columns kept in ``coords``."""
    dims = [f"dim{a + 1}" for a in range(ncp)]
    out = None
    if numeric:
        row = coords.agg(*[F.corr(x, d).alias(f"{x}_{d}") for x in numeric for d in dims])
        out = row.select(F.inline(F.array(*[F.struct(F.lit(x).alias("variable"), F.lit(None).cast("string").alias("level"),
                                                     F.lit(a + 1).alias("axis"), F.col(f"{x}_{d}").alias("value"))
                                            for x in numeric for a, d in enumerate(dims)])))
    if categorical:
        means = _stacked(coords, categorical, *dims).where("level IS NOT NULL").groupBy("var", "level").agg(*[F.avg(d).alias(d) for d in dims])
        long = means.select(F.inline(F.array(*[F.struct(F.col("var").alias("variable"), F.col("level"), F.lit(a + 1).alias("axis"),
                                                        F.col(d).alias("value")) for a, d in enumerate(dims)])))
        out = long if out is None else out.union(long)
    return out


def confidence_ellipses(coords: DataFrame, groups: list[str], x: str = "dim1", y: str = "dim2", level: float = 0.95) -> DataFrame:
    """(variable, level, n, mean_x, mean_y, var_x, var_y, cov_xy, axis_major, axis_minor, angle): for each level of each grouping
    column the mean and the ellipse that holds the true mean with probability ``level``.

    The half axes are sqrt(eigenvalue / n) times the radius of a bivariate normal distribution, sqrt(-2 ln(1 - level)); the
    eigenvalues and the angle of the major axis (radians) of the 2 x 2 covariance in closed form. Groups of one row have
    no covariance and null axes; rows without a coordinate or level are left out.
    """
    ok = coords.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    g = _stacked(ok, groups, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where("level IS NOT NULL")
    g = g.groupBy(F.col("var").alias("variable"), "level").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean_x"), F.avg("y").alias("mean_y"), F.var_samp("x").alias("var_x"),
        F.var_samp("y").alias("var_y"), F.covar_samp("x", "y").alias("cov_xy"))
    half, apart = (F.col("var_x") + F.col("var_y")) / 2, (F.col("var_x") - F.col("var_y")) / 2
    reach = F.sqrt(apart * apart + F.col("cov_xy") * F.col("cov_xy"))
    radius = math.sqrt(-2.0 * math.log(1.0 - level))

    def axis(value: Column) -> Column:
        return F.sqrt(F.when(value < 0, 0.0).otherwise(value) / F.col("n")) * radius

    return g.select("*", axis(half + reach).alias("axis_major"), axis(half - reach).alias("axis_minor"),
                    (F.atan2(F.col("cov_xy"), apart) / 2).alias("angle"))
