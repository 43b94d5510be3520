"""SQL oracles for the statistics queries."""

from __future__ import annotations

from itertools import combinations

from scholarspark.plans.oracle import DERIVED, EXPORTED, LATEST, PREPRINTS
from scholarspark.plans.stats import (EXPORT_CATEGORICAL, EXPORT_CORR, EXPORT_NUMERIC, LINE_NUMERICS,
                                      ORDER_CATEGORICALS, SAMPLE_K)


def _pairs_union(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, cast({a} AS varchar) AS a, cast({b} AS varchar) AS b FROM {source}"
        for a, b in combinations(columns, 2))


def _cells(source: str, columns: list[str]) -> str:
    return f"""cells AS (SELECT var1, var2, a, b, count(*) AS o FROM ({_pairs_union(source, columns)})
  WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY ALL),
ra AS (SELECT var1, var2, a, sum(o) AS ra FROM cells GROUP BY ALL),
cb AS (SELECT var1, var2, b, sum(o) AS cb FROM cells GROUP BY ALL),
tot AS (SELECT var1, var2, sum(o) AS n FROM cells GROUP BY ALL),
j AS (SELECT cells.*, ra, cb, tot.n, ra * cb / tot.n::DOUBLE AS e
      FROM cells JOIN ra USING (var1, var2, a) JOIN cb USING (var1, var2, b) JOIN tot USING (var1, var2))"""


def _chi2(source_cte: str, source: str, columns: list[str], prefix: str = "WITH ") -> str:
    return f"""{prefix}{source_cte}{_cells(source, columns)},
st AS (SELECT var1, var2, any_value(n) AS n, sum((o - e) ^ 2 / e) + any_value(n) - sum(e) AS pearson, max(abs(o - e)) AS dev
       FROM j GROUP BY ALL),
rs AS (SELECT var1, var2, count(*) AS r, sum(1.0::DOUBLE / ra) AS inv_r FROM ra GROUP BY ALL),
cs AS (SELECT var1, var2, count(*) AS c, sum(1.0::DOUBLE / cb) AS inv_c FROM cb GROUP BY ALL)
SELECT var1, var2, n::BIGINT AS n,
  round(CASE WHEN r = 2 AND c = 2 THEN (dev - least(0.5, dev)) ^ 2 * n * inv_r * inv_c ELSE pearson END, 6) AS chi2,
  (r - 1) * (c - 1) AS df, (r = 2 AND c = 2) AS yates
FROM st JOIN rs USING (var1, var2) JOIN cs USING (var1, var2)"""


OC = "base AS (SELECT o_orderstatus, o_orderpriority, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey),"


def _corr(prefix: str = "WITH ", source: str = "lineitem", cols: list[str] = LINE_NUMERICS) -> str:
    parts = []
    for a, b in combinations(cols, 2):
        parts.append(f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}, {b}) AS r, "
                     f"count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM {source}")
    return f"""{prefix}c AS ({" UNION ALL ".join(parts)})
SELECT var1, var2, round(r, 6) AS r, n, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t_stat FROM c"""


def _profile() -> str:
    cols = LINE_NUMERICS + ["l_orderkey", "l_linenumber"]
    parts = [f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null,
  count(DISTINCT {c}) AS n_distinct, round(min({c})::DOUBLE, 6) AS min, round(max({c})::DOUBLE, 6) AS max,
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
  round(avg(power({c} - mu, 3)) / power(avg(power({c} - mu, 2)), 1.5), 6) AS skewness,
  round(avg(power({c} - mu, 4)) / power(avg(power({c} - mu, 2)), 2) - 3, 6) AS kurtosis,
  round(quantile_cont({c}, 0.5), 6) AS median
FROM lineitem, (SELECT avg({c}) AS mu FROM lineitem) m""" for c in cols]
    return " UNION ALL ".join(parts)


def _profile_text() -> str:
    parts = [f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null,
  count(DISTINCT {c}) AS n_distinct, min({c}) AS min_value, max({c}) AS max_value,
  min(length({c}))::BIGINT AS min_length, max(length({c}))::BIGINT AS max_length FROM lineitem"""
             for c in ["l_returnflag", "l_linestatus"]]
    return " UNION ALL ".join(parts)


STATS = {
    "box_stats": """
WITH v AS (SELECT event_type, value FROM events WHERE value IS NOT NULL),
q AS (SELECT event_type, count(*) AS n, min(value) AS mn, max(value) AS mx, avg(value) AS mean,
        quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3
      FROM v GROUP BY event_type),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q),
w AS (SELECT f.event_type, min(CASE WHEN value >= lo_f THEN value END) AS wl,
        max(CASE WHEN value <= hi_f THEN value END) AS wh,
        count(*) FILTER (WHERE value < lo_f OR value > hi_f) AS n_out
      FROM f JOIN v USING (event_type) GROUP BY f.event_type)
SELECT event_type, n, round(mn, 6) AS min, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(mx, 6) AS max, round(mean, 6) AS mean, round(q3 - q1, 6) AS iqr, round(wl, 6) AS whisker_low,
  round(wh, 6) AS whisker_high, n_out AS n_outliers
FROM f JOIN w USING (event_type)""",

    "welch_anova": """
WITH g AS (SELECT event_type, count(value) AS n, avg(value) AS m, var_samp(value) AS s2 FROM events
           WHERE value IS NOT NULL GROUP BY event_type HAVING count(value) > 1 AND var_samp(value) > 1e-12 * greatest(1.0, avg(value) * avg(value))),
w AS (SELECT *, n / s2 AS w FROM g),
t AS (SELECT sum(w) AS wsum, sum(w * m) / sum(w) AS mw, count(*) AS k FROM w),
p AS (SELECT sum(w * (m - mw) ^ 2) AS A, sum((1 - w / wsum) ^ 2 / (n - 1)) AS B, any_value(k) AS k FROM w, t)
SELECT round((A / (k - 1)) / (1 + 2 * (k - 2) / (k * k - 1) * B), 6) AS f_stat, (k - 1)::DOUBLE AS df1,
  round((k * k - 1) / (3 * B), 6) AS df2 FROM p""",

    "kruskal": """
WITH v AS (SELECT event_type, value FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL),
r AS (SELECT event_type, value, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS mr
      FROM v),
g AS (SELECT event_type, sum(mr) AS R, count(*) AS n FROM r GROUP BY event_type),
t AS (SELECT count(*)::DOUBLE AS t FROM v GROUP BY value),
nn AS (SELECT sum(n)::DOUBLE AS N, count(*) AS k FROM g)
SELECT round((12.0 / (N * (N + 1)) * (SELECT sum(R * R / n) FROM g) - 3 * (N + 1))
             / (1 - (SELECT sum(t * t * t - t) FROM t) / (N * N * N - N)), 6) AS h_stat,
  k - 1 AS df, N::BIGINT AS n FROM nn""",

    "chi2_pairs": _chi2(OC, "base", ORDER_CATEGORICALS),
    "chi2_2x2": _chi2("", "labels", ["quality", "toxic"]),

    "mosaic": f"""WITH base AS (SELECT lang, quality FROM documents JOIN labels USING (doc_id)),
{_cells("base", ["lang", "quality"])}
SELECT var1, var2, a, b, o, n::BIGINT AS n, round(e, 6) AS expected, round((o - e) / sqrt(e), 6) AS residual,
  round(o * 100.0 / ra, 6) AS pct_of_row FROM j""",

    "corr_matrix": _corr(),

    "scatter_stats": """
SELECT round(corr(l_quantity, l_extendedprice), 6) AS r, regr_count(l_extendedprice, l_quantity)::BIGINT AS n,
  round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""",

    "histogram": """
WITH st AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS n FROM events WHERE value IS NOT NULL),
b AS (SELECT cast(CASE WHEN (hi - lo) / 30 > 0 THEN least(floor((value - lo) / ((hi - lo) / 30)), 29) ELSE 0 END
                  AS INTEGER) AS bin
      FROM events, st WHERE value IS NOT NULL)
SELECT bin::BIGINT AS bin, round(lo + bin * ((hi - lo) / 30), 6) AS bin_lo,
  round(lo + (bin + 1) * ((hi - lo) / 30), 6) AS bin_hi, count(*) AS count,
  round(CASE WHEN (hi - lo) / 30 > 0 THEN count(*) / (any_value(n) * ((hi - lo) / 30)) END, 6) AS density
FROM b, st GROUP BY bin, lo, hi""",

    "log_mean": """
SELECT event_type, count(*) AS n_pos, round(avg(log10(value)), 6) AS mean_log10,
  round(pow(10.0, avg(log10(value))), 6) AS geo_mean FROM events WHERE value > 0 GROUP BY event_type""",

    "group_sample": f"""
SELECT * FROM (SELECT event_id, event_type, round(value, 6) AS value,
  row_number() OVER (PARTITION BY event_type ORDER BY md5(cast(event_id AS varchar))) AS sample_rank
  FROM events) WHERE sample_rank <= {SAMPLE_K}""",

    "profile": _profile(),
    "profile_text": _profile_text(),
}


STATS["profile_batches"] = f'SELECT "column", n_rows, n_null, min, max, mean, stddev, skewness, kurtosis FROM ({STATS["profile"]})'

AF = """
af AS (SELECT *, CASE WHEN numberAuthors > 0 THEN ln(numberAuthors) END AS numberAuthorsLog FROM recoded
       WHERE abstractLength <> (SELECT max(abstractLength) FROM recoded))"""
AF_PREFIX = "WITH " + ",".join([PREPRINTS, LATEST, DERIVED, EXPORTED, AF]) + ",\n"


def _long(values: list[str], groups: list[str]) -> str:
    parts = [f"SELECT '{v} ~ {g}' AS test, {v}::DOUBLE AS value, cast({g} AS varchar) AS grp FROM af"
             for v in values for g in groups]
    return f"""long AS (SELECT * FROM ({" UNION ALL ".join(parts)}) WHERE value IS NOT NULL AND grp IS NOT NULL)"""


STATS["export_chi2"] = _chi2("", "af", EXPORT_CATEGORICAL, prefix=AF_PREFIX)
STATS["export_corr"] = _corr(AF_PREFIX, "af", EXPORT_CORR)
STATS["export_kruskal"] = AF_PREFIX + _long(EXPORT_NUMERIC, EXPORT_CATEGORICAL) + """,
r AS (SELECT test, grp, value, rank() OVER (PARTITION BY test ORDER BY value)
          + (count(*) OVER (PARTITION BY test, value) - 1) / 2.0 AS mr FROM long),
g AS (SELECT test, grp, sum(mr) AS R, count(*) AS n FROM r GROUP BY test, grp),
t AS (SELECT test, sum(t * t * t - t) AS tie FROM (SELECT test, value, count(*)::DOUBLE AS t FROM long GROUP BY test, value)
      GROUP BY test),
tot AS (SELECT test, sum(n)::DOUBLE AS N, sum(R * R / n) AS s, count(*) AS k FROM g GROUP BY test)
SELECT test, round((12.0 / (N * (N + 1)) * s - 3 * (N + 1)) / (1 - tie / (N * N * N - N)), 6) AS h_stat,
  k - 1 AS df, N::BIGINT AS n FROM tot JOIN t USING (test)"""
STATS["export_welch"] = AF_PREFIX + _long(EXPORT_NUMERIC, EXPORT_CATEGORICAL) + """,
g AS (SELECT test, grp, count(*) AS n, avg(value) AS m, var_samp(value) AS s2 FROM long GROUP BY test, grp
      HAVING count(*) > 1 AND var_samp(value) > 1e-12 * greatest(1.0, avg(value) * avg(value))),
w AS (SELECT *, n / s2 AS w FROM g),
tt AS (SELECT test, sum(w) AS wsum, sum(w * m) / sum(w) AS mw, count(*) AS k FROM w GROUP BY test),
p AS (SELECT test, sum(w * (m - mw) ^ 2) AS A, sum((1 - w / wsum) ^ 2 / (n - 1)) AS B, any_value(k) AS k
      FROM w JOIN tt USING (test) GROUP BY test)
SELECT test, round((A / (k - 1)) / (1 + 2 * (k - 2) / (k * k - 1) * B), 6) AS f_stat, (k - 1)::DOUBLE AS df1,
  round((k * k - 1) / (3 * B), 6) AS df2 FROM p"""

_BOX = STATS["box_stats"].replace("WITH v AS (SELECT event_type, value FROM events WHERE value IS NOT NULL),", "")
STATS["export_box"] = AF_PREFIX + _long(EXPORT_NUMERIC, EXPORT_CATEGORICAL) + "," + (
    _BOX.replace("event_type", "test, grp").replace("f.test, grp", "f.test, f.grp").replace("FROM v ", "FROM long ")
    .replace("JOIN v USING", "JOIN long USING"))
