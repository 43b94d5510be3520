"""SQL oracles for the extra queries (the axes of FAMD and model persistence are rows-only)."""

from __future__ import annotations

from scholarspark.functions.recode import STATUS_ORDER
from scholarspark.plans.oracle import PP_RECODED, RECORDS
from scholarspark.plans.oracle_stats import AF_PREFIX

_ORDER = "[" + ", ".join(f"'{s}'" for s in STATUS_ORDER) + "]"

_NUM = ["titleLength", "abstractLength", "numberAuthorsLog"]
_CAT = ["server", "category_grouped", "publiStatus_binary", "month_upload"]
_PAIRS = [(a, b) for i, a in enumerate(_CAT) for b in _CAT[i + 1:]]

_GRAM = AF_PREFIX + f"""c AS (SELECT {', '.join(f'{x}::DOUBLE AS {x}' for x in _NUM)}, {', '.join(f'cast({x} AS varchar) AS {x}' for x in _CAT)}
  FROM af WHERE {' AND '.join(f'{x} IS NOT NULL' for x in _NUM + _CAT)}),
m AS (SELECT count(*)::DOUBLE AS n, {', '.join(f'avg({x}) AS m_{x}, coalesce(nullif(stddev_pop({x}), 0), 1) AS s_{x}' for x in _NUM)} FROM c),
z AS (SELECT n, {', '.join(f'({x} - m_{x}) / s_{x} AS {x}' for x in _NUM)}, {', '.join(_CAT)} FROM c, m),
lv AS ({' UNION ALL '.join(f"SELECT '{c}' AS var, {c} AS level, count(*) / any_value(n) AS p, {', '.join(f'sum({x}) / any_value(n) AS {x}' for x in _NUM)} FROM z GROUP BY {c}" for c in _CAT)}),
cells AS ({' UNION ALL '.join(f"SELECT '{a}' AS var1, {a} AS level1, '{b}' AS var2, {b} AS level2, count(*) / any_value(n) AS f FROM z GROUP BY {a}, {b}" for a, b in _PAIRS)}),
out AS ({' UNION ALL '.join(f"SELECT '{a}' AS var1, NULL AS level1, '{b}' AS var2, NULL AS level2, avg({a} * {b}) AS value FROM z" for i, a in enumerate(_NUM) for b in _NUM[i:])}
  UNION ALL {' UNION ALL '.join(f"SELECT '{x}', NULL, var, level, {x} / sqrt(p) FROM lv" for x in _NUM)}
  UNION ALL SELECT var, level, var, level, 1 - p FROM lv
  UNION ALL SELECT cells.*  EXCLUDE (f), f / sqrt(a.p * b.p) - sqrt(a.p * b.p) FROM cells JOIN lv a ON a.var = var1 AND a.level = level1
    JOIN lv b ON b.var = var2 AND b.level = level2)
SELECT var1, level1, var2, level2, round(value, 6) AS value FROM out"""

EXTRA = {
    "famd_gram": _GRAM,

    "export_ellipses": AF_PREFIX + """g AS (
  SELECT variable, level, count(*) AS n, avg(x) AS mean_x, avg(y) AS mean_y, var_samp(x) AS var_x, var_samp(y) AS var_y, covar_samp(x, y) AS cov_xy
  FROM (SELECT 'server' AS variable, server AS level, abstractLength::DOUBLE AS x, numberAuthorsLog AS y FROM af
        UNION ALL SELECT 'publiStatus_binary', publiStatus_binary, abstractLength::DOUBLE, numberAuthorsLog FROM af)
  WHERE x IS NOT NULL AND y IS NOT NULL AND level IS NOT NULL GROUP BY variable, level),
e AS (SELECT *, (var_x + var_y) / 2 AS h, sqrt(((var_x - var_y) / 2) ^ 2 + cov_xy ^ 2) AS r FROM g)
SELECT variable, level, n, round(mean_x, 6) AS mean_x, round(mean_y, 6) AS mean_y, round(var_x, 6) AS var_x, round(var_y, 6) AS var_y,
  round(cov_xy, 6) AS cov_xy, round(sqrt(CASE WHEN h + r < 0 THEN 0 ELSE h + r END / n) * sqrt(-2 * ln(0.05)), 6) AS axis_major,
  round(sqrt(CASE WHEN h - r < 0 THEN 0 ELSE h - r END / n) * sqrt(-2 * ln(0.05)), 6) AS axis_minor, round(atan2(cov_xy, (var_x - var_y) / 2) / 2, 6) AS angle FROM e""",

    "density_grid": """
WITH v AS (SELECT value::DOUBLE AS x FROM events WHERE value IS NOT NULL),
st AS (SELECT count(*) AS n, stddev_samp(x) AS sd, min(x) AS lo, max(x) AS hi,
         quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM v),
hh AS (SELECT *, 0.9 * (CASE WHEN least(sd, iqr / 1.34) > 0 THEN least(sd, iqr / 1.34)
                             WHEN sd > 0 THEN sd ELSE 1.0 END) * pow(n::DOUBLE, -0.2) AS h FROM st),
p AS (SELECT *, lo - 4 * h AS b_lo, ((hi + 4 * h) - (lo - 4 * h)) / 1024 AS bw, lo - 3.0 * h AS g_lo,
        ((hi + 3.0 * h) - (lo - 3.0 * h)) / 511 AS step FROM hh),
b AS (SELECT least(floor((x - b_lo) / bw), 1023)::INTEGER AS b, count(*) AS c FROM v, p GROUP BY 1),
g AS (SELECT range AS g FROM range(512))
SELECT g::BIGINT AS grid_index, round(any_value(g_lo) + g * any_value(step), 6) AS x,
  round(sum(c * exp(-0.5 * pow((g_lo + g * step - (b_lo + (b + 0.5) * bw)) / h, 2)))
        / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density,
  round(any_value(h), 6) AS bandwidth
FROM b, g, p GROUP BY g""",

    "csv_roundtrip": RECORDS["export_table"],

    "ordered_status": PP_RECODED + f"""
SELECT publiStatus, list_position({_ORDER}, publiStatus)::BIGINT AS ordinal, count(*) AS n
FROM recoded GROUP BY ALL""",
}
