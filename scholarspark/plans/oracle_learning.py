"""SQL oracles for features, splits and evaluation metrics."""

from __future__ import annotations

from scholarspark.operators.embed import DEFAULT_DIM
from scholarspark.plans.oracle import EXPORTED, DERIVED, LATEST, PREPRINTS, with_ctes


def split_expr(key: str) -> str:
    return (f"CASE WHEN ('0x' || substr(md5(cast({key} AS varchar)), 1, 8))::UBIGINT % 100 < 80 "
            f"THEN 'train' ELSE 'test' END")


def _ml(kind: str) -> str:
    label = ("CASE WHEN publiStatus = 'year1' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label"
             if kind == "classification" else "cit1year::DOUBLE AS label")
    where = "" if kind == "classification" else " AND cit1year IS NOT NULL"
    return f""",
prep AS (SELECT * REPLACE (coalesce(month_upload, 0) AS month_upload),
           CASE WHEN numberAuthors > 0 THEN ln(numberAuthors) END AS numberAuthorsLog FROM recoded),
ml AS (SELECT p.*, {label}, {split_expr('p.doi')} AS split, {DEFAULT_DIM} AS dims FROM prep p WHERE TRUE{where}),
tr AS (SELECT * FROM ml WHERE split = 'train'),
srv AS (SELECT server, (row_number() OVER (ORDER BY count(*) DESC, server) - 1)::DOUBLE AS server_index
        FROM tr WHERE server IS NOT NULL GROUP BY server),
cat AS (SELECT category_grouped, (row_number() OVER (ORDER BY count(*) DESC, category_grouped) - 1)::DOUBLE
          AS category_grouped_index FROM tr WHERE category_grouped IS NOT NULL GROUP BY category_grouped),
pst AS (SELECT publiStatus, (row_number() OVER (ORDER BY count(*) DESC, publiStatus) - 1)::DOUBLE
          AS publiStatus_index FROM tr WHERE publiStatus IS NOT NULL GROUP BY publiStatus),
means AS (SELECT avg(titleLength) AS m1, avg(abstractLength) AS m2, avg(numberAuthorsLog) AS m3 FROM tr),
st AS (SELECT any_value(m1) AS m1, stddev_samp(coalesce(titleLength, m1)) AS s1, any_value(m2) AS m2,
         stddev_samp(coalesce(abstractLength, m2)) AS s2, any_value(m3) AS m3,
         stddev_samp(coalesce(numberAuthorsLog, m3)) AS s3 FROM tr, means),
sizes AS (SELECT (SELECT count(*) FROM srv) AS n_srv, (SELECT count(*) FROM cat) AS n_cat,
            (SELECT count(*) FROM pst) AS n_pst, (SELECT max(month_upload) FROM tr) AS n_month),
out AS (SELECT ml.*, coalesce(srv.server_index, (SELECT count(*) FROM srv)::DOUBLE) AS server_index,
          coalesce(cat.category_grouped_index, (SELECT count(*) FROM cat)::DOUBLE) AS category_grouped_index,
          coalesce(pst.publiStatus_index, (SELECT count(*) FROM pst)::DOUBLE) AS publiStatus_index,
          round(CASE WHEN s1 = 0 THEN 0 ELSE (coalesce(titleLength, m1) - m1) / s1 END, 6) AS z_title,
          round(CASE WHEN s2 = 0 THEN 0 ELSE (coalesce(abstractLength, m2) - m2) / s2 END, 6) AS z_abstract,
          round(CASE WHEN s3 = 0 THEN 0 ELSE (coalesce(numberAuthorsLog, m3) - m3) / s3 END, 6) AS z_authors,
          n_srv + n_month + n_cat + {'0' if kind == 'classification' else 'n_pst'} + 4 + dims AS n_features
        FROM ml LEFT JOIN srv USING (server) LEFT JOIN cat USING (category_grouped)
          LEFT JOIN pst USING (publiStatus), st, sizes)
"""


ML_BASE = with_ctes(PREPRINTS, LATEST, DERIVED, EXPORTED)

SCORED_CLS = f"""
WITH base AS (SELECT l.doc_id, l.quality::DOUBLE AS label, d.n_chars, {split_expr('l.doc_id')} AS Dataset
              FROM labels l JOIN documents d USING (doc_id)),
s AS (SELECT doc_id, Dataset, label, 'ModA' AS Model, (n_chars % 20)::DOUBLE / 20.0::DOUBLE AS score FROM base
      UNION ALL
      SELECT doc_id, Dataset, label, 'ModB' AS Model, (doc_id % 7)::DOUBLE / 7.0::DOUBLE AS score FROM base),
sp AS (SELECT *, CASE WHEN score >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM s)"""

AUC_CTE = """,
r AS (SELECT Model, Dataset, label, rank() OVER (PARTITION BY Model, Dataset ORDER BY score)
          + (count(*) OVER (PARTITION BY Model, Dataset, score) - 1) / 2.0 AS mr FROM sp),
a AS (SELECT Model, Dataset, sum(mr) FILTER (WHERE label = 1) AS R,
        count(*) FILTER (WHERE label = 1) AS n1, count(*) FILTER (WHERE label = 0) AS n0
      FROM r GROUP BY Model, Dataset)"""

F1_CTE = """,
conf AS (SELECT Model, Dataset, label, prediction, count(*) AS n FROM sp GROUP BY ALL),
sup AS (SELECT Model, Dataset, label AS c, sum(n) AS support FROM conf GROUP BY ALL),
prd AS (SELECT Model, Dataset, prediction AS c, sum(n) AS npred FROM conf GROUP BY ALL),
tp AS (SELECT Model, Dataset, label AS c, n AS tp FROM conf WHERE label = prediction),
per AS (SELECT sup.Model, sup.Dataset, sup.c, support, coalesce(tp, 0) AS tp, coalesce(npred, 0) AS npred
        FROM sup LEFT JOIN tp USING (Model, Dataset, c) LEFT JOIN prd USING (Model, Dataset, c)),
af AS (SELECT Model, Dataset, sum(tp) / sum(support) AS accuracy,
         sum(support * CASE WHEN tp = 0 THEN 0.0 ELSE 2.0 * (tp / npred) * (tp / support)
                                                   / ((tp / npred) + (tp / support)) END) / sum(support) AS f1
       FROM per GROUP BY Model, Dataset)"""

SCORED_REG = with_ctes(PREPRINTS, LATEST, DERIVED) + f""",
base AS (SELECT doi, {split_expr('doi')} AS Dataset, cit1year::DOUBLE AS cit1year, citTotal, cit2years
         FROM derived WHERE cit1year IS NOT NULL),
sp AS (SELECT doi, Dataset, cit1year, 'ModA' AS Model, (citTotal * 0.25)::DOUBLE AS prediction FROM base
       UNION ALL SELECT doi, Dataset, cit1year, 'ModB' AS Model, (cit2years * 0.5 + 1.0)::DOUBLE AS prediction FROM base)"""

LEARNING = {
    "hash_split": f"""
SELECT doc_id, {split_expr('doc_id')} AS split,
  (('0x' || substr(md5(cast(doc_id AS varchar)), 1, 8))::UBIGINT % 100)::BIGINT AS bucket FROM documents""",

    "features_cls": ML_BASE + _ml("classification") + """
SELECT doi, split, label, server_index, category_grouped_index, month_upload, z_title, z_abstract, z_authors,
  n_features FROM out""",

    "features_reg": ML_BASE + _ml("regression") + """
SELECT doi, split, label AS cit1year, publiStatus_index, server_index, z_title, z_abstract, z_authors, n_features
FROM out""",

    "metrics_cls": SCORED_CLS + AUC_CTE + F1_CTE + """
SELECT Model, Dataset, 'Accuracy' AS Metric, round(accuracy, 6) AS Value FROM af
UNION ALL SELECT Model, Dataset, 'F1', round(f1, 6) FROM af
UNION ALL SELECT Model, Dataset, 'ROC', round((R - n1 * (n1 + 1) / 2) / (n1 * n0), 6) FROM a""",

    "auc": SCORED_CLS + AUC_CTE + """
SELECT Model, Dataset, round((R - n1 * (n1 + 1) / 2) / (n1 * n0), 6) AS auc FROM a""",

    "roc_points": SCORED_CLS + """,
g AS (SELECT Model, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
        sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM sp WHERE Dataset = 'test' GROUP BY Model, score),
c AS (SELECT Model, score,
        sum(pos) OVER (PARTITION BY Model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
        sum(neg) OVER (PARTITION BY Model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
        sum(pos) OVER (PARTITION BY Model) AS P, sum(neg) OVER (PARTITION BY Model) AS N FROM g)
SELECT Model, round(score, 6) AS score, round(tp / P, 6) AS tpr, round(fp / N, 6) AS fpr FROM c""",

    "metrics_reg": SCORED_REG + """,
m AS (SELECT Model, Dataset, avg(abs(cit1year - prediction)) AS mae,
        sqrt(avg((cit1year - prediction) ^ 2)) AS rmse,
        1 - sum((cit1year - prediction) ^ 2) / (count(*) * var_pop(cit1year)) AS r2
      FROM sp GROUP BY Model, Dataset)
SELECT Model, Dataset, 'MAE' AS Metric, round(mae, 6) AS Value FROM m
UNION ALL SELECT Model, Dataset, 'RMSE', round(rmse, 6) FROM m
UNION ALL SELECT Model, Dataset, 'R2', round(r2, 6) FROM m""",

    "metric_pivot": SCORED_REG + """
SELECT Model, Dataset, round(avg(abs(cit1year - prediction)), 6) AS MAE,
  round(sqrt(avg((cit1year - prediction) ^ 2)), 6) AS RMSE,
  round(1 - sum((cit1year - prediction) ^ 2) / (count(*) * var_pop(cit1year)), 6) AS R2
FROM sp GROUP BY Model, Dataset""",

    "one_metric": SCORED_CLS + F1_CTE + """
SELECT Model, Dataset, round(f1, 6) AS Value FROM af""",

    "cv_folds": ML_BASE + _ml("classification") + """
SELECT doi, (('0x' || substr(md5('fold' || doi), 1, 8))::UBIGINT % 5)::BIGINT AS fold FROM ml WHERE split = 'train'""",

    "actual_vs_predicted": SCORED_REG + """
SELECT Model, doi, round(cit1year, 6) AS cit1year, round(prediction, 6) AS prediction FROM sp WHERE Dataset = 'test'""",
}
