"""Named feature-engineering, evaluation and model-training queries."""

from __future__ import annotations

import hashlib

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarspark.operators import evaluate, learn, selection
from scholarspark.operators.embed import DEFAULT_DIM, embed_text
from scholarspark.operators.features import (attach_vectors, classification_frame, feature_pipeline, hash_bucket,
                                             prepare, regression_frame, split_by_key)
from scholarspark.plans.common import derived_preprints, tidy
from scholarspark.session import reliable_checkpoint
from scholarspark.sources.tables import read_table

FOLDS = 5


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", ["doc_id"])
    return tidy(split_by_key(d, "doc_id").withColumn("bucket", hash_bucket("doc_id")))


def ml_frame(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Prepared records + the vector of their own title and abstract (stored by DOI) + label + split."""
    prep = reliable_checkpoint(prepare(derived_preprints(spark, sf_dir, keep=("title", "abstract"))), "prepared")
    vectors = reliable_checkpoint(embed_text(prep, "doi", ["title", "abstract"]), "vectors")
    df = attach_vectors(prep, vectors, F.col("doi"), "doi", "embedding", DEFAULT_DIM)
    df = classification_frame(df) if kind == "classification" else regression_frame(df)
    return split_by_key(df, "doi")


def materialised_frame(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The prepared frame written once to the shared checkpoint folder and read from there.

    Fitting stages, cross-validation folds and scoring all scan it; materialising it cuts
    the lineage back to the raw tables (a lost executor re-reads files, not the joins).
    """
    return reliable_checkpoint(ml_frame(spark, sf_dir, kind))


def _features(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    df = materialised_frame(spark, sf_dir, kind)
    model = feature_pipeline(kind).fit(df.where(F.col("split") == "train"))   # fitted on training rows only
    return model.transform(df)


def features_cls(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _features(spark, sf_dir, "classification")
    z = vector_to_array("numeric_scaled")
    return tidy(out.select("doi", "split", "label", "server_index", "category_grouped_index", "month_upload",
                           z[0].alias("z_title"), z[1].alias("z_abstract"), z[2].alias("z_authors"),
                           F.size(vector_to_array("features")).alias("n_features")))


def features_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _features(spark, sf_dir, "regression")
    z = vector_to_array("numeric_scaled")
    return tidy(out.select("doi", "split", "cit1year", "publiStatus_index", "server_index",
                           z[0].alias("z_title"), z[1].alias("z_abstract"), z[2].alias("z_authors"),
                           F.size(vector_to_array("features")).alias("n_features")))


def scored_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fixed scoring rules over labelled documents (ties on purpose), split by key."""
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    doc = read_table(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    base = split_by_key(lab.join(doc, "doc_id"), "doc_id").select(
        "doc_id", F.col("split").alias("Dataset"), F.col("quality").cast("double").alias("label"), "n_chars")
    rules = F.array(
        F.struct(F.lit("ModA").alias("Model"), ((F.col("n_chars") % 20).cast("double") / 20.0).alias("score")),
        F.struct(F.lit("ModB").alias("Model"), ((F.col("doc_id") % 7).cast("double") / 7.0).alias("score")))
    s = base.select("doc_id", "Dataset", "label", F.inline(rules))
    return s.withColumn("prediction", F.when(F.col("score") >= 0.5, 1.0).otherwise(0.0))


def scored_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived_preprints(spark, sf_dir, ["published", "publiDate", "citations"]).where(F.col("cit1year").isNotNull())
    base = split_by_key(d, "doi").select("doi", F.col("split").alias("Dataset"),
                                         F.col("cit1year").cast("double").alias("cit1year"), "citTotal", "cit2years")
    rules = F.array(
        F.struct(F.lit("ModA").alias("Model"), (F.col("citTotal") * 0.25).alias("prediction")),
        F.struct(F.lit("ModB").alias("Model"), (F.col("cit2years") * 0.5 + 1.0).alias("prediction")))
    return base.select("doi", "Dataset", "cit1year", F.inline(rules))


def metrics_cls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(evaluate.classification_table(scored_classification(spark, sf_dir)))


def metrics_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(evaluate.regression_table(scored_regression(spark, sf_dir), "cit1year"))


def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_classification(spark, sf_dir).where(F.col("Dataset") == "test")
    return tidy(evaluate.roc_points(s, "label", "score", ["Model"]))


def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(evaluate.auc(scored_classification(spark, sf_dir), "label", "score", ["Model", "Dataset"]))


def actual_vs_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored_regression(spark, sf_dir).where(F.col("Dataset") == "test")
    return tidy(s.select("Model", "doi", "cit1year", "prediction"))


def _train_frames(spark, sf_dir, kind):
    df = materialised_frame(spark, sf_dir, kind)
    return df.where(F.col("split") == "train"), df.where(F.col("split") == "test")


#: Grid -> kind of model, label and title.
GRIDS = {
    "logistic": ("classification", "label", "LogisticRegression"), "svc": ("classification", "label", "LinearSVM"),
    "rf_classifier": ("classification", "label", "RandomForest"), "glm_tweedie": ("regression", "cit1year", "LinearGM"),
    "rf_regressor": ("regression", "cit1year", "RandomForestRegressor"),
}


def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fold each training record is checked in."""
    train, _ = _train_frames(spark, sf_dir, "classification")
    return tidy(train.select("doi", learn.fold_of("doi", FOLDS).alias("fold")))


def _selection(spark: SparkSession, train: DataFrame, kind: str) -> str:
    """Named by the training rows, the grids and the number of folds: none of them may differ."""
    plan = hashlib.md5(repr((FOLDS, sorted(learn.GRIDS.items()))).encode()).hexdigest()[:8]
    return selection.selection_path(spark, f"{kind}-{plan}-{selection.content_name(train)}")


def _filled(spark: SparkSession, train: DataFrame, name: str, only: dict | None = None) -> str:
    """The selection over the training rows, with the metrics of all points of a grid (that have the values of ``only``)."""
    kind, label, _ = GRIDS[name]
    est = learn.estimator(name, label=label)
    grid = learn.param_grid(est, name)
    points = [i for i, p in enumerate(grid) if all(p[est.getParam(k)] == v for k, v in (only or {}).items())]
    path = _selection(spark, train, kind)
    selection.fill_metrics(spark, path, name, feature_pipeline(kind).getStages(), est, grid, learn.evaluator(kind, label), train, "doi",
                           FOLDS, points)
    return path


def _cv(spark: SparkSession, sf_dir: str, name: str, only: dict | None = None) -> DataFrame:
    """The project's grid (the points with the values of ``only``), five folds: mean metric of each point. Whole grids
    also say which point is best."""
    kind, _, title = GRIDS[name]
    train, _ = _train_frames(spark, sf_dir, kind)
    metrics = selection.read_metrics(spark, _filled(spark, train, name, only)).where(F.col("grid") == name)
    out = selection.rank_points(metrics, FOLDS).select(
        F.lit(title).alias("model"), F.col("point").cast("bigint").alias("grid_point"), "params", "metric", "folds", "is_best")
    for k, v in (only or {}).items():
        out = out.where(F.col("params").contains(f"{k}={v},")).drop("is_best")
    return out


def cv_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cv(spark, sf_dir, "logistic")


def cv_grid_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cv(spark, sf_dir, "svc")


def cv_grid_rf(spark: SparkSession, sf_dir: str, depth: int = 3) -> DataFrame:
    """The forest's grid is filled by three queries, one a depth; ``cv_best`` ranks the whole of it."""
    return _cv(spark, sf_dir, "rf_classifier", {"maxDepth": depth})


def cv_grid_rf_depth5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cv_grid_rf(spark, sf_dir, 5)


def cv_grid_rf_depth8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cv_grid_rf(spark, sf_dir, 8)


def cv_grid_glm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cv(spark, sf_dir, "glm_tweedie")


def cv_grid_rfr(spark: SparkSession, sf_dir: str, depth: int = 2) -> DataFrame:
    """As ``cv_grid_rf``."""
    return _cv(spark, sf_dir, "rf_regressor", {"maxDepth": depth})


def cv_grid_rfr_depth5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cv_grid_rfr(spark, sf_dir, 5)


def cv_grid_rfr_depth10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cv_grid_rfr(spark, sf_dir, 10)


def _best(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One row a grid: the best point over the whole of it. Fits what no query has fitted yet."""
    train, _ = _train_frames(spark, sf_dir, kind)
    names = [n for n, (k, _, _) in GRIDS.items() if k == kind]
    for name in names:
        path = _filled(spark, train, name)
    titles = F.create_map(*[F.lit(x) for n in names for x in (n, GRIDS[n][2])])
    return selection.rank_points(selection.read_metrics(spark, path), FOLDS).where("is_best").select(
        titles[F.col("grid")].alias("model"), F.col("point").cast("bigint").alias("grid_point"), "params", "metric", "folds")


def cv_best_cls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best(spark, sf_dir, "classification")


def cv_best_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best(spark, sf_dir, "regression")


def importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random-forest importances, named from the assembled vector's metadata."""
    train, _ = _train_frames(spark, sf_dir, "classification")
    feats = feature_pipeline("classification").fit(train).transform(train)
    rf = learn.estimator("rf_classifier").setMaxDepth(3).setNumTrees(100).setMinInstancesPerNode(2) \
        .setFeatureSubsetStrategy("sqrt")
    model = rf.fit(feats)
    return learn.importances(spark, model, feats, "RandomForest")


def _compared(spark: SparkSession, sf_dir: str, kind: str, columns: list) -> DataFrame:
    """Predictions of the selected models, refitted on the training rows and loaded from where they are kept, on train and test."""
    train, test = _train_frames(spark, sf_dir, kind)
    names = [n for n, (k, _, _) in GRIDS.items() if k == kind]
    for name in names:
        path = _filled(spark, train, name)
        est = learn.estimator(name, label=GRIDS[name][1])
        selection.fit_selected(spark, path, name, feature_pipeline(kind).getStages(), est, learn.param_grid(est, name), train, FOLDS)
    return selection.score_stored(spark, path, {"Train": train, "Test": test}, columns, {n: GRIDS[n][2] for n in names}, FOLDS)


def model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy, F1 and ROC of the classifiers that cross-validation selected, on train and test."""
    columns = ["doi", "label", "prediction", evaluate.positive_score("rawPrediction").alias("score")]
    return tidy(evaluate.classification_table(_compared(spark, sf_dir, "classification", columns)))


def regression_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAE, RMSE and R2 of the selected regression models, on train and test."""
    return tidy(evaluate.regression_table(_compared(spark, sf_dir, "regression", ["doi", "cit1year", "prediction"]), "cit1year"))


def metric_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long metric table with one column a metric, a row for each model and dataset."""
    return tidy(evaluate.pivot_metrics(evaluate.regression_table(scored_regression(spark, sf_dir), "cit1year"), ["MAE", "RMSE", "R2"]))


def one_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metric out of the long table."""
    table = evaluate.classification_table(scored_classification(spark, sf_dir))
    return tidy(table.where(F.col("Metric") == "F1").select("Model", "Dataset", "Value"))


QUERIES = {
    "hash_split": hash_split,
    "features_cls": features_cls,
    "features_reg": features_reg,
    "metrics_cls": metrics_cls,
    "metrics_reg": metrics_reg,
    "roc_points": roc_points,
    "auc": auc,
    "actual_vs_predicted": actual_vs_predicted,
    "metric_pivot": metric_pivot,
    "one_metric": one_metric,
    "cv_folds": cv_folds,
    "cv_grid": cv_grid,
    "cv_grid_svc": cv_grid_svc,
    "cv_grid_rf": cv_grid_rf,
    "cv_grid_glm": cv_grid_glm,
    "cv_grid_rfr": cv_grid_rfr,
    "cv_grid_rf_depth5": cv_grid_rf_depth5,
    "cv_grid_rf_depth8": cv_grid_rf_depth8,
    "cv_grid_rfr_depth5": cv_grid_rfr_depth5,
    "cv_grid_rfr_depth10": cv_grid_rfr_depth10,
    "cv_best_cls": cv_best_cls,
    "cv_best_reg": cv_best_reg,
    "importances": importances,
    "model_compare": model_compare,
    "regression_compare": regression_compare,
}
