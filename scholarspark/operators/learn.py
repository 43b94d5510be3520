"""Model training: estimators, parameter grids, folds, importances. ``selection`` cross-validates over the grids."""

from __future__ import annotations

from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import GeneralizedLinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 100

# FIXED VALUES: the project's hyper-parameter grids (parameter -> values, in order).
GRIDS = {
    "svc": [("regParam", [0.1, 0.3, 0.5, 0.6, 0.8]), ("maxIter", [5, 10, 15, 20])],
    "logistic": [("regParam", [0.1, 0.2, 0.3, 0.4, 0.5]), ("elasticNetParam", [0, 0.01, 0.1, 0.2]),
                 ("maxIter", [5, 10, 25])],
    "rf_classifier": [("maxDepth", [3, 5, 8]), ("numTrees", [100, 125, 150]), ("minInstancesPerNode", [2, 5, 10]),
                      ("featureSubsetStrategy", ["sqrt", "log2"])],
    "glm_tweedie": [("regParam", [0.001, 0.005, 0.01, 0.1, 0.5, 1.0]), ("maxIter", [50, 100, 200])],
    "rf_regressor": [("numTrees", [25, 50, 100]), ("maxDepth", [2, 5, 10]), ("minInstancesPerNode", [2, 5, 10, 15]),
                     ("featureSubsetStrategy", ["sqrt", "log2"])],
}


def estimator(name: str, label: str = "label", features: str = "features", variance_power: float = 0.0):
    if name == "svc":
        return LinearSVC(featuresCol=features, labelCol=label)
    if name == "logistic":
        return LogisticRegression(featuresCol=features, labelCol=label)
    if name == "rf_classifier":
        return RandomForestClassifier(featuresCol=features, labelCol=label, seed=SEED)
    if name == "glm_tweedie":
        return GeneralizedLinearRegression(featuresCol=features, labelCol=label, family="tweedie",
                                           variancePower=variance_power)
    if name == "rf_regressor":
        return RandomForestRegressor(featuresCol=features, labelCol=label, seed=SEED)
    raise ValueError(name)


def param_grid(est, name: str):
    """The project's grid for ``name``."""
    b = ParamGridBuilder()
    for param, values in GRIDS[name]:
        b = b.addGrid(est.getParam(param), values)
    return b.build()


def evaluator(kind: str, label: str = "label"):
    if kind == "classification":
        return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    return RegressionEvaluator(labelCol=label, metricName="mae")


def fold_of(key: str, folds: int):
    """Fold of a row by a hash of its key (the first 32 bits of an md5): the same rows whatever the partitioning."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit("fold"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(bits % folds, F.lit(0)).cast("int")


def feature_names(df: DataFrame, features_col: str = "features") -> list[str]:
    """Slot names of an assembled vector, from its ML attribute metadata."""
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    names: dict[int, str] = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a.get("name", str(a["idx"]))
    size = meta.get("num_attrs", len(names))
    return [names.get(i, f"f{i}") for i in range(size)]


def importances(spark: SparkSession, model, transformed: DataFrame, model_name: str,
                features_col: str = "features") -> DataFrame:
    """(model, feature_index, feature, importance) of a tree ensemble, named from vector metadata."""
    names = feature_names(transformed, features_col)
    imp = model.featureImportances.toArray()
    rows = [(model_name, i, names[i] if i < len(names) else f"f{i}", float(v)) for i, v in enumerate(imp)]
    return spark.createDataFrame(rows, "model string, feature_index bigint, feature string, importance double")
