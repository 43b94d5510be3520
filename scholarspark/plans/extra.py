"""Named queries: FAMD, kernel density, CSV export round trip, ordered levels, model persistence."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarspark.functions.recode import STATUS_ORDER
from scholarspark.operators import evaluate, famd as famd_ops, learn, stats
from scholarspark.operators.features import feature_pipeline
from scholarspark.operators.records import export_table, write_csv
from scholarspark.plans.common import derived_preprints, recoded_export, tidy
from scholarspark.plans.learning import _train_frames
from scholarspark.plans.stats import analysis_frame
from scholarspark.schemas import EXPORT
from scholarspark.session import reliable_checkpoint, shared_path
from scholarspark.sources.tables import read_csv, read_table

#: Active variables of the analysis frame, and the supplementary one.
FAMD_NUMERIC = ["titleLength", "abstractLength", "numberAuthorsLog"]
FAMD_CATEGORICAL = ["server", "category_grouped", "publiStatus_binary", "month_upload"]
FAMD_SUPPLEMENTARY = ["cit1year"]
ELLIPSE_GROUPS = ["server", "publiStatus_binary"]


def _famd(spark, sf_dir):
    frame = analysis_frame(spark, sf_dir)
    return frame, famd_ops.fit_famd(frame, FAMD_NUMERIC, FAMD_CATEGORICAL)


def famd(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _famd(spark, sf_dir)
    return tidy(famd_ops.eigen_table(spark, model, 5))


def famd_contrib(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _famd(spark, sf_dir)
    return tidy(famd_ops.contributions(spark, model, 3))


def famd_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of the matrix that is decomposed."""
    return tidy(famd_ops.gram_cells(analysis_frame(spark, sf_dir), FAMD_NUMERIC, FAMD_CATEGORICAL))


def famd_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidence ellipses of the individuals on the first two axes, by server and by publication status."""
    frame, model = _famd(spark, sf_dir)
    coords = reliable_checkpoint(famd_ops.coordinates(frame, model, ELLIPSE_GROUPS, 2), "famd-coordinates")
    return tidy(famd_ops.confidence_ellipses(coords, ELLIPSE_GROUPS))


def famd_supplementary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of the supplementary variable with the first axes."""
    frame, model = _famd(spark, sf_dir)
    coords = famd_ops.coordinates(frame, model, FAMD_SUPPLEMENTARY, 3)
    return tidy(famd_ops.supplementary(coords, FAMD_SUPPLEMENTARY, [], 3))


def export_ellipses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidence ellipses of two analysis variables by server and by publication status."""
    return tidy(famd_ops.confidence_ellipses(analysis_frame(spark, sf_dir), ELLIPSE_GROUPS, "abstractLength", "numberAuthorsLog"))


def density_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(stats.density_grid(read_table(spark, sf_dir, "events", ["value"]), "value"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export table written as CSV (distributed, with header) and read back with its schema."""
    path = shared_path(spark, "export-csv")
    write_csv(export_table(derived_preprints(spark, sf_dir)), path)
    return tidy(read_csv(spark, path, EXPORT))


def ordered_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status counts with the fixed level order (levels outside the order get no ordinal)."""
    df = recoded_export(spark, sf_dir, ["category", "published", "publiDate"])
    pos = F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col("publiStatus"))
    return tidy(df.groupBy("publiStatus", F.when(pos > 0, pos).alias("ordinal"))
                .agg(F.count(F.lit(1)).alias("n")))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load and score: metrics of the reloaded model, and whether predictions agree."""
    train, test = _train_frames(spark, sf_dir, "classification")
    model = Pipeline(stages=feature_pipeline("classification").getStages()
                     + [learn.estimator("logistic").setRegParam(0.1).setMaxIter(25)]).fit(train)
    path = shared_path(spark, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = model.transform(test).select("doi", F.col("prediction").alias("p1"))
    b = loaded.transform(test).select("doi", F.col("prediction").alias("p2"),
                                      evaluate.positive_score("rawPrediction").alias("score"), "label")
    j = a.join(b, "doi")
    agree = j.agg(F.min((F.col("p1") == F.col("p2")).cast("int")).alias("same"))
    scored = j.select(F.lit("LogisticRegression").alias("Model"), F.lit("Test").alias("Dataset"), "label",
                      F.col("p2").alias("prediction"), "score")
    table = evaluate.classification_table(scored)
    return tidy(table.withColumn("predictions_identical", agree.select(F.col("same") == 1).scalar()))


QUERIES = {
    "famd": famd,
    "famd_contrib": famd_contrib,
    "famd_groups": famd_groups,
    "famd_gram": famd_gram,
    "famd_supplementary": famd_supplementary,
    "export_ellipses": export_ellipses,
    "density_grid": density_grid,
    "csv_roundtrip": csv_roundtrip,
    "ordered_status": ordered_status,
    "model_roundtrip": model_roundtrip,
}
