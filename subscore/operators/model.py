"""Boosted-tree classifier for bad debtors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, fields

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscore.operators.boosting import (
    LABEL,
    BoostedTrees,
    BoostSettings,
    boosted_importance,
    load_boosted,
    predict_boosted,
    save_boosted,
    train_boosted,
)
from subscore.schemas import CATEGORICAL, feature_columns

SCORE_DIGITS = 4


@dataclass(frozen=True)
class ModelSettings:
    """Training parameters; the defaults are the fixed values of production."""

    sample_fraction: float = 0.1
    train_ratio: float = 0.75
    trees: int = 400
    rate: float = 0.02
    depth: int = 6
    row_sample: float = 0.56
    column_sample: float = 0.34
    seed: int = 567
    features: list[str] = field(default_factory=feature_columns)


def _index_name(column: str) -> str:
    return f"{column}_index" if column in CATEGORICAL else column


def feature_encoder(features: Sequence[str] | None = None) -> Pipeline:
    """Categories to indices (unseen ones to an index of their own), then one vector."""
    features = list(features or feature_columns())
    categories = [c for c in features if c in CATEGORICAL]
    indexer = StringIndexer(
        inputCols=categories, outputCols=[_index_name(c) for c in categories], handleInvalid="keep"
    )
    assembler = VectorAssembler(inputCols=[_index_name(c) for c in features], outputCol="features")
    return Pipeline(stages=[indexer, assembler])


def encode_features(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    return feature_encoder(features).fit(df).transform(df)


def train_classifier(train: DataFrame, settings: ModelSettings = ModelSettings()) -> BoostedTrees:
    """Grow second-order boosted trees on the labelled rows, a job of one stage for each level."""
    names = [f.name for f in fields(settings)]
    return train_boosted(train, BoostSettings(**{n: getattr(settings, n) for n in names}))


def save_model(model: PipelineModel | BoostedTrees, path: str) -> None:
    """Replace the model directory."""
    if isinstance(model, BoostedTrees):
        save_boosted(model, SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | BoostedTrees:
    """The model that a training job has saved; a pipeline, as older runs have left, has a folder of metadata."""
    spark = SparkSession.active()
    metadata = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/metadata")
    if metadata.getFileSystem(spark._jsc.hadoopConfiguration()).exists(metadata):
        return PipelineModel.load(path)
    return load_boosted(spark, path)


def variable_importance(model: PipelineModel | BoostedTrees) -> DataFrame:
    """Importance of each predictor: as is, relative to the largest, and as a share."""
    if isinstance(model, BoostedTrees):
        return boosted_importance(model)
    *_, assembler, trees = model.stages
    names = [c.removesuffix("_index") for c in assembler.getInputCols()]
    values = trees.featureImportances.toArray().tolist()
    largest, total = max(values) or 1.0, sum(values) or 1.0
    rows = [(n, v, v / largest, v / total) for n, v in zip(names, values, strict=True)]
    return (
        SparkSession.active()
        .createDataFrame(
            rows, "variable string, relative_importance double, scaled_importance double, percentage double"
        )
        .orderBy(F.desc("relative_importance"), "variable")
    )


def predict(model: PipelineModel | BoostedTrees, df: DataFrame) -> DataFrame:
    """Add ``p0``, the chance of paying back, and ``p1`` = 1 - ``p0``, both as the model gives them."""
    if isinstance(model, BoostedTrees):
        return predict_boosted(model, df)
    scored = model.transform(df).withColumn("p0", vector_to_array("probability")[0])
    return scored.withColumn("p1", 1 - F.col("p0")).select(*df.columns, "p0", "p1")


def score_subscribers(df: DataFrame, model: PipelineModel | BoostedTrees) -> DataFrame:
    """Scores as they are delivered: ``p0`` in four digits."""
    scored = predict(model, df).withColumn("p0", F.round("p0", SCORE_DIGITS))
    return scored.select("crm_sub_id", "analytic_id", "register_date", "p0")
