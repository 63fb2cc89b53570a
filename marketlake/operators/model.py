"""Fraud model: distributed ``pyspark.ml`` training (logistic baseline, gradient-boosted trees),
isotonic calibration and feature importance as a DataFrame.

Training data never passes through the driver: ``VectorAssembler`` + estimators run as Spark jobs
over the partitioned feature table; only model coefficients come back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import isotonic


def feature_frame(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast feature columns to double (booleans -> 0/1) so they can be imputed and assembled."""
    return df.select("*", *[F.col(c).cast("double").alias(f"f_{c}") for c in cols])


def train(df: DataFrame, cols: Sequence[str], kind: str = "logistic", label: str = "label",
          seed: int = 7) -> PipelineModel:
    """Fit ``Imputer -> VectorAssembler [-> StandardScaler] -> classifier`` on ``df``."""
    fcols = [f"f_{c}" for c in cols]
    stages = [Imputer(inputCols=fcols, outputCols=[f"{c}_i" for c in fcols], strategy="median"),
              VectorAssembler(inputCols=[f"{c}_i" for c in fcols], outputCol="raw_features")]
    if kind == "logistic":
        stages += [StandardScaler(inputCol="raw_features", outputCol="features"),
                   LogisticRegression(featuresCol="features", labelCol=label, maxIter=50, regParam=0.01)]
    elif kind == "gbt":
        stages += [GBTClassifier(featuresCol="raw_features", labelCol=label, maxIter=20, maxDepth=4, seed=seed)]
    else:
        raise ValueError(kind)
    data = feature_frame(df, cols).withColumn(label, F.col(label).cast("double"))
    return Pipeline(stages=stages).fit(data)


def score(model: PipelineModel, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Adds ``p_raw`` = P(label = 1)."""
    out = model.transform(feature_frame(df, cols))
    keep = [c for c in df.columns]
    return out.select(*keep, vector_to_array("probability")[1].alias("p_raw"))


def calibrate(scored: DataFrame, label: str = "label") -> DataFrame:
    """The isotonic curve of the label on ``p_raw``, over all distinct scores (``isotonic.fit``)."""
    return isotonic.fit(scored, "p_raw", label)


def calibrated(curve: DataFrame, scored: DataFrame) -> DataFrame:
    """Adds ``p_fraud``, the calibrated probability, to rows with ``p_raw``."""
    return isotonic.apply(scored, curve, "p_raw", "p_fraud")


def importance(spark: SparkSession, model: PipelineModel, cols: Sequence[str]) -> DataFrame:
    """Feature importance: tree importances, or |coefficient| of the standardised logistic model."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray().tolist()
    else:
        vals = [abs(v) for v in last.coefficients.toArray().tolist()]
    return spark.createDataFrame(list(zip(cols, [float(v) for v in vals])), "feature string, importance double")
