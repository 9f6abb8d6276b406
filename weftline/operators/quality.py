"""A trained quality score in place of the heuristic one."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T


def _worded(df: DataFrame, text: str, prefix: int | None) -> DataFrame:
    body = F.col(text) if prefix is None else F.substring(F.col(text), 1, prefix)
    return df.withColumn("_words", T.words(body))


def fit_quality_model(df: DataFrame, text: str = "content", label: str = "quality",
                      features: int = 1 << 16, prefix: int | None = None):
    """Logistic regression over hashed words, fitted on labelled documents."""
    steps = [HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
             LogisticRegression(featuresCol="_tf", labelCol=label, regParam=0.01, maxIter=20,
                                probabilityCol="_p", rawPredictionCol="_r", predictionCol="_y")]
    return Pipeline(stages=steps).fit(_worded(df, text, prefix))


def quality_model_score(df: DataFrame, model, text: str = "content", prefix: int | None = None) -> DataFrame:
    """df + quality_score, the probability of a good document; `prefix` reads only the first characters."""
    scored = model.transform(_worded(df, text, prefix))
    return scored.withColumn("quality_score", vector_to_array("_p")[1]).drop("_words", "_tf", "_p", "_r", "_y")
