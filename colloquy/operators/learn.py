"""Relevance classifier (M1-M4) on Spark ML: deterministic split, text
pipeline, prediction labels, accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_train_val(df: DataFrame, key: str, seed: int = 42, val_share: int = 10) -> tuple[DataFrame, DataFrame]:
    """M1: hash split, independent of partitioning (``randomSplit`` is not):
    ``pmod(xxhash64(key, seed), 100) < val_share`` -> validation."""
    h = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100))
    return df.filter(h >= val_share), df.filter(h < val_share)


def train_relevance(train: DataFrame, text_col: str = "text", label_col: str = "label",
                    num_features: int = 1 << 16, max_iter: int = 20):
    """M2: RegexTokenizer -> HashingTF -> IDF -> LogisticRegression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
    stages = [RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern="\\W+"),
              HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
              IDF(inputCol="_tf", outputCol="features"),
              LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter)]
    return Pipeline(stages=stages).fit(train.withColumn(label_col, F.col(label_col).cast("double")))


def predict_relevance(model, df: DataFrame) -> DataFrame:
    """M3: predicted class, 'Relevant' / 'Not Relevant' by argmax."""
    p = model.transform(df)
    return (p.withColumn("is_relevant", F.col("prediction").cast("int"))
             .withColumn("relevance", F.when(F.col("prediction") == 1, "Relevant").otherwise("Not Relevant"))
             .drop("_tok", "_tf", "features", "rawPrediction", "probability"))


def evaluate_relevance(model, val: DataFrame, label_col: str = "label") -> DataFrame:
    """M4: accuracy on the validation split."""
    from .aggregates import accuracy
    p = predict_relevance(model, val)
    return accuracy(p.withColumn("_l", F.col(label_col).cast("int")), "is_relevant", "_l")
