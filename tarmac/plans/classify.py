"""Binary classifiers on the training sets (gradient-boosted trees of Spark ML)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.ordering import hash_fraction
from tarmac.operators.ranges import stored

LEAST_BINS = 64


@dataclass(frozen=True)
class Classifier:
    model: PipelineModel
    inputs: list[str]
    positive: str
    negative: str


def holdout(df: DataFrame, key: str, share: float = 0.2, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key, so a rerun splits the same way."""
    drawn = hash_fraction(F.col(key), seed)
    return df.filter(drawn >= share), df.filter(drawn < share)


def train(
    df: DataFrame, label: str, positive: str, negative: str, exclude: Sequence[str] = (),
    trees: int = 5, depth: int = 4,
) -> Classifier:
    """Fit on a labelled table; rows with missing inputs are skipped, text columns indexed.

    The inputs are stored once, then indexed in one pass. A text column's values are the
    bins of its splits, so a column of very many values is costly: bucket or hash it first.
    """
    inputs = [c for c in df.columns if c != label and c not in exclude]
    texts = [c for c in inputs if df.schema[c].dataType.simpleString() == "string"]
    numbers = [c for c in inputs if c not in texts]
    rows = df.select(
        *[F.col(c).cast("double").alias(c) for c in numbers], *texts,
        (F.col(label) == positive).cast("double").alias("__label"),
    )
    rows = stored(rows.dropna())
    stages, bins = [], LEAST_BINS
    if texts:  # a value not seen in training gets an index of its own
        indexer = StringIndexer(inputCols=texts, outputCols=[f"{c}__i" for c in texts], handleInvalid="keep").fit(rows)
        stages, bins = [indexer], max(bins, *(len(values) + 1 for values in indexer.labelsArray))
    vector = VectorAssembler(
        inputCols=numbers + [f"{c}__i" for c in texts], outputCol="__features", handleInvalid="keep"
    )
    boosted = GBTClassifier(
        labelCol="__label", featuresCol="__features", maxIter=trees, maxDepth=depth, maxBins=bins, seed=11
    )
    model = Pipeline(stages=[*stages, vector, boosted]).fit(rows)
    return Classifier(model, numbers + texts, positive, negative)


def predict(c: Classifier, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns of every row, with predicted class and probability of the positive one.

    A row that lacks an input has a null prediction.
    """
    casts: dict[str, Column] = {
        name: F.col(name).cast("double")
        for name in c.inputs
        if df.schema[name].dataType.simpleString() != "string"
    }
    whole = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in c.inputs], F.lit(True))
    kept = df.select("*", whole.alias("__whole"), *[F.col(k).alias(f"__keep_{k}") for k in keep])
    scored = c.model.transform(kept.withColumns(casts))
    known = F.col("__whole")
    return scored.select(
        *[F.col(f"__keep_{k}").alias(k) for k in keep],
        F.when(known, F.when(F.col("prediction") == 1.0, c.positive).otherwise(c.negative)).alias("predicted"),
        F.when(known, vector_to_array("probability")[1]).alias("probability"),
    )


def classify_metrics(predicted: DataFrame, label: str, c: Classifier) -> DataFrame:
    """Confusion counts with accuracy, precision, recall and F1, in one aggregate."""
    truth, guess = F.col(label) == c.positive, F.col("predicted") == c.positive
    counts = predicted.agg(
        F.count_if(truth & guess).alias("true_positive"), F.count_if(~truth & guess).alias("false_positive"),
        F.count_if(truth & ~guess).alias("false_negative"), F.count_if(~truth & ~guess).alias("true_negative"),
    )

    def share(part: Column, whole: Column) -> Column:
        return part * 1.0 / F.nullif(whole, F.lit(0))

    tp, fp = F.col("true_positive"), F.col("false_positive")
    fn, tn = F.col("false_negative"), F.col("true_negative")
    return counts.withColumns({
        "accuracy": share(tp + tn, tp + fp + fn + tn),
        "precision": share(tp, tp + fp),
        "recall": share(tp, tp + fn),
        "f1": share(2 * tp, 2 * tp + fp + fn),
    })


def feature_importance(c: Classifier, df: DataFrame) -> DataFrame:
    """(rank, feature, importance): the fitted trees' shares, one row per input column."""
    shares = [float(v) for v in c.model.stages[-1].featureImportances.toArray()]
    ranked = sorted(zip(c.inputs, shares), key=lambda pair: (-pair[1], pair[0]))
    rows = [(n, name, share) for n, (name, share) in enumerate(ranked, start=1)]
    return df.sparkSession.createDataFrame(rows, "rank int, feature string, importance double")
