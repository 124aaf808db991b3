"""The scorer: a weighted logistic model for each target source, its training, artifact and thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from .features import NAMES

EPOCHS, BATCH, RATE, DECAY, MOST_WEIGHT = 3, 2048, 0.05, 1e-4, 20.0
#: 18 thresholds with the rounding noise of a running sum of doubles.
THRESHOLDS = [float(x) for x in np.arange(0.10, 0.951, 0.05)]


@dataclass
class Model:
    weights: dict[int, list[float]]
    bias: dict[int, float]
    threshold: dict[int, float] = field(default_factory=dict)
    names: list[str] = field(default_factory=lambda: list(NAMES))


def score(pairs: DataFrame, model: Model, clip: float = 30.0) -> DataFrame:
    """pairs with `score`: one sum of products for each source, inside generated code."""
    if list(model.names) != NAMES:
        raise ValueError("the model's features aren't in the expected order")
    z = None
    for src, weights in model.weights.items():
        total = F.lit(float(model.bias[src]))
        for name, w in zip(NAMES, weights):
            total = total + F.col(name) * F.lit(float(w))
        z = F.when(F.col("src") == src, total) if z is None else z.when(F.col("src") == src, total)
    return pairs.withColumn("score", text.sigmoid(z, clip))


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with label 1 where the truth has them."""
    return pairs.join(truth.distinct().withColumn("_t", F.lit(1)), ["src", "s1", "cand"], "left").withColumn("label", F.coalesce("_t", F.lit(0))).drop("_t")


def with_group(records: DataFrame) -> DataFrame:
    return records.withColumn("is_validation", (text.validation_group(F.col("entity_id")) == 0).cast("int"))


def train_sample(pairs: DataFrame) -> DataFrame:
    """Of labelled pairs with is_validation those that teach: all positives, and negatives whose id number 5 divides."""
    return pairs.where((F.col("is_validation") == 0) & ((F.col("label") == 1) | (text.id_number(F.col("cand")) % 5 == 0)))


def positive_weight(sample: DataFrame) -> DataFrame:
    """Per source: pairs, positives and the weight of a positive."""
    n = sample.groupBy("src").agg(F.count("*").alias("pairs"), F.sum("label").alias("positives"))
    weight = F.least(F.lit(MOST_WEIGHT), F.greatest(F.lit(0), F.col("pairs") - F.col("positives")) / F.greatest(F.lit(1), F.col("positives")))
    return n.withColumn("positive_weight", weight.cast("double"))


def train_sgd(sample: DataFrame, src: int, rate: float = RATE, epochs: int = EPOCHS) -> tuple[list[float], float]:
    """Mini-batch gradient descent in the order of (s1, cand): each step needs the last one's weights, so the rows stream to the
    driver in batches; what it holds is one partition. `train_lbfgs` is the form for large data."""
    own = sample.where(F.col("src") == src)
    weight = own.transform(positive_weight).select("positive_weight").first()
    heavy = weight[0] if weight else 1.0
    rows = own.orderBy("s1", "cand").select("label", *NAMES)
    w, b = np.zeros(len(NAMES)), 0.0

    def step(batch: list) -> None:
        nonlocal w, b
        x = np.array([r[1:] for r in batch], float)
        y = np.array([r[0] for r in batch], float)
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        error = (p - y) * np.where(y > 0, heavy, 1.0)
        w = w - rate * (x.T @ error / len(y) + DECAY * w)
        b -= rate * float(error.sum() / len(y))

    for _ in range(epochs):
        batch: list = []
        for r in rows.toLocalIterator():
            batch.append(tuple(r))
            if len(batch) == BATCH:
                step(batch)
                batch = []
        if batch:
            step(batch)
    return w.tolist(), b


def train_lbfgs(sample: DataFrame, src: int) -> tuple[list[float], float]:
    """The same weighted, regularized objective by distributed L-BFGS; other weights than train_sgd stops at."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    own = sample.where(F.col("src") == src)
    heavy = own.transform(positive_weight).first()["positive_weight"]
    rows = VectorAssembler(inputCols=NAMES, outputCol="x").transform(own.withColumn("w", F.when(F.col("label") == 1, float(heavy)).otherwise(1.0)).withColumn("label", F.col("label").cast("double")))
    fit = LogisticRegression(featuresCol="x", weightCol="w", regParam=DECAY, standardization=False).fit(rows)
    return fit.coefficients.toArray().tolist(), float(fit.intercept)


def save(spark: SparkSession, model: Model, path: str) -> None:
    """Refuses to overwrite."""
    rows = [(s, model.names, [float(x) for x in w], float(model.bias[s]), model.threshold.get(s)) for s, w in model.weights.items()]
    spark.createDataFrame(rows, "src int, feature_names array<string>, weights array<double>, bias double, threshold double").coalesce(1).write.mode("errorifexists").parquet(path)


def load(spark: SparkSession, path: str) -> Model:
    rows = spark.read.parquet(path).collect()
    if any(list(r["feature_names"]) != NAMES for r in rows):
        raise ValueError("the model's features aren't in the expected order")
    return Model({r["src"]: r["weights"] for r in rows}, {r["src"]: r["bias"] for r in rows}, {r["src"]: r["threshold"] for r in rows if r["threshold"] is not None})
