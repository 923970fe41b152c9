"""Model jobs: baselines, boosted trees, votes and stacks, scores with margins, importances and reasons."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stakeflow.operators import ranking
from stakeflow.sources.materialise import materialised


def _fit(train: DataFrame, features: list[str], stages: list) -> PipelineModel:
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_raw", handleInvalid="keep"), *stages]).fit(train.fillna(0, features))


def logistic_baseline(train: DataFrame, features: list[str], weight: str | None = None) -> PipelineModel:
    lr = LogisticRegression(featuresCol="_x", labelCol="label", maxIter=50, regParam=1e-3, **({"weightCol": weight} if weight else {}))
    return _fit(train, features, [StandardScaler(inputCol="_raw", outputCol="_x"), lr])


def tree_baseline(train: DataFrame, features: list[str], depth: int = 3) -> PipelineModel:
    return _fit(train, features, [DecisionTreeClassifier(featuresCol="_raw", labelCol="label", maxDepth=depth, seed=7)])


#: Of gradient descent: shards whose rows go one after another, passes, first step, its decay by rows, and the L2 penalty.
SHARDS, EPOCHS, STEP, DECAY, PENALTY = 16, 5, 0.1, 1e-4, 1e-4


@dataclass(frozen=True)
class Linear:
    """A linear model of standardised columns; ``steps`` are the mean losses of its epochs."""

    weights: list[float]
    bias: float
    means: list[float]
    sds: list[float]
    steps: list[float]

    def score(self, features: list[str]) -> Column:
        """The positive class's probability, as one expression."""
        z = F.lit(self.bias)
        for f, w, m, s in zip(features, self.weights, self.means, self.sds):
            z = z + (F.coalesce(F.col(f).cast("double"), F.lit(0.0)) - m) / s * w
        return 1 / (1 + F.exp(-z))


def descent_step(w: np.ndarray, x: np.ndarray, y: float, weight: float, seen: int, step: float, decay: float, penalty: float) -> float:
    """Moves the weights, bias last, by one row's gradient, ``seen`` rows after the first; returns the row's loss before."""
    z = float(w[:-1] @ x + w[-1])
    p = 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))
    rate = step / (1 + decay * seen)
    w[:-1] -= rate * (weight * (p - y) * x + penalty * w[:-1])
    w[-1] -= rate * weight * (p - y)
    return -weight * math.log(max(1e-15, p if y else 1 - p))


def sgd_baseline(train: DataFrame, features: list[str], key: str = "bet_id", label: str = "label", weight: str | None = None, shards: int = SHARDS, epochs: int = EPOCHS, step: float = STEP, decay: float = DECAY, penalty: float = PENALTY) -> Linear:
    """A logistic model by stochastic gradient descent with averaged weights, balanced classes unless ``weight`` names a column.

    Rows are dealt to ``shards`` by a hash of their key, and ordered by another, so that a run's order is the same over any
    partitioning. In each epoch every shard descends from the common weights, row by row, and returns the mean of its
    weights, a row a shard; their mean by rows is where the next epoch starts. Columns are standardised; nulls and NaN are
    0. Rows without a 0/1 label or a key don't count; one class alone, or none, is an error.
    """
    value = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(0.0))
    known = train.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    stats = known.agg(F.count("*"), F.sum(label), *[f(value(c)) for c in features for f in (F.avg, F.stddev_pop)]).first()
    n, pos = stats[0], stats[1] or 0
    if not 0 < pos < n:
        raise ValueError(f"{pos} of {n} rows are positive")
    means, sds = [float(v) for v in stats[2::2]], [float(v) or 1.0 for v in stats[3::2]]
    weigh = value(weight) if weight else F.when(F.col(label) == 1, n / (2 * pos)).otherwise(n / (2 * (n - pos)))
    scaled = F.array(*[(value(c) - m) / s for c, m, s in zip(features, means, sds)])
    shard = F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(shards)).cast("int")
    rows = materialised(known.select(shard.alias("shard"), F.xxhash64(F.lit("order"), key).alias("o"), F.col(key).alias("k"), scaled.alias("x"), F.col(label).cast("double").alias("y"), weigh.alias("weight")).repartition("shard").sortWithinPartitions("shard", "o", "k"))
    now, losses, sizes = np.zeros(len(features) + 1), [], {}
    for epoch in range(epochs):
        start = now.copy()
        seen = {s: epoch * m for s, m in sizes.items()}

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """Shards in order; what of one comes in later batches goes on from where it is."""
            held: dict[int, list] = {}
            for batch in batches:
                for s, part in batch.groupby("shard", sort=False):
                    w, mean, m, loss = held.get(s, [start, np.zeros_like(start), 0, 0.0])
                    x, y, wt = np.stack(part["x"].to_numpy()), part["y"].to_numpy(), part["weight"].to_numpy()
                    at = w.copy()
                    for i in range(len(x)):  # one row at a time, as the weights move
                        loss += descent_step(at, x[i], y[i], wt[i], seen.get(int(s), 0) + m + i, step, decay, penalty)
                        mean = mean + at
                    held[s] = [at, mean, m + len(x), loss]
            for s, (_, mean, m, loss) in held.items():
                yield pd.DataFrame({"shard": [s], "n": [m], "w": [(mean / m).tolist()], "loss": [loss]})

        got = sorted(rows.mapInPandas(run, "shard int, n long, w array<double>, loss double").collect())  # a row a shard
        sizes = {r.shard: r.n for r in got}
        now = sum(np.array(r.w) * r.n for r in got) / n
        losses.append(sum(r.loss for r in got) / n)
    return Linear(now[:-1].tolist(), float(now[-1]), means, sds, losses)


def boosted_trees(train: DataFrame, features: list[str], weight: str | None = None, rounds: int = 20, depth: int = 4) -> PipelineModel:
    gbt = GBTClassifier(featuresCol="_raw", labelCol="label", maxIter=rounds, maxDepth=depth, seed=7, **({"weightCol": weight} if weight else {}))
    return _fit(train, features, [gbt])


def scored(df: DataFrame, model: PipelineModel, features: list[str], name: str = "score") -> DataFrame:
    """Adds the positive class's probability."""
    out = model.transform(df.fillna(0, features)).withColumn(name, vector_to_array("probability")[1])
    return out.drop("_raw", "_x", "rawPrediction", "probability", "prediction")


def with_margin(df: DataFrame, threshold: float) -> DataFrame:
    """Adds margin and is_alert: at or above the threshold, and rated."""
    df = df.withColumn("margin", F.col("score") - threshold)
    return df.withColumn("is_alert", (F.col("margin") >= 0) & F.coalesce(F.col("is_rated"), F.lit(False)))


def soft_vote(*scores: Column) -> Column:
    return sum(scores[1:], scores[0]) / len(scores)


def out_of_fold(df: DataFrame, fold: str, folds: int, features: list[str], fit: Callable[[DataFrame, list[str]], PipelineModel], name: str) -> DataFrame:
    """Adds scores of models that were fitted on earlier folds only; rows of the first fold go."""
    parts = [scored(df.where(F.col(fold) == k), fit(df.where(F.col(fold) < k), features), features, name) for k in range(1, folds)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stacked(oof: DataFrame, scores: list[str]) -> PipelineModel:
    """A logistic model over out-of-fold scores."""
    return logistic_baseline(oof, scores)


def chosen_threshold(valid: DataFrame, recall_floor: float = 0.01) -> float:
    """The best threshold on scored rows, 0.5 where there is none."""
    best = ranking.pick_threshold(ranking.pr_curve(valid), recall_floor).first()
    return best["threshold"] if best else 0.5


def importances(model: PipelineModel, features: list[str]) -> dict[str, float]:
    """Features by importance, or by absolute coefficient for linear models."""
    last = model.stages[-1]
    values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    return dict(sorted(zip(features, map(float, values)), key=lambda x: (-x[1], x[0])))


def reason_codes(df: DataFrame, coefficients: dict[str, float], means: dict[str, float], k: int = 3) -> Column:
    """The k features of the largest absolute contribution to a linear score, as an array."""
    parts = F.array(*[F.struct(F.abs((F.coalesce(F.col(f).cast("double"), F.lit(0.0)) - means[f]) * c).alias("size"), F.lit(f).alias("name")) for f, c in coefficients.items()])
    ordered = F.reverse(F.array_sort(parts))
    return F.transform(F.slice(ordered, 1, k), lambda x: x["name"])
