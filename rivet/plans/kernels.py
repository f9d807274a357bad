"""A sequence model of remaining life: random convolution kernels and ridge.

A sequence of ``length`` steps of several sensors is convolved with fixed
random kernels (random weights, dilation, padding and sensors); each kernel
gives two features, the share of positive outputs and the largest one, so
level, shape and period at many time scales reach a linear model. Kernels are
not trained: they follow from a seed and are stored with the model. What is
learnt are the sensors' means and deviations, one aggregate, and a ridge
regression by normal equations, one more aggregate of (features x features)
numbers.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTHS = (7, 9)  # taps of a kernel, fewer where the sequence is shorter


@dataclass(frozen=True)
class Kernel:
    weights: list[list[float]]  # per sensor, per tap
    sensors: list[int]
    bias: float
    dilation: int
    padding: int


def draw_kernels(n: int, length: int, n_sensors: int, seed: int) -> list[Kernel]:
    """``n`` kernels that fit a sequence of ``length`` steps."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        taps = min(int(rng.choice(WIDTHS)), length)
        most = max(1.0, (length - 1) / max(taps - 1, 1))
        dilation = int(2 ** rng.uniform(0, math.log2(most)))
        sensors = sorted(rng.permutation(n_sensors)[:int(2 ** rng.uniform(0, math.log2(min(n_sensors, taps) + 1)))].tolist())
        weights = rng.normal(size=(len(sensors), taps))
        weights -= weights.mean(axis=1, keepdims=True)
        padding = (taps - 1) * dilation // 2 if rng.integers(2) else 0
        out.append(Kernel(weights.tolist(), sensors, float(rng.uniform(-1, 1)), dilation, padding))
    return out


def convolve(x: np.ndarray, kernels: list[Kernel]) -> np.ndarray:
    """(rows, 2 x kernels) features of (rows, sensors, steps) numbers."""
    out = np.empty((len(x), 2 * len(kernels)))
    for i, k in enumerate(kernels):
        w = np.asarray(k.weights)
        padded = np.pad(x[:, k.sensors, :], ((0, 0), (0, 0), (k.padding, k.padding)))
        places = padded.shape[2] - (w.shape[1] - 1) * k.dilation
        y = np.full((len(x), places), k.bias)
        for tap in range(w.shape[1]):
            at = tap * k.dilation
            y += np.tensordot(padded[:, :, at:at + places], w[:, tap], axes=(1, 0))
        out[:, 2 * i], out[:, 2 * i + 1] = (y > 0).mean(axis=1), y.max(axis=1)
    return out


def sensor_scales(rows: DataFrame, cols: list[str], n_sensors: int) -> tuple[list[float], list[float]]:
    """Mean and deviation of each sensor over all steps; ``cols`` are step by
    step. Nulls and NaN don't count; a sensor without values has (0, 1)."""
    def known(j: int):
        return F.filter(F.array(*[F.col(c).cast("double") for c in cols[j::n_sensors]]),
                        lambda v: v.isNotNull() & ~F.isnan(v))

    def total(j: int, part):
        return F.sum(F.aggregate(known(j), F.lit(0.0), lambda acc, v: acc + part(v)))
    sums = rows.agg(*[e for j in range(n_sensors) for e in (F.sum(F.size(known(j))).alias(f"n{j}"),
                                                            total(j, lambda v: v).alias(f"s{j}"))]).first()
    mean = [sums[f"s{j}"] / sums[f"n{j}"] if sums[f"n{j}"] else 0.0 for j in range(n_sensors)]
    # squares about the means, so that large levels cost no digits
    squares = rows.agg(*[total(j, lambda v, m=mean[j]: (v - m) * (v - m)).alias(f"q{j}") for j in range(n_sensors)]).first()
    return mean, [math.sqrt(squares[f"q{j}"] / sums[f"n{j}"]) or 1.0 if sums[f"n{j}"] else 1.0 for j in range(n_sensors)]


@dataclass
class SequenceModel:
    kernels: list[Kernel]
    mean: list[float]
    deviation: list[float]
    ridge: LinearRegressionModel | None = None

    def features(self, df: DataFrame, out: str) -> DataFrame:
        """``features``, a vector of step by step sensor values, as kernel
        features in ``out``; a missing value counts as its sensor's mean."""
        kernels, mean, deviation = self.kernels, np.array(self.mean), np.array(self.deviation)

        @F.pandas_udf("array<double>")
        def kernel_features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in batches:
                x = np.array(s.tolist(), float).reshape(len(s), -1, len(mean))
                yield pd.Series(list(convolve(np.nan_to_num((x - mean) / deviation).transpose(0, 2, 1), kernels)))
        return df.withColumn(out, array_to_vector(kernel_features(vector_to_array("features"))))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``."""
        return self.ridge.transform(self.features(df, "kernel_features")).drop("kernel_features")

    def save(self, path: str) -> None:
        state = {"kernels": [asdict(k) for k in self.kernels], "mean": self.mean, "deviation": self.deviation}
        self.ridge.write().overwrite().save(f"{path}/ridge")
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode("overwrite").parquet(f"{path}/kernels")

    @classmethod
    def load(cls, spark, path: str) -> SequenceModel:
        state = json.loads(spark.read.parquet(f"{path}/kernels").first()["state"])
        return cls([Kernel(**k) for k in state["kernels"]], state["mean"], state["deviation"],
                   LinearRegressionModel.load(f"{path}/ridge"))


def fit_sequences(train: DataFrame, cols: list[str], target: str, n_sensors: int, kernels: int = 100,
                  penalty: float = 0.01, seed: int = 42) -> SequenceModel:
    """A model of ``target`` on a frame with ``cols`` (step by step, sensor by
    sensor) and their vector ``features``. Rows without a target are left out."""
    train = train.filter(F.col(target).isNotNull())
    mean, deviation = sensor_scales(train, cols, n_sensors)
    model = SequenceModel(draw_kernels(kernels, len(cols) // n_sensors, n_sensors, seed), mean, deviation)
    ridge = LinearRegression(featuresCol="kernel_features", labelCol=target, solver="normal", regParam=penalty)
    model.ridge = ridge.fit(model.features(train, "kernel_features").select("kernel_features", F.col(target).cast("double")))
    return model
