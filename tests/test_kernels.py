import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivet.plans import kernels as KN
from rivet.plans import models as MD
from rivet.sources import io as IO


def by_hand(x, k):
    """One sequence, [step][sensor], under one kernel."""
    steps, outputs = len(x), []
    reach = (len(k.weights[0]) - 1) * k.dilation
    for start in range(-k.padding, steps + k.padding - reach):
        total = k.bias
        for w, sensor in zip(k.weights, k.sensors, strict=True):
            for tap, weight in enumerate(w):
                at = start + tap * k.dilation
                total += weight * x[at][sensor] if 0 <= at < steps else 0.0
        outputs.append(total)
    return sum(o > 0 for o in outputs) / len(outputs), max(outputs)


@pytest.mark.parametrize("steps,sensors", [(20, 2), (60, 6), (9, 1), (3, 2), (1, 1)])
def test_convolution_by_hand(steps, sensors):
    kernels = KN.draw_kernels(40, steps, sensors, seed=steps)
    x = np.random.default_rng(steps).normal(size=(5, steps, sensors))
    got = KN.convolve(x.transpose(0, 2, 1), kernels)
    for row in range(5):
        want = [v for k in kernels for v in by_hand(x[row], k)]
        assert np.allclose(got[row], want)
    assert kernels == KN.draw_kernels(40, steps, sensors, seed=steps)


def _sequences(spark, n=600, steps=20):
    """Remaining life follows how fast the first sensor swings; its level and
    the second sensor say nothing."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        speed = rng.uniform(0.2, 2.5)
        a = 50 + np.sin(speed * np.arange(steps) + rng.uniform(0, 6)) + rng.normal(size=steps) * 0.05
        x = np.stack([a, rng.normal(size=steps)], axis=1)
        rows.append((i, *map(float, x.ravel()), float(40 * speed)))
    cols = [f"s{t}_f{j}" for t in range(steps) for j in range(2)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in cols) + ", target double"), cols


def test_sequence_model_is_compared_staged_and_loaded(spark):
    df, cols = _sequences(spark)
    train, test = df.filter("id < 450"), df.filter("id >= 450")
    specs = [MD.ModelSpec("forest", "rf", {"numTrees": 10, "maxDepth": 5, "seed": 1}),
             MD.ModelSpec("kernels", "kernels", {"kernels": 100, "seed": 1})]
    models, metrics = MD.compare_regressors(train, test, cols, "target", specs, n_sensors=2)
    rmse = {r["model"]: r["rmse"] for r in metrics.collect()}
    assert rmse["kernels"] < 0.5 * rmse["forest"] and rmse["kernels"] < 8
    runs = IO.scratch_path(spark, "runs")
    MD.register(spark, runs, "life", models, metrics, "rmse", maximize=False)
    assert IO.staged(spark, runs, "life", "Staging")["params"]["model"] == "kernels"
    loaded = MD.load_regressor(spark, runs, "life", "Staging")
    both = [m.transform(MD.assemble(test, cols)).orderBy("id").select("prediction").collect()
            for m in (models["kernels"], loaded)]
    assert both[0] == both[1] and len(both[0]) == 150


def test_scales_and_missing_values(spark):
    rows = [(1.0, 5.0, 3.0, None), (None, 5.0, float("nan"), 5.0), (2.0, 5.0, 2.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    mean, deviation = KN.sensor_scales(df, ["a", "b", "c", "d"], 2)
    assert mean == [2.0, 5.0] and deviation == [pytest.approx(math.sqrt(0.5)), 1.0]
    assert KN.sensor_scales(df.filter("false"), ["a", "b", "c", "d"], 2) == ([0.0, 0.0], [1.0, 1.0])
    model = KN.SequenceModel(KN.draw_kernels(3, 2, 2, 1), mean, deviation)
    out = model.features(MD.assemble(df, ["a", "b", "c", "d"]), "k").select("k").collect()
    assert len(out) == 3 and all(np.isfinite(r["k"].toArray()).all() for r in out)


def test_rows_without_target_are_left_out(spark):
    df, cols = _sequences(spark, 60)
    some = MD.assemble(df.withColumn("target", F.when(F.col("id") < 40, F.col("target"))), cols)
    a = KN.fit_sequences(some, cols, "target", 2, kernels=5)
    b = KN.fit_sequences(some.filter("id < 40"), cols, "target", 2, kernels=5)
    assert np.allclose(a.ridge.coefficients.toArray(), b.ridge.coefficients.toArray())
