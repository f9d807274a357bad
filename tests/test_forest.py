"""The random forest by levels: exact sums, rules, edges, artifacts."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivet.operators import metrics as M
from rivet.plans import explain as EX
from rivet.plans import forest as FO
from rivet.plans import models as MD
from rivet.sources import io as IO


def _frame(spark, n=6000, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5)).round(2)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.5, n) > 0.4).astype(int)
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "y": y, **{c: x[:, i] for i, c in enumerate("abcde")}}))


def test_poisson_draws():
    d = np.concatenate([FO.draws(7, 3, b, 50_000) for b in range(4)])
    assert abs(d.mean() - 1) < 0.01 and abs(d.var() - 1) < 0.02 and abs((d == 0).mean() - np.exp(-1)) < 0.005
    assert (FO.draws(7, 3, 2, 100) == d[100_000:100_100]).all() and (FO.draws(7, 4, 2, 100) != d[100_000:100_100]).any()


def test_best_cut_equals_all_cuts():
    """Against every cut of every look by the Gini formula; no gain, no cut."""
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 4, (3, 6, FO.FOREST_BINS, 2)).astype(np.uint64)
    counts[:, 4] = 0
    counts[:, 5, :, 1] = 0  # one class
    weight = (0.7, 1.9)
    look, cut, sides = FO.best_cuts(counts, weight)

    def impure(c):
        c = c * np.array(weight)
        return c.sum() * (1 - ((c / c.sum()) ** 2).sum())
    for node in range(4):
        best = max(((impure(counts[j, node].sum(axis=0)) - impure(counts[j, node, :b + 1].sum(axis=0)) - impure(counts[j, node, b + 1:].sum(axis=0)))
                    / (counts[j, node].sum(axis=0) * np.array(weight)).sum(), j, b) for j in range(3) for b in range(FO.FOREST_BINS - 1)
                   if counts[j, node, :b + 1].sum() and counts[j, node, b + 1:].sum())
        assert (look[node], cut[node]) == best[1:]
        assert (sides[node] == np.concatenate([counts[best[1], node, :best[2] + 1].sum(axis=0), counts[best[1], node, best[2] + 1:].sum(axis=0)])).all()
    assert (look[4:] == -1).all()


def test_forest_in_blocks_counts_every_drawn_row(spark, monkeypatch):
    """Small blocks and chunks: node counts of a parent are those of its
    children, the root has all draws, pairs of leaves that predict alike are one."""
    monkeypatch.setattr(FO, "BLOCK_ROWS", 500)
    monkeypatch.setattr(FO, "CHUNK_ROWS", 1000)
    monkeypatch.setattr(FO, "GROUP_NODES", 4)
    df, weight = _frame(spark).repartition(3), (0.5, 2.0)
    model = FO.ForestModel(FO.fit_forest(df, list("abcde"), "y", weight, 5, 6, 1))
    nodes = model.nodes().toPandas()
    for _, tree in nodes.groupby("tree_id"):
        at = tree.set_index("node_id")
        root = at.loc[0, "stats"]
        assert abs(root[0] / weight[0] + root[1] / weight[1] - 6000) < 400  # draws
        for _, r in at[at["left"] >= 0].iterrows():
            kids = [at.loc[r[c]] for c in ("left", "right")]
            np.testing.assert_allclose(np.sum([k["stats"] for k in kids], axis=0), r["stats"])
            assert any(k["left"] >= 0 for k in kids) or len({k["stats"][1] > k["stats"][0] for k in kids}) == 2
        assert at.index.max() > 30
    rows = model.score(df, list("abcde")).select("id", "y", "pred", "score")
    assert M.binary_metrics(rows, "y", "pred", "score").first()["roc_auc"] > 0.85
    shap = EX.shap_values(model.nodes(), df, list("abcde"), "id", 5).groupBy("id").agg(F.sum("shap").alias("s"))
    assert rows.join(shap, "id").filter("abs(score - s) > 1e-9 or (score > 0.5) != (pred = 1)").isEmpty() and shap.count() == 6000


def test_large_tables_take_the_forest_by_levels(spark):
    """As good as MLlib's on the same rows, and logged, loaded and scored as such."""
    df = _frame(spark)
    train, test = df.filter("id < 4000"), df.filter("id >= 4000")
    spec = MD.ModelSpec("forest", "rf", {"numTrees": 20, "maxDepth": 6, "seed": 3})
    models = [MD.fit_classifier(spec, train, list("abcde"), "y", n) for n in (4000, 3999)]
    assert not isinstance(models[0], MD.ForestModel) and isinstance(models[1], MD.ForestModel)
    small, large = (M.binary_metrics(MD.positive_probability(m, test, list("abcde")), "y", "pred", "score").first() for m in models)
    assert abs(small["roc_auc"] - large["roc_auc"]) < 0.02 and abs(small["f1"] - large["f1"]) < 0.05
    assert abs(models[0].totalNumNodes / models[1].nodes().count() - 1) < 0.15


def test_forest_artifact_is_logged_by_its_kind(spark, monkeypatch):
    df = _frame(spark, 400)
    monkeypatch.setattr(MD.fit_classifier, "__defaults__", (100,))
    runs = IO.scratch_path(spark, "runs")
    MD.log_classifiers(spark, runs, "risk", [MD.ModelSpec("forest", "rf", {"numTrees": 3, "maxDepth": 4, "seed": 1})],
                       df, df, list("abcde"), "y", "id")
    run = IO.read_runs(spark, runs).first()
    model = MD.load_classifier(spark, run["path"], run["params"]["kind"])
    assert isinstance(model, MD.ForestModel) and model.getNumTrees == 3
    a = spark.read.parquet(run["params"]["scores"]).select("id", "score")
    assert a.exceptAll(model.score(df, list("abcde")).select("id", "score")).isEmpty() and a.count() == 400


def test_forest_edges(spark):
    """Nulls and NaN count as highest, constants and one class give leaves; no rows and null labels raise."""
    rows = [(i, i % 2, float("nan") if i % 2 else None if i % 4 else 1.0, 3.0, None) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, c double")
    model = FO.ForestModel(FO.fit_forest(df, ["a", "b", "c"], "y", (1.0, 1.0), 4, 3, 1))
    assert model.score(df, ["a", "b", "c"]).filter("score is null or score < 0 or score > 1").isEmpty()
    one = FO.ForestModel(FO.fit_forest(df.withColumn("y", F.lit(1)), ["a", "b"], "y", (1.0, 1.0), 2, 3, 1))
    assert [r["score"] for r in one.score(df, ["a", "b"]).select("score").distinct().collect()] == [1.0]
    assert one.nodes().count() == 2
    for bad in (df.limit(0), df.withColumn("y", F.when(F.col("id") > 3, F.col("y")))):
        with pytest.raises(ValueError):
            FO.fit_forest(bad, ["a", "b"], "y", (1.0, 1.0), 2, 3, 1)
