"""Isolation forest and Tree SHAP properties."""

import threading

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from rivet.plans import explain as EX
from rivet.plans import iforest as IF
from rivet.plans import models as MD
from rivet.plans.models import assemble, positive_probability
from rivet.sources.io import scratch_path


def test_isolation_forest_contamination_and_outliers(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(0, 1, (3000, 3))
    rows = [(i, *map(float, x)) for i, x in enumerate(X)]
    rows += [(10_000 + i, 8.0 + i, -8.0, 8.0) for i in range(5)]  # planted outliers
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    cols = ["a", "b", "c"]
    normal = df.filter(F.col("id") < 10_000)
    nodes = IF.fit(normal, cols, ["id"], n_trees=50)
    assert nodes.select("tree_id").distinct().count() == 50
    s = IF.score(normal, nodes, cols, ["id"])
    thr = IF.threshold(s, 0.1)
    rate = s.agg(F.avg((F.col("anomaly_score") > thr).cast("double"))).first()[0]
    assert abs(rate - 0.1) < 0.02
    top = IF.score(df, nodes, cols, ["id"]).orderBy(F.col("anomaly_score").desc()).limit(5).collect()
    assert {r["id"] for r in top} == {10_000 + i for i in range(5)}


def test_tree_shap_additivity(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(0, 1, (600, 4))
    y = ((X[:, 0] + 0.5 * X[:, 1] * X[:, 2]) > 0).astype(int)
    df = spark.createDataFrame([(i, int(t), *map(float, x)) for i, (x, t) in enumerate(zip(X, y))],
                               "id long, label int, a double, b double, c double, d double")
    cols = ["a", "b", "c", "d"]
    rf = RandomForestClassifier(numTrees=8, maxDepth=5, seed=1).fit(
        assemble(df, cols).withColumn("label", F.col("label").cast("double")))
    path = scratch_path(spark, "test-rf")
    rf.write().overwrite().save(path)
    rows = positive_probability(rf, df, cols).select("id", "score", *cols)
    shap = EX.shap_values(EX.tree_nodes(spark, path), rows, cols, "id", rf.getNumTrees)
    tot = {r["id"]: r["s"] for r in shap.groupBy("id").agg(F.sum("shap").alias("s")).collect()}
    assert len(tot) == 600
    for r in rows.collect():
        assert abs(tot[r["id"]] - r["score"]) < 1e-9
    few = EX.shap_values(EX.tree_nodes(spark, path), rows, cols, "id", rf.getNumTrees, sample=7)
    assert few.select("id").distinct().count() == 7
    imp = {r["feature"]: r["mean_abs_shap"] for r in EX.global_importance(shap, 4).collect()}
    assert max(imp, key=imp.get) == "a"


def test_every_tree_has_its_own_full_sample(spark):
    """Roots count 256 rows each, also where rows are fewer than trees times 256."""
    for n, size in ((5000, 256), (100, 100)):
        df = spark.range(n).select("id", (F.col("id") * 7 % 101).cast("double").alias("a"))
        roots = IF.fit(df, ["a"], ["id"], n_trees=40).filter("node_id = 0")
        assert [r["size"] for r in roots.collect()] == [size] * 40


def _labelled(spark, n=400):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (n, 2))
    return spark.createDataFrame([(i, int(a + 0.3 * b > 0), float(a), float(b)) for i, (a, b) in enumerate(x)],
                                 "id long, label int, a double, b double")


def test_log_promote_and_load_classifiers(spark):
    from rivet.operators import metrics as M
    from rivet.plans import models as MD
    from rivet.sources import io as IO
    df = _labelled(spark)
    train, test = df.filter("id < 300"), df.filter("id >= 300")
    specs = [MD.ModelSpec("stump", "rf", {"numTrees": 1, "maxDepth": 1, "seed": 1}),
             MD.ModelSpec("forest", "rf", {"numTrees": 10, "maxDepth": 6, "seed": 1}),
             MD.ModelSpec("boosted", "boosted", {"rounds": 5, "depth": 3, "rate": 0.3}, "pos_ratio")]
    runs = scratch_path(spark, "runs")
    assert IO.read_runs(spark, runs) is None
    MD.log_classifiers(spark, runs, "risk", specs, train, test, ["a", "b"], "label", "id")
    logged = {r["version"]: r for r in IO.read_runs(spark, runs).collect()}
    assert [logged[v]["params"]["model"] for v in (1, 2, 3)] == [s.name for s in specs]
    models = {}
    for r in logged.values():  # the grouped pass agrees with one model at a time, loaded from its artifact
        models[r["params"]["model"]] = m = MD.load_classifier(spark, r["path"], r["params"]["kind"])
        scored = MD.positive_probability(m, test, ["a", "b"])
        one = M.binary_metrics(scored, "label", "pred", "score").first()
        for c in ("precision", "recall", "f1", "roc_auc"):
            assert abs(one[c] - r["metrics"][c]) < 1e-12
        written = spark.read.parquet(r["params"]["scores"]).select("id", "label", "pred", "score")
        assert sorted(map(tuple, written.collect())) == sorted(map(tuple, scored.select("id", "label", "pred", "score").collect()))
    IO.promote(spark, runs, "risk", "f1")
    table = {r["version"]: r for r in IO.read_runs(spark, runs).collect()}
    staged = [r for r in table.values() if r["stage"] == "Staging"]
    assert len(staged) == 1 and staged[0]["metrics"]["f1"] == max(r["metrics"]["f1"] for r in table.values())
    run = IO.staged(spark, runs, "risk", "Staging")
    loaded = MD.load_classifier(spark, run["path"], run["params"]["kind"])
    a, b = (sorted(map(tuple, MD.positive_probability(m, test, ["a", "b"]).select("id", "score").collect()))
            for m in (loaded, models[run["params"]["model"]]))
    assert a == b
    try:
        IO.staged(spark, runs, "risk", "Production")
        raise AssertionError("no run is in Production")
    except LookupError:
        pass


def test_compare_regressors_stages_least_rmse(spark):
    from rivet.plans import models as MD
    from rivet.sources import io as IO
    df = _labelled(spark).withColumn("y", 3 * F.col("a") + 10)
    specs = [MD.ModelSpec("flat", "rf", {"numTrees": 1, "maxDepth": 1, "seed": 1}, "none"),
             MD.ModelSpec("deep", "rf", {"numTrees": 10, "maxDepth": 8, "seed": 1}, "none")]
    models, metrics = MD.compare_regressors(df.filter("id < 300"), df.filter("id >= 300"), ["a", "b"], "y", specs)
    runs = scratch_path(spark, "rul-runs")
    MD.register(spark, runs, "life", models, metrics, "rmse", maximize=False)
    assert IO.read_runs(spark, runs).filter("stage = 'Staging'").first()["params"]["model"] == "deep"
    pred = IO.load_model(spark, runs, "life", "Staging").transform(MD.assemble(df, ["a", "b"]))
    assert pred.agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 1.0


def test_als_embeddings_rank_seen_actions_first(spark):
    from rivet.operators.recommend import vector_top_k
    from rivet.plans.models import als_embeddings
    long = spark.createDataFrame([(f"m{i % 2}", f"a{i % 2}{j}", 20) for i in range(2) for j in range(3)],
                                 "failure_mode string, action string, cnt long")
    uf, itf = als_embeddings(long, rank=4)
    top = vector_top_k(uf, itf, 3, "failure_mode", "action").collect()
    assert {(r["failure_mode"], r["action"][1]) for r in top} == {("m0", "0"), ("m1", "1")}


def test_vector_top_k_in_blocks(spark):
    from rivet.operators.recommend import vector_top_k
    rng = np.random.default_rng(3)
    q = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(40)], "q int, vector array<double>")
    v = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(100)], "i int, vector array<double>")
    one, many = (sorted(map(tuple, vector_top_k(q, v, 3, "q", "i", block_bytes=b).collect())) for b in (1 << 20, 500))
    assert one == many and len(one) == 120


def test_newest_snapshot_and_json_object(spark):
    from rivet.sources import io as IO
    path = scratch_path(spark, "snap")
    for ts, n in (("20240101_000000", 3), ("20240203_000000", 5)):
        IO.write_snapshot(spark.range(n), path, ts)
    assert IO.latest_snapshot(spark, path).count() == 5
    obj = scratch_path(spark, "limits")
    spark.createDataFrame([('{\n "pipeline_capacity_bpd": 5.5,\n "compressor_capacity_bpd": 4.0\n}',)], "value string"
                          ).coalesce(1).write.text(obj, lineSep="\n")
    got = IO.read_json_object(spark, obj, "pipeline_capacity_bpd double, compressor_capacity_bpd double").collect()
    assert [tuple(r) for r in got] == [(5.5, 4.0)]


def test_forest_groups_leave_an_executor_room(spark, monkeypatch):
    """Four tasks' sums of a group stay below a third of a 6 GB heap, and no
    node id per row and tree is kept."""
    seen = {}

    class Forest:
        def __init__(self, **params):
            seen.update(params)

        def fit(self, df):
            return df.count()
    monkeypatch.setattr(MD, "RandomForestClassifier", Forest)
    df = spark.createDataFrame([(i % 2, float(i)) for i in range(6)], "y int, a double")
    assert MD.fit_classifier(MD.CLASSIFIERS[0], df, ["a"], "y") == 6
    assert 4 * seen["maxMemoryInMB"] <= 2048 and not seen["cacheNodeIds"]
    assert seen["numTrees"] == 200 and seen["maxDepth"] == 12


def test_regressors_are_fitted_side_by_side(spark, monkeypatch):
    meet = threading.Barrier(3, timeout=20)

    class Model:
        def __init__(self, at):
            self.at = at

        def transform(self, df):
            return df.withColumn("prediction", F.lit(self.at))

    def learner(at):
        class Learner:
            def __init__(self, **params):
                pass

            def fit(self, df):
                meet.wait()
                return Model(at)
        return Learner
    monkeypatch.setattr(MD, "GBTRegressor", learner(1.0))
    monkeypatch.setattr(MD, "RandomForestRegressor", learner(2.0))
    monkeypatch.setattr(MD, "fit_sequences", lambda *a, **k: learner(3.0)().fit(None))
    df = spark.createDataFrame([(float(i), 4.0) for i in range(6)], "a double, y double")
    models, metrics = MD.compare_regressors(df, df, ["a"], "y")
    assert list(models) == [s.name for s in MD.REGRESSORS]
    assert [r["rmse"] for r in metrics.orderBy("ord").collect()] == [3.0, 2.0, 1.0]
