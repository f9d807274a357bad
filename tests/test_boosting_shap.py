"""Histogram boosting, path-table SHAP and the forest's draws against brute force."""

from itertools import permutations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from rivet.plans import boosting as B
from rivet.plans import explain as EX
from rivet.plans import iforest as IF
from rivet.plans.models import assemble
from rivet.sources.io import scratch_path

LEAF = B.Growth(rounds=3, leaves=7, depth=6, l2=0.0, min_hessian=1e-3, min_rows=5)
LEVEL = B.Growth(rounds=3, depth=3)


def table(n=300, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(1)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.3, n)) > 0).astype(int)
    return x, y, rng.choice([1.0, 2.0], n)


def by_hand(x, y, w, grow):
    """Trees as (rows of each leaf, value), every split searched row by row."""
    start = np.log((y * w).sum() / ((1 - y) * w).sum())
    raw, trees = np.full(len(y), start), []
    for _ in range(grow.rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = w * (p - y), w * p * (1 - p)

        def score(i):
            return g[i].sum() ** 2 / (h[i].sum() + grow.l2)

        def best(i, depth):
            if depth >= grow.depth:
                return None
            found = None
            for f in range(x.shape[1]):
                for cut in np.unique(x[:, f])[:-1]:
                    a, b = i[x[i, f] <= cut], i[x[i, f] > cut]
                    if min(len(a), len(b)) < grow.min_rows or min(h[a].sum(), h[b].sum()) < grow.min_hessian:
                        continue
                    gain = score(a) + score(b) - score(i)
                    if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                        found = gain, a, b
            return found
        leaves = [(np.arange(len(y)), 0)]
        while True:
            open_ = [(k, best(i, d)) for k, (i, d) in enumerate(leaves)]
            open_ = [(k, b) for k, b in open_ if b]
            if not open_ or (grow.leaves and len(leaves) >= grow.leaves):
                break
            if grow.leaves:
                open_ = [max(open_, key=lambda kb: kb[1][0])]
            leaves = [x for k, leaf in enumerate(leaves) for x in next(
                ([(b[1], leaf[1] + 1), (b[2], leaf[1] + 1)] for j, b in open_ if j == k), [leaf])]
        for i, _ in leaves:
            raw[i] += -grow.rate * g[i].sum() / (h[i].sum() + grow.l2)
        trees.append(sorted(tuple(i) for i, _ in leaves))
    return raw, trees


def frame(spark, x, y, w):
    rows = [(i, int(a), float(b), *map(float, v)) for i, (v, a, b) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(rows, "id long, y int, w double, a double, b double, c double").repartition(3)


@pytest.mark.parametrize("grow", [LEAF, LEVEL], ids=["leaf-wise", "level-wise"])
def test_boosting_equals_brute_force_split_search(spark, grow):
    x, y, w = table()
    want, trees = by_hand(x, y, w, grow)
    df = frame(spark, x, y, w)
    model = B.BoostedModel(B.fit_boosted(df, ["a", "b", "c"], "y", "w", grow))
    path = scratch_path(spark, "boosted")
    model.save(path)
    got = B.BoostedModel.load(spark, path).score(df, ["a", "b", "c"]).orderBy("id").toPandas()
    np.testing.assert_allclose(got["score"], 1 / (1 + np.exp(-want)), rtol=1e-9)
    assert (got["pred"] == (want > 0)).all()
    leaves = model.nodes.filter("tree >= 0 and feature < 0").groupBy("tree").count().orderBy("tree").collect()
    assert [r["count"] for r in leaves] == [len(t) for t in trees]


def test_boosting_by_aggregates_grows_the_same_trees(spark):
    """The table path, one Spark aggregate per split round, against the rows
    of one task; and the two growth orders differ."""
    x, y, w = table(500, 4)
    df, cols = frame(spark, x, y, w), ["a", "b", "c"]
    grown = {}
    for name, grow in (("leaf", B.Growth(rounds=2, leaves=6, l2=0.0, min_rows=5)), ("level", B.Growth(rounds=2, depth=3))):
        local, spread = (B.fit_boosted(df, cols, "y", "w", grow, local_rows=n).toPandas().sort_values(["tree", "node"])
                         for n in (10_000, 10))
        # nodes are numbered in the order of the tree, so equal trees are equal tables
        pd.testing.assert_frame_equal(local.reset_index(drop=True), spread.reset_index(drop=True), rtol=1e-9)
        grown[name] = local
    assert len(grown["leaf"]) != len(grown["level"])


def test_boosting_sums_no_rows_at_full_depth():
    """Values at full depth come from the parent's bins: one round less a tree."""
    x, y, w = table(400, 7)
    bins = B.binned(x, [sorted(set(c)) for c in x.T])
    asked = []

    class Rows(B.ArrayRows):
        together = True

        def histograms(self, tree, nodes):
            asked.append({tree.depth[n] for n in nodes})
            return super().histograms(tree, nodes)
    grow = B.Growth(rounds=1, depth=3)
    rows = Rows(bins, y, w, 0.0)
    g, h = rows.g, rows.h
    tree = B.grow_tree(rows, grow)
    assert asked == [{0}, {1}, {2}]
    assert 3 in tree.depth
    for node, i in tree.places(bins).items():
        assert abs(tree.value[node] + grow.rate * g[i].sum() / (h[i].sum() + grow.l2)) < 1e-12


def test_leaf_wise_growth_needs_a_round_a_depth():
    """Nodes below nodes not taken yet are split ahead; the tree stays that of
    one split at a time."""
    x, y, w = table(2000, 9)
    bins = B.binned(x, [sorted(set(c)) for c in x.T])
    asked = []

    class Rows(B.ArrayRows):
        together = True

        def histograms(self, tree, nodes):
            asked.append(len(nodes))
            return super().histograms(tree, nodes)
    grow = B.Growth(rounds=1, depth=6, leaves=31, l2=0.0, min_hessian=1e-3, min_rows=5)
    ahead, alone = (B.grow_tree(rows(bins, y, w, 0.0), grow) for rows in (Rows, B.ArrayRows))
    assert len(asked) <= grow.depth + 1 and sum(asked) < 2 ** grow.depth
    a, b = (B._node_rows([t], [list(range(256))] * 3) for t in (ahead, alone))
    pd.testing.assert_frame_equal(a, b, rtol=1e-9)
    assert (a["feature"] < 0).sum() == 31


def test_kept_scores_equal_scores_from_the_start(monkeypatch):
    """A block's scores go on from any tree this process knows, and from the
    stored ones where it knows more or less; the rows kept are bounded."""
    x, y, w = table(300, 11)
    rows = B.ArrayRows(B.binned(x, [sorted(set(c)) for c in x.T]), y, w, 0.1)
    trees = B.boost(rows, B.Growth(rounds=5, depth=3))
    block = {"block": 4, "n": 300, "bins": rows.bins.tobytes(), "y": y.astype(float).tobytes(), "w": w.tobytes()}
    raws = [np.full(300, 0.1)]
    for t in trees:
        raws.append(raws[-1] + t.scores(rows.bins))
    np.testing.assert_array_equal(raws[-1], rows.raw)
    monkeypatch.setattr(B, "_kept", type(B._kept)())
    for done, upto in ((0, 1), (0, 4), (0, 4), (2, 5), (0, 2), (3, 3), (0, 5)):
        bins, raw, g, h = B._scored("m", done, trees[done:upto], {**block, "raw": raws[done].tobytes()})
        np.testing.assert_array_equal(raw, raws[upto])
        np.testing.assert_array_equal(g, B._gradients(y, w, raws[upto])[0])
        assert (bins == rows.bins).all()
    monkeypatch.setattr(B, "KEPT_ROWS", 700)
    for k in range(5):
        B._scored("m", 0, trees, {**block, "block": k, "raw": raws[0].tobytes()})
    assert [k[1] for k in B._kept] == [3, 4]


def test_boosting_edges(spark):
    rows = [(i, i % 2, 1.0, float("nan") if i % 5 == 0 else float(i % 7), 3.0, None) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, y int, w double, a double, b double, c double")
    model = B.BoostedModel(B.fit_boosted(df, ["a", "b", "c"], "y", "w", B.Growth(rounds=2)))
    assert model.score(df, ["a", "b", "c"]).filter("score is null or score < 0 or score > 1").isEmpty()
    with pytest.raises(ValueError):
        B.fit_boosted(df.limit(0), ["a"], "y", "w", B.Growth(rounds=1))


def shapley_by_hand(nodes, x, n_features):
    """Mean marginal contribution over all orders of the features."""
    rows = {int(r["node_id"]): r for r in nodes}

    def expected(node, known):
        r = rows[node]
        if r["left"] < 0:
            return r["stats"][1] / sum(r["stats"])
        if r["feature"] in known:
            return expected(r["left"] if x[r["feature"]] <= r["threshold"] else r["right"], known)
        share = [sum(rows[c]["stats"]) for c in (r["left"], r["right"])]
        return sum(s * expected(c, known) for s, c in zip(share, (r["left"], r["right"]))) / sum(share)
    phi, orders = np.zeros(n_features), list(permutations(range(n_features)))
    for order in orders:
        known = set()
        for f in order:
            before = expected(0, known)
            known = known | {f}
            phi[f] += expected(0, known) - before
    return phi / len(orders)


@pytest.mark.parametrize("rows_used", [3, 200], ids=["by row", "by pattern"])
def test_path_table_shap_equals_shapley_values(spark, rows_used):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 4)).round(2)
    y = ((x[:, 0] * x[:, 1] + x[:, 2]) > 0).astype(int)
    df = spark.createDataFrame([(i, float(t), *map(float, v)) for i, (t, v) in enumerate(zip(y, x))],
                               "id long, label double, a double, b double, c double, d double")
    cols = ["a", "b", "c", "d"]
    model = RandomForestClassifier(numTrees=4, maxDepth=5, seed=2).fit(assemble(df, cols))
    path = scratch_path(spark, "forest")
    model.write().save(path)
    nodes = EX.tree_nodes(spark, path)
    packed = [(bytes(r["packed"]), r["paths"]) for r in EX.tree_paths(nodes).collect()]
    phi, base = EX.explain_paths(x[:rows_used], packed, 4)
    trees = {}
    for r in nodes.collect():
        trees.setdefault(r["tree_id"], []).append(r)
    for i in range(3):
        np.testing.assert_allclose(phi[i], sum(shapley_by_hand(t, x[i], 4) for t in trees.values()), atol=1e-9)
    shap = EX.shap_values(nodes, df, cols, "id", 4).groupBy("id").agg(F.sum("shap").alias("s"))
    scored = model.transform(assemble(df, cols)).join(shap, "id").select("probability", "s").collect()
    assert max(abs(r["probability"][1] - r["s"]) for r in scored) < 1e-6


def test_shap_tables_and_places(monkeypatch):
    """Tables of patterns against the sums by row, at ends, for NaN and for a
    ratio of 0; a path's table is made once for all rows of a call."""
    inf, nan = np.inf, np.nan
    paths = [(0.7, [(0, -inf, 1.0, 0.3), (1, 0.0, 2.0, 0.0), (2, -1.0, inf, 0.9)]), (0.2, [(1, 2.0, inf, 0.4)]), (0.5, []),
             (0.9, [(0, 1.0, 1.0, 0.5), (2, -inf, -1.0, 0.25)])]  # an empty interval
    packed = [(EX._pack(paths[:2]), 2), (EX._pack(paths[2:]), 2)]
    x = np.array([[a, b, c] for a in (0.0, 1.0, 1.5, nan) for b in (0.0, 2.0, 2.5) for c in (-1.0, -0.5)])
    made = []
    table = EX._by_pattern
    monkeypatch.setattr(EX, "_by_pattern", lambda *a: made.append(len(a[0])) or table(*a))
    phi, base = EX.explain_paths(x, packed, 3)
    assert sum(made) == 3
    alone = np.vstack([EX.explain_paths(row[None], packed, 3)[0] for row in x])  # one row: by row
    np.testing.assert_allclose(phi, alone, atol=1e-12)

    def pays(row):
        return sum(v for v, c in paths if all(low < row[f] <= high for f, low, high, _ in c))
    np.testing.assert_allclose(base + phi.sum(axis=1), [pays(row) for row in x], atol=1e-12)


def _random_paths(rng, depth, n_features, low=-np.inf):
    """Paths of a tree that cuts at random quarters, with random ratios."""
    out = []

    def grow(d, conditions):
        if d == depth or rng.random() < 0.1:
            out.append((rng.random(), [(f, *c) for f, c in conditions.items()]))
            return
        f, t = int(rng.integers(n_features)), rng.integers(-6, 7) / 4
        low, high, ratio = conditions.get(f, (-np.inf, np.inf, 1.0))
        share = rng.random()
        grow(d + 1, {**conditions, f: (low, min(high, t), ratio * share)})
        grow(d + 1, {**conditions, f: (max(low, t), high, ratio * (1 - share))})
    grow(0, {})
    return out


@pytest.mark.parametrize("nan", [False, True])
def test_shap_tables_of_several_paths(monkeypatch, nan):
    """Paths that follow each other share a table of bounded size; rows get the
    sums by row, at chunk ends, for places that no row has and for NaN."""
    rng = np.random.default_rng(12)
    trees = [_random_paths(rng, 7, 6) for _ in range(3)]
    packed = [(EX._pack(p), len(p)) for p in trees]
    x = (rng.normal(size=(700, 6)) * 4).round() / 4
    x[:, 5] = 0.25  # one place only
    x[:, 4] = np.where(x[:, 4] < -0.5, -1.5, np.where(x[:, 4] < 0.5, 0.0, 1.5))  # places with gaps
    if nan:
        x[rng.random(x.shape) < 0.05] = np.nan
    monkeypatch.setattr(EX, "TABLE", 256)
    monkeypatch.setattr(EX, "TABLES", 3)
    monkeypatch.setattr(EX, "CHUNK", 256)
    tables, table = [], EX._table
    monkeypatch.setattr(EX, "_table", lambda *a: tables.append(table(*a)) or tables[-1])
    phi, base = EX.explain_paths(x, packed, 6)
    assert max(t.shape[1] for t in tables) <= 256 and len(tables) < sum(map(len, trees)) / 2
    alone = np.vstack([EX.explain_paths(row[None], packed, 6)[0] for row in x])  # one row: by row
    np.testing.assert_allclose(phi, alone, atol=1e-12)


def test_shap_moves_a_row_a_key_not_one_a_feature(spark, monkeypatch):
    """Several parts and groups of trees: the same sums, and what is summed
    per key is one row a group, whatever the number of features."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 3)).round(1)
    df = spark.createDataFrame([(i, float(v[0] > v[1]), *map(float, v)) for i, v in enumerate(x)], "id long, label double, a double, b double, c double")
    model = RandomForestClassifier(numTrees=5, maxDepth=4, seed=2).fit(assemble(df, ["a", "b", "c"]))
    path = scratch_path(spark, "forest")
    model.write().save(path)
    nodes = EX.tree_nodes(spark, path)
    one = EX.shap_values(nodes, df, ["a", "b", "c"], "id", 5).orderBy("id", "feature").toPandas()
    monkeypatch.setattr(EX, "ROWS_PER_TASK", 300)
    shap = EX.shap_values(nodes, df, ["a", "b", "c"], "id", 5)
    pd.testing.assert_frame_equal(one, shap.orderBy("id", "feature").toPandas(), atol=1e-12)
    plan = shap._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate") < plan.index("MapInPandas")
    assert shap.columns == ["id", "feature", "shap"] and shap.count() == 900 * 4


def test_shap_of_repeated_and_null_keys(spark):
    """Any number of tree groups gives the same sums for a key."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 2)).round(1)
    rows = [(None if i % 50 == 0 else i // 2, float(v[0] + v[1] > 0), *map(float, v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, label double, a double, b double").repartition(5)
    model = RandomForestClassifier(numTrees=3, maxDepth=4, seed=2).fit(assemble(df, ["a", "b"]))
    path = scratch_path(spark, "forest")
    model.write().save(path)
    few, many = (EX.shap_values(EX.tree_nodes(spark, path), df, ["a", "b"], "id", 3, tree_groups=g)
                 .orderBy("id", "feature").toPandas() for g in (1, 32))
    pd.testing.assert_frame_equal(few, many, atol=1e-12)
    assert len(few) == 3 * (df.select("id").distinct().count())
    want = model.transform(assemble(df, ["a", "b"])).select("id", "probability").collect()
    got = few.fillna({"id": -1}).groupby("id")["shap"].sum()
    by_id = {}
    for r in want:
        k = -1 if r["id"] is None else r["id"]
        by_id[k] = by_id.get(k, 0.0) + r["probability"][1]
    assert all(abs(got[k] - v) < 1e-9 for k, v in by_id.items())


def test_forest_draws_from_the_whole_table(spark):
    """Every row of a table far above the old pool can be drawn; trees get
    their rows, reruns agree."""
    df = spark.range(100_000).select("id", F.col("id").cast("double").alias("x"))
    drawn = IF.candidates(df, ["id"], ["id", "x"], 100_000, 256, 200, 42)
    per = drawn.groupBy("tree_id").count().collect()
    assert len(per) == 200 and all(400 < r["count"] < 760 for r in per)
    seen = drawn.select("id").distinct()
    assert seen.count() > 60_000  # 200 x 576 draws of 100,000 rows
    low, high = (seen.filter(c).count() for c in ("id < 50000", "id >= 50000"))
    assert abs(low - high) < 2000
    again = IF.candidates(df.repartition(7), ["id"], ["id", "x"], 100_000, 256, 200, 42)
    assert drawn.exceptAll(again).isEmpty()
    small = IF.candidates(df.limit(300), ["id"], ["id", "x"], 300, 256, 5, 42)
    assert small.count() == 1500  # all rows are candidates where the trees need most of them


def test_forest_walk_equals_node_by_node():
    """Rows of several walks at once against one row and node at a time, NaN and a tree of one node included."""
    rng = np.random.default_rng(6)
    grown = [IF._grow(rng.normal(size=(n, 3)).round(1), rng, 5) for n in (40, 1, 64)]
    nd = pd.concat([pd.DataFrame({"tree_id": t, **dict(zip(("feature", "threshold", "left_child", "right_child", "size"), zip(*g)))})
                    for t, g in enumerate(grown)])
    x = rng.normal(size=(IF.WALK_ROWS + 10, 3)).round(1)
    x[3, 1] = np.nan

    def length(row, tree):
        node, depth = 0, 0.0
        while tree[node][0] >= 0:
            f, threshold, left, right, _ = tree[node]
            node, depth = (left if row[f] < threshold else right), depth + 1
        return depth + float(IF.avg_path([tree[node][4]])[0])
    forest, c = IF._packed(nd)
    assert c == IF.avg_path([64])[0]
    got = IF._path_lengths(x, forest)
    for i in [*range(50), len(x) - 1]:
        assert abs(got[i] - sum(length(x[i], g) for g in grown)) < 1e-12
