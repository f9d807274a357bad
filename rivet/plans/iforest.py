"""Isolation forest as a Spark job.

Fit: every tree draws its own ``max_samples`` rows from the whole table by
seeded hashes (no ``rand()``, so a retried task draws the same rows). A row is
a candidate of a tree with a probability set for somewhat more candidates than
the tree needs; one hash gives the number of trees that a row is drawn for, by
the binomial distribution, and a second one which trees. So almost all rows
cost one hash, and only candidates are shuffled. Of its candidates a tree keeps
those of smallest hash.
``groupBy(tree).applyInPandas`` grows the tree (random feature, uniform split
between min and max, depth limit ceil(log2(max_samples))). The node table, at
most ``n_trees * (2 * max_samples - 1)`` rows, is written once.

Score: the node table is broadcast (that bound is its proof of size) and
``mapInPandas`` walks all trees for a whole Arrow batch at once with numpy;
s = 2 ** (-E[h(x)] / c(samples per tree)). The anomaly threshold is the
(1 - contamination) quantile of the training scores.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivet.operators.prep import seeded_hash
from rivet.session import materialize

NODE_SCHEMA = ("tree_id int, node_id int, feature int, threshold double, "
               "left_child int, right_child int, size int")
EULER_GAMMA = 0.5772156649015329


def avg_path(n):
    """c(n): mean path length of an unsuccessful search in a BST of n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[n == 2] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow(X: np.ndarray, rng: np.random.Generator, max_depth: int):
    nodes = []  # feature, threshold, left, right, size

    def build(idx, depth):
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, len(idx)])
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        ok = np.flatnonzero(hi > lo)
        if ok.size == 0:
            return me
        q = int(rng.choice(ok))
        p = float(rng.uniform(lo[q], hi[q]))
        left = idx[sub[:, q] < p]
        right = idx[sub[:, q] >= p]
        nodes[me][0], nodes[me][1] = q, p
        nodes[me][2] = build(left, depth + 1)
        nodes[me][3] = build(right, depth + 1)
        return me

    build(np.arange(X.shape[0]), 0)
    return nodes


def _draws_at_most(n_trees: int, p: float) -> list[float]:
    """Probability that a row is drawn for at most 0, 1, ... trees."""
    logs = [math.lgamma(n_trees + 1) - math.lgamma(k + 1) - math.lgamma(n_trees - k + 1)
            + k * math.log(p) + (n_trees - k) * math.log1p(-p) for k in range(n_trees)]
    return np.minimum(np.cumsum(np.exp(logs)), 1.0).tolist()


def candidates(df: DataFrame, key: list[str], keep: list[str], n: int, m: int, n_trees: int, seed: int) -> DataFrame:
    """(tree_id, _o, columns to keep): the rows drawn for each tree, about
    2m + 64 of the ``n`` rows each, and their order in the tree."""
    trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    wanted = (2 * m + 64) / n
    rows = df
    if wanted < 1.0:
        bounds = _draws_at_most(n_trees, wanted)
        u = seeded_hash(*key, seed=seed) / F.lit(float(1 << 60))
        more = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= u))
        rows = df.withColumn("_n", F.when(u < bounds[0], 0).otherwise(more)).filter("_n > 0")
        by_hash = F.array_sort(F.transform(trees, lambda t: F.struct(F.xxhash64(*key, t, F.lit(seed + 2)).alias("h"), t.alias("t"))))
        trees = F.transform(F.slice(by_hash, 1, F.col("_n")), lambda x: x["t"])
    return (rows.select(*key, *keep, trees.alias("_t")).withColumn("tree_id", F.explode("_t"))
            .select("tree_id", seeded_hash(*key, "tree_id", seed=seed + 1).alias("_o"), *keep))


def fit(df: DataFrame, cols: list[str], key: list[str], n_trees: int = 200, max_samples: int = 256,
        seed: int = 42) -> DataFrame:
    """Node table of the forest (one row per node)."""
    n = df.count()
    m = min(max_samples, n)
    if m == 0:
        raise ValueError("an isolation forest needs at least one row")
    renamed = [f"_x{i}" for i in range(len(cols))]
    rows = df.select(*key, *[F.col(c).cast("double").alias(x) for c, x in zip(cols, renamed, strict=True)])
    cand = candidates(rows, key, renamed, n, m, n_trees, seed)
    max_depth = int(math.ceil(math.log2(max(m, 2))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree_id"].iloc[0])
        pdf = pdf.sort_values("_o", kind="mergesort").head(m)
        X = pdf[renamed].to_numpy(dtype=float)
        rng = np.random.default_rng(seed * 100003 + t)
        nodes = _grow(X, rng, max_depth)
        a = np.asarray(nodes, dtype=float)
        return pd.DataFrame({"tree_id": t, "node_id": np.arange(len(nodes), dtype=np.int32),
                             "feature": a[:, 0].astype(np.int32), "threshold": a[:, 1],
                             "left_child": a[:, 2].astype(np.int32), "right_child": a[:, 3].astype(np.int32),
                             "size": a[:, 4].astype(np.int32)})

    return materialize(cand.groupBy("tree_id").applyInPandas(build, NODE_SCHEMA), "forest")


def _packed(nd: pd.DataFrame) -> tuple[list[tuple], float]:
    """Per tree: steps of its longest path, and per node feature, threshold,
    children (right, left) and path length if a row ends there. A leaf is its
    own child, so rows that have ended need no mask. And c(samples per tree)."""
    trees, samples = [], 2
    for _, g in nd.groupby("tree_id", sort=True):
        feature, threshold, left, right, size = (
            g[c].to_numpy() for c in ("feature", "threshold", "left_child", "right_child", "size"))
        samples = max(samples, int(size[0]))  # a tree's root counts its sample
        own, leaf = np.arange(len(feature)), feature < 0
        depth = np.zeros(len(feature))
        for n in np.flatnonzero(~leaf):  # parents come before their children
            depth[left[n]] = depth[right[n]] = depth[n] + 1
        children = np.stack([np.where(leaf, own, right), np.where(leaf, own, left)], axis=1).ravel()
        trees.append((int(depth.max()), np.where(leaf, 0, feature).astype(np.intp), threshold, children.astype(np.intp),
                      depth + avg_path(size)))
    return trees, float(avg_path([samples])[0])


WALK_ROWS = 2048  # rows that walk together: their values stay in the cache


def _path_lengths(x: np.ndarray, forest: list[tuple]) -> np.ndarray:
    """Sum of each row's path lengths over the trees."""
    total = np.zeros(len(x))
    for a in range(0, len(x), WALK_ROWS):
        part = np.ascontiguousarray(x[a:a + WALK_ROWS])
        flat, first = part.ravel(), np.arange(len(part)) * part.shape[1]
        for steps, feature, threshold, children, length in forest:
            node = np.zeros(len(part), np.intp)
            for _ in range(steps):
                node = children.take(2 * node + (flat.take(first + feature.take(node)) < threshold.take(node)))
            total[a:a + WALK_ROWS] += length.take(node)
    return total


def score(df: DataFrame, nodes: DataFrame, cols: list[str], keep: list[str],
          out: str = "anomaly_score") -> DataFrame:
    """Anomaly score per row; higher is more anomalous."""
    nd = nodes.orderBy("tree_id", "node_id").toPandas()  # bounded: n_trees * (2 * max_samples - 1) rows
    spark = df.sparkSession
    trees, c_norm = _packed(nd)
    bc = spark.sparkContext.broadcast(trees)

    def run(batches):
        forest = bc.value
        for pdf in batches:
            total = _path_lengths(pdf[cols].to_numpy(dtype=float), forest)
            res = pdf[keep].copy()
            res[out] = np.power(2.0, -(total / len(forest)) / c_norm)
            yield res

    schema = df.select(*keep).schema.add(out, "double")
    return df.select(*dict.fromkeys(keep + cols)).mapInPandas(run, schema)


def threshold(train_scores: DataFrame, contamination: float = 0.1, col: str = "anomaly_score") -> float:
    """(1 - contamination) quantile of the training scores."""
    return train_scores.agg(F.percentile_approx(col, 1.0 - contamination, 100000)).first()[0]
