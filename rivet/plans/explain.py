"""Tree SHAP for MLlib random forests over a table of paths.

Path-dependent Tree SHAP (Lundberg, Erion & Lee, 2018) with node covers taken
from the forest's own weighted class counts. Each root-to-leaf path becomes one
row: merged intervals and cover ratios per feature. A row's contributions are
sums over paths: a path's contributions depend on which of its conditions a
row meets, so paths that follow each other in a tree and share most conditions
are added up in one table over all that a row can meet of them, and a row looks
its contributions up there. The packed path table is broadcast (its size is bounded by the number
of trees and their depth) and the rows are distributed: a task explains its
batches against one group of trees, and a final aggregate adds the groups up.
Guard: base value + sum of contributions equals the class-1 probability of
every row.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from rivet.operators.prep import hash_sample


def tree_nodes(spark, model_path: str) -> DataFrame:
    """Node table of a saved random forest: one row per (tree, node)."""
    d = spark.read.parquet(f"{model_path}/data")
    return d.select(F.col("treeID").alias("tree_id"), F.col("nodeData.id").alias("node_id"),
                    F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
                    F.col("nodeData.split.featureIndex").alias("feature"),
                    F.try_element_at(F.col("nodeData.split.leftCategoriesOrThreshold"), F.lit(1)).alias("threshold"),
                    F.col("nodeData.impurityStats").alias("stats"))


_PACKED = "tree_id int, paths int, packed binary"


def _pack(paths: list[tuple]) -> bytes:
    """Paths as (value, [(feature, low, high, ratio), ...]) in one buffer:
    all lengths, all values, then the conditions one after the other."""
    lengths = np.array([len(c) for _, c in paths], np.float64)
    values = np.array([v for v, _ in paths], np.float64)
    conditions = np.array([x for _, c in paths for x in c], np.float64).reshape(-1)
    return np.concatenate([lengths, values, conditions]).tobytes()


def _tree_paths(pdf: pd.DataFrame) -> list[tuple]:
    """Root-to-leaf paths of one tree. The conditions on one feature are merged
    to one interval ``low < x <= high`` and one ratio: the share of the
    training weight that goes down the path where the feature is unknown."""
    at = {int(n): i for i, n in enumerate(pdf["node_id"])}
    left, right = pdf["left"].to_numpy(), pdf["right"].to_numpy()
    feature, threshold = pdf["feature"].to_numpy(), pdf["threshold"].to_numpy()
    stats = [np.asarray(s, float) for s in pdf["stats"]]
    cover = [float(s.sum()) for s in stats]
    out, stack = [], [(at[0], {})]
    while stack:
        i, conditions = stack.pop()
        if left[i] < 0:
            value = stats[i][1] / cover[i] if cover[i] > 0 and len(stats[i]) > 1 else 0.0
            out.append((value, [(f, *c) for f, c in conditions.items()]))
            continue
        f, t = int(feature[i]), float(threshold[i])
        low, high, ratio = conditions.get(f, (-np.inf, np.inf, 1.0))
        for child, lo, hi in ((at[int(left[i])], low, min(high, t)), (at[int(right[i])], max(low, t), high)):
            share = cover[child] / cover[i] if cover[i] > 0 else 0.0
            stack.append((child, {**conditions, f: (lo, hi, ratio * share)}))
    return out


def tree_paths(nodes: DataFrame) -> DataFrame:
    """Path table of a forest, one packed row per tree, made where the trees are."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        paths = _tree_paths(pdf)
        return pd.DataFrame({"tree_id": pdf["tree_id"].iloc[:1].astype("int32"), "paths": [len(paths)], "packed": [_pack(paths)]})
    return nodes.groupBy("tree_id").applyInPandas(pack, _PACKED)


def _unpack(packed: bytes, n: int) -> list[tuple]:
    """Paths in the order of the tree: value and feature, low, high, ratio of its conditions."""
    flat = np.frombuffer(packed)
    lengths, values, rest = flat[:n].astype(int), flat[n:2 * n], flat[2 * n:].reshape(-1, 4)
    return [(v, c[:, 0].astype(int), c[:, 1], c[:, 2], c[:, 3]) for v, c in zip(values, np.split(rest, np.cumsum(lengths)[:-1]))]


def _points(d: int) -> tuple[np.ndarray, np.ndarray]:
    """Gauss points on (0, 1) that integrate polynomials of degree d - 1 exactly."""
    points, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
    return (points + 1) / 2, weights / 2


def _by_pattern(value: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Contributions (paths x d x 2^d patterns) of paths of one length d.

    A path pays its value if the row meets all conditions; a condition on an
    unknown feature counts as met with its ratio z. The Shapley weight of a
    set of k of the d - 1 other features is the integral of t^k (1 - t)^(d - 1 - k),
    so the weighted sum over all sets is the integral of the product of
    z (1 - t) + o t over the others, o = 1 where the row meets the condition. So
    a row's contribution depends on the pattern of its o alone: bit j of a
    pattern is the o of condition j. With P the product over all conditions,
    a met one gives (1 - z) P / (z (1 - t) + t) and an unmet one
    - z P / (z (1 - t)) = - P / (1 - t), the same for all unmet ones."""
    n, d = z.shape
    t, w = _points(d)
    unmet = z[..., None] * (1 - t)
    met = unmet + t
    product = np.ones((n, len(t), 1))
    for j in range(d):
        product = np.concatenate([product * unmet[:, j, :, None], product * met[:, j, :, None]], axis=2)
    paid = value[:, None, None] * w
    bits = (np.arange(1 << d) >> np.arange(d)[:, None]) & 1
    return np.where(bits, (paid * (1 - z[..., None]) / met) @ product, (-paid / (1 - t)) @ product)


def _by_row(o: np.ndarray, value: np.ndarray, z: np.ndarray) -> np.ndarray:
    """As ``_by_pattern``, for the conditions that rows meet (rows x paths x
    d): for paths with more patterns than there are rows."""
    total = np.zeros(o.shape)
    for t, w in zip(*_points(o.shape[2]), strict=True):
        terms = z * (1 - t) + o * t
        before, after = np.ones_like(terms), np.ones_like(terms)
        np.cumprod(terms[..., :-1], axis=-1, out=before[..., 1:])
        after[..., :-1] = np.cumprod(terms[..., :0:-1], axis=-1)[..., ::-1]
        total += w * before * after
    return total * (o - z) * value[:, None]


CELLS = 1 << 19  # of rows x paths x conditions held at once
TABLE = 1 << 15  # entries a feature of a table of paths at most
TABLES = 8       # held at once
CHUNK = 1 << 15  # rows that are looked up at once


def _edges(trees: list[list[tuple]], n_features: int) -> list[np.ndarray]:
    """Each feature's different thresholds, ascending."""
    ends = [(path[1], e) for paths in trees for path in paths for e in path[2:4]]
    feature, end = (np.concatenate(x) for x in zip(*ends, strict=True)) if ends else (np.empty(0, int), np.empty(0))
    return [np.unique(end[(feature == f) & np.isfinite(end)]) for f in range(n_features)]


def _places(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Number of a feature's thresholds below each value (features x rows), one
    more than all for NaN: a condition is met where low < place <= high holds
    for the thresholds' own numbers. One byte a value where that will do."""
    most = max((len(e) for e in edges), default=0) + 1
    out = np.empty(x.shape[::-1], next(t for t in (np.uint8, np.uint16, np.uint32) if most < np.iinfo(t).max))
    for f, e in enumerate(edges):
        out[f] = np.where(np.isnan(x[:, f]), len(e) + 1, np.searchsorted(e, x[:, f]))
    return out


def _spans(path: tuple, edges: list[np.ndarray]) -> dict[int, int]:
    """The places that meet each condition of a path, as a number's bits."""
    out = {}
    for f, low, high in zip(*path[1:4]):
        first = 0 if np.isinf(low) else int(np.searchsorted(edges[f], low)) + 1
        last = len(edges[f]) if np.isinf(high) else int(np.searchsorted(edges[f], high))
        out[int(f)] = (1 << max(last + 1, first)) - (1 << first)
    return out


def _groups(paths: list[tuple], spans: list[dict[int, int]], seen: list[int], most: int) -> Iterator[tuple[list[int], dict[int, list[int]]]]:
    """Paths that follow each other, as long as their table has no more than
    ``most`` entries a feature: numbers of paths and, by feature, the sets of
    places that no path tells apart."""
    held, parts, size = [], {}, 1
    for p, _ in enumerate(paths):
        new, more = {}, size
        for f, span in spans[p].items():
            old = parts.get(f, [seen[f]])
            new[f] = [x for s in old for x in (s & span, s & ~span) if x]
            more = more // len(old) * len(new[f])
        if held and more > most:
            yield held, parts
            held, parts, size = [], {}, 1
            new = {f: [x for x in (seen[f] & span, seen[f] & ~span) if x] for f, span in spans[p].items()}
            more = int(np.prod([len(v) for v in new.values()], dtype=object))
        held.append(p)
        parts.update(new)
        size = more
    if held:
        yield held, parts


def _table(paths: list[tuple], spans: list[dict[int, int]], held: list[int], parts: dict[int, list[int]]) -> np.ndarray:
    """Contributions (features of the group x entries) that the paths add up to."""
    place = {f: i for i, f in enumerate(parts)}
    table = np.zeros((len(parts), int(np.prod([len(v) for v in parts.values()]))))
    by_length = {}
    for p in held:
        by_length.setdefault(len(paths[p][1]), []).append(p)
    for same in by_length.values():
        given = _by_pattern(np.array([paths[p][0] for p in same]), np.array([paths[p][4] for p in same]))
        for p, one in zip(same, given, strict=True):
            bit = {f: 1 << j for j, f in enumerate(spans[p])}
            code = np.zeros(1, np.intp)
            for f, sets in parts.items():
                met = [bit[f] if f in bit and x & spans[p][f] else 0 for x in sets]
                code = (code[:, None] + np.array(met)).ravel()
            for j, f in enumerate(spans[p]):
                table[place[f]] += one[j].take(code)
    return table


def _lookups(parts: dict[int, list[int]], kind: type) -> list[tuple]:
    """How a row finds its entry: by feature, either the first place, number
    of places and what to add there, or what to add for each place."""
    out, stride = [], 1
    for f, sets in reversed(parts.items()):
        if len(sets) == 2:  # conditions are spans, so between the ends of one set there is no place of the other
            ends = [((x & -x).bit_length() - 1, x.bit_length()) for x in sets]
            at = next(i for i, (a, b) in enumerate(ends) if not sets[1 - i] >> a & (1 << b - a) - 1)
            out.append((f, kind(stride if at else 0), kind(0 if at else stride), ends[at][0], ends[at][1] - ends[at][0], None))
        elif len(sets) > 2:
            add = np.zeros(max(x.bit_length() for x in sets), kind)
            for i, x in enumerate(sets):
                add[[k for k in range(x.bit_length()) if x >> k & 1]] = i * stride
            out.append((f, kind(0), kind(0), 0, 0, add))
        stride *= len(sets)
    return out


def _add_tables(phi: np.ndarray, places: np.ndarray, paths: list[tuple], edges: list[np.ndarray], seen: list[int]) -> None:
    """Adds to phi (features x rows) what the paths of a tree give."""
    spans, n = [_spans(path, edges) for path in paths], places.shape[1]
    most = min(TABLE, max(n >> 4, 1 << max(len(p[1]) for p in paths)))  # a table pays where many rows use it
    groups = _groups(paths, spans, seen, most)
    gap, holds = np.empty(min(n, CHUNK), places.dtype), np.empty(min(n, CHUNK), bool)
    at, found = np.empty(min(n, CHUNK), np.intp), np.empty(min(n, CHUNK))
    while some := list(itertools.islice(groups, TABLES)):
        tables = [_table(paths, spans, *g) for g in some]
        kinds = [np.uint16 if t.shape[1] <= 1 << 16 else np.uint32 for t in tables]
        looks = [_lookups(parts, kind) for (_, parts), kind in zip(some, kinds, strict=True)]
        for a in range(0, n, CHUNK):
            here = places[:, a:a + CHUNK]
            m = here.shape[1]
            for (_, parts), table, kind, look in zip(some, tables, kinds, looks, strict=True):
                code, more = np.zeros(m, kind), np.empty(m, kind)
                for f, inside, outside, first, width, add in look:
                    if add is not None:
                        add.take(here[f], out=more, mode="clip")
                    else:
                        np.subtract(here[f], here.dtype.type(first), out=gap[:m])  # places below the first wrap round
                        (np.less if inside else np.greater_equal)(gap[:m], width, out=holds[:m])
                        np.multiply(holds[:m], inside or outside, out=more)
                    code += more
                at[:m] = code
                for f, row in zip(parts, table, strict=True):
                    row.take(at[:m], out=found[:m], mode="clip")
                    phi[f, a:a + m] += found[:m]


def _add_rows(phi: np.ndarray, x: np.ndarray, block: tuple) -> None:
    """As ``_add_tables``, for paths with more patterns than there are rows."""
    d, n = block[1].shape[1], len(x)
    paths = max(1, CELLS // (d * n))
    for a in range(0, len(block[0]), paths):
        value, feature, low, high, z = (c[a:a + paths] for c in block)
        cells = x[:, feature]
        given = _by_row(((cells > low) & (cells <= high)).astype(float), value, z)
        place = feature * n + np.arange(n)[:, None, None]
        phi += np.bincount(place.ravel(), given.ravel(), phi.size).reshape(phi.shape)


def explain_paths(x: np.ndarray, packed: list[tuple[bytes, int]], n_features: int) -> tuple[np.ndarray, float]:
    """Contributions (rows x features) and expected value, summed over trees."""
    trees = [_unpack(raw, n) for raw, n in packed]
    edges = _edges(trees, n_features)
    places = _places(x, edges)
    seen = [sum(1 << int(p) for p in np.unique(row)) for row in places]
    phi, base = np.zeros((n_features, len(x))), 0.0
    for paths in trees:
        base += sum(float(value * z.prod()) for value, _, _, _, z in paths)
        if few := [p for p in paths if 0 < len(p[1]) and 1 << len(p[1]) <= len(x)]:
            _add_tables(phi, places, few, edges, seen)
        rest = [p for p in paths if 1 << len(p[1]) > len(x)]
        for d in sorted({len(p[1]) for p in rest} - {0}):
            _add_rows(phi, x, tuple(np.array(c) for c in zip(*(p for p in rest if len(p[1]) == d))))
    return phi.T, base


TREE_GROUPS = 32
ROWS_PER_TASK = 1 << 18  # a table of paths costs as much as the lookups of some ten thousand rows


def shap_values(nodes: DataFrame, rows: DataFrame, cols: list[str], row_key: str, n_trees: int,
                sample: int | None = None, tree_groups: int = TREE_GROUPS) -> DataFrame:
    """Long table (row key, feature, shap) of every row, averaged over trees,
    plus a ``__base__`` pseudo-feature holding the forest's expected value.

    ``sample`` explains only that many rows, those of smallest key hash. The
    number of tasks follows the number of rows. Where that leaves cores idle, a
    row is copied to a task for each of up to ``tree_groups`` groups of trees."""
    if sample is not None:
        rows = hash_sample(rows, sample, [row_key])
    # packed paths: at most trees x 2^depth paths of depth conditions
    packed = [(bytes(r["packed"]), r["paths"]) for r in tree_paths(nodes).orderBy("tree_id").collect()]
    forest = nodes.sparkSession.sparkContext.broadcast(packed)
    names = list(cols)
    cores = nodes.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-rows.count() // ROWS_PER_TASK))
    groups = min(tree_groups, -(-(2 if parts == 1 else 4) * cores // parts))  # several tasks a core, where rows are many

    def told(frames: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g, part in pd.concat(frames).groupby("_group"):  # a task has one group
            phi, base = explain_paths(part[names].to_numpy(dtype=float), forest.value[g::groups], len(names))
            out = pd.DataFrame(np.column_stack([phi, np.full(len(phi), base)]) / n_trees, columns=wide)
            out.insert(0, row_key, part[row_key].to_numpy())
            yield out

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []  # a table serves all rows that are held, so batches are put together
        for pdf in batches:
            held.append(pdf)
            if sum(map(len, held)) >= 2 * ROWS_PER_TASK:
                yield from told(held)
                held = []
        if held:
            yield from told(held)
    spread = (rows.select(row_key, *names, F.pmod(F.xxhash64(row_key, *names), F.lit(parts)).alias("_part"),
                          F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_group"))
              .repartitionById(parts * groups, (F.col("_group") * parts + F.col("_part")).cast("int")).drop("_part"))
    # a key and group of trees is one row up to the sum
    wide = [f"_shap_{i}" for i in range(len(names) + 1)]
    schema = rows.select(row_key).schema
    for c in wide:
        schema = schema.add(c, "double")
    per = spread.mapInPandas(explain, schema).groupBy(row_key).agg(*[F.sum(c).alias(c) for c in wide])
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(c).alias("shap")) for f, c in zip([*names, "__base__"], wide, strict=True)])
    return per.select(row_key, F.explode(each).alias("_e")).select(row_key, "_e.feature", "_e.shap")


def global_importance(shap: DataFrame, top: int = 15) -> DataFrame:
    """Mean |contribution| per feature, top n."""
    s = shap.filter(F.col("feature") != "__base__")
    return (s.groupBy("feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
             .orderBy(F.col("mean_abs_shap").desc(), "feature").limit(top))


def local_explanation(shap: DataFrame, values: DataFrame, row_key: str, top: int = 5) -> DataFrame:
    """Top contributions by |shap| for each row with value and direction."""
    s = shap.filter(F.col("feature") != "__base__").join(values, [row_key, "feature"])
    w = Window.partitionBy(row_key).orderBy(F.abs("shap").desc(), "feature")
    return (s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
             .withColumn("direction", F.when(F.col("shap") > 0, F.lit("increased")).otherwise(F.lit("decreased"))))
