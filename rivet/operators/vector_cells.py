"""Cosine top-k of groups of queries against groups of items.

Queries and items meet by key in groups of bounded size. In a group one
matrix product gives all scores nearly; pairs that could be among a query's
best k, ties included, are scored once more by a sum in the order of the
elements, the sum that SQL makes. So results don't hang on how rows are
grouped, and equal vectors score equally.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEAR = 1e-9  # far above the error of a product, far below what tells scores apart
CELLS = 1 << 20  # pairs scored at once


def norm(v: str | Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def _matrix(column: pa.ChunkedArray, usable: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Usable vectors, padded with zeros to ``width``, and their lengths."""
    vectors = column.combine_chunks()
    length = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    out = np.zeros((len(length), width))
    row = np.repeat(np.arange(len(length)), length)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    out[~usable] = 0.0
    return out, length


def _width(column: pa.ChunkedArray) -> int:
    return pc.max(pc.list_value_length(column)).as_py() or 0


def _fold(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Dot products of rows a[i] and b[j], summed element by element."""
    out = np.zeros(len(i))
    for c in range(a.shape[1]):
        out += a[i, c] * b[j, c]
    return out


def _best(queries: pa.Table, items: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of queries and items, scores and whether a score is known, of each
    query's k best: unknown scores last, NaN first, ties to the smaller item."""
    q_ok, i_ok = (t["usable"].to_numpy().astype(bool) for t in (queries, items))
    q_norm, i_norm = (np.where(ok, t["norm"].to_numpy(), 1.0) for ok, t in ((q_ok, queries), (i_ok, items)))
    width = max(_width(queries["vector"]), _width(items["vector"]))
    q, q_length = _matrix(queries["vector"], q_ok, width)
    x, x_length = _matrix(items["vector"], i_ok, width)
    order = np.empty(len(x), np.int64)
    order[pc.sort_indices(items["item"], null_placement="at_start").to_numpy()] = np.arange(len(x))
    sizes = np.concatenate([q_norm, i_norm])
    plain = bool(((sizes > 1e-100) & (sizes < 1e100)).all())  # else the product may lose all digits
    told = []
    step = max(1, CELLS // len(x))
    for a in range(0, len(q), step):
        b = min(a + step, len(q))
        with np.errstate(all="ignore"):
            near = (q[a:b] @ x.T) / (q_norm[a:b, None] * i_norm)
        both = q_ok[a:b, None] & i_ok
        unknown = both & (q_length[a:b, None] != x_length)
        near = np.where(both, np.where(np.isnan(near), np.inf, near), 0.0)
        near[unknown] = -np.inf
        if plain and len(x) > k:
            least = np.partition(near, len(x) - k, axis=1)[:, len(x) - k]
            i, j = np.nonzero(near >= least[:, None] - NEAR)
        else:
            i, j = (n.ravel() for n in np.indices(near.shape))
        with np.errstate(all="ignore"):
            score = np.where(both[i, j], _fold(q[a:b], x, i, j) / (q_norm[a:b][i] * i_norm[j]), 0.0)
        known = ~unknown[i, j]
        place = np.where(known, np.where(np.isnan(score), -np.inf, -score), np.inf)
        at = np.lexsort((order[j], place, i))
        i, j, score, known = i[at], j[at], score[at], known[at]
        first = np.searchsorted(i, np.arange(b - a))
        keep = np.arange(len(i)) - first[i] < k
        told.append((i[keep] + a, j[keep], score[keep], known[keep]))
    return tuple(np.concatenate(c) for c in zip(*told, strict=True))


def best_in_groups(queries: DataFrame, items: DataFrame, by: list[str], k: int) -> DataFrame:
    """query, rank, item, score: each query's k items of greatest cosine among
    the groups that it is in; ties go to the smaller item, and a vector of zeros
    or without a norm has similarity 0 with all. ``queries``: ``by``, query,
    vector, norm; ``items``: ``by``, item, vector, norm."""
    def sided(df: DataFrame, key: str) -> DataFrame:
        return df.select(*by, key, "vector", "norm", F.coalesce(F.col("norm") > 0, F.lit(False)).alias("usable")).groupBy(*by)
    kinds = dict(queries.dtypes)["query"], dict(items.dtypes)["item"]

    def best(asked: pa.Table, there: pa.Table) -> pa.Table:
        names = ["query", "item", "score"]
        if not (len(asked) and len(there)):
            return pa.table([asked["query"].slice(0, 0), there["item"].slice(0, 0), pa.array([], pa.float64())], names)
        i, j, score, known = _best(asked, there, k)
        return pa.table([asked["query"].take(pa.array(i)), there["item"].take(pa.array(j)), pa.array(score, mask=~known)], names)
    pairs = sided(queries, "query").cogroup(sided(items, "item")).applyInArrow(
        best, f"query {kinds[0]}, item {kinds[1]}, score double")
    first = Window.partitionBy("query").orderBy(F.col("score").desc(), "item")
    return pairs.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k).select("query", "rank", "item", "score")
