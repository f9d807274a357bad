"""Inverted-file index over vectors (J9 for many queries).

``vector_top_k`` compares every query with every item. Here coarse centroids,
fitted on a bounded sample (``sample_rows``), cut the items into lists by
nearest direction; every item is in one list, and a query looks only into the
``probes`` lists whose centroids are nearest to it. ``probes`` equal to the
number of lists gives the exact result. Lists are joined in cells of about
``cell_rows`` items, so a list that holds a third of all items is many cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivet.operators.prep import hash_sample
from rivet.operators.vector_cells import best_in_groups, norm
from rivet.session import materialize

SAMPLE_ROWS = 20_000
CELL_ROWS = 4096
QUERY_ROWS = 1 << 15  # queries that meet a cell at once


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)


def _stacked(column: pd.Series, width: int) -> np.ndarray:
    return np.array([np.asarray(v, float) if v is not None else np.zeros(width) for v in column]).reshape(len(column), width)


def fit_centroids(items: DataFrame, key: str, vec: str = "vector", lists: int = 16, rounds: int = 12,
                  sample_rows: int = SAMPLE_ROWS, seed: int = 42) -> np.ndarray:
    """Directions of the lists: spherical k-means on the ``sample_rows`` items
    of smallest key hash; reruns agree."""
    drawn = hash_sample(items.filter(F.size(vec) > 0).select(key, vec), sample_rows, [key], seed).orderBy(key).toPandas()
    if drawn.empty:
        raise ValueError("an index needs at least one vector")
    x = _unit(_stacked(drawn[vec], len(drawn[vec].iloc[0])))
    rng = np.random.default_rng(seed)
    centres = x[[int(rng.integers(len(x)))]]
    for _ in range(min(lists, len(x)) - 1):  # far from the centres there are, mostly
        gap = np.maximum(1.0 - (x @ centres.T).max(axis=1), 0.0)
        pick = rng.choice(len(x), p=gap / gap.sum()) if gap.sum() > 0 else int(rng.integers(len(x)))
        centres = np.vstack([centres, x[pick]])
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where((sums != 0).any(axis=1)[:, None], _unit(sums), centres)
    return centres


def _nearest(df: DataFrame, vec: str, centres: np.ndarray, probes: int) -> DataFrame:
    """``lists``: numbers of the nearest centroids, nearest first. The
    centroids are broadcast: lists x width numbers."""
    shipped = df.sparkSession.sparkContext.broadcast(centres)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres = shipped.value
        for pdf in frames:
            near = _unit(_stacked(pdf[vec], centres.shape[1])) @ centres.T
            yield pdf.assign(lists=list(np.argsort(-near, axis=1, kind="stable")[:, :probes]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{fields}, lists array<bigint>")


def build_index(items: DataFrame, centres: np.ndarray, key: str, vec: str = "vector", cell_rows: int = CELL_ROWS) -> DataFrame:
    """Posting lists of every item, written: list, cell (about ``cell_rows``
    items of the list by hash), cells (of the list), item, vector and norm."""
    listed = _nearest(items.select(F.col(key).alias("item"), F.col(vec).alias("vector")), "vector", centres, 1)
    listed = materialize(listed.select("item", "vector", F.col("lists")[0].alias("list"), norm("vector").alias("norm")), "vector-lists")
    sizes = listed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(cell_rows)).cast("long").alias("cells"))  # a row per list
    return (listed.join(F.broadcast(sizes), "list")
            .withColumn("cell", F.pmod(F.xxhash64("item"), F.col("cells"))))


def search(queries: DataFrame, index: DataFrame, centres: np.ndarray, k: int, probes: int, key: str,
           vec: str = "vector") -> DataFrame:
    """Cosine top-k items of each query among the lists it probes: ``key``,
    rank, item, score. Ties go to the smaller item; a vector of zeros has
    similarity 0 with all."""
    # small cells of a list meet the queries together, about CELL_ROWS items at once; a row per list
    sizes = index.groupBy("list").agg(F.max("cells").alias("cells"), F.greatest(
        F.lit(1), F.floor(F.lit(CELL_ROWS) * F.max("cells") / F.count(F.lit(1)))).alias("together"))
    sizes = sizes.select("list", "together", F.ceil(F.col("cells") / F.col("together")).cast("long").alias("meets"))
    slices = max(1, -(-queries.count() // QUERY_ROWS))
    asked = _nearest(queries.select(F.col(key).alias("query"), F.col(vec).alias("vector")), "vector", centres, probes)
    asked = (asked.withColumn("list", F.explode("lists")).join(F.broadcast(sizes), "list")
             .select("query", "vector", norm("vector").alias("norm"), "list", F.pmod(F.xxhash64("query", "vector"), F.lit(slices)).alias("slice"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.col("meets") - 1)).alias("meet")))
    there = (index.join(F.broadcast(sizes), "list").withColumn("meet", F.floor(F.col("cell") / F.col("together")).cast("long"))
             .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long")))))
    return best_in_groups(asked, there, ["list", "meet", "slice"], k).withColumnRenamed("query", key)


def recall(found: DataFrame, exact: DataFrame, key: str) -> DataFrame:
    """One row: queries, and the share of the exact pairs that were found."""
    hits = exact.join(found.select(key, "item", F.lit(1).alias("hit")), [key, "item"], "left")
    return hits.agg(F.count_distinct(key).alias("queries"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
