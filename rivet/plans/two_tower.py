"""Embeddings of modes and actions from positives and sampled negatives.

Every distinct (mode, action) pair is a positive, every hashed draw that is
none of them (``recommend.negative_pairs``, J7) a negative; the two vectors'
dot product goes through a logistic link and the log loss is descended in
small batches.

Modes and actions are cut by hash into ``blocks`` blocks each, which cuts the
pairs into blocks x blocks cells. Cells (i, i + s) of one stratum s share
neither a mode nor an action, so a task per cell descends them side by side
without conflicts; an epoch goes through all strata. A task holds one block of
vectors of either side and one cell of pairs. A name with most of the pairs is
spread over all cells of its row, and the number of blocks follows the largest
such name as well as the number of pairs. A stratum's vectors are a written
table, so a lost executor costs one cell.

Vectors start from hashes of their names and batches follow hashes of the
pairs, so reruns agree, however the tables are partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivet.operators.recommend import negative_pairs, shared
from rivet.session import materialize

# FIXED VALUES: the original's dimension, epochs, rate and batch size
DIMENSION, EPOCHS, RATE, BATCH = 16, 50, 0.05, 32
CELL_PAIRS = 1 << 20   # pairs aimed at in a cell, vectors in a block, and pairs of one name in a cell
DECAY, DECAY_SQUARES, TINY = 0.9, 0.999, 1e-8   # of the moments of each vector's gradient
START = 0.1            # standard deviation of a starting vector's numbers

STATE = "task long, side string, name string, vector array<double>, mean array<double>, squares array<double>, steps long"


def training_pairs(long: DataFrame, seed: int = 42) -> DataFrame:
    """(failure_mode, action, label): the distinct pairs with 1, the hashed
    negatives, which may repeat, with 0. Pairs with a null are left out."""
    long = shared(long.filter(F.col("failure_mode").isNotNull() & F.col("action").isNotNull()))
    positives = long.select("failure_mode", "action").distinct().withColumn("label", F.lit(1))
    return positives.unionByName(negative_pairs(long, seed).withColumn("label", F.lit(0)))


def _uniform(*parts: Column) -> Column:
    """In (0, 1), from the upper 52 bits of a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 12).cast("double") + 0.5) / float(1 << 52)


def _start(names: DataFrame, side: str, dimension: int, seed: int) -> DataFrame:
    """Normal numbers by hash of (side, name, place, seed)."""
    def normal(t: Column) -> Column:
        key = (F.lit(side), F.col("name"), t, F.lit(seed))
        return (F.sqrt(-2.0 * F.log(_uniform(*key, F.lit("radius"))))
                * F.cos(2.0 * F.pi() * _uniform(*key, F.lit("angle"))) * START)
    zeros = F.array_repeat(F.lit(0.0), dimension)
    return names.select(F.lit(side).alias("side"), "name",
                        F.transform(F.sequence(F.lit(1), F.lit(dimension)), normal).alias("vector"),
                        zeros.alias("mean"), zeros.alias("squares"), F.lit(0).cast("long").alias("steps"))


class _Side:
    """One block of vectors with the moments of their gradients."""

    def __init__(self, rows: pd.DataFrame, dimension: int):
        self.rows = rows.sort_values("name", kind="stable").reset_index(drop=True)
        self.names = pd.Index(self.rows["name"])

        def stacked(column: str) -> np.ndarray:
            return np.array(self.rows[column].tolist(), float).reshape(len(self.rows), dimension)
        self.vector, self.mean, self.squares = map(stacked, ("vector", "mean", "squares"))
        self.steps = self.rows["steps"].to_numpy(np.int64).copy()

    def descend(self, at: np.ndarray, gradient: np.ndarray, rate: float) -> None:
        """One step of the vectors in the batch, by their summed gradients."""
        own, place = np.unique(at, return_inverse=True)
        total = np.zeros((len(own), gradient.shape[1]))
        np.add.at(total, place, gradient)
        self.steps[own] += 1
        self.mean[own] = DECAY * self.mean[own] + (1 - DECAY) * total
        self.squares[own] = DECAY_SQUARES * self.squares[own] + (1 - DECAY_SQUARES) * total ** 2
        n = self.steps[own, None]
        mean, squares = self.mean[own] / (1 - DECAY ** n), self.squares[own] / (1 - DECAY_SQUARES ** n)
        self.vector[own] -= rate * mean / (np.sqrt(squares) + TINY)

    def frame(self) -> pd.DataFrame:
        return self.rows.assign(vector=list(self.vector), mean=list(self.mean), squares=list(self.squares), steps=self.steps)


def log_loss_gradient(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the batch's mean log loss for both vectors of each pair."""
    p = 1.0 / (1.0 + np.exp(-np.clip((a * b).sum(axis=1), -500, 500)))
    off = ((p - label) / len(label))[:, None]
    return off * b, off * a


def _cell(first: int, epochs: int, dimension: int, rate: float, batch: int, seed: int) -> Callable:
    """Descends one cell for ``epochs`` epochs from ``first`` on."""
    def run(state: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        modes = _Side(state[state["side"] == "mode"], dimension)
        actions = _Side(state[state["side"] == "action"], dimension)
        pairs = pairs.sort_values(["failure_mode", "action", "label"], kind="stable")
        m, a = modes.names.get_indexer(pairs["failure_mode"]), actions.names.get_indexer(pairs["action"])
        label, place = pairs["label"].to_numpy(float), pairs["place"].to_numpy(np.int64).view(np.uint64)
        for epoch in range(first, first + epochs):
            mixed = (place ^ np.uint64((seed * 1_000_003 + epoch) & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
            order = np.argsort(mixed ^ (mixed >> np.uint64(29)), kind="stable")
            for at in range(0, len(order), batch):
                rows = order[at:at + batch]
                of_mode, of_action = log_loss_gradient(modes.vector[m[rows]], actions.vector[a[rows]], label[rows])
                modes.descend(m[rows], of_mode, rate)
                actions.descend(a[rows], of_action, rate)
        return pd.concat([modes.frame(), actions.frame()], ignore_index=True)
    return run


def block_count(pairs: DataFrame, cell_pairs: int = CELL_PAIRS) -> int:
    """Blocks at which an even cell, a block of names and the part that one
    name has in a cell are expected to stay within ``cell_pairs`` rows."""
    def per_name(column: str) -> tuple[int, int]:
        names, most = pairs.groupBy(column).agg(F.count("*").alias("n")).agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
        return names, most
    return max(1, math.ceil(math.sqrt(pairs.count() / cell_pairs)),
               *(math.ceil(x / cell_pairs) for column in ("failure_mode", "action") for x in per_name(column)))


def two_tower_embeddings(long: DataFrame, dimension: int = DIMENSION, epochs: int = EPOCHS, rate: float = RATE,
                         batch: int = BATCH, blocks: int | None = None, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(failure_mode, vector) and (action, vector) from (failure_mode, action, cnt).

    ``blocks`` follows from the pairs (``block_count``) unless given. A single
    block has nothing to hand on, so all its epochs run in one task; more
    blocks take one job per stratum and epoch. An empty table gives two empty
    ones; null names have no vector."""
    pairs = training_pairs(long, seed)
    pairs = materialize(pairs.withColumn("place", F.xxhash64("failure_mode", "action", "label", F.lit(seed))), "two-tower-pairs")
    blocks = blocks or block_count(pairs)

    def block(column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column), F.lit(seed), F.lit("block")), F.lit(blocks))
    pairs = pairs.withColumn("task", block("failure_mode")).withColumn("stratum", F.pmod(block("action") - F.col("task"), F.lit(blocks)))
    positives = pairs.filter("label = 1")
    state = _start(positives.select(F.col("failure_mode").alias("name")).distinct(), "mode", dimension, seed).unionByName(
        _start(positives.select(F.col("action").alias("name")).distinct(), "action", dimension, seed))
    state = materialize(state, "two-tower")
    together = epochs if blocks == 1 else 1
    for first in range(0, epochs, together):
        for stratum in range(blocks):
            task = F.when(F.col("side") == "mode", block("name")).otherwise(F.pmod(block("name") - stratum, F.lit(blocks)))
            cells = pairs.filter(F.col("stratum") == stratum).select("task", "failure_mode", "action", "label", "place")
            run = _cell(first, together, dimension, rate, batch, seed)
            state = materialize(state.withColumn("task", task).groupBy("task").cogroup(cells.groupBy("task"))
                                .applyInPandas(run, STATE).drop("task"), "two-tower")
    return (state.filter("side = 'mode'").select(F.col("name").alias("failure_mode"), "vector"),
            state.filter("side = 'action'").select(F.col("name").alias("action"), "vector"))
