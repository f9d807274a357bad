"""Model-input preparation.

* Asset-level split: assets (never rows) are ordered by a seeded md5 of
  their id and the first k become the test set; rows follow their asset
  through a semi / anti join (B3).
* Standard scaler with population std (zero std -> 1), fitted on one
  frame, applied to another (fit on train, persist in the pipeline).
* Deterministic sample: the ``n`` rows with the smallest seeded hash, a
  per-task top-n, so no row count is needed and nothing is collected.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivet.functions.exprs import nan_to_null
from rivet.operators.rank import global_row_number

EXCLUDED = ["asset_id", "timestamp", "operating_mode", "reading_id"]


def feature_columns(df: DataFrame, exclude: list[str]) -> list[str]:
    """All columns except the excluded ones and labels (B1)."""
    return [c for c in df.columns if c not in exclude and not c.startswith("failure_within_")]


def seeded_hash(*cols, seed: int = 42):
    """60-bit non-negative integer from md5(cols | seed)."""
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed))))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def asset_split(df: DataFrame, key: str = "asset_id", test_size: float = 0.2, seed: int = 42,
                rule: str = "ceil") -> DataFrame:
    """(asset, split) with k test assets: ``ceil`` -> ceil(test_size n);
    ``floor1`` -> max(1, int(test_size n)) (J1)."""
    assets = df.select(key).distinct().withColumn("_h", seeded_hash(key, seed=seed))
    n = assets.count()
    k = math.ceil(test_size * n) if rule == "ceil" else max(1, int(test_size * n))
    ranked = global_row_number(assets, [F.col("_h"), F.col(key)], out="_r")
    return ranked.select(key, F.when(F.col("_r") <= k, F.lit("test")).otherwise(F.lit("train")).alias("split"))


def split_rows(df: DataFrame, split: DataFrame, key: str = "asset_id") -> tuple[DataFrame, DataFrame]:
    """(train rows, test rows) by asset membership (B3: semi joins)."""
    test = split.filter(F.col("split") == "test").select(key)
    return df.join(test, key, "left_anti"), df.join(test, key, "left_semi")


def fit_scaler(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: ``<c>_mean`` and population ``<c>_std`` (0 -> 1)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    st = df.agg(*aggs)
    return st.select(*[F.col(f"{c}_mean") for c in cols],
                     *[F.when(F.col(f"{c}_std") > 0, F.col(f"{c}_std")).otherwise(F.lit(1.0)).alias(f"{c}_std")
                       for c in cols])


def apply_scaler(df: DataFrame, stats: DataFrame, cols: list[str]) -> DataFrame:
    """(x - mean) / std with the fitted one-row statistics (broadcast)."""
    j = df.crossJoin(F.broadcast(stats))
    return j.select(*[((F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_std")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def hash_sample(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash of ``key``."""
    return (df.withColumn("_h", seeded_hash(*key, seed=seed))
              .orderBy("_h", *key).limit(n).drop("_h"))


def top_n(df: DataFrame, by, n: int, tie: str) -> DataFrame:
    """Global top-n by a column or expression, ties by ``tie``."""
    return df.orderBy(by, F.col(tie)).limit(n)


def clean_sensors(df: DataFrame, sensors: list[str]) -> DataFrame:
    """NaN and null alike -> 0 on the raw sensors."""
    return df.withColumns({c: F.coalesce(nan_to_null(F.col(c)), F.lit(0.0)) for c in sensors})
