"""Window operators.

Row-frame operators take the partition columns and the order column so the
same code runs on the skew-safe ``(asset, block)`` layout of
``rivet.operators.series.blocked`` (ordered by the global ``rn``) or on a
plain per-asset partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _w(part, order):
    return Window.partitionBy(*part).orderBy(*([order] if isinstance(order, str) else order))


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Latest row per key by ``order`` (E5).

    An aggregate, not a window: ``max_by`` combines map-side, so a hot key
    is reduced inside every task before the shuffle.
    """
    others = [c for c in df.columns if c != key]
    ordkey = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(key)
              .agg(F.max_by(F.struct(*[F.col(c) for c in others]), ordkey).alias("_r"))
              .select(key, "_r.*"))


def rolling_stats(df: DataFrame, sensors: list[str], windows: list[int],
                  part: list[str], order: str) -> DataFrame:
    """Rolling mean and sample std over the last k rows (E1). Missing readings
    are skipped; a frame without any reading has mean 0, one with fewer than
    two has std 0."""
    base = _w(part, order)
    cols = []
    for s in sensors:
        for k in windows:
            w = base.rowsBetween(-(k - 1), 0)
            cols.append(F.coalesce(F.avg(s).over(w), F.lit(0.0)).alias(f"{s}_roll_mean_{k}h"))
            cols.append(F.coalesce(F.stddev_samp(s).over(w), F.lit(0.0)).alias(f"{s}_roll_std_{k}h"))
    return df.select("*", *cols)


def lag_trend(df: DataFrame, sensors: list[str], lag: int, part: list[str], order: str) -> DataFrame:
    """Value ``lag`` rows back and x - lag, both 0 while undefined."""
    w = _w(part, order)
    cols = []
    for s in sensors:
        lg = F.lag(s, lag).over(w)
        cols.append(F.coalesce(lg, F.lit(0.0)).alias(f"{s}_lag_{lag}h"))
        cols.append(F.coalesce(F.col(s) - lg, F.lit(0.0)).alias(f"{s}_trend_{lag}h"))
    return df.select("*", *cols)


def spectral_energy(df: DataFrame, c: str, window: int, min_rows: int,
                    part: list[str], order: str, rn: str, out: str) -> DataFrame:
    """Energy of the de-meaned half spectrum over the last ``window`` rows.

    By Parseval, sum_k<=n/2 |rfft(x - mean)|^2 = (n^2 var_pop + [n even] a^2) / 2
    with a = sum (-1)^i x_i, so no FFT and no UDF: three aggregates on one frame.
    """
    w = _w(part, order).rowsBetween(-(window - 1), 0)
    n = F.count(c).over(w)
    vp = F.var_pop(c).over(w)
    sign = F.when(F.col(rn) % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    alt = F.sum(F.col(c) * sign).over(w)
    even = (n % 2 == 0).cast("double")
    energy = (n * n * vp + even * alt * alt) / 2.0
    return df.withColumn(out, F.when(n < min_rows, F.lit(0.0)).otherwise(energy))


def sliding_sequences(df: DataFrame, features: list[str], target: str, length: int,
                      stride: int, part: list[str], order: str, rn: str) -> DataFrame:
    """Windows of ``length`` rows ending every ``stride`` rows from the
    ``length``-th row of each asset; target taken at the last row (E4).

    Rows are first grouped into strides, one array each, that end where a
    sequence may end; a sequence is then the last few of those arrays. So an
    array is built for every ``stride`` rows, not for every row, and
    both steps share the exchange on ``part``. ``rn`` has no gaps.
    """
    others = [c for c in df.columns if c not in part]
    row = F.struct(F.col(order).alias("at"), F.array(*[F.col(f).cast("float") for f in features]).alias("x"))
    strides = (df.repartition(*part).withColumn("_end", F.ceil((F.col(rn) - length) / stride)).groupBy(*part, "_end")
               .agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["x"]).alias("_rows"),
                    F.max_by(F.struct(*others), order).alias("_last")))
    w = _w(part, "_end").rowsBetween(-(-(-length // stride) - 1), 0)
    steps = strides.withColumn("_rows", F.flatten(F.collect_list("_rows").over(w)))
    end = F.col(f"_last.{rn}")
    keep = (end >= length) & (((end - length) % stride) == 0)
    first = F.greatest(F.size("_rows") - length + 1, F.lit(1))
    return steps.filter(keep).select(*[F.col(c) if c in part else F.col(f"_last.{c}") for c in df.columns],
                                     F.slice("_rows", first, F.lit(length)).alias("sequence"))


def latest_n(df: DataFrame, key: str, order: list[str], n: int, features: list[str]) -> DataFrame:
    """The last ``n`` rows of each asset by ``order`` as one sequence; assets
    with fewer rows are dropped (E6).

    The rank limit lets Spark keep ``n`` rows per asset in every task before
    the shuffle (WindowGroupLimit), so an asset's history never moves."""
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    tail = df.select(key, *order, *features).withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") <= n)
    return (tail.groupBy(key)
                .agg(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("_at"),
                                                          *[F.col(f) for f in features]))).alias("_s"))
                .filter(F.size("_s") == n)
                .select(key, F.transform("_s", lambda s: F.array(*[s[f].cast("float") for f in features]))
                        .alias("sequence")))


def top_k_per_group(df: DataFrame, group: str, score: str, tie: str, k: int,
                    positive_only: bool = True) -> DataFrame:
    """Top ``k`` rows per group by score desc, ties by ``tie`` asc.

    Catalyst adds a WindowGroupLimit below the shuffle, so each task keeps
    at most k rows per group before the exchange.
    """
    if positive_only:
        df = df.filter(F.col(score) > 0)
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(tie).asc())
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
