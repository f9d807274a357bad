"""Feature pipeline (K8) and RUL labels: C1-C3, E1-E4, E6, B9, B13, D8, D9.

Physical plan: readings and the two event logs are laid out once by
``(asset, time chunk)`` for the as-of columns and the global row number,
then once by ``(asset, row block)`` with a halo for all row-frame windows
(rolling, lag/trend, spectral energy, sequences). Every window in the
second stage shares one partitioning and one sort order, so Spark plans a
single Exchange + Sort for all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivet import constants as K
from rivet.functions.exprs import US_PER_DAY, US_PER_HOUR, clip, nan_to_null
from rivet.operators.prep import clean_sensors
from rivet.operators.series import blocked, index_series
from rivet.operators.windows import lag_trend, latest_n, rolling_stats, sliding_sequences, spectral_energy


def labelled_series(readings: DataFrame, failures: DataFrame, work_orders: DataFrame | None,
                    sensors: list[str], key: str = "asset_id", ts: str = "timestamp",
                    tie: str = "reading_id", horizons=K.HORIZONS_DAYS,
                    chunk_us: int | None = None, strict_recency: bool = False,
                    fill: bool = True) -> DataFrame:
    """Readings + rn + failure labels per horizon (C2) + next-failure hours
    (C1, null after the last failure) + days since maintenance (C3).

    Before an asset's first work order the original measures from that
    first (future) order, giving negative days; ``strict_recency=True``
    reports 999 there instead. Assets without orders get 0 either way."""
    if fill:
        r = clean_sensors(readings, sensors)
    else:  # rolling statistics skip missing readings, so they come before the zero-fill
        r = readings.withColumns({c: nan_to_null(F.col(c)) for c in sensors})
    idx = index_series(r, key, ts, tie, failures=failures, work_orders=work_orders,
                       chunk_us=chunk_us)
    gap = F.col("next_failure_us") - F.col("_us")
    cols = [F.coalesce((gap <= F.lit(h * US_PER_DAY)).cast("int"), F.lit(0)).alias(f"failure_within_{h}d")
            for h in horizons]
    cols.append((gap / F.lit(float(US_PER_HOUR))).alias("hours_to_failure"))
    if work_orders is not None:
        ref = F.coalesce(F.col("last_order_us"), F.col("first_order_us"))
        days = F.coalesce((F.col("_us") - ref) / F.lit(float(US_PER_DAY)), F.lit(0.0))
        if strict_recency:
            days = F.when(F.col("last_order_us").isNull() & F.col("first_order_us").isNotNull(),
                          F.lit(999.0)).otherwise(days)
        cols.append(days.alias("days_since_maintenance"))
    return idx.select("*", *cols)


def rul_labels(series: DataFrame, cap: float = K.RUL_CAP_HOURS) -> DataFrame:
    """Drop rows with no later failure, cap at ``cap`` hours."""
    return (series.filter(F.col("hours_to_failure").isNotNull())
                  .withColumn("rul_hours", clip("hours_to_failure", upper=cap)))


def feature_frame(readings: DataFrame, failures: DataFrame, work_orders: DataFrame,
                  sensors: list[str], key: str = "asset_id", ts: str = "timestamp",
                  tie: str = "reading_id", horizons=K.HORIZONS_DAYS, windows=K.ROLL_WINDOWS,
                  lag: int = K.LAG_ROWS, fft_col: str = "vibration_mm",
                  fft_window: int = K.FFT_WINDOW, chunk_us: int | None = None,
                  block_rows: int = 1_000_000) -> DataFrame:
    """The full feature table (K8): labels, rolling mean/std, lag/trend,
    spectral energy and days since maintenance, one row per reading."""
    s = labelled_series(readings, failures, work_orders, sensors, key, ts, tie, horizons, chunk_us, fill=False)
    halo = max(max(windows) - 1, lag, fft_window - 1)
    b = blocked(s, key, "rn", halo=halo, block_rows=block_rows)
    part = [key, "_blk"]
    b = clean_sensors(rolling_stats(b, sensors, windows, part, "rn"), sensors)
    b = lag_trend(b, sensors, lag, part, "rn")
    b = spectral_energy(b, fft_col, fft_window, K.FFT_MIN_ROWS, part, "rn", "rn",
                        f"{fft_col.split('_')[0]}_fft_energy")
    return b.filter(~F.col("_halo")).drop("_halo", "_blk")


def sequences(rul: DataFrame, features: list[str], key: str = "asset_id",
              length: int = K.SEQUENCE_LENGTH, stride: int = K.SEQUENCE_STRIDE,
              block_rows: int = 1_000_000) -> DataFrame:
    """Sliding sequences over RUL-labelled rows (E4). ``rn`` of labelled
    rows equals the asset's row number because only a suffix is dropped."""
    b = blocked(rul, key, "rn", halo=length - 1, block_rows=block_rows)
    seq = sliding_sequences(b.select(key, "rn", "_blk", "_halo", "rul_hours", *features),
                            features, "rul_hours", length, stride, [key, "_blk"], "rn", "rn")
    return seq.filter(~F.col("_halo")).select(key, F.col("rn").alias("end_rn"),
                                              F.col("rul_hours").alias("target"), "sequence")


def latest_sequences(readings: DataFrame, features: list[str], key: str = "asset_id",
                     length: int = K.SEQUENCE_LENGTH, ts: str = "timestamp", tie: str = "reading_id") -> DataFrame:
    """The most recent ``length`` readings of every asset, zero-filled."""
    return latest_n(clean_sensors(readings, features), key, [ts, tie], length, features)


def label_summary(series: DataFrame, horizons) -> DataFrame:
    """Positives and rate in percent per horizon (D8), one pass."""
    aggs = []
    for h in horizons:
        c = F.col(f"failure_within_{h}d")
        aggs += [F.sum(c).cast("long").alias(f"p{h}"), (F.avg(c) * 100.0).alias(f"r{h}")]
    one = series.agg(*aggs)
    stack = ", ".join(f"{h}, p{h}, r{h}" for h in horizons)
    return one.selectExpr(f"stack({len(horizons)}, {stack}) AS (horizon_days, positives, positive_rate_pct)")


def rul_summary(series: DataFrame, cap: float = K.RUL_CAP_HOURS) -> DataFrame:
    """Kept / dropped / capped counts and min / max / mean of the capped RUL."""
    h = F.col("hours_to_failure")
    capped = F.least(h, F.lit(cap))
    return series.agg(
        F.count(h).alias("rows_kept"),
        F.sum(h.isNull().cast("long")).alias("rows_dropped"),
        F.sum((h > cap).cast("long")).alias("rows_capped"),
        F.min(capped).alias("rul_min"), F.max(capped).alias("rul_max"),
        F.avg(capped).alias("rul_mean"))
