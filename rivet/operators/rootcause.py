"""Sensor baselines, z-scores and rule-based diagnosis.

Plan shape at scale: the baseline is one global aggregate (partial
aggregation per task, one row out), the latest row per asset is a
``max_by`` aggregate (map-side combine, so a hot asset never lands whole
in one task), and the one-row baseline is joined to the per-asset rows by
a broadcast nested-loop join whose build side is provably one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivet import constants as K
from rivet.functions.exprs import zscore
from rivet.operators.prep import clean_sensors
from rivet.operators.windows import latest_per_key


def sensor_baselines(readings: DataFrame, sensors: list[str],
                     mode_col: str = "operating_mode", normal: str = "normal") -> DataFrame:
    """One row: ``<s>_mean`` and sample ``<s>_std`` per sensor over normal rows."""
    aggs = []
    for s in sensors:
        aggs += [F.avg(s).alias(f"{s}_mean"), F.stddev_samp(s).alias(f"{s}_std")]
    return readings.filter(F.col(mode_col) == normal).agg(*aggs)


def with_zscores(df: DataFrame, baselines: DataFrame, sensors: list[str]) -> DataFrame:
    """Attach ``z_<s>`` per sensor by broadcasting the one-row baseline."""
    joined = df.crossJoin(F.broadcast(baselines))
    out = joined.select(
        *df.columns,
        *[zscore(s, f"{s}_mean", f"{s}_std").alias(f"z_{s}") for s in sensors])
    return out


def _z(s: str, present: set[str]) -> Column:
    # a signal the frame does not carry deviates by 0 (dict.get(s, 0))
    return F.col(f"z_{s}") if s in present else F.lit(0.0)


def _cond(conds, present) -> Column:
    out = None
    for s, op, v in conds:
        z = _z(s, present)
        c = {">": z > v, "<": z < v, "abs>": F.abs(z) > v}[op]
        out = c if out is None else (out & c)
    return out


def diagnosis(sensors: list[str], rules=K.DIAGNOSIS_RULES) -> Column:
    """struct(likely_cause, contributing_signals map) from ``z_<s>`` columns.

    Rules are tried in order, first match wins (B7); otherwise the single
    most deviant sensor by |z|, ties to the earlier sensor (B8).
    """
    present = set(sensors)
    branches = []
    for name, signals, conds in rules:
        m = F.create_map(*[x for s in signals
                           for x in (F.lit(s), F.bround(_z(s, present), 2))])
        branches.append(F.when(_cond(conds, present),
                               F.struct(F.lit(name).alias("likely_cause"),
                                        m.alias("contributing_signals"))))
    cands = F.array(*[F.struct(F.abs(F.col(f"z_{s}")).alias("a"),
                               F.lit(-i).alias("o"),
                               F.lit(s).alias("name"),
                               F.col(f"z_{s}").alias("z"))
                      for i, s in enumerate(sensors)])
    top = F.array_max(cands)
    fallback = F.struct(F.lit(K.UNCLASSIFIED).alias("likely_cause"),
                        F.create_map(top["name"], F.bround(top["z"], 2)).alias("contributing_signals"))
    return F.coalesce(*branches, fallback)


def root_cause_report(readings: DataFrame, sensors: list[str],
                      key: str = "asset_id", ts: str = "timestamp",
                      tie: str | None = "reading_id") -> DataFrame:
    """Latest reading of every asset diagnosed against normal baselines.
    Missing readings (null or NaN) count as 0 in both."""
    readings = clean_sensors(readings, sensors)
    base = sensor_baselines(readings, sensors)
    order = [ts] + ([tie] if tie else [])
    latest = latest_per_key(readings.select(key, *order, *sensors), key, order)
    z = with_zscores(latest, base, sensors)
    d = diagnosis(sensors)
    return z.select(key, ts, d["likely_cause"].alias("likely_cause"),
                    d["contributing_signals"].alias("contributing_signals"))
