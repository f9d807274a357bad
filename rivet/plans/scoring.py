"""Scoring jobs and the fleet report.

Each job ends in a one-row-per-asset table; the global ranks use the
range-partitioned ``global_row_number`` rather than an unpartitioned window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivet import constants as K
from rivet.functions.exprs import advice, clip, risk_category, risk_marker
from rivet.operators.rank import global_row_number


def risk_report(scores: DataFrame, key: str = "asset_id", score: str = "failure_risk_score") -> DataFrame:
    """Category (half-open bins, 0 -> null) and 1..n priority by score desc,
    ties by asset (K9 tail: B10 + E7)."""
    s = scores.withColumn("risk_category", risk_category(score))
    return global_row_number(s, [F.col(score).desc_nulls_last(), F.col(key)], out="maintenance_priority_rank")


def rul_report(pred: DataFrame, key: str = "asset_id", hours: str = "predicted_rul_hours") -> DataFrame:
    """Clip at 0, days = hours / 24, urgency 1..n by hours asc (K10 tail: B9, B16, E7)."""
    p = pred.withColumn(hours, clip(hours, lower=0.0)).withColumn("predicted_rul_days", F.col(hours) / 24.0)
    return global_row_number(p, [F.col(hours).asc_nulls_last(), F.col(key)], out="maintenance_urgency_rank")


def fleet_report(risk: DataFrame, rul: DataFrame | None, causes: DataFrame | None,
                 recs: DataFrame | None, key: str = "asset_id") -> DataFrame:
    """risk left-join RUL, diagnosis and first recommended action, plus the
    marker and advice columns of the fleet view (K14, C5, B11, B18)."""
    out = risk.withColumn("status", risk_marker("risk_category")).withColumn(
        "recommended_action", advice("failure_risk_score"))
    if rul is not None:
        out = out.join(rul.select(key, "predicted_rul_hours", "predicted_rul_days"), key, "left")
    if causes is not None:
        out = out.join(causes.select(key, "likely_cause"), key, "left")
    if recs is not None:
        out = out.join(recs, key, "left")
    return out


def fleet_kpis(risk: DataFrame, rul: DataFrame | None) -> DataFrame:
    """Assets, high-risk count, mean risk, most urgent RUL."""
    k = risk.agg(F.count("*").alias("total_assets"),
                 F.sum((F.col("risk_category") == "High").cast("long")).alias("high_risk_assets"),
                 F.avg("failure_risk_score").alias("avg_fleet_risk"))
    if rul is not None:
        k = k.crossJoin(rul.agg(F.min("predicted_rul_hours").alias("min_rul_hours")))
    return k


def work_orders(failures: DataFrame, preventive: DataFrame, key: str = "asset_id") -> DataFrame:
    """Corrective orders from failures numbered first (by date, asset),
    preventive visits numbered after them, ids WO-%05d (K15, B19, G1).

    ``failures``: key, failure_date, failure_mode, downtime_hours, _tie;
    ``preventive``: key, work_order_date, _tie.
    """
    cor = global_row_number(failures, [F.col("failure_date"), F.col(key), F.col("_tie")], out="_n")
    n_cor = failures.count()
    pre = global_row_number(preventive, [F.col("work_order_date"), F.col(key), F.col("_tie")], out="_n")
    ctype, cdesc, cnotes = K.CORRECTIVE
    ptype, pdesc, pnotes = K.PREVENTIVE
    a = cor.select(F.format_string(K.WORK_ORDER_ID, F.col("_n")).alias("work_order_id"), key,
                   F.col("failure_date").alias("work_order_date"),
                   F.lit(ctype).alias("work_order_type"),
                   F.format_string(cdesc.replace("{mode}", "%s"), F.col("failure_mode")).alias("description"),
                   F.format_string(cnotes.replace("{mode}", "%s").replace("{hours}", "%d"),
                                   F.col("failure_mode"), F.col("downtime_hours")).alias("technician_notes"))
    b = pre.select(F.format_string(K.WORK_ORDER_ID, F.col("_n") + F.lit(n_cor)).alias("work_order_id"), key,
                   "work_order_date", F.lit(ptype).alias("work_order_type"),
                   F.lit(pdesc).alias("description"), F.lit(pnotes).alias("technician_notes"))
    return a.unionByName(b)
