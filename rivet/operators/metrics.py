"""Model and business metrics as aggregates.

Every metric is one aggregation over the scored rows (partial aggregation
per task); ROC-AUC aggregates to distinct scores first and uses the
prefix sums of ``rivet.operators.rank``, never a single-task sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivet import constants as K
from rivet.functions.exprs import safe_div
from rivet.operators.rank import prefix_sums


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    return df.agg(F.sum((y & p).cast("long")).alias("tp"),
                  F.sum((~y & p).cast("long")).alias("fp"),
                  F.sum((y & ~p).cast("long")).alias("fn"),
                  F.sum((~y & ~p).cast("long")).alias("tn"))


def _prf(tp: Column, fp: Column, fn: Column):
    precision = safe_div(tp, tp + fp)
    recall = safe_div(tp, tp + fn)
    f1 = safe_div(2 * precision * recall, precision + recall)
    return precision, recall, f1


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row ``roc_auc``: Mann-Whitney with mid-ranks for ties (null when a
    class is empty), from counts per distinct score."""
    per = (df.groupBy(F.col(score).alias("_s"))
             .agg(F.sum((F.col(label) == 1).cast("long")).alias("_pos"),
                  F.sum((F.col(label) != 1).cast("long")).alias("_neg")))
    pref = prefix_sums(per, "_s", ["_neg"])
    below = F.col("cum__neg") - F.col("_neg")
    return pref.agg(F.sum(F.col("_pos") * (below + 0.5 * F.col("_neg"))).alias("_u"),
                    F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n")) \
               .select(F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                              F.col("_u") / (F.col("_p") * F.col("_n"))).alias("roc_auc"))


def binary_metrics(df: DataFrame, label: str, pred: str, score: str | None = None) -> DataFrame:
    """precision / recall / F1 (0 on zero division) and ROC-AUC."""
    c = confusion(df, label, pred)
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    out = c.select("tp", "fp", "fn", "tn", precision.alias("precision"),
                   recall.alias("recall"), f1.alias("f1"))
    if score is not None:
        out = out.crossJoin(roc_auc(df, label, score))
    return out


def _grouped_confusion(df: DataFrame, group: str, label: str, pred: str) -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    return df.groupBy(group).agg(*[F.sum(x.cast("long")).alias(n) for n, x in
                                   (("tp", y & p), ("fp", ~y & p), ("fn", y & ~p), ("tn", ~y & ~p))])


def grouped_f1(df: DataFrame, group: str, label: str, pred: str) -> DataFrame:
    """F1 for every ``group`` in one pass."""
    _, _, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return _grouped_confusion(df, group, label, pred).select(group, f1.alias("f1"))


def grouped_binary_metrics(df: DataFrame, group: str, label: str, pred: str, score: str) -> DataFrame:
    """precision / recall / F1 and mid-rank ROC-AUC for every ``group`` (the
    models of a comparison) over one table of scored rows."""
    per = (df.groupBy(group, F.col(score).alias("_s"))
             .agg(F.sum((F.col(label) == 1).cast("long")).alias("_pos"),
                  F.sum((F.col(label) != 1).cast("long")).alias("_neg")))
    ranked = prefix_sums(per, "_s", ["_neg"], part=[group])
    below = F.col("cum__neg") - F.col("_neg")
    auc = ranked.groupBy(group).agg(
        F.sum(F.col("_pos") * (below + 0.5 * F.col("_neg"))).alias("_u"),
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    c = _grouped_confusion(df, group, label, pred)
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.join(auc, group).select(
        group, "tp", "fp", "fn", "tn", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
        F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_u") / (F.col("_p") * F.col("_n"))).alias("roc_auc"))


def anomaly_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Anomaly-detector variant: P/R/F1, flagged count, total and true anomaly rate."""
    c = df.agg(F.sum(((F.col(label) == 1) & (F.col(pred) == 1)).cast("long")).alias("tp"),
               F.sum(((F.col(label) != 1) & (F.col(pred) == 1)).cast("long")).alias("fp"),
               F.sum(((F.col(label) == 1) & (F.col(pred) != 1)).cast("long")).alias("fn"),
               F.sum((F.col(pred) == 1).cast("long")).alias("flagged"),
               F.count("*").alias("readings"),
               F.avg((F.col(label) == 1).cast("double")).alias("true_anomaly_rate"))
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
                    "flagged", "readings", "true_anomaly_rate")


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """RMSE, MAE, MAPE = mean(|y-p| / max(y,1)) * 100."""
    err = F.col(y) - F.col(p)
    return df.agg(F.sqrt(F.avg(err * err)).alias("rmse"),
                  F.avg(F.abs(err)).alias("mae"),
                  (F.avg(F.abs(err) / F.greatest(F.col(y), F.lit(1.0))) * 100.0).alias("mape"))


def false_alarm_share(predictions: DataFrame, actuals: DataFrame, key: str = "asset_id",
                      score: str = "failure_risk_score", actual: str = "actual_failure",
                      threshold: float = 0.5) -> DataFrame:
    """FP / high-risk predictions (a false discovery rate, kept under the
    name ``false_positive_rate``), 0 when nothing is high risk (D12)."""
    m = predictions.join(actuals, key, "inner")
    hi = F.col(score) >= threshold
    agg = m.agg(F.sum((hi & (F.col(actual) != 1)).cast("long")).alias("false_positives"),
                F.sum(hi.cast("long")).alias("total_high_risk_predictions"))
    return agg.select("false_positives", "total_high_risk_predictions",
                      F.bround(safe_div("false_positives", "total_high_risk_predictions"), 4)
                      .alias("false_positive_rate"))


def best_row(df: DataFrame, by: str, ordinal: str, maximize: bool = True) -> DataFrame:
    """Arg-max (or arg-min) row, first by ``ordinal`` (of any type) on ties
    (D17). A top-1: each task keeps one row."""
    best = F.col(by).desc_nulls_last() if maximize else F.col(by).asc_nulls_last()
    return df.orderBy(best, F.col(ordinal).asc_nulls_last()).limit(1)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """balanced weights n/(2 n_c) and the neg/pos ratio."""
    c = df.agg(F.count("*").alias("n"),
               F.sum((F.col(label) == 1).cast("long")).alias("n_pos"),
               F.sum((F.col(label) != 1).cast("long")).alias("n_neg"))
    return c.select("n", "n_pos", "n_neg",
                    F.try_divide(F.col("n"), 2.0 * F.col("n_pos")).alias("weight_pos"),
                    F.try_divide(F.col("n"), 2.0 * F.col("n_neg")).alias("weight_neg"),
                    F.try_divide(F.col("n_neg").cast("double"), F.col("n_pos")).alias("scale_pos_weight"))


def quality_gate(metrics: DataFrame, f1: str = "f1", threshold: float = K.QUALITY_GATE_F1) -> DataFrame:
    """best F1 and whether it clears the gate."""
    return metrics.agg(F.max(f1).alias("best_f1")).select(
        "best_f1", (F.col("best_f1") >= threshold).alias("passed"))
