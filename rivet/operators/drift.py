"""Distribution drift.

Two-sample Kolmogorov-Smirnov per column: values are aggregated to
distinct values with per-side counts (a hot value becomes one row), the
two ECDFs come from grouped prefix sums, and D = max |F1 - F2| is one
aggregate. The p-value of samples up to ``exact_rows`` rows is exact, by a
recurrence over the lattice paths of the two samples; above, it is the
Kolmogorov limit series p = 2 sum_k (-1)^(k-1) exp(-2 k^2 lambda^2),
lambda = sqrt(n m / (n + m)) D, clamped to [0, 1].
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivet import constants as K
from rivet.operators.rank import prefix_sums, split_rule
from rivet.session import materialize

KS_TERMS = 100
KS_SMALL = 0.2
EXACT_ROWS = 10_000  # the larger sample's rows up to which p is exact


def exact_p(n: int, m: int, d: float) -> float:
    """P(D >= d) of two samples of ``n`` and ``m`` rows from one continuous
    distribution.

    All orders of the rows are equally likely lattice paths from (0, 0) to
    (n, m); D is reached where |i / n - j / m| >= d. v(i, j), the share of
    paths to (i, j) that have met such a place, is 1 there and else the mean
    of v(i - 1, j) and v(i, j - 1) weighted by i and j; it is carried from
    diagonal to diagonal, O((n + m) min(n, m)) sums of positive numbers."""
    if n > m:
        n, m = m, n
    reach = round(d * n * m)
    v, low = np.array([1.0 if reach <= 0 else 0.0]), 0  # of the places on the diagonal, from i = low
    for s in range(1, n + m + 1):
        first, last = max(0, s - m), min(n, s)
        i = np.arange(first, last + 1)
        before = np.zeros(last - first + 3)  # v of the last diagonal at i = first - 1 .. last + 1
        a = low - (first - 1)
        before[a:a + len(v)] = v[:len(before) - a]
        v = (before[:-2] * i + before[1:-1] * (s - i)) / s
        v[np.abs(i * m - (s - i) * n) >= reach] = 1.0
        low = first
    return float(v[0])


def _exact_p_column(n: Column, m: Column, d: Column) -> Column:
    @F.pandas_udf("double")
    def p(n: pd.Series, m: pd.Series, d: pd.Series) -> pd.Series:  # one row per column
        return pd.Series([exact_p(int(a), int(b), float(c)) if c == c else float("nan") for a, b, c in zip(n, m, d, strict=True)])
    return p(n, m, d)


def kolmogorov_p(lam: Column) -> Column:
    """Tail of the Kolmogorov distribution. Below ``KS_SMALL`` it is 1 to more
    digits than a double prints, and the alternating series would need ever
    more terms there."""
    terms = F.sequence(F.lit(1), F.lit(KS_TERMS))
    s = F.aggregate(terms, F.lit(0.0),
                    lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam))
    return F.when(lam < KS_SMALL, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * s)))


def _ks_from_counts(per: DataFrame, alpha: float, exact_rows: int) -> DataFrame:
    """KS rows from per-value counts (column, v, c1, c2, s1, s2).

    Both ECDFs of all columns are one grouped prefix sum over the distinct
    values; D is one aggregate of it.
    """
    cum = prefix_sums(per, "v", ["c1", "c2"], part=["column"])
    n = per.groupBy("column").agg(F.sum("c1").alias("n1"), F.sum("c2").alias("n2"))  # one row per column
    d = cum.join(F.broadcast(n), "column").groupBy("column").agg(
        F.max(F.abs(F.col("cum_c1") / F.col("n1") - F.col("cum_c2") / F.col("n2"))).alias("d"),
        F.first("n1").alias("n1"), F.first("n2").alias("n2"),
        F.sum("s1").alias("t1"), F.sum("s2").alias("t2"))
    lam = F.sqrt(F.col("n1") * F.col("n2") / (F.col("n1") + F.col("n2"))) * F.col("d")
    limit, small = kolmogorov_p(lam), F.greatest("n1", "n2") <= exact_rows
    if exact_rows:  # rows above the bound never reach the recurrence
        d = materialize(d.withColumn("limit_p", limit), "ks-statistics")
        d = d.filter(small).withColumn("p", _exact_p_column(F.col("n1"), F.col("n2"), F.col("d"))).unionByName(
            d.filter(~small).withColumn("p", F.col("limit_p")))
    p = F.col("p") if exact_rows else limit
    return d.select("column",
                    F.bround("d", 4).alias("ks_statistic"),
                    F.bround(p, 4).alias("p_value"),
                    (p < alpha).alias("drifted"),
                    F.bround(F.col("t1") / F.col("n1"), 3).alias("reference_mean"),
                    F.bround(F.col("t2") / F.col("n2"), 3).alias("current_mean"))


def _long(df: DataFrame, columns: list[str], side: Column) -> DataFrame:
    """(_s, column, v), nulls and NaN dropped per column."""
    x = df.select(side.alias("_s"), *[F.col(c).cast("double").alias(c) for c in columns])
    return x.unpivot("_s", columns, "column", "v").filter(F.col("v").isNotNull() & ~F.isnan("v"))


def _per_value(both: DataFrame) -> DataFrame:
    """(column, v, c1, c2, s1, s2): per-side counts and sums of every
    distinct value of every column. A hot value becomes one row."""
    return both.groupBy("column", "v").agg(F.sum((F.col("_s") == 1).cast("long")).alias("c1"),
                                           F.sum((F.col("_s") == 2).cast("long")).alias("c2"),
                                           F.sum(F.when(F.col("_s") == 1, F.col("v"))).alias("s1"),
                                           F.sum(F.when(F.col("_s") == 2, F.col("v"))).alias("s2"))


def value_counts(ref: DataFrame, cur: DataFrame, columns: list[str]) -> DataFrame:
    """Per-value counts of two samples, in one pass over both."""
    return _per_value(_long(ref, columns, F.lit(1)).unionByName(_long(cur, columns, F.lit(2))))


def ks_column(ref: DataFrame, cur: DataFrame, c: str, alpha: float = K.KS_ALPHA, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """One row: column, ks_statistic, p_value, drifted, reference_mean,
    current_mean (statistics rounded half-even 4/4/3; drift on unrounded p)."""
    return data_drift(ref, cur, [c], alpha, exact_rows)


def data_drift(ref: DataFrame, cur: DataFrame, columns: list[str], alpha: float = K.KS_ALPHA,
               exact_rows: int = EXACT_ROWS) -> DataFrame:
    """KS report for every column (D13). The samples are read once; the
    per-value table is written once and every column's ECDF comes from one
    grouped prefix sum over it. p is exact for columns whose larger sample
    has at most ``exact_rows`` rows; 0 takes the limit series for all."""
    return _ks_from_counts(materialize(value_counts(ref, cur, columns), "ks-values"), alpha, exact_rows)


def split_drift(sample: DataFrame, order: list[str], columns: list[str], share: float = K.DRIFT_REFERENCE_SHARE,
                alpha: float = K.KS_ALPHA, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """KS report of the first ``share`` of ``sample`` under ``order`` against
    the rest (E8, D13): the side is a column, so one scan counts both."""
    return _split_report(sample, split_rule(sample, order, share)[0], columns, alpha, exact_rows)


def _split_report(sample: DataFrame, first: Column, columns: list[str], alpha: float, exact_rows: int) -> DataFrame:
    side = F.when(first, 1).otherwise(2)
    return _ks_from_counts(materialize(_per_value(_long(sample, columns, side)), "ks-values"), alpha, exact_rows)


def prediction_drift(ref: DataFrame, cur: DataFrame, score: str, alpha: float = K.KS_ALPHA,
                     exact_rows: int = EXACT_ROWS) -> DataFrame:
    """KS on two score samples plus mean risk per side."""
    r = ks_column(ref, cur, score, alpha, exact_rows)
    return r.select("ks_statistic", "p_value", "drifted",
                    F.col("reference_mean").alias("reference_mean_risk"),
                    F.col("current_mean").alias("current_mean_risk"))


def drift_rollup(report: DataFrame) -> DataFrame:
    """Number drifted of number of columns and the advice text."""
    agg = report.agg(F.sum(F.col("drifted").cast("long")).alias("n_drifted"),
                     F.count("*").alias("n_columns"))
    return agg.select("n_drifted", "n_columns",
                      F.when(F.col("n_drifted") > 0, F.lit(K.DRIFT_ADVICE))
                      .otherwise(F.lit(K.NO_DRIFT_ADVICE))
                      .alias("recommendation"))


def period_summary(ref: DataFrame, cur: DataFrame, ts: str) -> DataFrame:
    """min / max timestamp and rows per side."""
    both = (ref.select(F.col(ts).alias("t"), F.lit("reference").alias("period"))
            .unionByName(cur.select(F.col(ts).alias("t"), F.lit("current").alias("period"))))
    return both.groupBy("period").agg(F.min("t").alias("start"), F.max("t").alias("end"),
                                      F.count("*").alias("rows"))


def monitoring_job(sample: DataFrame, order: list[str], columns: list[str],
                   share: float = K.DRIFT_REFERENCE_SHARE, exact_rows: int = EXACT_ROWS):
    """Ordered 70/30 split (E8), KS report (D13) and roll-up."""
    first, _ = split_rule(sample, order, share)
    report = _split_report(sample, first, columns, K.KS_ALPHA, exact_rows)
    return sample.filter(first), sample.filter(~first), report, drift_rollup(report)
