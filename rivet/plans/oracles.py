"""Independent DuckDB SQL for each registered query (same column names).

Written by hand against the raw views (region nation customer supplier part
orders lineitem events ...); nothing here is generated from the Spark code.
``R6(x)`` = round to 6 digits and fold -0.0 into 0.0, mirroring ``r6``.
"""

from __future__ import annotations


def R6(x: str, digits: int = 6, nudge: str = "1e-12") -> str:
    return f"(round(({x}) * (1.0 + {nudge}), {digits}) + 0.0)"


# readings role projected from events (see rivet.sources.testdata)
READINGS = """
r AS (
  SELECT user_id AS asset_id, ts AS "timestamp", event_id AS reading_id,
         CASE event_type WHEN 'error' THEN 'critical'
                         WHEN 'purchase' THEN 'degrading' ELSE 'normal' END AS operating_mode,
         value AS vibration_mm,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS temperature_f
  FROM events)"""

ORACLES: dict[str, str] = {}

ORACLES["root_cause_report"] = f"""
WITH {READINGS},
b AS (SELECT avg(vibration_mm) AS mv, stddev_samp(vibration_mm) AS sv,
             avg(temperature_f) AS mt, stddev_samp(temperature_f) AS st
      FROM r WHERE operating_mode = 'normal'),
l AS (SELECT * FROM r
      QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY "timestamp" DESC, reading_id DESC) = 1),
z AS (SELECT l.asset_id, l."timestamp",
             CASE WHEN sv > 0 THEN (vibration_mm - mv) / sv ELSE 0.0 END AS zv,
             CASE WHEN st > 0 THEN (temperature_f - mt) / st ELSE 0.0 END AS zt
      FROM l CROSS JOIN b)
SELECT asset_id, "timestamp",
       CASE WHEN zv > 1.5 AND zt > 1.0 THEN 'Bearing wear' ELSE 'Unclassified anomaly' END AS likely_cause,
       CASE WHEN zv > 1.5 AND zt > 1.0 THEN 'vibration_mm'
            WHEN abs(zt) > abs(zv) THEN 'temperature_f' ELSE 'vibration_mm' END AS signal_1,
       {R6("round_even(CASE WHEN zv > 1.5 AND zt > 1.0 THEN zv WHEN abs(zt) > abs(zv) THEN zt ELSE zv END, 2)")} AS z_1,
       CASE WHEN zv > 1.5 AND zt > 1.0 THEN 'temperature_f' END AS signal_2,
       CASE WHEN zv > 1.5 AND zt > 1.0 THEN {R6("round_even(zt, 2)")} END AS z_2
FROM z
"""


# --- feature pipeline --------------------------------------------------------
EVENTS_LOGS = """
f AS (SELECT user_id AS asset_id, ts AS fts FROM events WHERE event_type = 'error'),
w AS (SELECT user_id AS asset_id, ts AS wts FROM events WHERE event_type = 'signup')"""

# next failure strictly after / last order strictly before, first order per asset
ASOF = """
nf AS (SELECT r.*, f.fts AS next_f
       FROM r ASOF LEFT JOIN f ON r.asset_id = f.asset_id AND f.fts > r."timestamp"),
lo AS (SELECT nf.*, w.wts AS last_w
       FROM nf ASOF LEFT JOIN w ON nf.asset_id = w.asset_id AND w.wts < nf."timestamp"),
fo AS (SELECT asset_id, min(wts) AS first_w FROM w GROUP BY asset_id),
s AS (SELECT lo.*, fo.first_w,
             (epoch_us(next_f) - epoch_us(lo."timestamp")) / 3600000000.0 AS hours_to_failure,
             coalesce((epoch_us(lo."timestamp") - epoch_us(coalesce(last_w, first_w))) / 86400000000.0, 0.0)
               AS days_since_maintenance,
             row_number() OVER (PARTITION BY lo.asset_id ORDER BY lo."timestamp", lo.reading_id) AS rn
      FROM lo LEFT JOIN fo ON lo.asset_id = fo.asset_id)"""

BASE = f"WITH {READINGS},{EVENTS_LOGS},{ASOF}"


def _label(h: int) -> str:
    return (f"CAST(coalesce(epoch_us(next_f) - epoch_us(\"timestamp\") <= {h} * 86400000000, false) AS INTEGER)"
            f" AS failure_within_{h}d")


ORACLES["failure_labels"] = f"""{BASE}
SELECT asset_id, "timestamp", reading_id, {_label(1)}, {_label(3)}, {_label(7)} FROM s"""

ORACLES["rul_labels"] = f"""{BASE}
SELECT asset_id, "timestamp", reading_id, {R6("least(hours_to_failure, 3000.0)")} AS rul_hours
FROM s WHERE next_f IS NOT NULL"""

ORACLES["days_since_maintenance"] = f"""{BASE}
SELECT asset_id, "timestamp", reading_id, {R6("days_since_maintenance")} AS days_since_maintenance FROM s"""

_SENS = ["vibration_mm", "temperature_f"]


def _win(k: int) -> str:
    return f"(PARTITION BY asset_id ORDER BY \"timestamp\", reading_id ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


def _roll_cols() -> list[str]:
    out = []
    for s in _SENS:
        for k in (6, 24, 72):
            out.append(f"{R6(f'avg({s}) OVER {_win(k)}')} AS {s}_roll_mean_{k}h")
            out.append(f"{R6(f'coalesce(stddev_samp({s}) OVER {_win(k)}, 0.0)')} AS {s}_roll_std_{k}h")
    return out


def _lag_cols() -> list[str]:
    out = []
    for s in _SENS:
        lg = f"lag({s}, 24) OVER (PARTITION BY asset_id ORDER BY \"timestamp\", reading_id)"
        out.append(f"{R6(f'coalesce({lg}, 0.0)')} AS {s}_lag_24h")
        out.append(f"{R6(f'coalesce({s} - {lg}, 0.0)')} AS {s}_trend_24h")
    return out


_ENERGY = f"""(round((1.0 + 1e-9) * CASE WHEN count(vibration_mm) OVER {_win(24)} < 4 THEN 0.0 ELSE
   (count(vibration_mm) OVER {_win(24)} * count(vibration_mm) OVER {_win(24)} * var_pop(vibration_mm) OVER {_win(24)}
    + CASE WHEN count(vibration_mm) OVER {_win(24)} % 2 = 0
           THEN pow(sum(CASE WHEN rn % 2 = 0 THEN vibration_mm ELSE -vibration_mm END) OVER {_win(24)}, 2)
           ELSE 0.0 END) / 2.0 END, 2) + 0.0)"""

ORACLES["rolling_features"] = f"""{BASE}
SELECT asset_id, reading_id, {", ".join(_roll_cols())} FROM s"""

ORACLES["lag_trend_features"] = f"""{BASE}
SELECT asset_id, reading_id, {", ".join(_lag_cols())} FROM s"""

ORACLES["spectral_energy"] = f"""{BASE}
SELECT asset_id, reading_id, {_ENERGY} AS vibration_fft_energy FROM s"""

ORACLES["feature_table"] = f"""{BASE}
SELECT asset_id, "timestamp", reading_id, operating_mode,
       {R6("vibration_mm")} AS vibration_mm, {R6("temperature_f")} AS temperature_f,
       {_label(1)}, {_label(3)}, {_label(7)},
       {", ".join(_roll_cols())}, {", ".join(_lag_cols())},
       {_ENERGY} AS vibration_fft_energy,
       {R6("days_since_maintenance")} AS days_since_maintenance
FROM s"""

ORACLES["label_summary"] = f"""{BASE},
l AS (SELECT {_label(1)}, {_label(3)}, {_label(7)} FROM s)
SELECT 1 AS horizon_days, CAST(sum(failure_within_1d) AS BIGINT) AS positives,
       {R6("avg(failure_within_1d) * 100.0")} AS positive_rate_pct FROM l
UNION ALL
SELECT 3, CAST(sum(failure_within_3d) AS BIGINT), {R6("avg(failure_within_3d) * 100.0")} FROM l
UNION ALL
SELECT 7, CAST(sum(failure_within_7d) AS BIGINT), {R6("avg(failure_within_7d) * 100.0")} FROM l"""

ORACLES["rul_summary"] = f"""{BASE}
SELECT count(hours_to_failure) AS rows_kept,
       CAST(sum(CASE WHEN hours_to_failure IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_dropped,
       CAST(sum(CASE WHEN hours_to_failure > 3000.0 THEN 1 ELSE 0 END) AS BIGINT) AS rows_capped,
       {R6("min(least(hours_to_failure, 3000.0))")} AS rul_min,
       {R6("max(least(hours_to_failure, 3000.0))")} AS rul_max,
       {R6("avg(least(hours_to_failure, 3000.0))")} AS rul_mean
FROM s"""

ORACLES["sliding_sequences"] = f"""{BASE},
k AS (SELECT asset_id, rn, least(hours_to_failure, 3000.0) AS target, vibration_mm, temperature_f
      FROM s WHERE next_f IS NOT NULL),
e AS (SELECT asset_id, rn AS end_rn, target FROM k WHERE rn >= 20 AND (rn - 20) % 6 = 0)
SELECT e.asset_id, e.end_rn, {R6("e.target")} AS target, CAST(k.rn - e.end_rn + 19 AS INTEGER) AS step,
       {R6("CAST(CAST(k.vibration_mm AS FLOAT) AS DOUBLE)")} AS vibration_mm,
       {R6("CAST(CAST(k.temperature_f AS FLOAT) AS DOUBLE)")} AS temperature_f
FROM e JOIN k ON k.asset_id = e.asset_id AND k.rn BETWEEN e.end_rn - 19 AND e.end_rn"""

ORACLES["latest_sequences"] = f"""WITH {READINGS},
k AS (SELECT asset_id, vibration_mm, temperature_f,
             row_number() OVER (PARTITION BY asset_id ORDER BY "timestamp" DESC, reading_id DESC) AS back,
             count(*) OVER (PARTITION BY asset_id) AS n
      FROM r)
SELECT asset_id, CAST(60 - back AS INTEGER) AS step,
       {R6("CAST(CAST(vibration_mm AS FLOAT) AS DOUBLE)")} AS vibration_mm,
       {R6("CAST(CAST(temperature_f AS FLOAT) AS DOUBLE)")} AS temperature_f
FROM k WHERE n >= 60 AND back <= 60"""

ORACLES["latest_reading"] = f"""WITH {READINGS}
SELECT * FROM r
QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY "timestamp" DESC, reading_id DESC) = 1"""


# --- validation ------------------------------------------------------------------
_VIOL = f"""WITH {READINGS},
v AS (
  SELECT asset_id, reading_id, 'vibration_mm' AS "column", 'in_range(0, 20)' AS "check",
         CAST(vibration_mm AS VARCHAR) AS failure_case
  FROM r WHERE vibration_mm < 0 OR vibration_mm > 20
  UNION ALL
  SELECT asset_id, reading_id, 'temperature_f', 'in_range(-20, 400)', CAST(temperature_f AS VARCHAR)
  FROM r WHERE temperature_f < -20 OR temperature_f > 400
  UNION ALL
  SELECT asset_id, reading_id, 'operating_mode', 'isin([''normal'', ''degrading'', ''critical''])', operating_mode
  FROM r WHERE operating_mode NOT IN ('normal', 'degrading', 'critical')
  UNION ALL
  SELECT asset_id, reading_id, c, 'not_nullable', CAST(NULL AS VARCHAR)
  FROM (SELECT asset_id, reading_id,
               unnest([CASE WHEN asset_id IS NULL THEN 'asset_id' END,
                       CASE WHEN "timestamp" IS NULL THEN 'timestamp' END,
                       CASE WHEN operating_mode IS NULL THEN 'operating_mode' END,
                       CASE WHEN vibration_mm IS NULL THEN 'vibration_mm' END,
                       CASE WHEN temperature_f IS NULL THEN 'temperature_f' END]) AS c FROM r)
  WHERE c IS NOT NULL)"""

ORACLES["validation_violations"] = f"""{_VIOL}
SELECT * FROM v"""

ORACLES["validation_summary"] = f"""{_VIOL}
SELECT "column", "check", count(*) AS failures FROM v GROUP BY 1, 2"""

ORACLES["missing_profile"] = """
WITH p AS (
  SELECT avg(CASE WHEN c_custkey IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS c_custkey,
         avg(CASE WHEN c_name IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS c_name,
         avg(CASE WHEN c_nationkey IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS c_nationkey,
         avg(CASE WHEN c_acctbal IS NULL OR isnan(c_acctbal) THEN 1.0 ELSE 0.0 END) * 100 AS c_acctbal,
         avg(CASE WHEN c_mktsegment IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS c_mktsegment
  FROM customer)
SELECT "column", round_even(missing_pct, 2) AS missing_pct, round_even(missing_pct, 2) > 5.0 AS reported
FROM (UNPIVOT p ON c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
      INTO NAME "column" VALUE missing_pct)"""

ORACLES["duplicate_keys"] = """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey, l_shipdate)"""

ORACLES["validation_report"] = f"""{_VIOL}
SELECT CASE WHEN (SELECT count(*) FROM v) > 0 OR 8 > 0 THEN 'failed' ELSE 'passed' END AS status,
       (SELECT count(*) FROM v) AS cell_violations,
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM r GROUP BY asset_id, "timestamp")) AS duplicate_rows,
       CAST(0 AS BIGINT) AS columns_over_missing_limit,
       CAST(8 AS BIGINT) AS schema_violations"""


# --- metrics and monitoring ---------------------------------------------------------
SCORED = """
e AS (SELECT event_id, ts, user_id, value / (value + 50.0) AS score,
             CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
             CASE WHEN value / (value + 50.0) >= 0.5 THEN 1 ELSE 0 END AS pred
      FROM events)"""


def _prf_sql(src: str) -> str:
    return f"""
  SELECT tp, fp, fn, tn,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall
  FROM (SELECT CAST(sum(label * pred) AS BIGINT) AS tp, CAST(sum((1 - label) * pred) AS BIGINT) AS fp,
               CAST(sum(label * (1 - pred)) AS BIGINT) AS fn,
               CAST(sum((1 - label) * (1 - pred)) AS BIGINT) AS tn FROM {src})"""


def _f1(p="precision", r="recall") -> str:
    return f"CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END"


ORACLES["binary_metrics"] = f"""WITH {SCORED},
c AS ({_prf_sql("e")}),
per AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM e GROUP BY score),
cum AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score) - neg AS below FROM per),
a AS (SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                  THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS roc_auc FROM cum)
SELECT tp, fp, fn, tn, {R6("precision")} AS precision, {R6("recall")} AS recall,
       {R6(_f1())} AS f1, {R6("roc_auc")} AS roc_auc
FROM c, a"""

ORACLES["anomaly_metrics"] = f"""WITH {READINGS},
x AS (SELECT CASE WHEN operating_mode <> 'normal' THEN 1 ELSE 0 END AS label,
             CASE WHEN vibration_mm > 80 THEN 1 ELSE 0 END AS pred FROM r),
c AS (SELECT CAST(sum(label * pred) AS BIGINT) AS tp, CAST(sum((1 - label) * pred) AS BIGINT) AS fp,
             CAST(sum(label * (1 - pred)) AS BIGINT) AS fn, CAST(sum(pred) AS BIGINT) AS flagged,
             count(*) AS readings, avg(label) AS rate FROM x),
p AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
                CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM c)
SELECT {R6("precision")} AS precision, {R6("recall")} AS recall, {R6(_f1())} AS f1,
       flagged, readings, {R6("rate")} AS true_anomaly_rate FROM p"""

ORACLES["regression_metrics"] = f"""{BASE},
x AS (SELECT least(hours_to_failure, 3000.0) AS y, temperature_f * 5.0 AS p FROM s WHERE next_f IS NOT NULL)
SELECT {R6("sqrt(avg((y - p) * (y - p)))")} AS rmse, {R6("avg(abs(y - p))")} AS mae,
       {R6("avg(abs(y - p) / greatest(y, 1.0)) * 100.0")} AS mape FROM x"""

ORACLES["false_alarm_share"] = f"""WITH {SCORED},
pr AS (SELECT user_id AS asset_id, score AS failure_risk_score FROM e
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
ac AS (SELECT user_id AS asset_id,
              CASE WHEN sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) >= 14 THEN 1 ELSE 0 END
                AS actual_failure
       FROM events GROUP BY user_id),
m AS (SELECT * FROM pr JOIN ac USING (asset_id)),
c AS (SELECT CAST(sum(CASE WHEN failure_risk_score >= 0.5 AND actual_failure <> 1 THEN 1 ELSE 0 END) AS BIGINT)
               AS false_positives,
             CAST(sum(CASE WHEN failure_risk_score >= 0.5 THEN 1 ELSE 0 END) AS BIGINT)
               AS total_high_risk_predictions FROM m)
SELECT false_positives, total_high_risk_predictions,
       round_even(CASE WHEN total_high_risk_predictions > 0
                       THEN false_positives / total_high_risk_predictions ELSE 0.0 END, 4)
         AS false_positive_rate
FROM c"""

ORACLES["best_row"] = f"""WITH {SCORED}
SELECT event_id, user_id, {R6("score")} AS score FROM e ORDER BY score DESC, event_id ASC LIMIT 1"""

ORACLES["class_weights"] = f"""{BASE},
l AS (SELECT {_label(1)} FROM s),
c AS (SELECT count(*) AS n, CAST(sum(failure_within_1d) AS BIGINT) AS n_pos,
             CAST(sum(1 - failure_within_1d) AS BIGINT) AS n_neg FROM l)
SELECT n, n_pos, n_neg, {R6("n / (2.0 * n_pos)")} AS weight_pos, {R6("n / (2.0 * n_neg)")} AS weight_neg,
       {R6("n_neg / n_pos")} AS scale_pos_weight FROM c"""

ORACLES["quality_gate"] = f"""WITH {SCORED},
t AS (SELECT unnest([0.3, 0.5, 0.7]) AS thr),
x AS (SELECT thr, label, CASE WHEN score >= thr THEN 1 ELSE 0 END AS pred FROM e, t),
c AS (SELECT thr, sum(label * pred) AS tp, sum((1 - label) * pred) AS fp, sum(label * (1 - pred)) AS fn
      FROM x GROUP BY thr),
p AS (SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM c),
f AS (SELECT max({_f1()}) AS best_f1 FROM p)
SELECT {R6("best_f1")} AS best_f1, best_f1 >= 0.70 AS passed FROM f"""

ORACLES["run_table"] = f"""WITH {SCORED},
t AS (SELECT unnest([0.3, 0.5, 0.7]) AS thr, unnest([1, 2, 3]) AS version),
x AS (SELECT version, thr, label, CASE WHEN score >= thr THEN 1 ELSE 0 END AS pred FROM e, t),
c AS (SELECT version, thr, sum(label * pred) AS tp, sum((1 - label) * pred) AS fp,
             sum(label * (1 - pred)) AS fn FROM x GROUP BY version, thr),
p AS (SELECT version, thr, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM c),
f AS (SELECT version, thr, {_f1()} AS f1 FROM p)
SELECT 'threshold-rule' AS name, version, CASE WHEN row_number() OVER (ORDER BY f1 DESC, version) = 1
       THEN 'Staging' ELSE 'None' END AS stage, 'threshold/' || thr AS path, {R6("f1")} AS f1 FROM f"""

SPLIT = """
li AS (SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                              l_extendedprice) AS rn,
              count(*) OVER () AS n FROM lineitem),
sp AS (SELECT *, CASE WHEN rn <= floor(0.7 * n) THEN 'reference' ELSE 'current' END AS period FROM li)"""

ORACLES["temporal_split"] = f"""WITH {SPLIT}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, period FROM sp"""


def _ks_sql(long_src: str, col_name: str = "col") -> str:
    return f"""
per AS (SELECT {col_name} AS col, v, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c1,
               sum(CASE WHEN side = 2 THEN 1 ELSE 0 END) AS c2 FROM {long_src}
        WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY 1, 2),
cum AS (SELECT col, sum(c1) OVER (PARTITION BY col ORDER BY v) AS cc1, sum(c2) OVER (PARTITION BY col ORDER BY v) AS cc2,
               sum(c1) OVER (PARTITION BY col) AS n1, sum(c2) OVER (PARTITION BY col) AS n2 FROM per),
d AS (SELECT col, max(abs(cc1 / n1 - cc2 / n2)) AS d, any_value(n1) AS n1, any_value(n2) AS n2
      FROM cum GROUP BY col),
lam AS (SELECT col, d, sqrt(n1 * n2 / (n1 + n2)) * d AS lam FROM d),
pv AS (SELECT col, d, CASE WHEN lam <= 0 THEN 1.0
                      ELSE least(1.0, greatest(0.0, 2 * sum(pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam)))) END AS p
       FROM lam, range(1, 101) t(k) GROUP BY col, d, lam),
mu AS (SELECT {col_name} AS col, avg(CASE WHEN side = 1 THEN v END) AS m1, avg(CASE WHEN side = 2 THEN v END) AS m2
       FROM {long_src} WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY 1)"""


ORACLES["data_drift"] = f"""WITH {SPLIT},
w AS (SELECT CASE WHEN period = 'reference' THEN 1 ELSE 2 END AS side,
             l_quantity, l_extendedprice, l_discount, l_tax FROM sp),
lg AS (UNPIVOT w ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME col VALUE v),{_ks_sql("lg")}
SELECT pv.col AS "column", round_even(d, 4) AS ks_statistic, round_even(p, 4) AS p_value, p < 0.05 AS drifted,
       round_even(m1, 3) AS reference_mean, round_even(m2, 3) AS current_mean
FROM pv JOIN mu ON pv.col = mu.col"""

ORACLES["prediction_drift"] = f"""WITH {SCORED},
o AS (SELECT score AS v, row_number() OVER (ORDER BY ts, event_id) AS rn, count(*) OVER () AS n FROM e),
lg AS (SELECT 'score' AS col, v, CASE WHEN rn <= floor(0.7 * n) THEN 1 ELSE 2 END AS side FROM o),{_ks_sql("lg")}
SELECT round_even(d, 4) AS ks_statistic, round_even(p, 4) AS p_value, p < 0.05 AS drifted,
       round_even(m1, 3) AS reference_mean_risk, round_even(m2, 3) AS current_mean_risk
FROM pv JOIN mu ON pv.col = mu.col"""

ORACLES["drift_exact"] = f"""WITH RECURSIVE o AS (SELECT s_acctbal, abs(s_acctbal) AS size,
       CASE WHEN row_number() OVER (ORDER BY s_suppkey) <= floor(0.7 * count(*) OVER ()) THEN 1 ELSE 2 END AS side FROM supplier),
lg AS (UNPIVOT o ON s_acctbal, size INTO NAME col VALUE v),{_ks_sql("lg")},
lat AS (SELECT col, 0::BIGINT AS s, 0::BIGINT AS i, CASE WHEN round(d * n1 * n2) <= 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v FROM d
        UNION ALL
        SELECT col, s, i, CASE WHEN abs(i * n2 - (s - i) * n1) >= round(d * n1 * n2) THEN 1.0::DOUBLE ELSE v END
        FROM (SELECT lat.col, lat.s + 1 AS s, lat.i + step AS i, d.d, n1, n2,
                     sum(lat.v * CASE step WHEN 1 THEN lat.i + 1 ELSE lat.s + 1 - lat.i END / (lat.s + 1)) AS v
              FROM lat JOIN d ON d.col = lat.col, (VALUES (0), (1)) t(step)
              WHERE lat.i + step <= n1 AND lat.s + 1 - lat.i - step <= n2
              GROUP BY ALL))
SELECT d.col AS "column", round_even(d, 4) AS ks_statistic, round_even(v, 4) AS p_value, v < 0.05 AS drifted,
       round_even(m1, 3) AS reference_mean, round_even(m2, 3) AS current_mean
FROM d JOIN mu ON d.col = mu.col JOIN lat ON lat.col = d.col AND lat.s = n1 + n2"""

_DRIFT_REPORT = f"""{SPLIT},
w AS (SELECT CASE WHEN period = 'reference' THEN 1 ELSE 2 END AS side,
             l_quantity, l_extendedprice, l_discount, l_tax FROM sp),
lg AS (UNPIVOT w ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME col VALUE v),{_ks_sql("lg")},
rep AS (SELECT pv.col AS "column", round_even(d, 4) AS ks_statistic, round_even(p, 4) AS p_value,
               p < 0.05 AS drifted, round_even(m1, 3) AS reference_mean, round_even(m2, 3) AS current_mean
        FROM pv JOIN mu ON pv.col = mu.col),
roll AS (SELECT CAST(sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS BIGINT) AS n_drifted,
                count(*) AS n_columns FROM rep)"""

ORACLES["drift_rollup"] = f"""WITH {_DRIFT_REPORT}
SELECT n_drifted, n_columns,
       CASE WHEN n_drifted > 0
            THEN 'investigate drifted sensors and consider retraining if drift persists across multiple monitoring cycles'
            ELSE 'no significant drift detected - model remains valid' END AS recommendation
FROM roll"""

ORACLES["monitoring_job"] = f"""WITH {_DRIFT_REPORT}
SELECT rep.*, n_drifted, n_columns FROM rep, roll"""

ORACLES["period_summary"] = f"""WITH {SPLIT}
SELECT period, min(l_shipdate) AS start, max(l_shipdate) AS "end", count(*) AS rows FROM sp GROUP BY period"""


# --- recommendations -----------------------------------------------------------------
LONG = """
wa AS (SELECT p_brand AS failure_mode, p_name AS action
       FROM lineitem JOIN part ON l_partkey = p_partkey),
lg AS (SELECT failure_mode, action, count(*) AS cnt FROM wa GROUP BY 1, 2)"""

CATS = """
cats AS (
  SELECT * FROM (VALUES ('bearing_wear', 'mechanical', 1), ('shaft_misalignment', 'mechanical', 2),
                        ('rotor_imbalance', 'mechanical', 3), ('lubrication_failure', 'mechanical', 4),
                        ('seal_leakage', 'hydraulic', 5), ('cavitation', 'hydraulic', 6),
                        ('impeller_erosion', 'hydraulic', 7), ('motor_winding_failure', 'electrical', 8))
           t(failure_mode, category, ordinal)
  UNION ALL
  SELECT 'Brand#' || n, CASE WHEN n <= 10 THEN 'mechanical' WHEN n <= 20 THEN 'hydraulic' ELSE 'electrical' END,
         CAST(100 + n AS INTEGER)
  FROM range(1, 26) r(n))"""

TOP = """
top AS (SELECT failure_mode, CAST(row_number() OVER (PARTITION BY failure_mode ORDER BY cnt DESC, action) AS INTEGER)
               AS rank, action, cnt AS association_strength
        FROM lg WHERE cnt > 0
        QUALIFY row_number() OVER (PARTITION BY failure_mode ORDER BY cnt DESC, action) <= 5)"""

ORACLES["cooccurrence_counts"] = f"WITH {LONG} SELECT * FROM lg"

ORACLES["cooccurrence_matrix"] = f"""WITH {LONG},
cell AS (SELECT m.failure_mode, a.action FROM (SELECT DISTINCT failure_mode FROM lg) m,
         (SELECT DISTINCT action FROM lg) a)
SELECT cell.failure_mode, string_agg(coalesce(lg.cnt, 0)::BIGINT::VARCHAR, '|' ORDER BY cell.action) AS counts
FROM cell LEFT JOIN lg ON lg.failure_mode = cell.failure_mode AND lg.action = cell.action GROUP BY 1"""

ORACLES["distinct_counts"] = f"""WITH {LONG}
SELECT count(DISTINCT failure_mode) AS n_failure_modes, count(DISTINCT action) AS n_actions FROM lg"""

ORACLES["action_sets"] = f"""WITH {LONG}
SELECT failure_mode, string_agg(DISTINCT action, '|' ORDER BY action) AS actions FROM lg GROUP BY 1"""

ORACLES["distinct_pairs"] = f"WITH {LONG} SELECT DISTINCT failure_mode, action FROM wa"

ORACLES["top_actions"] = f"WITH {LONG},{TOP} SELECT * FROM top"

SIM = """
nrm AS (SELECT failure_mode, sqrt(sum(cnt * cnt)) AS nrm FROM lg GROUP BY 1),
modes AS (SELECT DISTINCT failure_mode FROM lg),
allp AS (SELECT a.failure_mode, b.failure_mode AS similar_mode FROM modes a, modes b
         WHERE a.failure_mode <> b.failure_mode),
dots AS (SELECT a.failure_mode, b.failure_mode AS similar_mode, sum(a.cnt * b.cnt) AS dot
         FROM lg a JOIN lg b ON a.action = b.action AND a.failure_mode <> b.failure_mode GROUP BY 1, 2),
sims AS (SELECT allp.failure_mode, allp.similar_mode,
                coalesce(dot / (n1.nrm * n2.nrm), 0.0) AS similarity
         FROM allp LEFT JOIN dots USING (failure_mode, similar_mode)
              JOIN nrm n1 ON n1.failure_mode = allp.failure_mode
              JOIN nrm n2 ON n2.failure_mode = allp.similar_mode)"""


def _sim_top(k: int) -> str:
    return f"""
simk AS (SELECT failure_mode, similar_mode, round_even(similarity, 3) AS similarity,
                CAST(row_number() OVER (PARTITION BY failure_mode ORDER BY similarity DESC, similar_mode) AS INTEGER)
                  AS rank
         FROM sims QUALIFY rank <= {k})"""


ORACLES["similar_modes"] = f"""WITH {LONG},{SIM},{_sim_top(3)}
SELECT failure_mode, similar_mode, similarity, rank FROM simk"""

FALLBACK = """
known AS (SELECT DISTINCT failure_mode FROM lg),
donors AS (SELECT category, arg_min(c.failure_mode, ordinal) AS borrowed_from
           FROM cats c JOIN known k ON c.failure_mode = k.failure_mode GROUP BY category),
res AS (SELECT l.failure_mode,
               CASE WHEN k.failure_mode IS NOT NULL THEN l.failure_mode ELSE d.borrowed_from END AS src,
               CASE WHEN k.failure_mode IS NOT NULL THEN 'direct_historical_match'
                    WHEN c.category IS NULL THEN 'no_data_available'
                    WHEN d.borrowed_from IS NULL THEN 'no_similar_category_data'
                    ELSE 'category_fallback (borrowed from ' || d.borrowed_from || ')' END AS method,
               CASE WHEN k.failure_mode IS NOT NULL THEN 'high'
                    WHEN c.category IS NULL OR d.borrowed_from IS NULL THEN 'none'
                    ELSE 'low - verify with engineer before acting' END AS confidence
        FROM (SELECT DISTINCT failure_mode FROM lookups) l
             LEFT JOIN known k ON k.failure_mode = l.failure_mode
             LEFT JOIN cats c ON c.failure_mode = l.failure_mode
             LEFT JOIN donors d ON d.category = c.category),
flat AS (SELECT res.failure_mode, method, confidence, top.rank, top.action, top.association_strength
         FROM res LEFT JOIN top ON top.failure_mode = res.src)"""

DIAG_KEYS = f"""
b AS (SELECT avg(vibration_mm) AS mv, stddev_samp(vibration_mm) AS sv,
             avg(temperature_f) AS mt, stddev_samp(temperature_f) AS st
      FROM r WHERE operating_mode = 'normal'),
l AS (SELECT * FROM r
      QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY "timestamp" DESC, reading_id DESC) = 1),
z AS (SELECT l.asset_id, CASE WHEN sv > 0 THEN (vibration_mm - mv) / sv ELSE 0.0 END AS zv,
             CASE WHEN st > 0 THEN (temperature_f - mt) / st ELSE 0.0 END AS zt FROM l CROSS JOIN b),
dk AS (SELECT asset_id, 'Bearing wear' AS likely_cause, 'bearing_wear' AS failure_mode
       FROM z WHERE zv > 1.5 AND zt > 1.0)"""

ORACLES["recommend_with_fallback"] = f"""WITH {READINGS},{LONG},{CATS},{TOP},{DIAG_KEYS},
lookups AS (SELECT DISTINCT p_brand AS failure_mode FROM part UNION ALL SELECT failure_mode FROM dk),{FALLBACK}
SELECT failure_mode, method, confidence, CAST(rank AS INTEGER) AS rank, action, association_strength FROM flat"""

ORACLES["diagnosis_recommendations"] = f"""WITH {READINGS},{LONG},{CATS},{TOP},{DIAG_KEYS},
lookups AS (SELECT failure_mode FROM dk),{FALLBACK}
SELECT dk.asset_id, dk.likely_cause, dk.failure_mode, method, confidence, CAST(rank AS INTEGER) AS rank,
       action, association_strength
FROM dk JOIN flat ON flat.failure_mode = dk.failure_mode"""

ORACLES["negative_pairs"] = f"""WITH {LONG},
pos AS (SELECT DISTINCT failure_mode, action FROM lg),
mi AS (SELECT failure_mode, row_number() OVER (ORDER BY failure_mode) - 1 AS i FROM (SELECT DISTINCT failure_mode FROM pos)),
ai AS (SELECT action, row_number() OVER (ORDER BY action) - 1 AS i FROM (SELECT DISTINCT action FROM pos)),
h AS (SELECT md5(failure_mode || '|' || action || '|42') AS h FROM pos),
dr AS (SELECT (('0x' || substr(h, 1, 15))::BIGINT) % (SELECT count(*) FROM mi) AS m,
              (('0x' || substr(h, 16, 15))::BIGINT) % (SELECT count(*) FROM ai) AS a FROM h)
SELECT mi.failure_mode, ai.action
FROM dr JOIN mi ON mi.i = dr.m JOIN ai ON ai.i = dr.a
WHERE NOT EXISTS (SELECT 1 FROM pos WHERE pos.failure_mode = mi.failure_mode AND pos.action = ai.action)"""

ORACLES["two_tower_pairs"] = f"""WITH {LONG},
pairs AS (SELECT DISTINCT failure_mode, action, 1 AS label FROM lg
          UNION ALL SELECT failure_mode, action, 0 FROM ({ORACLES["negative_pairs"]}))
SELECT failure_mode, label, count(*) AS pairs, min(action) AS first_action, max(action) AS last_action
FROM pairs GROUP BY 1, 2"""

ORACLES["precision_at_k"] = f"""WITH {LONG},{TOP},
act AS (SELECT DISTINCT failure_mode, action FROM lg),
hits AS (SELECT t.failure_mode, count(*) AS hits FROM top t JOIN act a USING (failure_mode, action) GROUP BY 1),
per AS (SELECT m.failure_mode, coalesce(hits, 0) / 5.0 AS p
        FROM (SELECT DISTINCT failure_mode FROM act) m LEFT JOIN hits USING (failure_mode))
SELECT {R6("avg(p)")} AS precision_at_k, count(*) AS n_modes FROM per"""

ORACLES["vector_top_k"] = """
WITH v AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
c AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM v GROUP BY 1, 2),
cn AS (SELECT label, sqrt(sum(x * x)) AS n FROM c GROUP BY 1),
vn AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS n FROM v GROUP BY 1),
dot AS (SELECT c.label, v.vec_id, sum(c.x * CAST(v.x AS DOUBLE)) AS d FROM c JOIN v ON c.pos = v.pos GROUP BY 1, 2),
sc AS (SELECT dot.label, dot.vec_id,
              CASE WHEN cn.n > 0 AND vn.n > 0 THEN d / (cn.n * vn.n) ELSE 0.0 END AS score
       FROM dot JOIN cn ON cn.label = dot.label JOIN vn ON vn.vec_id = dot.vec_id)
SELECT label, CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, (round(score * (1.0 + 1e-12), 6) + 0.0) AS score
FROM sc QUALIFY rank <= 5"""

ORACLES["vector_index_all_lists"] = """
WITH v AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
n AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS n FROM v GROUP BY 1),
dot AS (SELECT q.vec_id AS query_id, v.vec_id AS item, sum(CAST(q.x AS DOUBLE) * CAST(v.x AS DOUBLE)) AS d
        FROM v q JOIN v ON q.pos = v.pos WHERE q.vec_id % 100 = 0 GROUP BY 1, 2),
sc AS (SELECT query_id, item, CASE WHEN a.n > 0 AND b.n > 0 THEN d / (a.n * b.n) ELSE 0.0 END AS score
       FROM dot JOIN n a ON a.vec_id = query_id JOIN n b ON b.vec_id = item)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item) AS INTEGER) AS rank,
       item, (round(score * (1.0 + 1e-12), 6) + 0.0) AS score
FROM sc QUALIFY rank <= 5"""

ORACLES["recommendation_job"] = f"""WITH {LONG},{TOP},{SIM},{_sim_top(2)}
SELECT top.failure_mode, top.rank, top.action, top.association_strength, simk.similar_mode, simk.similarity
FROM top LEFT JOIN simk ON simk.failure_mode = top.failure_mode AND simk.rank = top.rank"""


# --- allocation ------------------------------------------------------------------------
HEALTH = f"""{BASE},
{SCORED.strip()},
risk AS (SELECT user_id AS asset_id, score AS risk FROM e
         QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
rul AS (SELECT asset_id, least(hours_to_failure, 3000.0) AS rul FROM s WHERE next_f IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY "timestamp" DESC, reading_id DESC) = 1),
hr AS (SELECT risk.asset_id, risk.risk, rul.rul,
              row_number() OVER (ORDER BY risk.risk DESC, risk.asset_id) AS i
       FROM risk LEFT JOIN rul ON rul.asset_id = risk.asset_id),
wl AS (SELECT p_brand AS field_id, p_partkey AS well_id, p_retailprice AS max_capacity_bpd,
              row_number() OVER (ORDER BY p_partkey) AS i FROM part),
hc AS (SELECT wl.field_id, wl.well_id, wl.max_capacity_bpd, hr.asset_id AS health_asset_id,
              CASE WHEN hr.asset_id IS NULL
                   THEN round_even(CAST(max_capacity_bpd AS DECIMAL(20,4)), 1)
                   ELSE round_even(CAST(max_capacity_bpd AS DECIMAL(20,4)) *
                        CASE WHEN coalesce(risk, 0.1) > 0.7 OR coalesce(rul, 1000.0) < 50 THEN 0.3
                             WHEN coalesce(risk, 0.1) > 0.4 OR coalesce(rul, 1000.0) < 200 THEN 0.7
                             ELSE 1.0 END, 1) END AS safe,
              CASE WHEN hr.asset_id IS NULL THEN 'No health data - assumed healthy'
                   WHEN coalesce(risk, 0.1) > 0.7 OR coalesce(rul, 1000.0) < 50 THEN 'CRITICAL - Derated'
                   WHEN coalesce(risk, 0.1) > 0.4 OR coalesce(rul, 1000.0) < 200 THEN 'DEGRADED - Reduced'
                   ELSE 'HEALTHY - Full capacity' END AS health_status
       FROM wl LEFT JOIN hr ON hr.i = wl.i),
lim AS (SELECT p_brand AS field_id,
               round_even(sum(CAST(p_retailprice AS DECIMAL(20,4))) * 0.55, 0) AS pipe,
               round_even(sum(CAST(p_retailprice AS DECIMAL(20,4))) * 0.60, 0) AS comp
        FROM part GROUP BY 1)"""


def _alloc_sql(src: str, part: str) -> str:
    return f"""
al0 AS (SELECT {src}.*, safe * 0.30 AS fl, safe - safe * 0.30 AS hd,
               sum(safe - safe * 0.30) OVER (PARTITION BY {part} ORDER BY well_id DESC) AS cum_hd,
               sum(safe * 0.30) OVER (PARTITION BY {part}) AS sfl,
               least(lim2.pipe, lim2.comp) AS cap
        FROM {src} JOIN lim2 USING ({part})),
al AS (SELECT *, CASE WHEN sfl <= cap
                      THEN round_even(fl + least(greatest(cap - sfl - (cum_hd - hd), 0), hd), 1) END AS x
       FROM al0)"""


ORACLES["health_capacity"] = f"""{HEALTH}
SELECT field_id, well_id, max_capacity_bpd, health_asset_id, CAST(safe AS DOUBLE) AS safe_capacity_bpd,
       health_status FROM hc"""

PLAN = f"""{HEALTH},
lim2 AS (SELECT * FROM lim),{_alloc_sql("hc", "field_id")}"""

ORACLES["allocation_plan"] = f"""{PLAN}
SELECT field_id, well_id, CAST(safe AS DOUBLE) AS safe_capacity_bpd, health_status,
       CAST(x AS DOUBLE) AS allocated_production_bpd,
       round_even(CAST(x AS DOUBLE) / CAST(safe AS DOUBLE) * 100.0, 1) AS utilization_pct,
       CASE WHEN sfl <= cap THEN 'optimal' ELSE 'infeasible' END AS status
FROM al"""

ORACLES["binding_constraints"] = f"""{PLAN},
tot AS (SELECT field_id, CAST(round_even(sum(x), 1) AS DOUBLE) AS total FROM al GROUP BY 1)
SELECT field_id, 0 AS seq, CAST(NULL AS BIGINT) AS well_id,
       'Pipeline capacity (' || CAST(CAST(pipe AS BIGINT) AS VARCHAR) ||
       ' bpd) is FULLY UTILIZED - this is the limiting factor for total output' AS message
FROM tot JOIN lim USING (field_id) WHERE abs(total - CAST(pipe AS DOUBLE)) < 0.5
UNION ALL
SELECT field_id, 1, NULL, 'Compressor capacity (' || CAST(CAST(comp AS BIGINT) AS VARCHAR) ||
       ' bpd) is FULLY UTILIZED - this is the limiting factor for total output'
FROM tot JOIN lim USING (field_id) WHERE abs(total - CAST(comp AS DOUBLE)) < 0.5
UNION ALL
SELECT field_id, 2, well_id, CAST(well_id AS VARCHAR) || ' is producing at its FULL safe capacity (' ||
       CAST(CAST(round_even(safe, 0) AS BIGINT) AS VARCHAR) || ' bpd) - ' || health_status
FROM al WHERE abs(CAST(x AS DOUBLE) - CAST(safe AS DOUBLE)) < 0.5"""

ORACLES["allocation_kpis"] = f"""{PLAN}
SELECT field_id, CAST(round_even(sum(x), 1) AS DOUBLE) AS total_production,
       CAST(sum(CASE WHEN round_even(CAST(x AS DOUBLE) / CAST(safe AS DOUBLE) * 100.0, 1) >= 99 THEN 1 ELSE 0 END) AS BIGINT)
         AS wells_at_full_capacity,
       CAST(sum(CASE WHEN round_even(CAST(x AS DOUBLE) / CAST(safe AS DOUBLE) * 100.0, 1) <= 31 THEN 1 ELSE 0 END) AS BIGINT)
         AS wells_at_fairness_floor
FROM al GROUP BY 1"""

WHATIF = f"""{HEALTH},
sc AS (SELECT * FROM (VALUES ('Baseline', 0.0, 0.0, NULL), ('Pipeline +500 bpd', 500.0, 0.0, NULL),
                              ('Top well degrades 50%', 0.0, 0.0, 0.5), ('Compressor +300 bpd', 0.0, 300.0, NULL))
              t(scenario, dp, dc, f)),
tg AS (SELECT field_id, max(well_id) AS tw FROM hc GROUP BY 1),
hs AS (SELECT hc.field_id || '|' || sc.scenario AS fs, hc.field_id, sc.scenario, hc.well_id,
              CASE WHEN sc.f IS NOT NULL AND hc.well_id = tg.tw
                   THEN CAST(CAST(max_capacity_bpd AS DECIMAL(20,4)) * CAST(sc.f AS DECIMAL(4,2)) AS DECIMAL(20,4))
                   ELSE safe END AS safe,
              CASE WHEN sc.f IS NOT NULL AND hc.well_id = tg.tw THEN 'SIMULATED - Further Degraded'
                   ELSE health_status END AS health_status
       FROM hc JOIN tg USING (field_id) CROSS JOIN sc),
lim2 AS (SELECT lim.field_id || '|' || sc.scenario AS fs, pipe + dp AS pipe, comp + dc AS comp FROM lim CROSS JOIN sc),
{_alloc_sql("hs", "fs").strip()}"""

ORACLES["whatif_plans"] = f"""{WHATIF}
SELECT field_id, scenario, well_id, CAST(safe AS DOUBLE) AS safe_capacity_bpd, health_status,
       CAST(x AS DOUBLE) AS allocated_production_bpd,
       round_even(CAST(x AS DOUBLE) / CAST(safe AS DOUBLE) * 100.0, 1) AS utilization_pct
FROM al"""

ORACLES["scenario_comparison"] = f"""{WHATIF},
tot AS (SELECT field_id, scenario, round_even(sum(x), 1) AS t FROM al GROUP BY 1, 2)
SELECT s.field_id, s.scenario, CAST(b.t AS DOUBLE) AS baseline_production, CAST(s.t AS DOUBLE) AS scenario_production,
       CAST(round_even(s.t - b.t, 1) AS DOUBLE) AS delta_bpd,
       round_even(CAST(s.t - b.t AS DOUBLE) / CAST(b.t AS DOUBLE) * 100.0, 2) AS pct_change
FROM tot s JOIN tot b ON b.field_id = s.field_id AND b.scenario = 'Baseline'
WHERE s.scenario <> 'Baseline'"""


# --- preparation, scoring, fleet report ---------------------------------------------
def _hash_sql(expr: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5(CAST({expr} AS VARCHAR) || '|{seed}'), 1, 15))::BIGINT)"


ORACLES["asset_split"] = f"""
WITH a AS (SELECT DISTINCT user_id AS asset_id FROM events),
h AS (SELECT asset_id, row_number() OVER (ORDER BY {_hash_sql("asset_id")}, asset_id) AS rn,
             count(*) OVER () AS n FROM a)
SELECT asset_id, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM h"""

ORACLES["scaled_test_features"] = f"""WITH {READINGS},
a AS (SELECT DISTINCT asset_id FROM r),
h AS (SELECT asset_id, row_number() OVER (ORDER BY {_hash_sql("asset_id")}, asset_id) AS rn,
             count(*) OVER () AS n FROM a),
t AS (SELECT asset_id FROM h WHERE rn <= greatest(1, floor(0.2 * n))),
st AS (SELECT avg(vibration_mm) AS mv, CASE WHEN stddev_pop(vibration_mm) > 0 THEN stddev_pop(vibration_mm) ELSE 1.0 END AS sv,
              avg(temperature_f) AS mt, CASE WHEN stddev_pop(temperature_f) > 0 THEN stddev_pop(temperature_f) ELSE 1.0 END AS stt
       FROM r WHERE asset_id NOT IN (SELECT asset_id FROM t) AND operating_mode = 'normal')
SELECT asset_id, reading_id, {R6("(vibration_mm - mv) / sv")} AS vibration_mm,
       {R6("(temperature_f - mt) / stt")} AS temperature_f,
       CASE WHEN operating_mode <> 'normal' THEN 1 ELSE 0 END AS true_anomaly
FROM r, st WHERE asset_id IN (SELECT asset_id FROM t)"""

ORACLES["hash_sample"] = f"""WITH {READINGS}
SELECT asset_id, reading_id FROM r ORDER BY {_hash_sql("reading_id")}, reading_id LIMIT 500"""

ORACLES["top_readings"] = f"""WITH {READINGS}
SELECT asset_id, reading_id, vibration_mm FROM r ORDER BY vibration_mm DESC, reading_id LIMIT 15"""

ORACLES["top_deviations"] = f"""WITH {READINGS},
b AS (SELECT avg(vibration_mm) AS mv, stddev_samp(vibration_mm) AS sv FROM r WHERE operating_mode = 'normal'),
l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY "timestamp" DESC, reading_id DESC) = 1),
z AS (SELECT asset_id, CASE WHEN sv > 0 THEN (vibration_mm - mv) / sv ELSE 0.0 END AS z FROM l, b)
SELECT asset_id, {R6("z")} AS z_vibration_mm FROM z ORDER BY abs(z) DESC, asset_id LIMIT 5"""

ORACLES["head_rul_labels"] = f"""{BASE}
SELECT asset_id, reading_id, {R6("least(hours_to_failure, 3000.0)")} AS rul_hours FROM s
WHERE next_f IS NOT NULL ORDER BY asset_id, "timestamp", reading_id LIMIT 20"""

RISK = f"""{SCORED.strip()},
rk AS (SELECT user_id AS asset_id, score AS failure_risk_score FROM e
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
rr AS (SELECT asset_id, failure_risk_score,
              CASE WHEN failure_risk_score > 0 AND failure_risk_score <= 0.3 THEN 'Low'
                   WHEN failure_risk_score > 0.3 AND failure_risk_score <= 0.6 THEN 'Medium'
                   WHEN failure_risk_score > 0.6 AND failure_risk_score <= 1.0 THEN 'High' END AS risk_category,
              row_number() OVER (ORDER BY failure_risk_score DESC, asset_id) AS maintenance_priority_rank
       FROM rk)"""

RULP = f"""
ls AS (SELECT asset_id, temperature_f,
              row_number() OVER (PARTITION BY asset_id ORDER BY "timestamp" DESC, reading_id DESC) AS back,
              count(*) OVER (PARTITION BY asset_id) AS n FROM r),
rp AS (SELECT asset_id, greatest(avg(CAST(CAST(temperature_f AS FLOAT) AS DOUBLE)) * 10.0 - 100.0, 0.0) AS h
       FROM ls WHERE n >= 60 AND back <= 60 GROUP BY asset_id),
ru AS (SELECT asset_id, h AS predicted_rul_hours, h / 24.0 AS predicted_rul_days,
              row_number() OVER (ORDER BY h, asset_id) AS maintenance_urgency_rank FROM rp)"""

ORACLES["risk_scoring"] = f"""WITH {RISK}
SELECT asset_id, {R6("failure_risk_score")} AS failure_risk_score, risk_category, maintenance_priority_rank FROM rr"""

ORACLES["rul_scoring"] = f"""WITH {READINGS},{RULP}
SELECT asset_id, {R6("predicted_rul_hours")} AS predicted_rul_hours, {R6("predicted_rul_days")} AS predicted_rul_days,
       maintenance_urgency_rank FROM ru"""

ORACLES["fleet_report"] = f"""WITH {READINGS},{LONG},{CATS},{TOP},{DIAG_KEYS},
lookups AS (SELECT failure_mode FROM dk),{FALLBACK},
{RISK.strip()},{RULP},
zz AS (SELECT asset_id, CASE WHEN zv > 1.5 AND zt > 1.0 THEN 'Bearing wear' ELSE 'Unclassified anomaly' END AS likely_cause FROM z),
fa AS (SELECT dk.asset_id, flat.method, flat.action AS first_action FROM dk JOIN flat ON flat.failure_mode = dk.failure_mode
       WHERE flat.rank = 1 OR flat.rank IS NULL)
SELECT rr.asset_id AS "Asset",
       CASE risk_category WHEN 'High' THEN '🔴' WHEN 'Medium' THEN '🟡' WHEN 'Low' THEN '🟢' ELSE '⚪' END AS "Status",
       {R6("failure_risk_score")} AS "Failure Risk", risk_category AS "Category",
       maintenance_priority_rank AS "Priority Rank", {R6("predicted_rul_hours")} AS "RUL (hours)",
       CASE WHEN failure_risk_score > 0.8 THEN 'URGENT' WHEN failure_risk_score > 0.5 THEN 'MODERATE' ELSE 'NORMAL' END
         AS recommended_action,
       zz.likely_cause, fa.method, fa.first_action
FROM rr LEFT JOIN ru ON ru.asset_id = rr.asset_id LEFT JOIN zz ON zz.asset_id = rr.asset_id
     LEFT JOIN fa ON fa.asset_id = rr.asset_id"""

ORACLES["fleet_kpis"] = f"""WITH {READINGS},{RISK},{RULP}
SELECT (SELECT count(*) FROM rr) AS total_assets,
       (SELECT CAST(sum(CASE WHEN risk_category = 'High' THEN 1 ELSE 0 END) AS BIGINT) FROM rr) AS high_risk_assets,
       (SELECT {R6("avg(failure_risk_score)")} FROM rr) AS avg_fleet_risk,
       (SELECT {R6("min(predicted_rul_hours)")} FROM ru) AS min_rul_hours"""

ORACLES["work_orders"] = """
WITH f AS (SELECT user_id AS asset_id, ts AS d, event_id,
                  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type = 'error'),
fm AS (SELECT *, (['bearing_wear', 'shaft_misalignment', 'rotor_imbalance', 'lubrication_failure', 'seal_leakage',
                   'cavitation', 'impeller_erosion', 'motor_winding_failure'])[k % 8 + 1] AS mode,
              row_number() OVER (ORDER BY d, asset_id, event_id) AS n FROM f),
p AS (SELECT user_id AS asset_id, ts AS d, row_number() OVER (ORDER BY ts, user_id, event_id) AS n
      FROM events WHERE event_type = 'signup')
SELECT 'WO-' || lpad(CAST(n AS VARCHAR), 5, '0') AS work_order_id, asset_id, d AS work_order_date,
       'corrective' AS work_order_type, 'Repair for ' || mode AS description,
       'Addressed ' || mode || '. Downtime: ' || CAST(k AS VARCHAR) || ' hours.' AS technician_notes FROM fm
UNION ALL
SELECT 'WO-' || lpad(CAST(n + (SELECT count(*) FROM f) AS VARCHAR), 5, '0'), asset_id, d, 'preventive',
       'Routine scheduled inspection', 'No issues found. Lubrication checked.' FROM p"""


# --- sources and sinks -------------------------------------------------------------------
ORACLES["csv_roundtrip"] = f"WITH {READINGS} SELECT * FROM r"

ORACLES["json_limits"] = """
SELECT p_brand AS field_id,
       CAST(round_even(sum(CAST(p_retailprice AS DECIMAL(20,4))) * 0.55, 0) AS DOUBLE) AS pipeline_capacity_bpd,
       CAST(round_even(sum(CAST(p_retailprice AS DECIMAL(20,4))) * 0.60, 0) AS DOUBLE) AS compressor_capacity_bpd
FROM part GROUP BY 1"""

ORACLES["snapshot_latest"] = ORACLES["risk_scoring"]

ORACLES["snapshot_newest_file"] = ORACLES["risk_scoring"]

ORACLES["work_orders_sorted"] = f"""SELECT work_order_id, work_order_date,
       row_number() OVER (ORDER BY work_order_date, work_order_id) AS place FROM ({ORACLES["work_orders"]})"""

ORACLES["csv_bad_rows"] = f"""WITH {READINGS},
c AS (SELECT *, CASE WHEN reading_id % 97 = 0 THEN asset_id || ',' || reading_id
                     WHEN reading_id % 89 = 0 THEN asset_id || ',r' || reading_id || ',' || operating_mode END AS line FROM r)
SELECT CASE WHEN line IS NULL THEN asset_id END AS asset_id, CASE WHEN line IS NULL THEN reading_id END AS reading_id,
       CASE WHEN line IS NULL THEN operating_mode END AS operating_mode, line FROM c"""


ORACLES["validation_quarantine"] = f"""{_VIOL},
bad AS (SELECT DISTINCT reading_id FROM v)
SELECT CASE WHEN reading_id IN (SELECT reading_id FROM bad) THEN 'quarantine' ELSE 'clean' END AS "partition",
       operating_mode, count(*) AS readings
FROM r GROUP BY 1, 2"""
