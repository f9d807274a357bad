"""Edge cases of validation, drift, metrics, scoring and preparation."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivet.functions.exprs import derate, risk_category
from rivet.operators import drift as DR
from rivet.operators import metrics as M
from rivet.operators import prep as PR
from rivet.operators import validate as V
from rivet.operators.rank import global_row_number, ordered_split, prefix_sums
from rivet.operators.rootcause import diagnosis, sensor_baselines, with_zscores

T0 = dt.datetime(2024, 1, 1)
SENSOR_COLS = ["vibration_mm", "temperature_f", "pressure_psi", "flow_rate", "rpm", "motor_current",
               "oil_quality_index", "ambient_temp", "ambient_humidity"]


def _reading(asset, h, vib=2.0, mode="normal"):
    vals = {c: 50.0 for c in SENSOR_COLS}
    vals["vibration_mm"] = vib
    return (asset, T0 + dt.timedelta(hours=h), mode, *[vals[c] for c in SENSOR_COLS])


SCHEMA = "asset_id string, timestamp timestamp, operating_mode string, " + ", ".join(f"{c} double" for c in SENSOR_COLS)


def test_validation_bounds_nulls_duplicates(spark):
    rows = [_reading("A", 0, 0.0), _reading("A", 1, 20.0), _reading("A", 2, 20.01), _reading("A", 3, -0.01),
            _reading("A", 4, None), _reading("B", 5), _reading("B", 5), _reading("B", 5)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rid", F.monotonically_increasing_id())
    v = V.violations(df, V.sensor_contract(), ["rid"]).collect()
    checks = sorted((x["check"], x["failure_case"]) for x in v)
    assert checks == [("in_range(0, 20)", "-0.01"), ("in_range(0, 20)", "20.01"), ("not_nullable", None)]
    assert V.duplicate_count(df, ["asset_id", "timestamp"]).first()[0] == 2
    rep = V.validation_report(df, V.sensor_contract(), ["rid"]).first()
    assert rep["status"] == "failed" and rep["cell_violations"] == 3 and rep["duplicate_rows"] == 2


def test_validation_passes_clean(spark):
    df = spark.createDataFrame([_reading("A", h) for h in range(5)], SCHEMA)
    rep = V.validation_report(df, V.sensor_contract(), ["asset_id", "timestamp"]).first()
    assert rep["status"] == "passed" and rep["cell_violations"] == 0


def test_missing_profile_threshold(spark):
    n = 2000
    rows = [(None if i < 100 else 1.0, None if i < 101 else 1.0) for i in range(n)]  # 5.00 % / 5.05 %
    prof = {r["column"]: r for r in V.missing_profile(spark.createDataFrame(rows, "a double, b double")).collect()}
    assert prof["a"]["missing_pct"] == 5.0 and not prof["a"]["reported"]
    assert prof["b"]["reported"]


def test_ks_identical_and_disjoint(spark):
    a = spark.createDataFrame([(float(i),) for i in range(200)], "x double")
    same = DR.ks_column(a, a, "x").first()
    assert same["ks_statistic"] == 0.0 and same["p_value"] == 1.0 and not same["drifted"]
    b = spark.createDataFrame([(float(i + 1000),) for i in range(200)], "x double")
    dis = DR.ks_column(a, b, "x").first()
    assert dis["ks_statistic"] == 1.0 and dis["p_value"] == 0.0 and dis["drifted"]


def test_ks_statistic_matches_numpy(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(0, 1, 700).round(2), rng.normal(0.2, 1, 500).round(2)
    a = spark.createDataFrame([(float(v),) for v in x], "x double")
    b = spark.createDataFrame([(float(v),) for v in y], "x double")
    grid = np.union1d(x, y)
    d = np.max(np.abs(np.searchsorted(np.sort(x), grid, "right") / len(x)
                      - np.searchsorted(np.sort(y), grid, "right") / len(y)))
    assert DR.ks_column(a, b, "x").first()["ks_statistic"] == round(float(d), 4)


def test_ordered_split_exact(spark):
    rows = [(T0 + dt.timedelta(days=i % 7), i % 5, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "d timestamp, k int, i int")
    ref, cur, n = ordered_split(df, ["d", "k", "i"], 0.7)
    exp = sorted(rows, key=lambda r: (r[0], r[1], r[2]))[:700]
    assert n == 1000 and sorted(r["i"] for r in ref.collect()) == sorted(r[2] for r in exp)
    assert cur.count() == 300


def test_prefix_sums_and_row_number(spark):
    rng = np.random.default_rng(1)
    vals = rng.permutation(3000)
    df = spark.createDataFrame([(int(v), 1) for v in vals], "k long, c long")
    got = {r["k"]: r["cum_c"] for r in prefix_sums(df, "k", ["c"]).collect()}
    assert all(got[k] == k + 1 for k in got)
    rn = {r["k"]: r["row_number"] for r in global_row_number(df, [F.col("k")]).collect()}
    assert all(rn[k] == k + 1 for k in rn)


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, pred int, score double")
    m = M.binary_metrics(df, "label", "pred", "score").first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0) and m["roc_auc"] is None
    df2 = spark.createDataFrame([(1, 1, 0.9), (0, 1, 0.8), (1, 0, 0.3), (0, 0, 0.3)], "label int, pred int, score double")
    m2 = M.binary_metrics(df2, "label", "pred", "score").first()
    assert m2["precision"] == 0.5 and m2["recall"] == 0.5 and abs(m2["roc_auc"] - 0.625) < 1e-12


def test_false_alarm_share_none_high(spark):
    p = spark.createDataFrame([("A", 0.1)], "asset_id string, failure_risk_score double")
    a = spark.createDataFrame([("A", 1)], "asset_id string, actual_failure int")
    assert M.false_alarm_share(p, a).first()["false_positive_rate"] == 0.0


@pytest.mark.parametrize("score,cat", [(0.0, None), (0.3, "Low"), (0.6, "Medium"), (1.0, "High"), (0.31, "Medium")])
def test_risk_bins(spark, score, cat):
    assert spark.range(1).select(risk_category(F.lit(score))).first()[0] == cat


@pytest.mark.parametrize("risk,rul,factor", [(0.7, 1000.0, 0.7), (0.71, 1000.0, 0.3), (0.4, 1000.0, 1.0),
                                             (0.1, 50.0, 0.7), (0.1, 49.9, 0.3), (0.1, 200.0, 1.0),
                                             (None, None, 1.0)])
def test_derate_thresholds(spark, risk, rul, factor):
    f, _ = derate(F.lit(risk).cast("double"), F.lit(rul).cast("double"))
    assert spark.range(1).select(f).first()[0] == factor


def test_diagnosis_rules(spark):
    sensors = ["vibration_mm", "temperature_f", "motor_current", "rpm"]
    rows = [("both", 2.5, 2.5, 2.5, 0.0),      # bearing wear precedes motor winding
            ("motor", 0.0, 0.0, 2.5, 0.0),     # motor winding
            ("rotor", 2.5, 0.0, 0.0, -1.5),    # rotor imbalance
            ("none", 0.5, -0.7, 0.7, 0.0)]     # unclassified: |temp| largest? no: tie-break order
    df = spark.createDataFrame(rows, "asset_id string, " + ", ".join(f"z_{s} double" for s in sensors))
    d = {r["asset_id"]: r for r in df.select("asset_id", diagnosis(sensors).alias("d")).select("asset_id", "d.*").collect()}
    assert d["both"]["likely_cause"] == "Bearing wear"
    assert d["motor"]["likely_cause"] == "Motor winding failure"
    assert d["motor"]["contributing_signals"] == {"motor_current": 2.5, "temperature_f": 0.0}
    assert d["rotor"]["likely_cause"] == "Rotor imbalance / shaft misalignment"
    assert d["none"]["likely_cause"] == "Unclassified anomaly"
    assert d["none"]["contributing_signals"] == {"temperature_f": -0.7}


def test_zero_variance_sensor(spark):
    df = spark.createDataFrame([("A", "normal", 1.0, 5.0), ("A", "normal", 1.0, 7.0)],
                               "asset_id string, operating_mode string, a double, b double")
    z = with_zscores(df, sensor_baselines(df, ["a", "b"]), ["a", "b"]).collect()
    assert all(r["z_a"] == 0.0 for r in z)


def test_asset_split_disjoint(spark):
    df = spark.createDataFrame([(f"A{i}", j) for i in range(12) for j in range(3)], "asset_id string, v int")
    s = PR.asset_split(df, rule="ceil")
    assert s.filter(F.col("split") == "test").count() == 3
    train, test = PR.split_rows(df, s)
    assert not ({r[0] for r in train.select("asset_id").distinct().collect()}
                & {r[0] for r in test.select("asset_id").distinct().collect()})
    assert PR.asset_split(df, rule="floor1").filter(F.col("split") == "test").count() == 2


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "a double, b double")
    st = PR.fit_scaler(df, ["a", "b"]).first()
    assert st["a_std"] == 1.0 and st["b_std"] == 1.0  # pop std of (1,3) is 1; zero std -> 1


def test_global_row_number_hot_tie_split(spark):
    """Half the rows share one first-key value: the sort cuts them by the
    second key, and the numbering stays exact."""
    from rivet.operators.rank import ordered
    rows = [(0.5 if i % 2 == 0 else float(i), f"k{i:04d}") for i in range(4000)]
    df = spark.createDataFrame(rows, "s double, k string")
    got = global_row_number(df, [F.col("s"), F.col("k")])
    exp = {k: i + 1 for i, (s, k) in enumerate(sorted(rows))}
    assert {r["k"]: r["row_number"] for r in got.collect()} == exp
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = ordered(df, [F.col("s"), F.col("k")]).filter("s = 0.5").groupBy("_task").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) >= 2


def test_ordered_split_keeps_null_keys_last(spark):
    rows = [(T0 + dt.timedelta(days=i) if i % 10 else None, i) for i in range(100)]
    df = spark.createDataFrame(rows, "ts timestamp, i long")
    ref, cur, n = ordered_split(df, ["ts", "i"], 0.7)
    exp = [i for _, i in sorted(rows, key=lambda r: (r[0] is None, r[0] or T0, r[1]))]
    assert n == 100
    assert sorted(r["i"] for r in ref.collect()) == sorted(exp[:70])
    assert sorted(r["i"] for r in cur.collect()) == sorted(exp[70:])


def test_ordered_split_cut_inside_null_keys(spark):
    df = spark.createDataFrame([(None if i >= 50 else i, i) for i in range(100)], "k int, i long")
    ref, cur, _ = ordered_split(df, ["k", "i"], 0.8)
    assert sorted(r["i"] for r in ref.collect()) == list(range(80))
    assert cur.count() == 20


def test_ordered_split_beyond_double_precision(spark):
    base = 2 ** 53 + 1
    df = spark.createDataFrame([(base + i,) for i in range(100)], "id long")
    for share in (0.70, 0.71):
        ref, cur, _ = ordered_split(df, ["id"], share)
        assert (ref.count(), cur.count()) == (int(100 * share), 100 - int(100 * share))
    assert ref.agg(F.max("id")).first()[0] == base + 70


def test_prefix_sums_string_keys_and_groups(spark):
    df = spark.createDataFrame([(g, f"w{i:03d}", i) for g in ("a", "b") for i in range(200)],
                               "g string, w string, c long")
    got = {(r["g"], r["w"]): r["cum_c"] for r in prefix_sums(df, "w", ["c"], part=["g"], descending=True).collect()}
    assert got == {(g, f"w{i:03d}"): sum(range(i, 200)) for g in ("a", "b") for i in range(200)}


def test_kolmogorov_p_near_zero(spark):
    lam = [0.0, 0.001, 0.005, 0.01, 0.19, 0.2, 0.5, 1.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in lam], "l double")
           .select(DR.kolmogorov_p(F.col("l"))).collect()]
    assert got[:5] == [1.0] * 5 and abs(got[5] - 1.0) < 1e-9
    assert abs(got[6] - 0.9639) < 1e-3 and abs(got[7] - 0.27) < 1e-3


def test_nan_is_missing_not_out_of_range(spark):
    from rivet.operators import validate as V
    rule = V.ColumnRule("x", V.T.DoubleType(), nullable=False, in_range=(0, 20))
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 25.0), (4, 5.0)], "id int, x double")
    got = {(r["id"], r["check"]) for r in V.violations(df, V.Contract([rule], key=["id"]), ["id"]).collect()}
    assert {i for i, c in got if "not_nullable" in c} == {1, 2}
    assert {i for i, c in got if "in_range" in c} == {3}


def test_root_cause_with_missing_readings(spark):
    """NaN and null count as 0 in the baseline and in the diagnosed reading."""
    from rivet.operators.rootcause import root_cause_report
    rows = [("A", T0 + dt.timedelta(hours=i), i, "normal", v)
            for i, v in enumerate([2.0, float("nan"), 4.0, None, 6.0])]
    df = spark.createDataFrame(rows, "asset_id string, timestamp timestamp, reading_id int, "
                                     "operating_mode string, vibration_mm double")
    filled = df.fillna(0.0).replace(float("nan"), 0.0)
    got, exp = (root_cause_report(x, ["vibration_mm"]).first() for x in (df, filled))
    assert got == exp and got["contributing_signals"]


def test_diagnosis_rules_by_number(spark):
    """Every rule of the table is reached by readings that satisfy it."""
    from rivet import constants as K
    from rivet.operators.rootcause import diagnosis
    sensors = sorted({s for _, _, conds in K.DIAGNOSIS_RULES for s, _, _ in conds}
                     | {s for _, signals, _ in K.DIAGNOSIS_RULES for s in signals})
    for name, _, conds in K.DIAGNOSIS_RULES:
        z = dict.fromkeys(sensors, 0.0)
        for s, op, v in conds:
            z[s] = {">": v + 0.5, "<": v - 0.5, "abs>": -(v + 0.5)}[op]
        df = spark.createDataFrame([tuple(z.values())], ", ".join(f"z_{s} double" for s in z))
        found = df.select(diagnosis(sensors)["likely_cause"]).first()[0]
        earlier = [n for n, _, c in K.DIAGNOSIS_RULES[:[r[0] for r in K.DIAGNOSIS_RULES].index(name)]
                   if all({">": z[s] > v, "<": z[s] < v, "abs>": abs(z[s]) > v}[op] for s, op, v in c)]
        assert found == (earlier[0] if earlier else name), name
