"""Registered queries: each maps the shared tables onto an operator.

``QUERIES[name](spark, sf_dir) -> DataFrame``. Every query reads whole
tables (no id subsets, no row caps); limits appear only where the limit is
the feature (top-k). Doubles compared against the SQL oracle are rounded to
6 digits (``r6``); reference roundings (2 digits, half-even) are applied
first where the original rounds.
"""

from __future__ import annotations

import hashlib

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivet.functions.exprs import r2big, r6
from rivet.operators.rootcause import root_cause_report
from rivet.sources import testdata as td

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("root_cause_report")
def q_root_cause_report(spark, sf):
    """K11 = D1 + C9 + E5 + B17 + B7 + B8 on the latest reading of every asset."""
    rep = root_cause_report(td.readings(spark, sf), td.TESTDATA_SENSORS)
    keys = F.map_keys("contributing_signals")
    vals = F.map_values("contributing_signals")
    return rep.select(
        "asset_id", "timestamp", "likely_cause",
        F.try_element_at(keys, F.lit(1)).alias("signal_1"),
        r6(F.try_element_at(vals, F.lit(1))).alias("z_1"),
        F.try_element_at(keys, F.lit(2)).alias("signal_2"),
        r6(F.try_element_at(vals, F.lit(2))).alias("z_2"))


# --- feature pipeline (K8) and its parts ------------------------------------
from rivet.plans import features as FT  # noqa: E402
from rivet.operators.windows import latest_per_key  # noqa: E402

# 14 / 30 day labels saturate on a 30-day table with failures every ~2 days
TD_HORIZONS = [1, 3, 7]
TD_SEQ_LEN, TD_SEQ_STRIDE = 20, 6


def _series(spark, sf, with_orders=True):
    return FT.labelled_series(td.readings(spark, sf), td.failures(spark, sf),
                              td.work_orders(spark, sf) if with_orders else None,
                              td.TESTDATA_SENSORS, horizons=TD_HORIZONS)


def _features(spark, sf):
    return FT.feature_frame(td.readings(spark, sf), td.failures(spark, sf),
                            td.work_orders(spark, sf), td.TESTDATA_SENSORS,
                            horizons=TD_HORIZONS)


ROLL_COLS = [f"{s}_roll_{m}_{k}h" for s in td.TESTDATA_SENSORS for k in (6, 24, 72)
             for m in ("mean", "std")]
LAG_COLS = [f"{s}_{m}_24h" for s in td.TESTDATA_SENSORS for m in ("lag", "trend")]
LABEL_COLS = [f"failure_within_{h}d" for h in TD_HORIZONS]


@query("failure_labels")
def q_failure_labels(spark, sf):
    """label_h = a failure F exists with F - h <= ts < F."""
    return _series(spark, sf, with_orders=False).select("asset_id", "timestamp", "reading_id", *LABEL_COLS)


@query("rul_labels")
def q_rul_labels(spark, sf):
    """C1 + B9 + B13: hours to the next failure strictly after, rows after the
    last failure dropped, capped at 3000 h."""
    rul = FT.rul_labels(_series(spark, sf, with_orders=False))
    return rul.select("asset_id", "timestamp", "reading_id", r6("rul_hours").alias("rul_hours"))


@query("days_since_maintenance")
def q_days_since_maintenance(spark, sf):
    """Days since the last order strictly before, first order before it, 0 without orders."""
    s = _series(spark, sf)
    return s.select("asset_id", "timestamp", "reading_id",
                    r6("days_since_maintenance").alias("days_since_maintenance"))


@query("rolling_features")
def q_rolling_features(spark, sf):
    """Rolling mean / sample std over 6/24/72 rows per asset."""
    f = _features(spark, sf)
    return f.select("asset_id", "reading_id", *[r6(c).alias(c) for c in ROLL_COLS])


@query("lag_trend_features")
def q_lag_trend_features(spark, sf):
    """24-row lag and trend per sensor."""
    f = _features(spark, sf)
    return f.select("asset_id", "reading_id", *[r6(c).alias(c) for c in LAG_COLS])


@query("spectral_energy")
def q_spectral_energy(spark, sf):
    """Rolling 24-row half-spectrum energy of vibration."""
    f = _features(spark, sf)
    return f.select("asset_id", "reading_id",
                    r2big("vibration_fft_energy").alias("vibration_fft_energy"))


@query("feature_table")
def q_feature_table(spark, sf):
    """K8: the whole feature table, one row per reading."""
    f = _features(spark, sf)
    return f.select("asset_id", "timestamp", "reading_id", "operating_mode",
                    *[r6(c).alias(c) for c in td.TESTDATA_SENSORS], *LABEL_COLS,
                    *[r6(c).alias(c) for c in ROLL_COLS + LAG_COLS],
                    r2big("vibration_fft_energy").alias("vibration_fft_energy"),
                    r6("days_since_maintenance").alias("days_since_maintenance"))


@query("label_summary")
def q_label_summary(spark, sf):
    """Positives and positive rate (%) per horizon."""
    s = _series(spark, sf, with_orders=False)
    return FT.label_summary(s, TD_HORIZONS).select(
        "horizon_days", "positives", r6("positive_rate_pct").alias("positive_rate_pct"))


@query("rul_summary")
def q_rul_summary(spark, sf):
    """Kept / dropped / capped counts and min / max / mean RUL."""
    s = _series(spark, sf, with_orders=False)
    out = FT.rul_summary(s)
    return out.select("rows_kept", "rows_dropped", "rows_capped",
                      *[r6(c).alias(c) for c in ("rul_min", "rul_max", "rul_mean")])


def _flatten(seq: DataFrame, keys: list[str]) -> DataFrame:
    x = seq.select(*keys, F.posexplode("sequence").alias("step", "v"))
    return x.select(*keys, "step",
                    *[r6(F.col("v")[i].cast("double")).alias(s) for i, s in enumerate(td.TESTDATA_SENSORS)])


@query("sliding_sequences")
def q_sliding_sequences(spark, sf):
    """20-row windows every 6 rows over RUL-labelled readings (flattened)."""
    rul = FT.rul_labels(_series(spark, sf, with_orders=False))
    seq = FT.sequences(rul, td.TESTDATA_SENSORS, length=TD_SEQ_LEN, stride=TD_SEQ_STRIDE)
    seq = seq.withColumn("target", r6("target"))
    return _flatten(seq, ["asset_id", "end_rn", "target"])


@query("latest_sequences")
def q_latest_sequences(spark, sf):
    """The last 60 readings of every asset with at least 60 (flattened)."""
    return _flatten(FT.latest_sequences(td.readings(spark, sf), td.TESTDATA_SENSORS, length=60), ["asset_id"])


@query("latest_reading")
def q_latest_reading(spark, sf):
    """E5: latest reading per asset (aggregate, no per-asset window)."""
    r = td.readings(spark, sf)
    return latest_per_key(r, "asset_id", ["timestamp", "reading_id"])


# --- validation (K7) -----------------------------------------------------------
from rivet.operators import validate as V  # noqa: E402


@query("validation_violations")
def q_validation_violations(spark, sf):
    """B5 + D7: one row per failing cell of the sensor contract."""
    r = td.readings(spark, sf)
    return V.violations(r, V.sensor_contract(), ["asset_id", "reading_id"])


@query("validation_summary")
def q_validation_summary(spark, sf):
    """Failures per (column, check)."""
    r = td.readings(spark, sf)
    return V.violation_summary(V.violations(r, V.sensor_contract(), ["asset_id", "reading_id"]))


@query("missing_profile")
def q_missing_profile(spark, sf):
    """Percent missing per column, flag above 5 %."""
    return V.missing_profile(td.table(spark, sf, "customer"))


@query("duplicate_keys")
def q_duplicate_keys(spark, sf):
    """Rows beyond the first per (l_suppkey, l_shipdate)."""
    return V.duplicate_count(td.table(spark, sf, "lineitem"), ["l_suppkey", "l_shipdate"])


@query("validation_quarantine")
def q_validation_quarantine(spark, sf):
    """K7 (addition): clean and quarantined readings per operating mode."""
    r = td.readings(spark, sf)
    clean, bad = V.quarantine(r, V.sensor_contract(), ["reading_id"])
    return (clean.withColumn("partition", F.lit("clean"))
            .unionByName(bad.withColumn("partition", F.lit("quarantine")))
            .groupBy("partition", "operating_mode").agg(F.count("*").alias("readings")))


@query("validation_report")
def q_validation_report(spark, sf):
    """K7: status and counts of the sensor-contract validation."""
    r = td.readings(spark, sf)
    return V.validation_report(r, V.sensor_contract(), ["asset_id", "reading_id"])


# --- metrics and monitoring (D10-D14, D17, D20-D23, E8, K12) ----------------------
from rivet.operators import drift as DR  # noqa: E402
from rivet.operators import metrics as M  # noqa: E402
from rivet.operators.rank import ordered_split  # noqa: E402


def _scored(spark, sf):
    """Deterministic score vs actual failure, one row per event."""
    ev = td.table(spark, sf, "events")
    score = F.col("value") / (F.col("value") + F.lit(50.0))
    return ev.select("event_id", "ts", "user_id", score.alias("score"),
                     (F.col("event_type") == "error").cast("int").alias("label"),
                     (score >= 0.5).cast("int").alias("pred"))


def _r6all(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("binary_metrics")
def q_binary_metrics(spark, sf):
    """Confusion counts, precision / recall / F1, mid-rank ROC-AUC."""
    return _r6all(M.binary_metrics(_scored(spark, sf), "label", "pred", "score"))


@query("anomaly_metrics")
def q_anomaly_metrics(spark, sf):
    """D10 (anomaly variant): flags vs non-normal operating mode."""
    r = td.readings(spark, sf)
    x = r.select((F.col("operating_mode") != "normal").cast("int").alias("anomaly"),
                 (F.col("vibration_mm") > 80).cast("int").alias("flag"))
    return _r6all(M.anomaly_metrics(x, "anomaly", "flag"))


@query("regression_metrics")
def q_regression_metrics(spark, sf):
    """RMSE / MAE / MAPE of a deterministic RUL guess (5 h per unit of k)."""
    rul = FT.rul_labels(_series(spark, sf, with_orders=False))
    x = rul.select("rul_hours", (F.col("temperature_f") * 5.0).alias("pred"))
    return _r6all(M.regression_metrics(x, "rul_hours", "pred"))


def _asset_scores(spark, sf):
    s = _scored(spark, sf)
    latest = latest_per_key(s.select("user_id", "ts", "event_id", "score"), "user_id", ["ts", "event_id"])
    return latest.select(F.col("user_id").alias("asset_id"), F.col("score").alias("failure_risk_score"))


def _actuals(spark, sf):
    ev = td.table(spark, sf, "events")
    return (ev.groupBy(F.col("user_id").alias("asset_id"))
              .agg((F.sum((F.col("event_type") == "error").cast("int")) >= 14).cast("int").alias("actual_failure")))


@query("false_alarm_share")
def q_false_alarm_share(spark, sf):
    """FP share among high-risk predictions (inner join on asset)."""
    return M.false_alarm_share(_asset_scores(spark, sf), _actuals(spark, sf))


@query("best_row")
def q_best_row(spark, sf):
    """The highest-score event, first event id on ties."""
    s = _scored(spark, sf).select("event_id", "user_id", "score")
    return _r6all(M.best_row(s, "score", "event_id"))


@query("class_weights")
def q_class_weights(spark, sf):
    """Balanced class weights and neg/pos ratio for the 1-day label."""
    s = _series(spark, sf, with_orders=False)
    return _r6all(M.class_weights(s, "failure_within_1d"))


@query("quality_gate")
def q_quality_gate(spark, sf):
    """Best F1 over three thresholds against the 0.70 gate."""
    t = F.explode(F.array(*[F.lit(x) for x in (0.3, 0.5, 0.7)]))  # one pass for all thresholds
    s = (_scored(spark, sf).withColumn("threshold", t)
         .withColumn("pred", (F.col("score") >= F.col("threshold")).cast("int")))
    return _r6all(M.quality_gate(M.grouped_f1(s, "threshold", "label", "pred")))


def _drift_split(spark, sf):
    return ordered_split(td.drift_sample(spark, sf), td.DRIFT_ORDER, 0.7)


@query("temporal_split")
def q_temporal_split(spark, sf):
    """First 70 % of rows by (ship date, key) vs the rest, as a filter."""
    ref, cur, _ = _drift_split(spark, sf)
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return (ref.select(*cols, F.lit("reference").alias("period"))
            .unionByName(cur.select(*cols, F.lit("current").alias("period"))))


@query("data_drift")
def q_data_drift(spark, sf):
    """Two-sample KS per column with p-value and means."""
    return DR.split_drift(td.drift_sample(spark, sf), td.DRIFT_ORDER, td.DRIFT_COLUMNS, exact_rows=0)


@query("drift_exact")
def q_drift_exact(spark, sf):
    """D13 on small samples: supplier balances of the first 70 % of keys
    against the rest, p from the lattice paths."""
    s = td.table(spark, sf, "supplier").select("s_suppkey", "s_acctbal", F.abs("s_acctbal").alias("size"))
    return DR.split_drift(s, ["s_suppkey"], ["s_acctbal", "size"], exact_rows=10_000)


@query("prediction_drift")
def q_prediction_drift(spark, sf):
    """KS on scores of the first 70 % of events vs the rest."""
    s = _scored(spark, sf)
    ref, cur, _ = ordered_split(s, ["ts", "event_id"], 0.7)
    return DR.prediction_drift(ref, cur, "score", exact_rows=0)


@query("drift_rollup")
def q_drift_rollup(spark, sf):
    """Drifted columns of all and the advice."""
    return DR.drift_rollup(DR.split_drift(td.drift_sample(spark, sf), td.DRIFT_ORDER, td.DRIFT_COLUMNS, exact_rows=0))


@query("period_summary")
def q_period_summary(spark, sf):
    """Start, end and rows of each period."""
    ref, cur, _ = _drift_split(spark, sf)
    return DR.period_summary(ref, cur, "l_shipdate")


@query("monitoring_job")
def q_monitoring_job(spark, sf):
    """Split + KS report + roll-up in one table."""
    _, _, report, roll = DR.monitoring_job(td.drift_sample(spark, sf), td.DRIFT_ORDER, td.DRIFT_COLUMNS, exact_rows=0)
    return report.crossJoin(roll.select("n_drifted", "n_columns"))


# --- recommendations (K13) ----------------------------------------------------------
from rivet.operators import recommend as RC  # noqa: E402
from rivet.operators import vector_index as VI  # noqa: E402


def _long(spark, sf):
    return RC.shared(RC.cooccurrence(td.work_order_actions(spark, sf)))


@query("cooccurrence_counts")
def q_cooccurrence_counts(spark, sf):
    """D2 (long form): count per (failure mode, action)."""
    return _long(spark, sf)


@query("cooccurrence_matrix")
def q_cooccurrence_matrix(spark, sf):
    """D2 with zero cells: one row per mode, counts in the order of all actions."""
    return RC.cooccurrence_matrix(_long(spark, sf)).select(
        "failure_mode", F.array_join(F.transform("counts", lambda n: n.cast("string")), "|").alias("counts"))


@query("distinct_counts")
def q_distinct_counts(spark, sf):
    """D3: distinct failure modes and actions."""
    return RC.distinct_counts(_long(spark, sf))


@query("action_sets")
def q_action_sets(spark, sf):
    """Sorted distinct actions per mode."""
    return RC.action_sets(_long(spark, sf)).select(
        "failure_mode", F.array_join("actions", "|").alias("actions"))


@query("distinct_pairs")
def q_distinct_pairs(spark, sf):
    """Distinct (mode, action) pairs."""
    return td.work_order_actions(spark, sf).select("failure_mode", "action").dropDuplicates()


@query("top_actions")
def q_top_actions(spark, sf):
    """Top-5 actions per mode by count."""
    return RC.top_actions(_long(spark, sf), 5)


@query("similar_modes")
def q_similar_modes(spark, sf):
    """J8 + C12 + G3: top-3 cosine-similar other modes."""
    return RC.similar_modes(_long(spark, sf), 3)


def _flat_recs(df: DataFrame, keys: list[str]) -> DataFrame:
    x = df.select(*keys, "method", "confidence", F.posexplode_outer("recommendations").alias("pos", "r"))
    return x.select(*keys, "method", "confidence", (F.col("pos") + 1).alias("rank"),
                    F.col("r.action").alias("action"), F.col("r.association_strength").alias("association_strength"))


def _lookups(spark, sf):
    brands = td.table(spark, sf, "part").select(F.col("p_brand").alias("failure_mode")).distinct()
    rep = root_cause_report(td.readings(spark, sf), td.TESTDATA_SENSORS)
    return brands.unionByName(RC.diagnosis_keys(rep).select("failure_mode"))


@query("recommend_with_fallback")
def q_recommend_with_fallback(spark, sf):
    """Direct lookup, else first same-category mode with history, else none."""
    out = RC.recommend_with_fallback(_long(spark, sf), _lookups(spark, sf), td.categories(spark), 5)
    return _flat_recs(out, ["failure_mode"])


@query("diagnosis_recommendations")
def q_diagnosis_recommendations(spark, sf):
    """Root-cause report -> key normalisation -> fallback recommendations."""
    rep = root_cause_report(td.readings(spark, sf), td.TESTDATA_SENSORS)
    keys = RC.diagnosis_keys(rep)
    recs = RC.recommend_with_fallback(_long(spark, sf), keys.select("failure_mode"), td.categories(spark), 5)
    return _flat_recs(keys.join(recs, "failure_mode"), ["asset_id", "likely_cause", "failure_mode"])


@query("negative_pairs")
def q_negative_pairs(spark, sf):
    """J7 + C11: hashed random pairs not among the positives."""
    return RC.negative_pairs(_long(spark, sf))


@query("precision_at_k")
def q_precision_at_k(spark, sf):
    """D15 + G2: Precision@5 of the co-occurrence top-5 against actual sets."""
    long = _long(spark, sf)
    return _r6all(RC.precision_at_k(RC.top_actions(long, 5), long, 5))


@query("vector_top_k")
def q_vector_top_k(spark, sf):
    """Cosine top-5 vectors for every label centroid of the embeddings."""
    v = td.embedding_vectors(spark, sf)
    cent = (v.select("label", F.posexplode("vector").alias("pos", "x"))
             .groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
             .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("_c"))
             .select("label", F.transform("_c", lambda s: s["x"]).alias("vector")))
    out = RC.vector_top_k(cent, v, 5, "label", "vec_id")
    return out.withColumn("score", r6("score"))


VECTOR_LISTS, VECTOR_PROBES = 16, 8


@query("vector_index_recall")
def q_vector_index_recall(spark, sf):
    """J9 by inverted lists: top-10 of the vectors whose id is divisible by
    100 among all, against the exact top-10."""
    v = td.embedding_vectors(spark, sf)
    centres = VI.fit_centroids(v, "vec_id", lists=VECTOR_LISTS)
    asked = v.filter(F.col("vec_id") % 100 == 0).withColumnRenamed("vec_id", "query_id")
    found = VI.search(asked, VI.build_index(v, centres, "vec_id"), centres, 10, VECTOR_PROBES, "query_id")
    exact = RC.vector_top_k(asked, v, 10, "query_id", "vec_id").withColumnRenamed("vec_id", "item")
    return VI.recall(found, exact, "query_id").select("queries", (F.col("recall") >= 0.9).alias("recall_at_least_90_percent"))


@query("vector_index_all_lists")
def q_vector_index_all_lists(spark, sf):
    """J9 by inverted lists with every list probed: the exact top-5."""
    v = td.embedding_vectors(spark, sf)
    centres = VI.fit_centroids(v, "vec_id", lists=VECTOR_LISTS)
    asked = v.filter(F.col("vec_id") % 100 == 0).withColumnRenamed("vec_id", "query_id")
    found = VI.search(asked, VI.build_index(v, centres, "vec_id", cell_rows=64), centres, 5, VECTOR_LISTS, "query_id")
    return found.select("query_id", "rank", "item", r6("score").alias("score"))


@query("recommendation_job")
def q_recommendation_job(spark, sf):
    """Top-5 actions per mode beside its top-2 similar modes."""
    long = _long(spark, sf)
    top = RC.top_actions(long, 5)
    sim = RC.similar_modes(long, 2)
    return top.join(sim, ["failure_mode", "rank"], "left").select(
        "failure_mode", "rank", "action", "association_strength", "similar_mode", "similarity")


# --- allocation and what-if (K1-K6) --------------------------------------------------
from rivet.operators import allocate as AL  # noqa: E402

FIELD = ["field_id"]


def _asset_rul(spark, sf):
    rul = FT.rul_labels(_series(spark, sf, with_orders=False))
    last = latest_per_key(rul.select("asset_id", "timestamp", "reading_id", "rul_hours"),
                          "asset_id", ["timestamp", "reading_id"])
    return last.select("asset_id", F.col("rul_hours").alias("predicted_rul_hours"))


def _health(spark, sf):
    wells = td.wells(spark, sf).select("field_id", "well_id", "max_capacity_bpd")
    risk = _asset_scores(spark, sf)
    return AL.health_capacity(wells, risk, _asset_rul(spark, sf))


def _limits(spark, sf):
    w = td.wells(spark, sf)
    tot = F.sum(F.col("max_capacity_bpd").cast(AL.DEC))
    return w.groupBy("field_id").agg(
        F.bround(tot * F.lit(0.55).cast("decimal(3,2)"), 0).alias("pipeline_capacity_bpd"),
        F.bround(tot * F.lit(0.60).cast("decimal(3,2)"), 0).alias("compressor_capacity_bpd"))


def _dbl(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
                       for c, t in df.dtypes])


TD_SCENARIOS = [("Baseline", 0, None, None, None),
                ("Pipeline +500 bpd", 1, 500.0, None, None),
                ("Top well degrades 50%", 2, None, None, 0.5),
                ("Compressor +300 bpd", 3, None, 300.0, None)]


def _plans(spark, sf):
    h = _health(spark, sf)
    target = h.groupBy("field_id").agg(F.max("well_id").alias("well_id"))
    return AL.what_if(h, _limits(spark, sf), AL.scenarios_table(spark, TD_SCENARIOS), FIELD, target)


@query("health_capacity")
def q_health_capacity(spark, sf):
    """K6 + C6 + C8 + B6: derated safe capacity by positional asset-well pairing."""
    return _dbl(_health(spark, sf)).select("field_id", "well_id", "max_capacity_bpd", "health_asset_id",
                                           "safe_capacity_bpd", "health_status")


@query("allocation_plan")
def q_allocation_plan(spark, sf):
    """K1 + K3 + E10: closed-form optimal allocation per field with utilisation."""
    plan = AL.allocate(_health(spark, sf), _limits(spark, sf), FIELD)
    return _dbl(plan).select("field_id", "well_id", "safe_capacity_bpd", "health_status",
                             "allocated_production_bpd", "utilization_pct", "status")


@query("binding_constraints")
def q_binding_constraints(spark, sf):
    """K2 + B19: binding shared limits and wells at full safe capacity."""
    lim = _limits(spark, sf)
    plan = AL.allocate(_health(spark, sf), lim, FIELD)
    return AL.binding_constraints(plan, lim, FIELD)


@query("allocation_kpis")
def q_allocation_kpis(spark, sf):
    """Total, wells at full capacity, wells at the fairness floor per field."""
    return AL.kpis(AL.allocate(_health(spark, sf), _limits(spark, sf), FIELD), FIELD)


@query("whatif_plans")
def q_whatif_plans(spark, sf):
    """K4 + B14: all scenarios solved in one pass by (field, scenario)."""
    return _dbl(_plans(spark, sf)).select("field_id", "scenario", "well_id", "safe_capacity_bpd",
                                          "health_status", "allocated_production_bpd", "utilization_pct")


@query("scenario_comparison")
def q_scenario_comparison(spark, sf):
    """K5: delta and percent change of each scenario against the baseline."""
    return AL.compare_scenarios(_plans(spark, sf), FIELD)


# --- preparation, scoring jobs, fleet report (J1, J2, F3-F6, K9, K10, K14, K15, D18) ---
from rivet.operators import prep as PR  # noqa: E402
from rivet.plans import scoring as SC  # noqa: E402
from rivet import constants as KC  # noqa: E402


@query("asset_split")
def q_asset_split(spark, sf):
    """Assets ordered by seeded md5, first ceil(0.2 n) are test."""
    return PR.asset_split(td.readings(spark, sf), rule="ceil")


@query("scaled_test_features")
def q_scaled_test_features(spark, sf):
    """J2 + B2 + B3 + B4: scaler fit on normal rows of train assets, applied to test assets."""
    r = td.readings(spark, sf)
    split = PR.asset_split(r, rule="floor1")
    train, test = PR.split_rows(r, split)
    cols = td.TESTDATA_SENSORS
    stats = PR.fit_scaler(train.filter(F.col("operating_mode") == "normal"), cols)
    out = PR.apply_scaler(test, stats, cols)
    return out.select("asset_id", "reading_id", *[r6(c).alias(c) for c in cols],
                      (F.col("operating_mode") != "normal").cast("int").alias("true_anomaly"))


@query("hash_sample")
def q_hash_sample(spark, sf):
    """500 readings with the smallest seeded hash of their id."""
    return PR.hash_sample(td.readings(spark, sf), 500, ["reading_id"]).select("asset_id", "reading_id")


@query("top_readings")
def q_top_readings(spark, sf):
    """global top-15 readings by vibration, ties by id."""
    return PR.top_n(td.readings(spark, sf), F.col("vibration_mm").desc(), 15, "reading_id").select(
        "asset_id", "reading_id", "vibration_mm")


@query("top_deviations")
def q_top_deviations(spark, sf):
    """five latest readings with the largest |z| of vibration."""
    from rivet.operators.rootcause import sensor_baselines, with_zscores
    r = td.readings(spark, sf)
    latest = latest_per_key(r, "asset_id", ["timestamp", "reading_id"])
    z = with_zscores(latest, sensor_baselines(r, td.TESTDATA_SENSORS), td.TESTDATA_SENSORS)
    top = PR.top_n(z, F.abs(F.col("z_vibration_mm")).desc(), 5, "asset_id")
    return top.select("asset_id", r6("z_vibration_mm").alias("z_vibration_mm"))


@query("head_rul_labels")
def q_head_rul_labels(spark, sf):
    """preview of the first 20 RUL rows by (asset, time)."""
    rul = FT.rul_labels(_series(spark, sf, with_orders=False))
    return (rul.orderBy("asset_id", "timestamp", "reading_id").limit(20)
               .select("asset_id", "reading_id", r6("rul_hours").alias("rul_hours")))


def _risk_report(spark, sf):
    return SC.risk_report(_asset_scores(spark, sf))


def _rul_pred(spark, sf):
    seq = FT.latest_sequences(td.readings(spark, sf), td.TESTDATA_SENSORS, length=60)
    mean_k = F.aggregate("sequence", F.lit(0.0), lambda acc, x: acc + x[1].cast("double")) / F.size("sequence")
    return SC.rul_report(seq.select("asset_id", (mean_k * 10.0 - 100.0).alias("predicted_rul_hours")))


@query("risk_scoring")
def q_risk_scoring(spark, sf):
    """K9 + B10 + E7: latest state of every asset, category and priority rank."""
    return _risk_report(spark, sf).select(
        "asset_id", r6("failure_risk_score").alias("failure_risk_score"), "risk_category",
        F.col("maintenance_priority_rank").cast("long").alias("maintenance_priority_rank"))


@query("rul_scoring")
def q_rul_scoring(spark, sf):
    """K10 + E6 + B9 + B16 + E7: RUL from the last 60 readings, clipped, ranked."""
    p = _rul_pred(spark, sf)
    return p.select("asset_id", r6("predicted_rul_hours").alias("predicted_rul_hours"),
                    r6("predicted_rul_days").alias("predicted_rul_days"),
                    F.col("maintenance_urgency_rank").cast("long").alias("maintenance_urgency_rank"))


@query("fleet_report")
def q_fleet_report(spark, sf):
    """K14 + C5 + B11 + B18: risk left-join RUL, diagnosis and first action."""
    risk = _risk_report(spark, sf)
    rul = _rul_pred(spark, sf)
    rep = root_cause_report(td.readings(spark, sf), td.TESTDATA_SENSORS)
    keys = RC.diagnosis_keys(rep)
    recs = RC.recommend_with_fallback(_long(spark, sf), keys.select("failure_mode"), td.categories(spark), 5)
    first = keys.join(recs, "failure_mode").select(
        "asset_id", "method", F.try_element_at("recommendations", F.lit(1))["action"].alias("first_action"))
    out = SC.fleet_report(risk, rul, rep, first)
    return out.select(F.col("asset_id").alias("Asset"), F.col("status").alias("Status"),
                      r6("failure_risk_score").alias("Failure Risk"), F.col("risk_category").alias("Category"),
                      F.col("maintenance_priority_rank").cast("long").alias("Priority Rank"),
                      r6("predicted_rul_hours").alias("RUL (hours)"), "recommended_action", "likely_cause",
                      "method", "first_action")


@query("fleet_kpis")
def q_fleet_kpis(spark, sf):
    """Assets, high-risk assets, mean risk, most urgent RUL."""
    return _r6all(SC.fleet_kpis(_risk_report(spark, sf), _rul_pred(spark, sf)))


@query("work_orders")
def q_work_orders(spark, sf):
    """K15 + G1 + B19: corrective orders from failures, then preventive visits, WO-%05d ids."""
    ev = td.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    modes = F.array(*[F.lit(m) for m, _ in KC.FAILURE_MODE_CATEGORIES])
    fail = ev.filter(F.col("event_type") == "error").select(
        F.col("user_id").alias("asset_id"), F.col("ts").alias("failure_date"),
        F.element_at(modes, (k % len(KC.FAILURE_MODE_CATEGORIES)) + 1).alias("failure_mode"),
        k.alias("downtime_hours"), F.col("event_id").alias("_tie"))
    prev = ev.filter(F.col("event_type") == "signup").select(
        F.col("user_id").alias("asset_id"), F.col("ts").alias("work_order_date"), F.col("event_id").alias("_tie"))
    return SC.work_orders(fail, prev)


# --- sources and sinks (A1-A8) -------------------------------------------------------
from rivet.sources import io as IO  # noqa: E402


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    """A1 + A2 + A8: readings written as CSV, read back with a declared schema, timestamps parsed."""
    r = td.readings(spark, sf)
    path = IO.scratch_path(spark, "readings-csv")
    IO.write_csv(r.withColumn("timestamp", IO.format_timestamp("timestamp")), path)
    schema = ("asset_id bigint, timestamp string, reading_id bigint, operating_mode string, "
              "vibration_mm double, temperature_f double")
    back = IO.read_csv(spark, path, schema)
    return back.withColumn("timestamp", IO.parse_timestamp("timestamp"))


@query("csv_bad_rows")
def q_csv_bad_rows(spark, sf):
    """A1: a CSV with broken lines (a column too few, a word for a number):
    rows that parse, and the other lines as they are; none is lost."""
    r = td.readings(spark, sf)
    short = F.concat_ws(",", "asset_id", "reading_id")
    word = F.concat_ws(",", "asset_id", F.concat(F.lit("r"), F.col("reading_id").cast("string")), "operating_mode")
    line = F.when(F.col("reading_id") % 97 == 0, short).when(F.col("reading_id") % 89 == 0, word).otherwise(
        F.concat_ws(",", "asset_id", "reading_id", "operating_mode"))
    path = IO.scratch_path(spark, "readings-broken")
    r.select(line.alias("value")).write.text(path)
    good, bad = IO.read_csv_checked(spark, path, "asset_id bigint, reading_id bigint, operating_mode string", header=False)
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


@query("json_limits")
def q_json_limits(spark, sf):
    """A3 + A4: per-field limits written as JSON lines, then as one
    pretty-printed JSON document per field, and read back with a schema."""
    lines, objects = IO.scratch_path(spark, "limits-json"), IO.scratch_path(spark, "limits-objects")
    schema = "field_id string, pipeline_capacity_bpd double, compressor_capacity_bpd double"
    IO.write_json(_limits(spark, sf), lines)
    IO.write_json_objects(IO.read_json_lines(spark, lines, schema), objects, "field_id")
    return IO.read_json_object(spark, objects, schema).drop("document")


@query("work_orders_sorted")
def q_work_orders_sorted(spark, sf):
    """F2 + K15: work orders written in order of date, each with its place in the files."""
    path = IO.scratch_path(spark, "work-orders")
    IO.write_sorted(q_work_orders(spark, sf).select("work_order_id", "work_order_date"), path, ["work_order_date", "work_order_id"])
    return IO.read_in_file_order(spark, path)


@query("snapshot_newest_file")
def q_snapshot_newest_file(spark, sf):
    """A5 + A6: of two runs the one written last is read back, though its name sorts first."""
    cur = q_risk_scoring(spark, sf)
    path = IO.scratch_path(spark, "risk-snapshots")
    IO.write_snapshot(cur.withColumn("failure_risk_score", F.col("failure_risk_score") * 0.5), path, "20240102_000000")
    IO.write_snapshot(cur, path, "20240101_000000")
    return IO.newest_snapshot(spark, path)


@query("snapshot_latest")
def q_snapshot_latest(spark, sf):
    """A5 + A6: two scoring runs appended as run_ts partitions; the latest is read back."""
    cur = q_risk_scoring(spark, sf)
    path = IO.scratch_path(spark, "risk-snapshots")
    IO.write_snapshot(cur.withColumn("failure_risk_score", F.col("failure_risk_score") * 0.5),
                      path, "20240101_000000")
    IO.write_snapshot(cur, path, "20240102_000000")
    return IO.latest_snapshot(spark, path)


# --- models (J3, J5, J6, J12, J13, A7) --------------------------------------------------
from rivet.plans import models as MD  # noqa: E402
from rivet.session import ensure_checkpoint_dir, materialize  # noqa: E402

FEATURE_EXCLUDE = ["asset_id", "timestamp", "reading_id", "operating_mode", "_us", "rn", "n_rows",
                   "next_failure_us", "last_order_us", "first_order_us", "hours_to_failure"]
LABEL = "failure_within_1d"


def _training_frames(spark, sf):
    f = materialize(_features(spark, sf), "features")
    cols = PR.feature_columns(f, FEATURE_EXCLUDE)
    split = PR.asset_split(f, rule="ceil")
    train, test = PR.split_rows(f, split)
    return f, train, test, cols


def _runs_path(spark, sf, job):
    """The run table of one application, job and data folder."""
    data = hashlib.md5(sf.encode()).hexdigest()[:12]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/rivet-io/runs-{spark.sparkContext.applicationId}-{job}-{data}"


def _logged(spark, sf, specs) -> str:
    """Run table of the classifiers, fitted and logged where they are not there yet."""
    path = _runs_path(spark, sf, "risk")
    runs = IO.read_runs(spark, path)
    there = set() if runs is None else {r[0] for r in runs.select(F.col("params")["model"]).collect()}  # one row per model
    missing = [s for s in specs if s.name not in there]
    if missing:
        _, train, test, cols = _training_frames(spark, sf)
        MD.log_classifiers(spark, path, "failure-risk", missing, train, test, cols, LABEL, "reading_id")
    return path


def _classifier_runs(spark, sf):
    """Run table of the classifier comparison, the best F1 in Staging."""
    path = _logged(spark, sf, MD.CLASSIFIERS)
    if IO.read_runs(spark, path).filter("stage = 'Staging'").isEmpty():
        IO.promote(spark, path, "failure-risk", "f1")
    return path


def _staged_classifier(spark, sf):
    run = IO.staged(spark, _classifier_runs(spark, sf), "failure-risk", "Staging")
    return MD.load_classifier(spark, run["path"], run["params"]["kind"])


def _run_metrics(spark, path, names):
    return IO.read_runs(spark, path).select(
        "version", F.col("params")["model"].alias("model"), *[F.col("metrics")[n].alias(n) for n in names])


CLASSIFIER_METRICS = ("precision", "recall", "f1", "roc_auc")


@query("classifier_comparison")
def q_classifier_comparison(spark, sf):
    """J3a-d + J12 + D10 + D20: a forest, level-wise and leaf-wise boosted trees
    on asset-split features, precision / recall / F1 / ROC-AUC on test assets."""
    return _r6all(_run_metrics(spark, _classifier_runs(spark, sf), CLASSIFIER_METRICS).drop("version"))


@query("best_classifier")
def q_best_classifier(spark, sf):
    """D17 + D22: best model by F1 and the 0.70 quality gate."""
    runs = _run_metrics(spark, _classifier_runs(spark, sf), CLASSIFIER_METRICS)
    best = M.best_row(runs, "f1", "version").drop("version")
    return _r6all(best.withColumn("passed_gate", F.col("f1") >= F.lit(KC.QUALITY_GATE_F1)))


@query("model_runs")
def q_model_runs(spark, sf):
    """J13 + A7: the run table (version = max + 1, best run in Staging); the
    staged model is loaded by name and stage and scores every reading."""
    path = _classifier_runs(spark, sf)
    f = materialize(_features(spark, sf), "features")
    model = _staged_classifier(spark, sf)
    scored = MD.positive_probability(model, f, PR.feature_columns(f, FEATURE_EXCLUDE))
    return (IO.read_runs(spark, path)
            .select("name", "version", F.col("params")["model"].alias("model"), "stage",
                    r6(F.col("metrics")["f1"]).alias("f1"))
            .crossJoin(F.broadcast(scored.agg(F.count("score").alias("scored_rows")))))  # one row


@query("model_risk_scoring")
def q_model_risk_scoring(spark, sf):
    """K9 with the staged model: latest reading of every asset, class-1
    probability, category and priority rank."""
    model = _staged_classifier(spark, sf)
    f = _features(spark, sf)
    cols = PR.feature_columns(f, FEATURE_EXCLUDE)
    latest = latest_per_key(f, "asset_id", ["timestamp", "reading_id"])
    p = MD.positive_probability(model, latest, cols, "failure_risk_score")
    return SC.risk_report(p.select("asset_id", "timestamp", "failure_risk_score")).select(
        "asset_id", "timestamp", r6("failure_risk_score").alias("failure_risk_score"), "risk_category",
        "maintenance_priority_rank")


@query("run_table")
def q_run_table(spark, sf):
    """J13 + D17 on deterministic metrics: three threshold rules logged as
    runs, the best F1 (lowest version on ties) stored as Staging."""
    path = IO.scratch_path(spark, "runs")
    s = materialize(_scored(spark, sf), "run-scores")
    for t in (0.3, 0.5, 0.7):
        m = M.binary_metrics(s.withColumn("pred", (F.col("score") >= t).cast("int")), "label", "pred").first()
        IO.log_run(spark, path, "threshold-rule", f"threshold/{t}", {"threshold": t},
                   {k: m[k] for k in ("precision", "recall", "f1")})
    IO.promote(spark, path, "threshold-rule", "f1")
    return IO.read_runs(spark, path).select("name", "version", "stage", "path", r6(F.col("metrics")["f1"]).alias("f1"))


def _rul_runs(spark, sf):
    """Run table of the RUL regressors; the least RMSE is staged."""
    path = _runs_path(spark, sf, "rul")
    if IO.read_runs(spark, path) is None:
        rul = FT.rul_labels(_series(spark, sf, with_orders=False))
        seq = FT.sequences(rul, td.TESTDATA_SENSORS, length=TD_SEQ_LEN, stride=TD_SEQ_STRIDE)
        flat, cols = MD.flatten_sequences(seq, len(td.TESTDATA_SENSORS), TD_SEQ_LEN)
        flat = materialize(flat, "rul-sequences")
        train, test = PR.split_rows(flat, PR.asset_split(flat, rule="floor1"))
        models, metrics = MD.compare_regressors(train, test, cols, "target", n_sensors=len(td.TESTDATA_SENSORS))
        MD.register(spark, path, "remaining-life", models, metrics, "rmse", maximize=False)
    return path


@query("rul_model_comparison")
def q_rul_model_comparison(spark, sf):
    """J5 + D11: two tree regressors and a sequence model (random kernels and
    ridge) on 20-step sequences, asset split."""
    return _r6all(_run_metrics(spark, _rul_runs(spark, sf), ("rmse", "mae", "mape")).drop("version"))


@query("rul_model_scoring")
def q_rul_model_scoring(spark, sf):
    """K10 with the regressor of least RMSE, loaded by name and stage: the
    latest sequence of every asset, predicted hours and urgency rank."""
    model = MD.load_regressor(spark, _rul_runs(spark, sf), "remaining-life", "Staging")
    seq = FT.latest_sequences(td.readings(spark, sf), td.TESTDATA_SENSORS, length=TD_SEQ_LEN)
    flat, cols = MD.flatten_sequences(seq, len(td.TESTDATA_SENSORS), TD_SEQ_LEN)
    pred = model.transform(MD.assemble(flat, cols)).select(
        "asset_id", F.col("prediction").alias("predicted_rul_hours"))
    return _r6all(SC.rul_report(pred))


@query("als_recommendations")
def q_als_recommendations(spark, sf):
    """J6 + J9 + D15: implicit ALS factors, cosine top-5 actions per mode, Precision@5."""
    long = _long(spark, sf)
    uf, itf = MD.als_embeddings(long)
    top = RC.vector_top_k(uf, itf, 5, "failure_mode", "action")
    return _r6all(RC.precision_at_k(top, long, 5))


from rivet.plans import two_tower as TT  # noqa: E402


@query("two_tower_pairs")
def q_two_tower_pairs(spark, sf):
    """J6 + J7: what the embeddings learn from, positives and hashed negatives."""
    return TT.training_pairs(_long(spark, sf)).groupBy("failure_mode", "label").agg(
        F.count("*").alias("pairs"), F.min("action").alias("first_action"), F.max("action").alias("last_action"))


@query("two_tower_recommendations")
def q_two_tower_recommendations(spark, sf):
    """J6 + J9: embeddings from sampled negatives, cosine top-5 actions per mode."""
    modes, actions = TT.two_tower_embeddings(_long(spark, sf))
    return RC.vector_top_k(modes, actions, 5, "failure_mode", "action").withColumn("score", r6("score"))


@query("two_tower_precision")
def q_two_tower_precision(spark, sf):
    """J6 + D15: Precision@5 of the embeddings beside that of random actions,
    the share of (mode, action) cells that are positives."""
    long = _long(spark, sf)
    modes, actions = TT.two_tower_embeddings(long)
    p = RC.precision_at_k(RC.vector_top_k(modes, actions, 5, "failure_mode", "action"), long, 5)
    chance = long.agg((F.count_distinct("failure_mode", "action") / F.count_distinct("failure_mode")
                       / F.count_distinct("action")).alias("by_chance"))
    return _r6all(p.crossJoin(F.broadcast(chance)))  # one row each


# --- isolation forest (J4, K16) ----------------------------------------------------------
from rivet.plans import iforest as IF  # noqa: E402


def _anomaly_frames(spark, sf):
    f = materialize(_features(spark, sf), "features")
    cols = PR.feature_columns(f, FEATURE_EXCLUDE)
    split = PR.asset_split(f, rule="floor1")
    train, test = PR.split_rows(f, split)
    normal = train.filter(F.col("operating_mode") == "normal")
    stats = PR.fit_scaler(normal, cols)
    return PR.apply_scaler(normal, stats, cols), PR.apply_scaler(test, stats, cols), cols


@query("isolation_forest_train_flags")
def q_isolation_forest_train_flags(spark, sf):
    """Forest fit on normal rows of train assets; flag rate on them is the contamination."""
    train, _, cols = _anomaly_frames(spark, sf)
    nodes = IF.fit(train, cols, ["reading_id"])
    s = IF.score(train, nodes, cols, ["reading_id"])
    thr = IF.threshold(s)
    return s.agg(F.count("*").alias("train_rows"),
                 F.round(F.avg((F.col("anomaly_score") > F.lit(thr)).cast("double")), 2).alias("flag_rate"))


@query("anomaly_job")
def q_anomaly_job(spark, sf):
    """Split -> normal rows -> scaler -> isolation forest -> metrics on test assets."""
    train, test, cols = _anomaly_frames(spark, sf)
    nodes = IF.fit(train, cols, ["reading_id"])
    thr = IF.threshold(IF.score(train, nodes, cols, ["reading_id"]))
    s = IF.score(test, nodes, cols, ["reading_id", "operating_mode"])
    x = s.select((F.col("operating_mode") != "normal").cast("int").alias("anomaly"),
                 (F.col("anomaly_score") > F.lit(thr)).cast("int").alias("flag"))
    return _r6all(M.anomaly_metrics(x, "anomaly", "flag").select(F.lit("Isolation Forest").alias("model"), "*"))


# --- explanations (J10, J11, D16) ----------------------------------------------------------
from rivet.plans import explain as EX  # noqa: E402


def _shap(spark, sf):
    """SHAP values of every test row under the logged random forest; values
    and scores are tables of the application, computed where not there yet."""
    path = _runs_path(spark, sf, "shap")
    done = IO.read_runs(spark, path)
    if done is None:
        spec = MD.CLASSIFIERS[0]
        runs = IO.read_runs(spark, _logged(spark, sf, [spec]))
        forest = runs.filter(F.col("params")["model"] == spec.name).orderBy(F.col("version").desc()).first()
        _, _, test, cols = _training_frames(spark, sf)
        rf = MD.load_classifier(spark, forest["path"], forest["params"]["kind"])
        scored = materialize(MD.positive_probability(rf, test, cols).select("reading_id", "score", *cols), "shap-rows")
        nodes = rf.nodes() if isinstance(rf, MD.ForestModel) else EX.tree_nodes(spark, forest["path"])
        shap = EX.shap_values(nodes, scored, cols, "reading_id", rf.getNumTrees)
        shap_path, rows_path = IO.scratch_path(spark, "shap-values"), IO.scratch_path(spark, "shap-scores")
        shap.write.parquet(shap_path)
        scored.write.parquet(rows_path)
        IO.log_run(spark, path, "shap", shap_path, {"rows": rows_path}, {})
        done = IO.read_runs(spark, path)
    row = done.first()
    shap, scored = spark.read.parquet(row["path"]), spark.read.parquet(row["params"]["rows"])
    return shap, scored, [c for c in scored.columns if c not in ("reading_id", "score")]


@query("shap_global_importance")
def q_shap_global_importance(spark, sf):
    """J10 + D16: mean |SHAP| per feature of the random forest, top 15."""
    shap, _, _ = _shap(spark, sf)
    return EX.global_importance(shap, 15).select("feature", r6("mean_abs_shap").alias("mean_abs_shap"))


@query("shap_local_explanation")
def q_shap_local_explanation(spark, sf):
    """J11 + D17: top-5 contributions of the highest-risk sampled reading."""
    shap, scored, cols = _shap(spark, sf)
    top = M.best_row(scored.select("reading_id", "score"), "score", "reading_id").select("reading_id")
    vals = scored.join(top, "reading_id").select(
        "reading_id", F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                                                  F.array(*[F.col(c).cast("double") for c in cols])))
        .alias("feature", "value"))
    out = EX.local_explanation(shap.join(top, "reading_id"), vals, "reading_id", 5)
    return out.select("reading_id", "rank", "feature", r6("value").alias("value"),
                      r6("shap").alias("shap_contribution"), "direction")


@query("shap_additivity")
def q_shap_additivity(spark, sf):
    """J10 guard: base value + sum of contributions = class-1 probability."""
    shap, scored, _ = _shap(spark, sf)
    tot = shap.groupBy("reading_id").agg(F.sum("shap").alias("explained"))
    j = tot.join(scored.select("reading_id", "score"), "reading_id")
    return j.agg(F.count("*").alias("rows"),
                 (F.max(F.abs(F.col("explained") - F.col("score"))) < 1e-6).alias("additive"))
