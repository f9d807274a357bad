"""As-of labels, maintenance recency and row-frame features against numpy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivet.operators.series import blocked, index_series
from rivet.operators.windows import sliding_sequences
from rivet.plans import features as FT

T0 = dt.datetime(2024, 1, 1)
SENS = ["vibration_mm", "temperature_f"]


def _fixture(spark, seed=7, n_assets=4, n=90):
    rng = np.random.default_rng(seed)
    rows, fails, orders = [], [], []
    rid = 0
    for a in range(n_assets):
        hours = np.sort(rng.choice(np.arange(0, 24 * 12), size=n, replace=False))
        for h in hours:
            rows.append((f"A{a}", T0 + dt.timedelta(hours=int(h)), rid, "normal",
                         float(rng.normal(2.2, 0.3)), float(rng.normal(175, 6))))
            rid += 1
        if a == 0:
            continue  # asset without failures and orders
        # failures: one exactly at a reading time, others in between
        fails.append((f"A{a}", T0 + dt.timedelta(hours=int(hours[30]))))
        fails.append((f"A{a}", T0 + dt.timedelta(hours=int(hours[60]) + 0.5)))
        fails.append((f"A{a}", T0 + dt.timedelta(hours=int(hours[75]))))
        orders.append((f"A{a}", T0 + dt.timedelta(hours=int(hours[20]))))
        orders.append((f"A{a}", T0 + dt.timedelta(hours=int(hours[50]) - 0.25)))
    r = spark.createDataFrame(rows, "asset_id string, timestamp timestamp, reading_id long, operating_mode string, "
                                    "vibration_mm double, temperature_f double")
    f = spark.createDataFrame(fails, "asset_id string, failure_date timestamp")
    o = spark.createDataFrame(orders, "asset_id string, work_order_date timestamp")
    return r, f, o, rows, fails, orders


def _np_expect(rows, fails, orders, horizon_days):
    out = {}
    by = {}
    for a, t, rid, *_ in rows:
        by.setdefault(a, []).append((t, rid))
    for a, lst in by.items():
        ts = np.array([np.datetime64(t) for t, _ in lst])
        fs = np.sort(np.array([np.datetime64(t) for aa, t in fails if aa == a], dtype="datetime64[us]"))
        ws = np.sort(np.array([np.datetime64(t) for aa, t in orders if aa == a], dtype="datetime64[us]"))
        for (t, rid), tt in zip(lst, ts):
            if len(fs):
                i = np.searchsorted(fs, tt, side="right")
                nxt = fs[i] if i < len(fs) else None
            else:
                nxt = None
            rul = None if nxt is None else (nxt - tt) / np.timedelta64(1, "h")
            lab = {h: int(any((tt < f) and (tt >= f - np.timedelta64(h, "D")) for f in fs)) for h in horizon_days}
            if len(ws):
                j = np.clip(np.searchsorted(ws, tt) - 1, 0, len(ws) - 1)
                days = (tt - ws[j]) / np.timedelta64(1, "D")
            else:
                days = 0.0
            out[rid] = (rul, lab, days)
    return out


@pytest.mark.parametrize("chunk_hours", [24, 5])
def test_asof_labels_match_searchsorted(spark, chunk_hours):
    r, f, o, rows, fails, orders = _fixture(spark)
    s = FT.labelled_series(r, f, o, SENS, horizons=[1, 3], chunk_us=chunk_hours * 3_600_000_000).collect()
    exp = _np_expect(rows, fails, orders, [1, 3])
    assert len(s) == len(rows)
    for row in s:
        rul, lab, days = exp[row["reading_id"]]
        if rul is None:
            assert row["hours_to_failure"] is None
        else:
            assert abs(row["hours_to_failure"] - rul) < 1e-9
        assert row["failure_within_1d"] == lab[1] and row["failure_within_3d"] == lab[3]
        assert abs(row["days_since_maintenance"] - days) < 1e-9


def test_row_numbers_dense_and_counts(spark):
    r, f, o, rows, *_ = _fixture(spark)
    s = FT.labelled_series(r, f, o, SENS, chunk_us=3 * 3_600_000_000)
    per = s.groupBy("asset_id").agg(F.min("rn"), F.max("rn"), F.count("*"), F.countDistinct("rn"),
                                    F.max("n_rows")).collect()
    for p in per:
        assert p[1] == 1 and p[2] == p[3] == p[4] == p[5]


def test_negative_days_before_first_order_and_zero_without_orders(spark):
    r, f, o, *_ = _fixture(spark)
    s = FT.labelled_series(r, f, o, SENS).collect()
    assert any(x["days_since_maintenance"] < 0 for x in s if x["asset_id"] != "A0")
    assert all(x["days_since_maintenance"] == 0.0 for x in s if x["asset_id"] == "A0")
    assert all(x["hours_to_failure"] is None for x in s if x["asset_id"] == "A0")


def test_rul_cap_and_drop(spark):
    rows = [("A", T0 + dt.timedelta(hours=h), h, "normal", 1.0, 1.0) for h in range(0, 5000, 500)]
    r = spark.createDataFrame(rows, "asset_id string, timestamp timestamp, reading_id long, operating_mode string, "
                                    "vibration_mm double, temperature_f double")
    f = spark.createDataFrame([("A", T0 + dt.timedelta(hours=4000))], "asset_id string, failure_date timestamp")
    rul = FT.rul_labels(FT.labelled_series(r, f, None, SENS)).orderBy("reading_id").collect()
    assert [x["rul_hours"] for x in rul] == [3000.0, 3000.0, 3000.0, 2500.0, 2000.0, 1500.0, 1000.0, 500.0]


@pytest.mark.parametrize("block_rows", [1_000_000, 80])
def test_features_match_numpy(spark, block_rows):
    r, f, o, rows, *_ = _fixture(spark, n=150)
    feat = FT.feature_frame(r, f, o, SENS, horizons=[1], block_rows=block_rows).collect()
    assert len(feat) == len(rows)
    by = {}
    for x in sorted(feat, key=lambda x: (x["asset_id"], x["rn"])):
        by.setdefault(x["asset_id"], []).append(x)
    for a, lst in by.items():
        v = np.array([x["vibration_mm"] for x in lst])
        for i, x in enumerate(lst):
            for k in (6, 24, 72):
                seg = v[max(0, i - k + 1): i + 1]
                assert abs(x[f"vibration_mm_roll_mean_{k}h"] - seg.mean()) < 1e-9
                sd = seg.std(ddof=1) if len(seg) > 1 else 0.0
                assert abs(x[f"vibration_mm_roll_std_{k}h"] - sd) < 1e-9
            lag = v[i - 24] if i >= 24 else 0.0
            assert abs(x["vibration_mm_lag_24h"] - lag) < 1e-12
            assert abs(x["vibration_mm_trend_24h"] - ((v[i] - v[i - 24]) if i >= 24 else 0.0)) < 1e-12
            seg = v[max(0, i - 23): i + 1]
            e = 0.0 if len(seg) < 4 else float(np.sum(np.abs(np.fft.rfft(seg - seg.mean())) ** 2))
            assert abs(x["vibration_fft_energy"] - e) <= 1e-9 * max(1.0, e)


def test_first_row_features_are_zero(spark):
    r, f, o, *_ = _fixture(spark)
    first = FT.feature_frame(r, f, o, SENS, horizons=[1]).filter(F.col("rn") == 1).collect()
    for x in first:
        assert x["vibration_mm_roll_std_6h"] == 0.0 and x["vibration_mm_lag_24h"] == 0.0
        assert x["vibration_mm_trend_24h"] == 0.0 and x["vibration_fft_energy"] == 0.0


@pytest.mark.parametrize("n,expected", [(19, 0), (20, 1), (25, 1), (26, 2), (50, 6)])
def test_sequence_counts(spark, n, expected):
    rows = [("A", i + 1, float(i), float(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "asset_id string, rn long, target double, x double")
    b = blocked(df, "asset_id", "rn", halo=19, block_rows=23)
    seq = sliding_sequences(b, ["x"], "target", 20, 6, ["asset_id", "_blk"], "rn", "rn").filter(~F.col("_halo"))
    got = seq.collect()
    assert len(got) == expected
    for s in got:
        assert [v[0] for v in s["sequence"]] == [float(i) for i in range(s["rn"] - 20, s["rn"])]


def test_index_series_without_logs(spark):
    r, *_ = _fixture(spark, n=90)
    s = index_series(r, chunk_us=3_600_000_000 * 7)
    assert s.count() == 4 * 90 and "next_failure_us" not in s.columns


def test_strict_recency_option(spark):
    r, f, o, *_ = _fixture(spark)
    a = {x["reading_id"]: x["days_since_maintenance"] for x in FT.labelled_series(r, f, o, SENS).collect()}
    b = {x["reading_id"]: x["days_since_maintenance"]
         for x in FT.labelled_series(r, f, o, SENS, strict_recency=True).collect()}
    changed = [k for k in a if a[k] != b[k]]
    assert changed and all(a[k] <= 0 and b[k] == 999.0 for k in changed)


def test_label_bounds_exact(spark):
    """Reading at F - h -> 1 (inclusive); at F -> refers to the next failure;
    after the last failure -> 0 and no RUL."""
    F1, F2 = T0 + dt.timedelta(days=3), T0 + dt.timedelta(days=10)
    hours = [0, 48, 72, 96, 240, 250]  # F1 - 1d, F1, between, F2, after
    rows = [("A", T0 + dt.timedelta(hours=h), i, "normal", 1.0, 1.0) for i, h in enumerate(hours)]
    r = spark.createDataFrame(rows, "asset_id string, timestamp timestamp, reading_id long, operating_mode string, "
                                    "vibration_mm double, temperature_f double")
    f = spark.createDataFrame([("A", F1), ("A", F2)], "asset_id string, failure_date timestamp")
    s = {x["reading_id"]: x for x in FT.labelled_series(r, f, None, SENS, horizons=[1]).collect()}
    assert s[0]["failure_within_1d"] == 0 and s[1]["failure_within_1d"] == 1   # 72 h before / exactly F1 - 1d
    assert s[2]["failure_within_1d"] == 0 and s[2]["hours_to_failure"] == 168.0  # at F1 -> next is F2
    assert s[4]["hours_to_failure"] is None and s[4]["failure_within_1d"] == 0   # at F2, no later failure
    assert s[5]["hours_to_failure"] is None
