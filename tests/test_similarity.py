"""Top-k similar modes with hot actions against all pairs."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rivet.operators.recommend import mode_similarity, similar_modes
from rivet.operators.similarity import nearest_candidates

SCHEMA = "failure_mode string, action string, cnt long"


def _table(n: int, n_hot: int, seed: int) -> list[tuple]:
    """``n`` modes under ``n_hot`` hot actions, a few rare ones, and groups of equal vectors."""
    r = random.Random(seed)
    rows = []
    for m in range(n):
        name = f"m{m:05d}"
        if m % 7 == 0:  # equal on the hot actions
            rows += [(name, f"hot{h}", 3) for h in range(n_hot)]
        else:
            rows += [(name, f"hot{h}", r.randint(1, 9)) for h in range(n_hot) if r.random() < 0.8]
        if m % 3:
            rows += [(name, f"rare{a}", r.randint(1, 4)) for a in set(r.choices(range(n // 4), k=2))]
    return rows


def _all_pairs(long, k):
    w = Window.partitionBy("failure_mode").orderBy(F.round("similarity", 9).desc(), "similar_mode")
    return (mode_similarity(long).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))


@pytest.mark.parametrize("n_hot", [1, 4])
def test_top_k_equals_all_pairs(spark, n_hot):
    long = spark.createDataFrame(_table(240, n_hot, n_hot), SCHEMA)
    want = {(r["failure_mode"], r["rank"]): r["similarity"] for r in _all_pairs(long, 3).collect()}
    got = {(r["failure_mode"], r["rank"]): r for r in similar_modes(long, 3, hot=20).collect()}
    assert {key: round(v, 3) for key, v in want.items()} == pytest.approx(
        {key: got[key]["similarity"] for key in want}, abs=1.1e-3)
    exact = {(r["failure_mode"], r["similar_mode"]): r["similarity"] for r in mode_similarity(long).collect()}
    found = nearest_candidates(long, 3, hot=20).collect()
    assert len({(r["failure_mode"], r["similar_mode"]) for r in found}) == len(found)  # each pair once
    for r in found:
        assert r["similarity"] == exact[r["failure_mode"], r["similar_mode"]]
    for mode in {m for m, _ in want}:  # the three best, but for the rounding of doubles
        mine = sorted((r["similarity"] for r in found if r["failure_mode"] == mode), reverse=True)[:3]
        best = sorted((s for (m, _), s in exact.items() if m == mode), reverse=True)[:3]
        assert mine == pytest.approx(best, rel=1e-12)


def test_ties_go_by_name(spark):
    rows = [(f"m{m:04d}", "hot", 1) for m in range(300)]
    rows += [(f"m{m:04d}", f"own{m}", 1) for m in range(300)]
    got = {(r["failure_mode"], r["rank"]): r["similar_mode"]
           for r in similar_modes(spark.createDataFrame(rows, SCHEMA), 2, hot=20).collect()}
    assert got["m0000", 1] == "m0001" and got["m0000", 2] == "m0002"
    assert all((got[f"m{m:04d}", 1], got[f"m{m:04d}", 2]) == ("m0000", "m0001") for m in range(2, 300))


def test_pairs_follow_the_modes_of_a_hot_action(spark):
    """One action held by all modes, few rare ones: candidates grow with the modes."""
    counts = {}
    for n in (1000, 4000):
        long = (spark.range(n).select(F.format_string("m%06d", "id").alias("failure_mode"), F.explode(F.array(
            F.struct(F.lit("hot").alias("action"), (F.col("id") % 5 + 1).alias("cnt")),
            F.struct(F.concat(F.lit("a"), (F.col("id") / 4).cast("int").cast("string")).alias("action"),
                     F.lit(2).cast("long").alias("cnt")))).alias("e"))
            .select("failure_mode", "e.*"))
        counts[n] = nearest_candidates(long, 3, hot=50).count()
    assert counts[4000] < 5 * counts[1000] < 5 * 1000 * 8


def test_null_modes_and_actions_meet_nothing(spark):
    rows = [(f"m{m:03d}", "hot", 1) for m in range(40)] + [(None, "hot", 5), ("m000", None, 7)]
    found = nearest_candidates(spark.createDataFrame(rows, SCHEMA), 2, hot=10).collect()
    assert found and all(r["failure_mode"] and r["similar_mode"] for r in found)
    assert nearest_candidates(spark.createDataFrame([], SCHEMA), 2).count() == 0
