"""Selection, exact KS p-values, the vector index and sources, against brute force."""

import datetime
import random
import time
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivet.operators import drift as DR
from rivet.operators import vector_index as VI
from rivet.operators.rank import ordered_split, row_at
from rivet.operators.recommend import vector_top_k
from rivet.sources import io as IO


def key_of(r):
    return tuple((v is None, 0 if v is None else v) for v in r)


@pytest.mark.parametrize("few, sample", [(50_000, 20_000), (200, 400)])
def test_row_at_is_the_row_of_a_sort(spark, few, sample):
    rng = random.Random(few)
    rows = [(rng.choice([None, "a", "b", "hot", "hot", "hot"]), rng.choice([None, 1 << 62, -5, rng.randrange(1 << 60)]), i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "s string, n long, id long").repartition(5)
    ranked = sorted(rows, key=key_of)
    for k in (0, 777, 1500, 2999):
        got = row_at(df, ["s", "n", "id"], k, len(rows), few, sample)
        assert (got["s"], got["n"], got["id"]) == ranked[k], k


def test_split_by_dates_has_no_global_sort(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = [(start + datetime.timedelta(hours=i % 40), datetime.date(2024, 1, 1 + i % 3) if i % 7 else None, i) for i in range(500)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, d date, id long").repartition(4)
    ref, cur, n = ordered_split(df, ["d", "ts", "id"], 0.7)
    ranked = sorted(((d, ts, i) for ts, d, i in rows), key=lambda r: (r[0] is None, r[0] or datetime.date(2024, 1, 1), r[1], r[2]))
    assert sorted(r["id"] for r in ref.collect()) == sorted(i for *_, i in ranked[:350])
    assert ref.count() + cur.count() == n == 500
    assert "Sort" not in ref._jdf.queryExecution().executedPlan().toString()


def test_exact_p_equals_an_enumeration():
    rng = np.random.default_rng(5)
    for n in range(1, 9):
        for m in (1, 3, 8):
            cdf = []
            for chosen in combinations(range(n + m), n):
                first = np.isin(np.arange(n + m), chosen)
                cdf.append(np.abs(np.cumsum(first) / n - np.cumsum(~first) / m).max())
            for d in {0.0, *rng.choice(cdf, 3), 1.0}:
                want = np.mean([x >= d - 1e-9 for x in cdf])
                assert abs(DR.exact_p(n, m, float(d)) - want) < 1e-12
    began = time.time()
    assert 0.0 < DR.exact_p(10_000, 9_999, 0.05) < 1e-9 and time.time() - began < 60


def test_both_branches_of_the_p_value(spark):
    rng = np.random.default_rng(1)
    ref = spark.createDataFrame([(float(x),) for x in rng.normal(0, 1, 60)], "x double")
    cur = spark.createDataFrame([(float(x),) for x in rng.normal(0.6, 1, 40)], "x double")
    exact, limit = (DR.data_drift(ref, cur, ["x"], exact_rows=e).first() for e in (10_000, 59))
    assert exact["ks_statistic"] == limit["ks_statistic"] and exact["p_value"] != limit["p_value"]
    assert limit == DR.data_drift(ref, cur, ["x"], exact_rows=0).first()


def test_vector_index(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    v = [(i, [float(x) for x in centres[i % 12 if i % 3 else 0] + rng.normal(0, 0.5, 16)]) for i in range(2000)]  # a hot list
    v += [(5000, [0.0] * 16)]
    df = spark.createDataFrame(v, "id long, vector array<double>").repartition(4)
    found = VI.fit_centroids(df, "id", lists=12)
    index = VI.build_index(df, found, "id", cell_rows=100)
    assert index.count() == len(v) and index.agg(F.max("cells")).first()[0] > 1
    asked = df.filter("id % 100 = 0").withColumnRenamed("id", "q")
    exact = vector_top_k(asked, df, 10, "q", "id").withColumnRenamed("id", "item")
    part = VI.recall(VI.search(asked, index, found, 10, 4, "q"), exact, "q").first()
    assert part["queries"] == 21 and part["recall"] >= 0.9
    whole = VI.search(asked, index, found, 10, 12, "q")
    assert sorted((r["q"], r["rank"], r["item"]) for r in whole.collect()) == \
        sorted((r["q"], r["rank"], r["item"]) for r in exact.collect())
    assert (VI.fit_centroids(df.repartition(7), "id", lists=12) == found).all()


def test_vectors_in_groups_equal_pair_by_pair(spark, monkeypatch):
    """Copies, zeros, NaN, nulls and vectors of another length, in groups of
    any size, against one expression per pair; small cells meet together."""
    rng = np.random.default_rng(4)
    v = [(i, [float(x) for x in rng.normal(size=5).round(1)]) for i in range(60)]
    v += [(100 + i, v[i % 3][1]) for i in range(40)] + [(200, [0.0] * 5), (201, None), (202, []), (203, [1.0, None, 2.0, 0.0, 1.0]),
                                                       (204, [1.0, float("nan"), 0.0, 0.0, 0.0]), (205, [3.0, 1.0]), (None, v[0][1]),
                                                       (206, [x * 1e-150 for x in v[0][1]]), (7, v[8][1])]
    df = spark.createDataFrame(v, "id long, vector array<double>").repartition(3)
    q = df.filter("id is null or id % 10 < 7").select(F.col("id").alias("q"), "vector")
    size = "sqrt(aggregate({0}, 0D, (a, x) -> a + x * x))"
    pairs = (q.withColumnRenamed("vector", "a").crossJoin(df.withColumnRenamed("vector", "b").withColumnRenamed("id", "item")).selectExpr(
        "q", "item", f"case when {size.format('a')} > 0 and {size.format('b')} > 0 then aggregate(zip_with(a, b, (x, y) -> x * y), 0D, "
        f"(s, x) -> s + x) / ({size.format('a')} * {size.format('b')}) else 0D end as score"))
    pairs.createOrReplaceTempView("vector_pairs")
    want = spark.sql("select * from (select *, row_number() over (partition by q order by score desc, item) as rank "
                     "from vector_pairs) where rank <= 9").select("q", "rank", "item", "score")

    def rows(found):
        return sorted(map(repr, found.select("q", "rank", "item", "score").collect()))
    from rivet.operators import recommend, vector_cells
    for cells, pairs_at_once, block in ((4096, 1 << 20, 1 << 20), (7, 40, 300)):
        monkeypatch.setattr(recommend, "CELL_ROWS", cells)
        monkeypatch.setattr(vector_cells, "CELLS", pairs_at_once)
        assert rows(vector_top_k(q, df, 9, "q", "id", block_bytes=block).withColumnRenamed("id", "item")) == rows(want)
    known = df.filter("id < 200")
    centres = VI.fit_centroids(known, "id", lists=4)
    index, asked = VI.build_index(known, centres, "id", cell_rows=3), known.filter("id < 30").withColumnRenamed("id", "q")
    meets, whole = [], VI.best_in_groups
    monkeypatch.setattr(VI, "best_in_groups", lambda a, *r: meets.append(a.count()) or whole(a, *r))
    found = VI.search(asked, index, centres, 9, 4, "q")
    assert meets == [asked.count() * index.select("list").distinct().count()] and index.agg(F.max("cells")).first()[0] > 1
    assert rows(found) == rows(vector_top_k(asked, known, 9, "q", "id").withColumnRenamed("id", "item"))


def test_csv_lines_that_do_not_parse(spark, tmp_path):
    lines = ["a,b", "1,x", "2", "z,y", "3,x,more", ",", '4,"q"']
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    good, bad = IO.read_csv_checked(spark, str(tmp_path / "t.csv"), "a int, b string")
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, "x"), (None, None), (4, "q")], key=str)
    assert sorted(r["line"] for r in bad.collect()) == ["2", "3,x,more", "z,y"]


def test_snapshot_by_name_and_by_time(spark):
    path = IO.scratch_path(spark, "snapshots")
    for run in ("20240105", "20240109", "20240101"):
        IO.write_snapshot(spark.createDataFrame([(run,)], "made string"), path, run)
        time.sleep(1.1)  # file times may be whole seconds
    assert IO.latest_snapshot(spark, path).first()["made"] == "20240109"
    assert IO.newest_snapshot(spark, path).first()["made"] == "20240101"


def test_sorted_sink_and_json_objects(spark):
    path, objects = IO.scratch_path(spark, "sorted"), IO.scratch_path(spark, "objects")
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("n"), F.col("id").cast("string").alias("s")).repartition(6)
    IO.write_sorted(df, path, ["n"])
    got = IO.read_in_file_order(spark, path).collect()
    assert all(r["place"] == r["n"] + 1 for r in got) and len(got) == 1000
    IO.write_json_objects(df.limit(5), objects, "s")
    assert IO.read_json_object(spark, objects, "n long, s string").count() == 5
