"""Registered queries on the small tables: oracles, digests and the pipeline."""

from __future__ import annotations

import os
import random
from collections import Counter

import duckdb
import pytest
from helpers import documents, near_like_rows, words
from pyspark.sql import functions as F

import corpus_pipeline
from rivet.llm.mixing import emit, mix_sources
from rivet.llm.oracles import LLM_ORACLES
from rivet.llm.queries import LLM_QUERIES
from rivet.llm.text import row_key
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = LLM_QUERIES[name](spark, SF)
    con.execute(f"CREATE OR REPLACE VIEW oracle_view AS {LLM_ORACLES[name]}")
    res = con.execute("SELECT * FROM oracle_view")
    cols, rows = [d[0] for d in res.description], res.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(cols) and len(got) == len(rows)
    assert digest(df.columns, got)[0] == digest(cols, rows)[0]


@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_ORACLES)))
def test_query_covers_its_table(spark, name):
    df = LLM_QUERIES[name](spark, SF)
    source, key = ("pages", "page_id") if name.startswith("op10_") else ("documents", "doc_id")
    ids = [r[0] for r in df.select(key).collect()]
    want = [r[0] for r in spark.read.parquet(f"{SF}/{source}.parquet").select(key).collect()]
    assert sorted(ids) == sorted(want)


def test_pipeline_stages(spark, tmp_path):
    """Each stage keeps what a by-hand version of its rule keeps."""
    rows = near_like_rows()
    docs = documents(spark, rows, clash=False)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        path = f"{tmp_path}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    texts = {r[0]: r[1] for r in rows}
    good = [i for i, t in texts.items() if t and len(t.split()) >= 50]
    assert seen["quality rules"] == sorted(good)
    last = {}
    for i in sorted(good):
        last[texts[i].lower()] = i
    assert seen["exact dedup"] == sorted(last.values())
    near = sorted(i for i in last.values() if not (i >= 500 and i % 100))  # planted near copies: the smallest stays
    assert seen["near dedup"] == near
    assert set(seen["mix sources"]) <= set(near)
    final = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in final.collect()) == seen["mix sources"]


def test_pipeline_judges_rows_not_ids(spark, tmp_path):
    """Repeated rows, null ids and ids with two texts or sources: a verdict
    holds for its row only, and one row of each group stays."""
    rng = random.Random(3)
    a, b, c, d, e, f = (words(rng, 70) for _ in range(6))
    near = " ".join(a.split()[:-1]) + " tail"
    rows = [(1, a, "s"), (1, a, "s"), (1, a, "s"), (None, b, "s"), (None, b, "s"), (None, "short", "s"), (None, "", "s"),
            (None, None, "s"), (None, near, "s"), (2, c, "s"), (2, "too short", "s"), (3, d, "t"), (4, d.replace("b", "B"), "t"),
            (4, e, "t"), (4, e.replace("a", "A"), "t"), (None, d, "t"), (5, f, "t"), (6, f, "t"), (6, a, "t")]
    docs = documents(spark, rows, clash=False)
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        path = f"{tmp_path}/{name.replace(' ', '-')}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert seen["quality rules"] == Counter((i, t) for i, t, _ in rows if t and len(t.split()) >= 50)
    exact = seen["exact dedup"]
    e_row = [x for x in exact if x[0] == 4 and x[1].lower() == e]
    assert len(e_row) == 1
    assert exact == Counter([(6, a), (None, b), (None, near), (2, c), (4, d.replace("b", "B")), e_row[0], (6, f)])
    assert seen["near dedup"] == Counter({x: 1 for x in exact if x != (None, near)})
    mix = mix_sources(docs)
    want = Counter()
    for r in docs.select("doc_id", "text", row_key(docs).alias("k")).collect():
        told = [m["copies"] for m in mix.filter(F.col("row_key") == F.lit(bytes(r["k"]))).collect()]
        want[(r["doc_id"], r["text"])] = sum(told)
    assert Counter((r["doc_id"], r["text"]) for r in emit(docs, mix).collect()) == +want


def test_emit_and_near_stage_with_repeated_rows(spark, tmp_path):
    """Each stage on its own takes repeated rows as well."""
    rng = random.Random(4)
    a, b = words(rng, 60), words(rng, 61)
    rows = [(1, a, "s")] * 5 + [(1, b, "s"), (None, a, "t"), (None, b, "t"), (2, b + " x y z", "u"), (None, None, "u")]
    docs = documents(spark, rows, clash=False)
    near = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_stage(spark, docs, str(tmp_path)).collect()]
    assert Counter(near) == Counter([(1, a), (1, b), (None, None)])
    mix = mix_sources(docs)
    copies = Counter()
    for r in mix.collect():
        copies[r["doc_id"], r["source"], r["size"]] += r["copies"]
    got = Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in emit(docs, mix).collect())
    assert got == +copies


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "ids_sha256" in out.columns
