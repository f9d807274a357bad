"""Role mapping of the shared parquet tables onto the fleet data model.

The operators are written against the fleet schema (asset_id, timestamp,
sensor columns, failure and work-order logs). The benchmark tables carry no
equipment data, so each role is projected out of them here:

* readings     <- events (asset_id=user_id, timestamp=ts, vibration_mm=value,
                  temperature_f=props.k, operating_mode from event_type)
* failures     <- events with event_type 'error'
* work orders  <- events with event_type 'signup'
* co-occurrence (failure_mode, action) <- lineitem x part (p_brand, p_name)
* wells        <- part (well_id=p_partkey, field=p_brand, capacity=p_retailprice)
* drift sample <- lineitem numeric columns ordered by ship date
* vectors      <- embeddings

Every projection is a plain select/filter so Catalyst prunes columns and
pushes predicates into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]

# the two sensor channels the events table can carry
TESTDATA_SENSORS = ["vibration_mm", "temperature_f"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def operating_mode(event_type):
    return (F.when(event_type == "error", F.lit("critical"))
            .when(event_type == "purchase", F.lit("degrading"))
            .otherwise(F.lit("normal")))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("asset_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("reading_id"),
        operating_mode(F.col("event_type")).alias("operating_mode"),
        F.col("value").alias("vibration_mm"),
        F.get_json_object("props", "$.k").cast("double").alias("temperature_f"),
    )


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev.filter(F.col("event_type") == "error")
            .select(F.col("user_id").alias("asset_id"),
                    F.col("ts").alias("failure_date")))


def work_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev.filter(F.col("event_type") == "signup")
            .select(F.col("user_id").alias("asset_id"),
                    F.col("ts").alias("work_order_date")))


def work_order_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per performed action: failure_mode=p_brand, action=p_name."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    return (li.join(pt, li.l_partkey == pt.p_partkey)
            .select(F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                F.col("l_linenumber").cast("string")).alias("work_order_id"),
                    F.col("p_brand").alias("failure_mode"),
                    F.col("p_name").alias("action")))


def wells(spark: SparkSession, sf_dir: str) -> DataFrame:
    pt = table(spark, sf_dir, "part")
    return pt.select(
        F.col("p_brand").alias("field_id"),
        F.col("p_partkey").alias("well_id"),
        F.col("p_retailprice").alias("max_capacity_bpd"),
        (F.col("p_size") / F.lit(50.0)).alias("failure_risk"),
    )


def drift_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax")


DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DRIFT_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
               "l_suppkey", "l_extendedprice"]


def categories(spark: SparkSession) -> DataFrame:
    """Mode -> category with ordinals: the fixed failure modes first (listed
    order), then the benchmark brands by rule (Brand#1-10 mechanical,
    #11-20 hydraulic, #21-25 electrical)."""
    from rivet import constants as K
    rows = [(m, c, i + 1) for i, (m, c) in enumerate(K.FAILURE_MODE_CATEGORIES)]
    for n in range(1, 26):
        cat = "mechanical" if n <= 10 else ("hydraulic" if n <= 20 else "electrical")
        rows.append((f"Brand#{n}", cat, 100 + n))
    return spark.createDataFrame(rows, "failure_mode string, category string, ordinal int")


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").alias("vector"))
