"""Ordered per-asset series without putting one asset into one task.

A plain ``Window.partitionBy("asset_id")`` sends every row of an asset to a
single task. When one asset holds a third of all rows that task is the whole
job. The two layouts below split every asset and stay exact:

1. ``index_series`` -- time chunks. Rows (readings plus failure and
   work-order events) are partitioned by ``(asset, chunk)`` where ``chunk``
   is a stretch of time holding about ``CHUNK_ROWS`` rows. Inside a chunk we compute the reading's
   running index and the strict as-of answers (next failure after the
   reading, last work order before it). A small per-chunk table
   (one row per asset-chunk) carries counts and first/last events across
   chunks through windows over chunks, and one join finishes the global
   row number ``rn`` and the as-of columns (C1, C3).

2. ``blocked`` -- row blocks with a halo. ``rn`` cuts each asset into
   blocks of ``block_rows`` rows; the last ``halo`` rows of each block are
   copied (flagged) into the next block, so any row frame reaching at most
   ``halo`` rows back is exact when windows are partitioned by
   ``(asset, block)`` and ordered by ``rn``. Each row is copied at most
   once (``block_rows >= halo``).

Chunk boundaries are written once, so a lost executor recomputes the same
partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivet.functions.exprs import epoch_us
from rivet.session import materialize

KIND_READING, KIND_FAILURE, KIND_ORDER = 0, 1, 2


CHUNK_ROWS = 2_000_000
MAX_CUTS = 1000


def with_chunks(rows: DataFrame, key: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``_chunk``, ascending in ``_us`` within an asset, so that no chunk
    of an asset holds many more than ``chunk_rows`` rows.

    Chunks are cut by row count, per asset and over readings and events
    alike: an asset above ``chunk_rows`` gets boundaries from quantiles of
    its own times (so a burst is cut as finely as it is dense), any other
    asset is one chunk. Rows of one instant stay together. The only number
    that reaches the driver is the size of the largest asset; boundaries are
    one row per large asset.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n"))
    most = sizes.agg(F.max("_n")).first()[0] or 0
    if most <= chunk_rows:
        return rows.withColumn("_chunk", F.lit(0).cast("long"))
    cuts = min(MAX_CUTS, -(-most // chunk_rows))
    large = sizes.filter(F.col("_n") > chunk_rows)
    quantiles = F.percentile_approx("_us", [i / cuts for i in range(1, cuts)], F.lit(100 * max(cuts, 100)))
    stride = F.greatest(F.lit(1), F.floor(F.lit(cuts) * chunk_rows / F.first("_n"))).cast("int")
    bounds = materialize(
        rows.join(large, key).groupBy(key).agg(quantiles.alias("_q"), stride.alias("_s"))
        .select(key, F.array_distinct(F.filter("_q", lambda x, i: (i + 1) % F.col("_s") == 0)).alias("_q")),
        "chunk-bounds")
    place = F.size(F.filter("_q", lambda q: q <= F.col("_us")))
    return (rows.join(bounds, key, "left")
            .withColumn("_chunk", F.when(F.col("_q").isNull(), F.lit(0)).otherwise(place).cast("long")).drop("_q"))


def index_series(readings: DataFrame, key: str = "asset_id", ts: str = "timestamp",
                 tie: str = "reading_id", failures: DataFrame | None = None,
                 failure_ts: str = "failure_date", work_orders: DataFrame | None = None,
                 order_ts: str = "work_order_date", chunk_us: int | None = None,
                 chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Readings plus ``_us``, ``rn`` (1..n per asset by (ts, tie)), ``n_rows``
    (readings of the asset) and, when the
    logs are given, ``next_failure_us`` (first failure strictly after the
    reading), ``last_order_us`` (last order strictly before) and
    ``first_order_us`` (the asset's first order).

    ``chunk_us`` fixes a chunk width in time; by default ``with_chunks`` cuts
    each asset by row count."""
    parts = [readings.withColumn("_us", epoch_us(ts)).withColumn("_kind", F.lit(KIND_READING))]
    if failures is not None:
        parts.append(failures.select(F.col(key), epoch_us(failure_ts).alias("_us"),
                                     F.lit(KIND_FAILURE).alias("_kind")))
    if work_orders is not None:
        parts.append(work_orders.select(F.col(key), epoch_us(order_ts).alias("_us"),
                                        F.lit(KIND_ORDER).alias("_kind")))
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if chunk_us is None:
        u = with_chunks(u, key, chunk_rows)
    else:
        u = u.withColumn("_chunk", F.floor(F.col("_us") / F.lit(chunk_us)))

    is_r = F.col("_kind") == KIND_READING
    w_rows = (Window.partitionBy(key, "_chunk").orderBy("_us", "_kind", tie)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # frames that look ahead run over the reversed order: Spark extends an
    # unbounded-preceding frame row by row but rebuilds an unbounded-following one
    earlier = Window.partitionBy(key, "_chunk").orderBy("_us").rangeBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(key, "_chunk").orderBy(F.col("_us").desc()).rangeBetween(Window.unboundedPreceding, -1)
    u = u.withColumn("_rn_in", F.sum(is_r.cast("long")).over(w_rows))
    if failures is not None:
        u = u.withColumn("_nf_in", F.min(F.when(F.col("_kind") == KIND_FAILURE, F.col("_us")))
                         .over(later))
    if work_orders is not None:
        u = u.withColumn("_lo_in", F.max(F.when(F.col("_kind") == KIND_ORDER, F.col("_us")))
                         .over(earlier))

    # one row per (asset, chunk): carries counts and events across chunks.
    # Column pruning reduces this branch to the key and time columns, so its
    # scan reads two or three narrow columns, not the sensor payload.
    aggs = [F.sum(is_r.cast("long")).alias("_cnt")]
    if failures is not None:
        aggs.append(F.min(F.when(F.col("_kind") == KIND_FAILURE, F.col("_us"))).alias("_fmin"))
    if work_orders is not None:
        aggs.append(F.max(F.when(F.col("_kind") == KIND_ORDER, F.col("_us"))).alias("_omax"))
        aggs.append(F.min(F.when(F.col("_kind") == KIND_ORDER, F.col("_us"))).alias("_omin"))
    chunks = u.groupBy(key, "_chunk").agg(*aggs)
    wk = Window.partitionBy(key).orderBy("_chunk")
    cols = [F.col(key), F.col("_chunk"),
            F.coalesce(F.sum("_cnt").over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)).alias("_off"),
            F.sum("_cnt").over(Window.partitionBy(key)).alias("n_rows")]
    if failures is not None:
        cols.append(F.min("_fmin").over(Window.partitionBy(key).orderBy(F.col("_chunk").desc())
                                       .rowsBetween(Window.unboundedPreceding, -1)).alias("_nf_later"))
    if work_orders is not None:
        cols.append(F.max("_omax").over(wk.rowsBetween(Window.unboundedPreceding, -1)).alias("_lo_earlier"))
        cols.append(F.min("_omin").over(Window.partitionBy(key)).alias("first_order_us"))
    chunks = chunks.select(*cols)

    out = u.filter(is_r).join(chunks, [key, "_chunk"])
    out = out.withColumn("rn", F.col("_off") + F.col("_rn_in"))
    drop = ["_kind", "_rn_in", "_off", "_chunk"]
    if failures is not None:
        out = out.withColumn("next_failure_us", F.coalesce("_nf_in", "_nf_later"))
        drop += ["_nf_in", "_nf_later"]
    if work_orders is not None:
        out = out.withColumn("last_order_us", F.coalesce("_lo_in", "_lo_earlier"))
        drop += ["_lo_in", "_lo_earlier"]
    return out.drop(*drop)


def blocked(df: DataFrame, key: str = "asset_id", rn: str = "rn", halo: int = 71,
            block_rows: int = 1_000_000) -> DataFrame:
    """Add ``_blk`` and ``_halo``; rows in the last ``halo`` positions of a block
    are emitted twice (the copy, flagged ``_halo``, belongs to the next block).

    Partition windows by ``(key, "_blk")``, order them by ``rn`` and drop
    ``_halo`` rows afterwards.
    """
    if block_rows < halo:
        raise ValueError("block_rows must be at least halo")
    pos = F.col(rn) - 1
    blk = F.floor(pos / F.lit(block_rows))
    in_tail = (pos % F.lit(block_rows)) >= F.lit(block_rows - halo)
    tags = F.when(in_tail & F.lit(halo > 0),
                  F.array(F.struct(blk.alias("b"), F.lit(False).alias("h")),
                          F.struct((blk + 1).alias("b"), F.lit(True).alias("h"))))\
        .otherwise(F.array(F.struct(blk.alias("b"), F.lit(False).alias("h"))))
    return (df.withColumn("_tag", F.explode(tags))
              .withColumn("_blk", F.col("_tag.b"))
              .withColumn("_halo", F.col("_tag.h"))
              .drop("_tag"))
