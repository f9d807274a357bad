"""Maintenance-action recommendations.

Data stays in long form ``(failure_mode, action, cnt)``: the raw action log
is aggregated once (partial aggregation per task, so a hot mode or action
is combined before the shuffle); everything else works on that distinct
table. The matrix form is produced only for output.

Cosine similarity between modes is the sparse product M M^T: a self-join
of the distinct (mode, action) table on ``action``, never of raw rows. Its
top k is found without all pairs of a hot action (``similarity``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivet import constants as K
from rivet.functions.exprs import normalise_key
from rivet.operators.rank import global_row_number
from rivet.operators.similarity import HOT_MODES, cosines, nearest_candidates, pair_dots
from rivet.operators.vector_cells import best_in_groups, norm
from rivet.operators.windows import top_k_per_group
from rivet.session import materialize

CELL_ROWS = 4096  # items that meet a block of queries
DIRECT = (K.METHOD_DIRECT, K.CONFIDENCE_DIRECT)


def shared(long: DataFrame) -> DataFrame:
    """Write the distinct (mode, action, cnt) table for operators that read it
    several times, so the raw action log is scanned and aggregated once. Its
    size is bounded by distinct pairs, not by the log. A table that was
    written here is passed on as it is, so a job writes it once."""
    if getattr(long, "_rivet_shared", False):
        return long
    out = materialize(long, "cooccurrence")
    out._rivet_shared = True
    return out


NO_DATA = (K.METHOD_NO_DATA, K.CONFIDENCE_NONE)
NO_CATEGORY_DATA = (K.METHOD_NO_CATEGORY_DATA, K.CONFIDENCE_NONE)
FALLBACK_CONFIDENCE = K.CONFIDENCE_FALLBACK


def cooccurrence(actions: DataFrame, mode: str = "failure_mode", action: str = "action") -> DataFrame:
    """Long-form co-occurrence counts."""
    return (actions.groupBy(F.col(mode).alias("failure_mode"), F.col(action).alias("action"))
                   .agg(F.count("*").alias("cnt")))


def cooccurrence_matrix(long: DataFrame) -> DataFrame:
    """(failure_mode, counts): the mode x action matrix with zero cells, one
    row per mode, ``counts`` in the order of all actions (D2). A row is as
    wide as the output it stands for; actions go by their place in the
    order, and only their number is shared with all rows."""
    places = global_row_number(long.select("action").filter(F.col("action").isNotNull()).distinct(),
                               [F.col("action")], out="_at")
    n = places.agg(F.count("*").cast("int").alias("_n"))
    cell = F.when(F.col("_at").isNotNull(), F.struct(F.col("_at").cast("int"), "cnt"))
    own = (long.join(places, "action", "left").groupBy("failure_mode")
           .agg(F.map_from_entries(F.collect_list(cell)).alias("_own")))
    every = F.slice(F.sequence(F.lit(0), F.col("_n")), F.lit(2), F.col("_n"))  # 1 .. n, none of none
    return own.crossJoin(F.broadcast(n)).select(  # one row
        "failure_mode", F.transform(every, lambda i: F.coalesce(
            F.try_element_at("_own", i), F.lit(0).cast("long"))).alias("counts"))


def distinct_counts(long: DataFrame) -> DataFrame:
    """Distinct modes and actions (D3)."""
    return long.agg(F.countDistinct("failure_mode").alias("n_failure_modes"),
                    F.countDistinct("action").alias("n_actions"))


def action_sets(long: DataFrame) -> DataFrame:
    """Sorted distinct action set per mode."""
    return long.groupBy("failure_mode").agg(F.array_sort(F.collect_set("action")).alias("actions"))


def top_actions(long: DataFrame, k: int = 5) -> DataFrame:
    """Top-k actions per mode by count, positives only, ties by action."""
    t = top_k_per_group(long, "failure_mode", "cnt", "action", k)
    return t.select("failure_mode", "rank", "action", F.col("cnt").alias("association_strength"))


def mode_similarity(long: DataFrame) -> DataFrame:
    """Cosine similarity for every pair of modes sharing an action."""
    return cosines(pair_dots(long), long)


def similar_modes(long: DataFrame, k: int = 3, hot: int = HOT_MODES) -> DataFrame:
    """Top-k most similar other modes, similarity rounded half-even to 3
    digits; modes with no shared action count as 0 and fill the list in
    name order (J8, C12, G3). An action of more than ``hot`` modes does not
    bring all its modes together (``similarity.nearest_candidates``)."""
    long = shared(long)
    sims = materialize(nearest_candidates(long, k, hot), "similar-candidates")
    modes = long.select("failure_mode").distinct()
    # zero-similarity candidates: the first 2k+1 modes by name suffice for any
    # mode (it can skip itself and at most k-1 positive neighbours)
    cand = (modes.orderBy("failure_mode").limit(2 * k + 1)  # per-task top-n, bounded
                 .select(F.col("failure_mode").alias("similar_mode")))
    zeros = (modes.crossJoin(F.broadcast(cand))
                  .filter(F.col("failure_mode") != F.col("similar_mode"))
                  .join(sims.select("failure_mode", "similar_mode"), ["failure_mode", "similar_mode"], "left_anti")
                  .withColumn("similarity", F.lit(0.0)))
    allc = sims.unionByName(zeros)
    w = Window.partitionBy("failure_mode").orderBy(F.col("similarity").desc(), F.col("similar_mode"))
    return (allc.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
                .withColumn("similarity", F.bround("similarity", 3)))


def recommend_with_fallback(long: DataFrame, lookups: DataFrame, categories: DataFrame,
                            k: int = 5) -> DataFrame:
    """Recommendations for each looked-up mode.

    direct hit -> its top-k, ``direct_historical_match`` / ``high``;
    else the first mode (category ordinal) of the same category that has
    history -> its top-k, ``category_fallback (borrowed from m)`` / low;
    known category without history -> ``no_similar_category_data``;
    unknown category -> ``no_data_available``.
    ``categories``: (failure_mode, category, ordinal). ``lookups``: (failure_mode).
    """
    long = shared(long)
    known = long.select("failure_mode").distinct().withColumn("_known", F.lit(True))
    # first mode with history per category, by ordinal
    donors = (categories.join(known, "failure_mode")
                        .groupBy("category")
                        .agg(F.min_by("failure_mode", "ordinal").alias("borrowed_from")))
    lk = (lookups.select("failure_mode").distinct()
                 .join(known, "failure_mode", "left")
                 .join(categories.select("failure_mode", "category"), "failure_mode", "left")
                 .join(donors, "category", "left"))
    is_direct = F.col("_known").isNotNull()
    source = F.when(is_direct, F.col("failure_mode")).otherwise(F.col("borrowed_from"))
    method = (F.when(is_direct, F.lit(DIRECT[0]))
               .when(F.col("category").isNull(), F.lit(NO_DATA[0]))
               .when(F.col("borrowed_from").isNull(), F.lit(NO_CATEGORY_DATA[0]))
               .otherwise(F.concat(F.lit(K.METHOD_FALLBACK.split("{mode}")[0]), F.col("borrowed_from"),
                                   F.lit(K.METHOD_FALLBACK.split("{mode}")[1]))))
    confidence = (F.when(is_direct, F.lit(DIRECT[1]))
                   .when(F.col("category").isNull() | F.col("borrowed_from").isNull(), F.lit(K.CONFIDENCE_NONE))
                   .otherwise(F.lit(FALLBACK_CONFIDENCE)))
    lk = lk.select("failure_mode", source.alias("_src"), method.alias("method"), confidence.alias("confidence"))
    top = top_actions(long, k)
    recs = (top.groupBy(F.col("failure_mode").alias("_src"))
               .agg(F.array_sort(F.collect_list(F.struct("rank", "action", "association_strength")))
                    .alias("_r")))
    out = lk.join(recs, "_src", "left")
    return out.select("failure_mode",
                      F.coalesce(F.transform("_r", lambda x: F.struct(x["action"].alias("action"),
                                                                       x["association_strength"]
                                                                       .alias("association_strength"))),
                                 F.array().cast("array<struct<action:string,association_strength:bigint>>"))
                      .alias("recommendations"),
                      "method", "confidence")


def diagnosis_keys(report: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Diagnosis names -> recommender keys, unclassified rows skipped.

    By default the normalised name is the key, as in the original, so four
    of the seven diagnosis names find no history. ``aliases``
    (diagnosis_key, failure_mode) optionally maps normalised names onto
    recommender modes; names without an alias keep their own key."""
    k = report.select("asset_id", "likely_cause", normalise_key("likely_cause").alias("failure_mode"))
    k = k.filter(F.col("failure_mode") != K.UNCLASSIFIED_KEY)
    if aliases is None:
        return k
    a = aliases.select(F.col("diagnosis_key").alias("_dk"), F.col("failure_mode").alias("_alias"))
    return (k.join(F.broadcast(a), k.failure_mode == a._dk, "left")  # alias table: a handful of rows
             .select("asset_id", "likely_cause", F.coalesce("_alias", "failure_mode").alias("failure_mode")))


def _hex_int(hexstr):
    return F.conv(hexstr, 16, 10).cast("long")


def negative_pairs(long: DataFrame, seed: int = 42) -> DataFrame:
    """As many hashed (mode, action) draws as positive pairs, minus the
    positives; repeats allowed (J7, C11, G3).

    Draw i takes the md5 of the i-th positive pair and the seed: its first
    and second 15 hex digits pick a mode and an action by dense index, so
    the sample is deterministic, needs no driver loop and is reproducible
    in any engine with md5.
    """
    pos = shared(long).select("failure_mode", "action").distinct()
    modes = pos.select("failure_mode").distinct()
    acts = pos.select("action").distinct()
    # dense indexes over the distinct modes / actions
    mi = global_row_number(modes, [F.col("failure_mode")], out="_mi").withColumn("_mi", F.col("_mi") - 1)
    ai = global_row_number(acts, [F.col("action")], out="_ai").withColumn("_ai", F.col("_ai") - 1)
    n_m = mi.agg(F.count("*").alias("_nm"))
    n_a = ai.agg(F.count("*").alias("_na"))
    h = F.md5(F.concat_ws("|", F.col("failure_mode"), F.col("action"), F.lit(str(seed))))
    draws = (pos.crossJoin(F.broadcast(n_m)).crossJoin(F.broadcast(n_a))
                .select(F.pmod(_hex_int(F.substring(h, 1, 15)), F.col("_nm")).alias("_mi"),
                        F.pmod(_hex_int(F.substring(h, 16, 15)), F.col("_na")).alias("_ai")))
    neg = draws.join(mi, "_mi").join(ai, "_ai").select("failure_mode", "action")
    return neg.join(pos, ["failure_mode", "action"], "left_anti")


def precision_at_k(recs: DataFrame, long: DataFrame, k: int = 5) -> DataFrame:
    """mean over modes of |top-k recommended & actual| / k."""
    actual = shared(long).select("failure_mode", "action").distinct()
    hits = (recs.select("failure_mode", "action").distinct()
                .join(actual, ["failure_mode", "action"], "left_semi")
                .groupBy("failure_mode").agg(F.count("*").alias("hits")))
    modes = actual.select("failure_mode").distinct()
    per = modes.join(hits, "failure_mode", "left").select(
        "failure_mode", (F.coalesce(F.col("hits"), F.lit(0)) / F.lit(float(k))).alias("precision"))
    return per.agg(F.avg("precision").alias("precision_at_k"), F.count("*").alias("n_modes"))


BLOCK_BYTES = 64 << 20  # of query vectors that meet a cell at once


def vector_top_k(queries: DataFrame, items: DataFrame, k: int, qkey: str, ikey: str,
                 qvec: str = "vector", ivec: str = "vector", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Cosine top-k items per query vector (J9): every pair is scored.

    The stated queries (modes, label centroids) are cut by hash into blocks
    of about ``block_bytes``, the items into cells of about ``CELL_ROWS``. Each
    block meets each cell in a group, which keeps k rows per query before the
    shuffle. More queries or items mean more groups, never a larger one."""
    total = queries.agg(F.sum(F.size(qvec) * 8 + 64)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    cells = max(1, -(-items.count() // CELL_ROWS))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    q = queries.select(F.col(qkey).alias("query"), F.col(qvec).alias("vector"), norm(qvec).alias("norm"),
                       F.pmod(F.xxhash64(qkey, qvec), F.lit(blocks)).alias("block"), every(cells).alias("cell"))
    i = items.select(F.col(ikey).alias("item"), F.col(ivec).alias("vector"), norm(ivec).alias("norm"),
                     F.pmod(F.xxhash64(ikey, ivec), F.lit(cells)).alias("cell"), every(blocks).alias("block"))
    return best_in_groups(q, i, ["block", "cell"], k).select(F.col("query").alias(qkey), "rank", F.col("item").alias(ikey), "score")
