"""Mixing sources to target weights.

Tokens (here: words) are summed per source, each source's target follows from
its weight, and rate = target / size. Every document is emitted floor(rate)
times, plus one hash-seeded Bernoulli copy with probability equal to the
fraction.

A document's copy is drawn by a number hashed from the seed and its id, and
comes with a probability of exactly the fraction. The draws of one stratum,
about ``split_rows`` documents of one source, offset each other: documents
are decided from the longest to the shortest, and what a decision takes above
or below its probability, in words, is given back by the probabilities of the
documents after it, as far as these stay between 0 and 1. The mean of those
changes is 0, so every document keeps the fraction as its probability, while
a source's words come near its target even where one text holds many of them.

Plan. One scan of the texts writes (id, source, size, row key). One aggregate gives
source sizes and counts. A source is split into strata by hash, so no window
holds a hot source, and strata into blocks of at most ``BLOCK_ROWS`` rows, which
are decided as one array without texts. Only sums and the offsets of the sources' ranks, one row
per task, are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivet.llm.text import n_words, one_of_each, row_key, whole, written

SPLIT_ROWS = 512
BLOCK_ROWS = 2048  # of one stratum that offset each other


def _hex(text: Column, digits: int) -> Column:
    """The first hex digits of a text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: tuple[int, ...], cap: float) -> DataFrame:
    """Targets for (source, source_size), one row per source.

    Sources in order of code point, null last, take ``weights`` in turn. The
    targets share the sum of all sizes by weight; a target above ``cap``
    times its source's size stops there and the excess is shared again by
    weight until none is above. Each round needs three sums.
    """
    ordered = written(totals.orderBy(F.col("source").asc_nulls_last())
                      .withColumn("place", F.monotonically_increasing_id()), "mix-sources")
    task = F.shiftright("place", 33)
    counts = ordered.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # one row per task of the ordered write
    offsets = counts.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                          (rank % len(weights) + 1).cast("int"))
    sources = written(ordered.withColumn("task", task).join(offsets, "task")
                      .select("source", "source_size", weight.alias("weight")), "mix-weights")

    share = 0.0
    while True:
        above = F.col("source_size") * F.lit(cap) < F.col("weight") * F.lit(share)
        total, stopped, w = sources.agg(
            F.sum("source_size"), F.sum(F.when(above, F.col("source_size"))),
            F.sum(F.when(~above, F.col("weight")))).first()
        new = ((total or 0) - cap * (stopped or 0)) / w if w else share
        if new <= share:
            break
        share = new
    target = F.least(F.col("source_size") * F.lit(float(cap)), F.col("weight") * F.lit(float(share)))
    return sources.select("source", "source_size", "weight", target.alias("target"))


def _draws(docs: Column, fraction: Column, words: Column) -> Column:
    """Array of 0 or 1 for an array of (size, u), u even between 0 and 1.

    ``p`` is the probability of all documents not yet decided. A document of
    s words, with ``rest`` words after it, moves it by -a (1 - p) if taken and
    by a p if not, with a = s / rest or the largest step that keeps p between
    0 and 1."""
    def decide(state: Column, doc: Column) -> Column:
        p, rest = state["p"], state["rest"] - doc["size"]
        hit = doc["u"] < p
        step = F.when((p <= 0.0) | (p >= 1.0) | (rest <= 0), F.lit(0.0)).otherwise(
            F.least(doc["size"] / rest, p / (1.0 - p), (1.0 - p) / p))
        moved = F.when(hit, p - step * (1.0 - p)).otherwise(p + step * p)
        return F.struct(F.least(F.lit(1.0), F.greatest(F.lit(0.0), moved)).alias("p"), rest.alias("rest"),
                        F.concat(state["taken"], F.array(hit.cast("int"))).alias("taken"))
    start = F.struct(fraction.alias("p"), words.alias("rest"), F.array().cast("array<int>").alias("taken"))
    return F.aggregate(docs, start, decide, lambda state: state["taken"])


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1),
                cap: int = 3, seed: int = 0, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """One row per input row: ``id_col``, source, size, source_size, target, copies, row_key.

    Size is the number of words; null text has none. Null is a source of its
    own, last in order. A source without words has target 0 and no copies.
    Ids may be null or repeat: row_key, a digest of the whole row, tells such
    rows apart, so reruns agree. No row gets more than ``cap`` copies. An
    empty table gives an empty result.
    """
    sized = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                n_words(whole(docs[text_col])).alias("size"), row_key(docs, text_col).alias("row_key")),
                    "mix-sizes")
    totals = written(sized.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")), "mix-totals")
    targets = source_targets(totals.select("source", "source_size"), weights, cap)
    plan = (totals.select(F.col("source").alias("s"), F.ceil(F.col("n") / split_rows).alias("splits"))
            .join(targets, F.col("s").eqNullSafe(targets["source"]))
            .select("s", "splits", "source_size", "target"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # null ids are told apart by their rows
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"),
                                                        F.concat(F.lit("null:"), F.hex("row_key"))))
    rows = (sized.join(plan, sized["source"].eqNullSafe(plan["s"]))
            .select("id", "source", "size", "row_key", "source_size", "target", rate.alias("rate"),
                    F.md5(key.cast("binary")).alias("draw"),
                    (_hex(key, 7) % F.col("splits")).alias("split")))
    place = F.row_number().over(Window.partitionBy("source", "split")
                                .orderBy(F.col("size").desc(), "draw", "id", "row_key"))
    rows = rows.withColumn("place", place)
    u = _hex(F.concat_ws(":", "draw", F.col("place").cast("string")), 13) / F.lit(float(1 << 52))
    blocks = (rows.withColumn("block", F.floor((F.col("place") - 1) / BLOCK_ROWS)).withColumn("u", u)
              .groupBy("source", "split", "block", "source_size", "target", "rate")
              .agg(F.array_sort(F.collect_list(F.struct("place", "size", "u", "id", "row_key"))).alias("docs"),
                   F.sum("size").alias("words")))
    taken = _draws(F.col("docs"), F.col("rate") - F.floor("rate"), F.col("words"))
    told = blocks.withColumn("doc", F.explode(F.arrays_zip("docs", taken.alias("taken"))))
    return told.select(F.col("doc.docs.id").alias(id_col), "source", F.col("doc.docs.size").alias("size"),
                       "source_size", "target",
                       (F.floor("rate") + F.col("doc.taken")).cast("long").alias("copies"),
                       F.col("doc.docs.row_key").alias("row_key"))


def emit(docs: DataFrame, mix: DataFrame, text_col: str = "text") -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as ``mix``, made from
    the same columns, says, with its own columns. Rows that are equal in all
    columns are emitted together, as often as they are told in sum."""
    told = written(mix.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("__copies"))
                   .filter("__copies > 0"), "mix-copies")
    return (one_of_each(docs, told, text_col)
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
            .select(*docs.columns))
