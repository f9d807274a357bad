"""Exact dedup: group by a 128-bit content hash, compare bytes inside groups.

Two texts are equal when they are identical after lower-casing A-Z.

Plan. One scan writes (id, hash, SHA-256) per row. Hashes that occur once are
settled. For the others only, the texts are fetched by id and aggregated by
(hash, normalised text): rows of one hash whose bytes differ fall into
different classes, and copies collapse in the map-side half, so a text held
by a third of all rows crosses that shuffle once per task and never as a
group. Rows then look their class up by hash. Where one hash holds several
classes, and only there, the lookup repeats the byte comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivet.llm.text import ascii_lower, digest128, whole, written


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "smallest",
                content_hash: Callable[[Column], Column] = digest128) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256.

    ``keep`` names which stable id of a class stays, the smallest or the
    largest. Other columns of ``docs`` are ignored, whatever their names.
    Null text is the empty text. A null id never wins over another id; a
    class of null ids only has a null keep_id, and its rows are kept. Rows
    that repeat an id share one verdict and each count in group_size. An
    empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    pick = F.min if keep == "smallest" else F.max
    norm = ascii_lower(whole(docs[text_col]))
    part = F.xxhash64(whole(docs[text_col])).alias("part")  # tells rows apart that repeat an id
    rows = written(docs.select(F.col(id_col).alias("id"), part, norm.alias("norm"))
                   .select("id", "part", content_hash(F.col("norm")).alias("hash"),
                           F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha")), "exact-rows")
    repeated = written(rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                       .select("hash"), "exact-repeated")
    members = (rows.join(repeated, "hash")
               .select(F.col("id").alias("m_id"), F.col("part").alias("m_part"), "hash").distinct())
    # the members' side is ids only: hash it rather than sort the texts
    texts = (docs.select(F.col(id_col).alias("id"), part, docs[text_col].alias("text"))
             .join(members.hint("shuffle_hash"),
                   F.col("id").eqNullSafe(F.col("m_id")) & (F.col("part") == F.col("m_part")))
             .select("id", "hash", ascii_lower(whole("text")).alias("norm")))
    classes = texts.groupBy("hash", "norm").agg(pick("id").alias("keep_id"),
                                                F.count(F.lit(1)).alias("group_size"))
    by_hash = written(classes.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.min(F.struct("keep_id", "group_size")).alias("c")), "exact-classes")

    verdicts = by_hash.filter("n_classes = 1").select("hash", "c.*")
    collided = by_hash.filter("n_classes > 1").select("hash")
    alone = F.col("group_size").isNull()
    collision = not collided.isEmpty()
    clean = rows.join(collided, "hash", "left_anti") if collision else rows
    found = clean.join(verdicts, "hash", "left").select(
        "id", "sha", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"))
    if collision:
        inside = classes.join(collided, "hash", "left_semi")
        found = found.unionByName(
            texts.join(inside, ["hash", "norm"])
            .select("id", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"),
                    "keep_id", "group_size"))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size",
                        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        F.lower(F.hex("sha")).alias("text_sha256"))
