"""Line dedup: range-partitioned line hashes, secondary sort, keep bitmaps.

Each long enough line is a (key hash, document, position) row. Rows are range
partitioned by (hash, salt) and sorted by hash, salt, document and position;
streaming over that order, the first row of each run of equal (hash, salt) is
that part's first occurrence, and each change of document counts one. The
salt, 64 values from the document, splits a line that a third of all
documents hold over 64 ranges; parts are joined by the hash again as at most
64 summary rows. What leaves the operator is one run-length bitmap per
document, not text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivet.llm.text import ascii_lower, digest128, strip, whole, written

SALTS = 64


def _row_key(docs: DataFrame, id_col: str, text: Column) -> list[Column]:
    """Rows that repeat an id with another text are told apart."""
    return [F.col(id_col).alias("id"), F.xxhash64(text).alias("part")]


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_chars: int = 20, min_docs: int = 3, keep: str = "first") -> DataFrame:
    """(id, part, position): every line occurrence to drop.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased.
    Keys of at least ``min_chars`` code points found under at least
    ``min_docs`` ids lose all lines except those of the first (smallest) or
    last (largest) id. Null ids come after all others in either order and
    count as one.
    """
    text = whole(docs[text_col])
    lines = docs.select(*_row_key(docs, id_col, text),
                        F.posexplode(F.split(text, "\n", -1)).alias("position", "line"))
    keys = written(
        lines.filter(F.char_length(strip(F.col("line"))) >= min_chars)
        .withColumn("line", strip(F.col("line"))).withColumn("line", ascii_lower(F.col("line")))
        .select(digest128(F.col("line")).alias("key"),
                F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"), "id", "part", "position"),
        "line-keys")
    ranged = keys.repartitionByRange("key", "salt")
    order = F.col("id").asc_nulls_last() if keep == "first" else F.col("id").desc_nulls_last()
    stream = Window.partitionBy("key", "salt").orderBy(order, "part", "position")
    new_id = (F.row_number().over(stream) == 1) | ~F.lag("id").over(stream).eqNullSafe(F.col("id"))
    heads = written(
        ranged.withColumn("new_id", new_id).filter("new_id").groupBy("key", "salt")
        .agg(F.count(F.lit(1)).alias("n"),
             (F.min("id") if keep == "first" else F.max("id")).alias("head")), "line-heads")
    verdicts = (heads.groupBy("key")
                .agg(F.sum("n").alias("n"),
                     (F.min("head") if keep == "first" else F.max("head")).alias("keep_id"))
                .filter(F.col("n") >= min_docs).select("key", "keep_id"))
    marks = heads.select("key", "salt").join(verdicts, "key")
    return (keys.join(marks, ["key", "salt"])
            .filter(~F.col("id").eqNullSafe(F.col("keep_id"))).select("id", "part", "position"))


def _bitmap(positions: Column, n: Column) -> Column:
    """Run lengths of kept, dropped, kept, ... lines from sorted dropped positions."""
    start = F.struct(F.array().cast("array<int>").alias("runs"), F.lit(0).alias("at"), F.lit(0).alias("open"))

    def step(s, p):
        joins = (p == s["at"]) & (s["open"] > 0)
        return F.struct(
            F.when(joins, s["runs"]).when(s["open"] > 0, F.concat(s["runs"], F.array(s["open"], p - s["at"])))
            .otherwise(F.array(p)).alias("runs"),
            (p + 1).alias("at"), F.when(joins, s["open"] + 1).otherwise(F.lit(1)).alias("open"))

    def finish(s):
        return F.when(s["open"] > 0, F.concat(s["runs"], F.array(s["open"], n - s["at"]))).otherwise(F.array(n))
    return F.aggregate(positions, start, step, finish)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 20, min_docs: int = 3, keep: str = "first") -> DataFrame:
    """One row per input row: id_col, __part, n_lines, n_dropped, keep_runs.

    keep_runs is the compressed keep bitmap: lengths of alternating runs of
    kept and dropped lines, kept first. ``__part`` tells apart rows that
    repeat an id with different texts. Null or empty text is one empty line.
    An empty table gives an empty result.
    """
    return _with_runs(docs, id_col, text_col, min_chars, min_docs, keep, carry_text=False)


def _with_runs(docs, id_col, text_col, min_chars, min_docs, keep, carry_text):
    dropped = (repeated_lines(docs, id_col, text_col, min_chars, min_docs, keep)
               .groupBy("id", "part").agg(F.sort_array(F.collect_set("position")).alias("positions"))
               .select(F.col("id").alias("d_id"), F.col("part").alias("d_part"), "positions"))
    text = whole(docs[text_col])
    rows = docs.select(*_row_key(docs, id_col, text), text.alias("text"))
    if not carry_text:
        rows = rows.select("id", "part", F.size(F.split("text", "\n", -1)).alias("n"))
    else:
        rows = rows.withColumn("n", F.size(F.split("text", "\n", -1)))
    joined = rows.join(dropped, rows["id"].eqNullSafe(dropped["d_id"])
                       & (rows["part"] == dropped["d_part"]), "left")
    runs = F.when(F.col("positions").isNull(), F.array("n")).otherwise(_bitmap(F.col("positions"), F.col("n")))
    kept = [F.col("text").alias("__text")] if carry_text else []
    return joined.select(F.col("id").alias(id_col), F.col("part").alias("__part"),
                         F.col("n").cast("long").alias("n_lines"),
                         F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_dropped"),
                         runs.alias("keep_runs"), *kept)


def kept_text(text: Column, n_dropped: Column, keep_runs: Column) -> Column:
    """The kept lines joined by a line feed, from a text and its bitmap."""
    flags = F.flatten(F.transform(keep_runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    zipped = F.arrays_zip(F.split(text, "\n", -1).alias("line"), flags.alias("keep"))
    lines = F.transform(F.filter(zipped, lambda x: x["keep"]), lambda x: x["line"])
    return F.when(n_dropped == 0, text).otherwise(F.array_join(lines, "\n"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3, keep: str = "first") -> DataFrame:
    """As ``line_dedup``, with the kept text as ``kept_text``."""
    runs = _with_runs(docs, id_col, text_col, min_chars, min_docs, keep, carry_text=True)
    return (runs.withColumn("kept_text", kept_text(F.col("__text"), F.col("n_dropped"), F.col("keep_runs")))
            .drop("__text"))
