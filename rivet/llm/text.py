"""Column expressions and table helpers shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivet.session import ensure_checkpoint_dir

# FIXED VALUES: the six ASCII white-space characters that separate words.
WHITE_SPACE = " \t\n\x0b\f\r"
WHITE_SPACE_RUN = "[ \\t\\n\\x0B\\f\\r]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole(text) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other letter stays as it is.

    ``lower`` folds all of Unicode, so it serves only texts without a
    non-ASCII character (as many bytes as characters).
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def strip(text: Column) -> Column:
    """Without the six white-space characters at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def words(text: Column) -> Column:
    """Array of maximal runs of other characters; empty for a blank text."""
    stripped = strip(text)
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, WHITE_SPACE_RUN))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def without(text: Column, characters: str) -> Column:
    """The text without the given single characters."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def digest128(text: Column) -> Column:
    """128-bit content hash, 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder the
    cluster names in ``spark.checkpoint.dir`` and read it back. The files
    survive lost executors, and their size is known to the planner."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rivet-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """``written``, in buckets by a column, so that later groups and joins on
    it read the table without moving its rows again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rivet-llm/{name}-{uuid.uuid4().hex}"
    table = f"spark_catalog.default.{path.rsplit('/', 1)[1].replace('-', '_')}"
    buckets = min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    (df.repartition(buckets, column).write.bucketBy(buckets, column)
     .option("path", path).option("compression", "zstd").saveAsTable(table))
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # from the catalog only: the files are at a path of our own
    return out


def row_key(docs: DataFrame, text_col: str = "text") -> Column:
    """128-bit digest of a whole row: the raw text and every other column,
    null told from empty. Rows with one key are equal in all columns."""
    others = F.to_json(F.struct(*[docs[c] for c in docs.columns if c != text_col]))
    return digest128(F.concat(others, F.when(docs[text_col].isNull(), "0").otherwise(F.concat(F.lit("1"), docs[text_col]))))


def keep_rows(docs: DataFrame, keys: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose row key is in ``keys`` (one column, row_key).
    Rows that repeat stay as often as they are."""
    keyed = docs.withColumn("__row_key", row_key(docs, text_col))
    return keyed.join(keys.select(F.col("row_key").alias("__row_key")), "__row_key", "left_semi").drop("__row_key")


def one_of_each(docs: DataFrame, wanted: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose row key is in ``wanted`` (row_key, n, other
    columns), joined with its other columns. Rows that repeat, n of a key,
    become one; only theirs are the texts that are grouped."""
    keyed = docs.withColumn("__row_key", row_key(docs, text_col))
    told = wanted.withColumnsRenamed({"row_key": "__row_key", "n": "__n"})
    out = keyed.join(told, "__row_key")
    if not told.filter("__n > 1").isEmpty():
        out = out.filter("__n = 1").unionByName(out.filter("__n > 1").dropDuplicates(["__row_key"]))
    return out.drop("__row_key", "__n")


def keep_one(docs: DataFrame, keys: DataFrame, text_col: str = "text") -> DataFrame:
    """``keep_rows``, but rows that repeat are reduced to one."""
    wanted = written(keys.groupBy("row_key").agg(F.count(F.lit(1)).alias("n")), "kept-keys")
    return one_of_each(docs, wanted, text_col)
