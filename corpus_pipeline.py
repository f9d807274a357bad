"""Corpus pipeline: quality rules, exact dedup, near-dedup, mixing, encoding.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written as Parquet and reread as the
next one's docs. All but the last return the columns of ``documents``. The
decisions of a stage are carried back by a digest of the whole row, as ids may
be null or repeat.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivet.llm.bpe import encode
from rivet.llm.exact_dedup import exact_dedup
from rivet.llm.mixing import emit, mix_sources
from rivet.llm.quality import quality_rules
from rivet.llm.setsketch import near_dedup
from rivet.llm.text import keep_one, keep_rows, row_key, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; each row is judged by itself."""
    rows = docs.select(row_key(docs).alias("row_key"), "text", "source")
    return keep_rows(docs, quality_rules(rows, id_col="row_key").filter("kept").select("row_key"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the largest id. A null id
    stays only where no other is; rows that repeat become one."""
    rows = docs.select(F.struct("doc_id", row_key(docs).alias("row_key")).alias("row"), "text")
    return keep_one(docs, exact_dedup(rows, id_col="row", keep="largest").filter("kept").select("row.row_key"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the smallest id. A null id
    stays only where no other is; rows that repeat become one."""
    row = F.struct(docs["doc_id"].isNull().alias("none"), "doc_id", row_key(docs).alias("row_key"))
    rows = docs.select(row.alias("row"), "text")
    return keep_one(docs, near_dedup(rows, id_col="row").filter("kept").select("row.row_key"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return emit(docs, mix_sources(docs))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every emitted document, with digests of the ids and of the bytes
    they decode to. A document that the mix repeats is encoded as often."""
    out = encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", "ids", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mix sources", mix_stage),
    ("byte bpe", encode_stage),
]

# Near-dedup and encoding are not SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
