"""Registered queries over the shared tables, one per operator.

Each query reads its whole table, runs the operator with production
parameters and derives the digest columns from the operator's real output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivet.llm.automaton import encode_words
from rivet.llm.bpe import encode
from rivet.llm.conversations import damage, repair_report
from rivet.llm.exact_dedup import exact_dedup
from rivet.llm.html_extract import extract
from rivet.llm.line_dedup import deduplicated
from rivet.llm.merkle import hexed, merkle_manifest
from rivet.llm.mixing import mix_sources
from rivet.llm.quality import quality_rules
from rivet.llm.runindex import repeated_spans
from rivet.llm.secrets import BASE_RULES, scan_secrets
from rivet.llm.setsketch import near_dedup
from rivet.llm.toxicity import THRESHOLD, fit, score


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of every document: who stays, group size, content hash."""
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and digest of the base kinds, all spans."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in BASE_RULES]

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(*wanted: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*wanted))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(listed(of(*kinds)).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op3_repeat_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes under 50-byte strings that a smaller document id has too."""
    out = repeated_spans(table(spark, sf_dir, "documents"), length=50)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and what they decode to."""
    out = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                 public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines repeated in three or more documents, kept in the largest id only."""
    out = deduplicated(table(spark, sf_dir, "documents"), keep="last")
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies by five-word shingles at similarity 0.75: set sizes and components."""
    return near_dedup(table(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to source weights 5, 2, 1 with at most three copies each."""
    out = mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model trained on two thirds of the labels."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("toxic").alias("label"))
    model = fit(docs, labels)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdicts of every document, judged with its source."""
    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; half of them are
    presented without their newlines, and the proof shows it."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    shown = F.when(tampered, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])
    out = merkle_manifest(docs, presented={"text": shown})
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(hexed(F.col("siblings")).cast("binary"), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the test damage."""
    rows = table(spark, sf_dir, "conversations")
    found = repair_report(damage(rows))
    ids = rows.select("conv_id").distinct()
    joined = ids.join(found, ids["conv_id"].eqNullSafe(found["conv_id"]), "left")
    return joined.select(ids["conv_id"], *[F.coalesce(c, F.lit(0).cast("long")).alias(c)
                                           for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word BPE ids of every document and what they decode to."""
    out = encode_words(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


LLM_QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_repeat_dedup": op3_repeat_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_line_dedup": op5_line_dedup,
    "op6_near_dedup": op6_near_dedup,
    "op7_mix_sources": op7_mix_sources,
    "op8_toxicity": op8_toxicity,
    "op9_quality_rules": op9_quality_rules,
    "op10_html_extract": op10_html_extract,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_word_bpe": op13_word_bpe,
}
