"""Quality rules at host level.

Each document is measured once. Rule failures are summed by host (domain or
source), each host's failure rate is shrunk towards the corpus rate with a
beta prior fitted to the hosts themselves, and the host's verdict is joined
back to its documents.

The base rules reject a document on its own. The remaining rules (symbols,
repeated lines, word length) reject it only on a host whose shrunk rate is
above ``max_rate``: the same odd document passes on a host that is otherwise
clean. A document that breaks no rule always stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivet.llm.text import strip, whole, without, words, written

# FIXED VALUES: symbol characters and limits of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# A window's place takes the low bits of its number, as many as any array has places.
PLACE_BITS = 31
PLACE = (1 << PLACE_BITS) - 1

# Limits of the rules that count on failing hosts only.
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUP_LINE_SHARE = 0.3
MEAN_WORD_CHARS = (2.0, 15.0)
MAX_HOST_RATE = 0.25


def place(number: Column) -> Column:
    return number.bitwiseAND(F.lit(PLACE)).cast("int")


def measures(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """(id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words).

    Repeats: each 3-word window becomes one number, the upper bits of its hash
    above and its place below, and the numbers are sorted. Windows that share
    these bits with a neighbour are sorted again by whole hash and words, and
    those with the words of a neighbour repeat: neither the length of a text
    nor a hash collision, interleaved or not, changes the count. The words
    that repeated windows cover follow from the gaps between their places. All
    of it is array work inside the row, n log n in its words.
    """
    text = F.col("text")
    d = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"),
                    whole(docs[text_col]).alias("text"))
    d = d.withColumn("w", words(text))
    window = lambda i: (F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))
    none = F.array().cast("array<bigint>")
    d = d.withColumn("hashes", F.when(F.size("w") < 3, none).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - 3, F.lit(0))),
                    lambda i: F.xxhash64(*window(i)))))
    # most texts repeat no window and are done here
    d = d.withColumn("numbers", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(
        F.transform("hashes", lambda h, i: h.bitwiseAND(F.lit(~PLACE)).bitwiseOR(i.cast("long"))))).otherwise(none))

    def kept(column, equal):
        return F.filter(column, lambda x, i: equal(x, F.get(column, i - 1)) | equal(x, F.get(column, i + 1)))
    d = d.withColumn("numbers", kept("numbers", lambda x, y: F.shiftrightunsigned(x.bitwiseXOR(y), PLACE_BITS) == 0))
    d = d.withColumn("found", F.sort_array(F.transform("numbers", lambda x: F.struct(
        F.get("hashes", place(x)).alias("hash"), F.struct(*window(place(x))).alias("words"), place(x).alias("place")))))
    d = d.withColumn("found", kept("found", lambda x, y: (x["hash"] == y["hash"]) & (x["words"] == y["words"])))
    d = d.withColumn("repeats", F.sort_array(F.transform("found", lambda x: x["place"])))
    lines = F.filter(F.split(text, "\n", -1), lambda line: strip(line) != "")
    d = d.withColumn("lines", lines)
    covered = F.aggregate(
        F.transform("repeats", lambda p, i: F.least(
            F.lit(3), F.coalesce(F.get("repeats", i + 1) - p, F.lit(3)))),
        F.lit(0), lambda total, n: total + n)
    return d.select(
        "id", "host", F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_failed() -> Column:
    """The rules that a failing host's documents must also pass."""
    mean = F.col("word_chars") / F.greatest("n_words", F.lit(1))
    return ((F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * F.col("n_words"))
            | (F.col("n_dup_lines") > MAX_DUP_LINE_SHARE * F.col("n_lines"))
            | ~mean.between(*MEAN_WORD_CHARS))


def host_rates(measured: DataFrame) -> DataFrame:
    """(host, n, n_failed, rate): failure rates shrunk with an empirical beta prior.

    The prior has the corpus' mean rate m; its strength a + b follows from
    the variance of the hosts' own rates (method of moments, at least 1).
    With equal or single hosts the strength is the mean host size.
    """
    failed = (F.col("base_failed") | F.col("host_failed")).cast("long")
    hosts = written(measured.groupBy("host").agg(F.count(F.lit(1)).alias("n"),
                                                 F.sum(failed).alias("n_failed")), "hosts")
    own = F.col("n_failed") / F.col("n")
    rows, bad, var, size = hosts.agg(F.sum("n"), F.sum("n_failed"), F.var_pop(own), F.avg("n")).first()
    m = bad / rows if rows else 0.0
    strength = max(1.0, m * (1 - m) / var - 1) if var else float(size or 1)
    return hosts.select("host", "n", "n_failed",
                        ((F.col("n_failed") + F.lit(m * strength)) / (F.col("n") + F.lit(strength)))
                        .alias("rate"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per input row: ``id_col``, the counts, base_failed, host_failed, kept.

    Null text has no words and fails the base rules. Null is a host of its
    own. Ids may be null or repeat: every row is judged by its own text.
    Other columns of ``docs`` are ignored, whatever their names. An empty
    table gives an empty result.
    """
    measured = written(measures(docs, id_col, text_col, host_col)
                       .withColumn("base_failed", base_failed())
                       .withColumn("host_failed", host_failed()), "quality")
    bad = (host_rates(measured).filter(F.col("rate") > max_rate)
           .select(F.col("host").alias("bad_host"), F.lit(True).alias("strict")))
    judged = measured.join(bad, measured["host"].eqNullSafe(bad["bad_host"]), "left")
    strict = F.coalesce("strict", F.lit(False))
    return judged.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "host_failed",
                         (~F.col("base_failed") & ~(strict & F.col("host_failed"))).alias("kept"))
