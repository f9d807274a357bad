"""Toxicity: a bag of subword embeddings, averaged into a linear softmax.

A text's features are the character n-grams of its words, hashed into
buckets. Their embeddings are averaged and a two-class softmax reads the mean;
embeddings and softmax are trained jointly with AdaGrad in numpy. A
misspelling that training never saw shares most n-grams with its word.

Training runs in one task on a bounded sample of the labelled rows, the
``max_rows`` with the smallest hash of their id. Scoring is one
map over all rows and whole texts. As mean and softmax are linear up to the
logit, a bucket's embedding enters it as one number, computed once per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 17
DIMENSIONS = 8
SIZES = (3, 4, 5, 6)
EPOCHS = 5
RATE = 0.2  # falls to zero over the epochs
MAX_ROWS = 8000
SCALE = 1000  # the mean of thousands of n-grams is small; the softmax reads it enlarged
THRESHOLD = 0.7
PIECE_BYTES = 1 << 20

# Letters, digits and all non-ASCII bytes are kept, A-Z in lower case; the rest separates words.
_NORMAL = np.array([b if chr(b).isalnum() or b > 127 else 32 for b in bytes(range(128)).lower()]
                   + list(range(128, 256)), np.uint8)


def _pieces(text: bytes) -> Iterator[np.ndarray]:
    """Bucket numbers of a text's n-grams, piece by piece; pieces overlap by
    less than the longest n-gram, and each n-gram belongs to the piece it
    starts in."""
    data = np.concatenate(([32], _NORMAL[np.frombuffer(text, np.uint8)], [32])).astype(np.uint64)
    for at in range(0, len(data), PIECE_BYTES):
        b = data[at:at + PIECE_BYTES + SIZES[-1] - 1]
        space = b == 32
        code, out = b.copy(), []
        inner = np.zeros(len(b), bool)  # a separator strictly inside
        for n in range(2, SIZES[-1] + 1):
            if len(b) < n:
                break
            code = (code[:-1] << np.uint64(8)) | b[n - 1:]
            inner = inner[:-1] | space[n - 2:len(b) - 1] if n > 2 else inner[:-1]
            if n in SIZES:
                starts = min(len(code), PIECE_BYTES)
                ok = ~inner[:starts]
                h = (code[:starts][ok] + np.uint64(n << 56)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                h *= np.uint64(0xBF58476D1CE4E5B9)
                out.append((h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
        if out:
            yield np.concatenate(out)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, their shares of all n-grams), buckets ascending."""
    counts: np.ndarray | int = 0
    for piece in _pieces(text.encode("utf-8", "surrogatepass")):
        counts = counts + np.bincount(piece, minlength=BUCKETS)
    if isinstance(counts, int):
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    ids = np.flatnonzero(counts)
    return ids.astype(np.int32), (counts[ids] / max(counts.sum(), 1)).astype(np.float32)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], seed: int = 1,
          epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(embeddings with a bias row last, softmax weights) from feature bags."""
    rng = np.random.default_rng(seed)
    e = rng.uniform(-1, 1, (BUCKETS + 1, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    w = rng.uniform(-1, 1, (DIMENSIONS, 2)).astype(np.float32) / DIMENSIONS
    ge, gw = np.full(BUCKETS + 1, 1e-8, np.float32), np.full((DIMENSIONS, 2), 1e-8, np.float32)
    order = np.concatenate([rng.permutation(len(bags)) for _ in range(epochs)]) if bags else []
    for step, i in enumerate(order):
        rate = np.float32(RATE * (1 - step / len(order)))
        ids, share = bags[i]
        ids, share = np.append(ids, BUCKETS), np.append(share, np.float32(1 / SCALE))  # the bias counts once
        rows = e[ids]
        h = SCALE * (share @ rows)
        z = h @ w
        p = np.exp(z - z.max())
        p /= p.sum()
        p[labels[i]] -= 1
        back = w @ p
        grad_w = np.outer(h, p)
        g = ge[ids] + (share * share) * (back @ back)
        ge[ids] = g
        e[ids] = rows - np.outer(rate * share / np.sqrt(g), back)
        gw += grad_w * grad_w
        w -= rate * grad_w / np.sqrt(gw)
    return e, w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "label", max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Train on the texts of at most ``max_rows`` rows of ``labels`` (id,
    label), those with the smallest hash of their id.

    The sample is drawn from the labels alone and is broadcast (``max_rows``
    ids at most), so only the sampled texts move. Rows without an id or label
    are left out; null text is empty. The model has the same few megabytes at
    every size of the tables. Without any row it scores everything alike."""
    chosen = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .select(F.col(id_col).alias("s_id"), F.xxhash64(F.col(id_col)).alias("h"),
                      F.col(label_col).cast("int").alias("label"))
              .orderBy("h", "s_id", "label").limit(max_rows))
    sample = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
              .join(F.broadcast(chosen), F.col("id") == F.col("s_id")).select("h", "label", "text").repartition(1)
              .sortWithinPartitions("h", "label", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, labels = [], []
        for batch in batches:
            for label, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                bags.append(features(text))
                labels.append(label)
        e, w = train(bags, labels)
        yield pa.RecordBatch.from_arrays([pa.array([e.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary())],
                                         ["e", "w"])
    row = sample.mapInArrow(run, "e binary, w binary").first()
    if row is None:
        return np.zeros((BUCKETS + 1, DIMENSIONS), np.float32), np.zeros((DIMENSIONS, 2), np.float32)
    return (np.frombuffer(row["e"], np.float32).reshape(-1, DIMENSIONS),
            np.frombuffer(row["w"], np.float32).reshape(-1, 2))


def class_logits(e: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What a bucket adds to the logit of class 1 when it is the whole mean; the bias last."""
    logits = (e @ (w[:, 1] - w[:, 0])).astype(np.float64)
    logits[:-1] *= SCALE
    return logits


def score_texts(texts: list[str], logits: np.ndarray) -> list[float]:
    out = []
    for text in texts:
        total, n = 0.0, 0
        for piece in _pieces(text.encode("utf-8", "surrogatepass")):
            total += float(logits[piece].sum(dtype=np.float64))
            n += len(piece)
        out.append(1 / (1 + float(np.exp(-np.clip(total / max(n, 1) + logits[-1], -60, 60)))))
    return out


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col`` and score, the probability of the label.

    Null and blank texts have no features and get the bias alone. Ids may be
    null or repeat and are never looked at; other columns are ignored. An
    empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, w = shared.value
        logits = class_logits(e, w)
        for batch in batches:
            scores = score_texts([t or "" for t in batch.column(1).to_pylist()], logits)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], [id_col, "score"])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
