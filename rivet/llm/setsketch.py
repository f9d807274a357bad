"""Near-dedup with SetSketch registers.

A document's set is its distinct 5-word shingles. Every shingle starts a
Poisson process of exponentially spaced points on each of m registers; a
register keeps the least point of all shingles, truncated on a logarithmic
scale of base b. Registers of two sets are equal with a probability close to
their similarity, and the register-wise maximum is the sketch of a union.

1. One map writes (id, set size, 128-bit set digest, registers); texts go no
   further. Equal sets collapse to a class with its smallest id.
2. Bands of register values name buckets. In each bucket, all members are
   paired with one centre (a star, never all pairs): the member that shares
   the most bands with others, which is the likeliest to be linked to them.
3. Pairs are estimated from both sketches by maximum likelihood; those that
   may reach the threshold are verified on the full sets.
4. Verified links give components. The members of buckets that then still
   hold several components go through an exact filter: two sets can reach the
   threshold only if they share one of their rarest shingles. The pairs that
   do, and lie in different components, are estimated and verified too. So no
   link between two members of a bucket is lost that joins components.

A hot bucket (a third of all documents, near copies of one another) costs one
star of one pair per member.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivet.llm.secrets import blocks
from rivet.llm.text import written

SHINGLE = 5
REGISTERS = 128
BASE = 1.001
BAND = 4  # registers in a band
BLOCK_BYTES = 2 << 20
#: the estimate may fall short of the threshold by this many standard errors
MARGIN = 4.5

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
# ASCII white space separates words; A-Z count as a-z
_FOLD = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijective scramble."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash) of the distinct shingles, sorted by both.

    A word's hash is a polynomial over its bytes, a shingle's one over its
    words' hashes, both scrambled. A text of fewer words is one shingle.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.cumsum([len(r) + 1 for r in raw])
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    start, stop = edge[::2], edge[1::2]  # the last byte is a space, so each word stops
    # the odd base has an inverse modulo 2^64, which takes a word back to its first place
    base = 0x9E3779B97F4A7C15 | 1
    power = _powers(len(data), base)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[_FOLD[data]] * power)))
    back = _powers(len(data), pow(base, -1, 1 << 64))
    word = mix((sums[stop] - sums[start]) * back[start])
    owner = np.searchsorted(ends, start, side="right")
    n_words = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    h = np.zeros(len(word), np.uint64)
    for j in range(SHINGLE):
        later = word[j:] if j else word
        h[:len(later)] = h[:len(later)] * _M1 + later * _GOLD
    h = mix(h)
    at = np.arange(len(word)) - first[owner]
    whole = at + SHINGLE <= n_words[owner]
    own, value = owner[whole], h[whole]
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    few = np.zeros(len(short), np.uint64)
    for j in range(SHINGLE - 1):
        there = n_words[short] > j
        few[there] = few[there] * _M2 + word[first[short[there]] + j] + np.uint64(j + 1)
    own, value = np.concatenate((own, short)), np.concatenate((value, mix(few)))
    order = np.lexsort((value, own))
    own, value = own[order], value[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (value[1:] != value[:-1])
    return own[new], value[new]


def sketches(own: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Registers (n x m, uint16) of sets given as (set number, element hash).

    An element's points on all registers together are one Poisson process of
    rate m; the gap to its next point and the register that point falls on
    come from a hash of (element, point number). Points are entered up to a
    bound that is likely to fill every register of the set. Where one is
    still empty the bound is doubled and the processes go on; once all are
    full, later points cannot change a register.
    """
    m = REGISTERS
    least = np.full((n, m), np.inf)
    flat = least.reshape(-1)
    size = np.bincount(own, minlength=n)
    bound = (math.log(m) + 4) / np.maximum(size, 1)
    point = np.zeros(len(own))
    number = np.zeros(len(own), np.uint64)
    register = np.zeros(len(own), np.int64)

    def advance(i: np.ndarray) -> None:
        number[i] += np.uint64(1)
        r = mix(value[i] + _GOLD * number[i])
        point[i] -= np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / m
        register[i] = (mix(r ^ _M2) >> np.uint64(32)).astype(np.int64) % m

    rest = np.arange(len(own))
    advance(rest)
    while len(rest):
        live = rest[point[rest] <= bound[own[rest]]]
        while len(live):
            np.minimum.at(flat, own[live] * m + register[live], point[live])
            advance(live)
            live = live[point[live] <= bound[own[live]]]
        empty = np.isinf(least).any(axis=1)
        bound[empty] *= 2
        rest = rest[empty[own[rest]]]
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(least / 20) / math.log(BASE))
    return np.clip(np.nan_to_num(k, neginf=0), 0, 65535).astype(np.uint16)


def estimate(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Similarities of pairs of sets by maximum likelihood.

    Given the set sizes, the numbers of registers where the first sketch is
    larger, smaller or equal are multinomial with probabilities that depend
    on the similarity alone; the log-likelihood is concave and is searched by
    thirds, for all pairs at once.
    """
    more, less = (x > y).sum(axis=1), (x < y).sum(axis=1)
    same = x.shape[1] - more - less
    u = nx / (nx + ny)
    v = 1 - u

    def p(share):
        return -np.log1p(-np.clip(share, 1e-12, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def likelihood(j):
        a, b = p(u - v * j), p(v - u * j)
        return more * np.log(a) + less * np.log(b) + same * np.log(np.maximum(1 - a - b, 1e-12))
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        third = (high - low) / 3
        left = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


SKETCH = "n_shingles long, cls binary, registers array<smallint>"


def sketch_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, part, n_shingles, cls, registers) of every row. ``cls`` is a
    128-bit digest of the set, null for the empty set; ``part`` tells rows
    apart that repeat an id."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("part", T.LongType()),
                           *T.StructType.fromDDL(SKETCH)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, b in blocks(texts, BLOCK_BYTES):
                own, value = shingles(texts[a:b])
                size = np.bincount(own, minlength=b - a)
                registers = sketches(own, value, b - a).view(np.int16)
                cuts = np.concatenate(([0], np.cumsum(size)))
                cls = [hashlib.blake2b(value[s:e].tobytes(), digest_size=16).digest() if e > s else None
                       for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                lists = pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * REGISTERS,
                                                 pa.array(registers.reshape(-1), pa.int16()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(size, pa.int64()),
                     pa.array(cls, pa.binary()), lists], schema.fieldNames())
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("part"), text.alias("text")
                       ).mapInArrow(run, schema)


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimate does not rule the threshold out."""
    j = percent / 100
    least = j - MARGIN * math.sqrt(j * (1 - j) / REGISTERS)
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("cls").alias(side), F.col("n").alias(f"n_{side}"),
                                          F.col("registers").alias(f"r_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (batch.column(c).flatten().to_numpy().view(np.uint16).reshape(batch.num_rows, REGISTERS)
                    for c in (2, 3))
            ok = estimate(x, y, *(batch.column(c).to_numpy().astype(float) for c in (4, 5))) >= least
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok)) for c in (0, 1)], ["a", "b"])
    return pairs.select("a", "b", "r_a", "r_b", "n_a", "n_b").mapInArrow(run, "a binary, b binary")


def _class_texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(cls, text) of the classes in ``nodes``, one text of each."""
    wanted = nodes.join(classes.select("cls", "id", "part"), "cls").select(
        "cls", F.col("id").alias("w_id"), F.col("part").alias("w_part"))
    # ids only on that side: hash it rather than sort the texts
    return written(docs.join(wanted.hint("shuffle_hash"), docs["id"].eqNullSafe(F.col("w_id"))
                             & (docs["part"] == F.col("w_part")))
                   .groupBy("cls").agg(F.first("text").alias("text")), "near-texts")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("cls").alias(side), F.col("text").alias(f"t_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [[t or "" for t in batch.column(c).to_pylist()] for c in (2, 3)]
            ok = []
            for i, j in blocks([x + y for x, y in zip(*both, strict=True)], BLOCK_BYTES):
                own, value = shingles(both[0][i:j] + both[1][i:j])
                size = np.bincount(own, minlength=2 * (j - i))
                pair = own % (j - i)
                order = np.lexsort((value, pair))
                pair, value = pair[order], value[order]
                equal = (pair[1:] == pair[:-1]) & (value[1:] == value[:-1])
                common = np.bincount(pair[1:][equal], minlength=j - i)
                ok.append(100 * common >= percent * (size[:j - i] + size[j - i:] - common))
            mask = np.concatenate(ok) if ok else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(mask)) for c in (0, 1)], ["a", "b"])
    return pairs.select("a", "b", "t_a", "t_b").mapInArrow(run, "a binary, b binary")


def _prefix_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of (cls, root, text) that may reach the threshold, roots
    apart: an exact filter for buckets that hold several components.

    Sets of sizes x and y reach it only if they share a shingle among the
    x - ceil(percent * x) + 1 rarest of the one and as many of the other, in
    any common order. Rarest first, documents that have only a frequent
    passage in common do not meet, however many they are; and what follows
    the first common shingle must leave room for the overlap that is needed.
    That room is part of the join: sets meet under (shingle, size class).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in blocks(texts, BLOCK_BYTES):
                own, value = shingles(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own + a)),
                                                  pa.array(value.view(np.int64))], ["cls", "shingle"])
    rows = written(nodes.select("cls", "text").mapInArrow(run, "cls binary, shingle long"), "near-shingles")
    count = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("f"))
    own = Window.partitionBy("cls")
    n = F.count(F.lit(1)).over(own)
    # after: how many shingles are left from this one on, in the common order
    after = n - F.row_number().over(own.orderBy("f", "shingle")) + 1
    prefix = (rows.join(count, "shingle").withColumn("after", after).withColumn("n", n)
              .filter((F.col("f") > 1) & (F.col("after") >= F.ceil(F.col("n") * percent / 100)))
              .join(nodes.select("cls", "root"), "cls"))
    prefix = written(prefix.select("cls", "root", "n", "after", "shingle"), "near-prefix")
    # n >= m: the larger set asks for the sizes its place leaves room for, by classes of size; the smaller
    # one is met only where its place leaves room for a set of its own size
    step = math.log(100 / min(percent, 90))

    def size_class(size: Column) -> Column:
        return F.floor(F.log(size) / step)
    low = F.ceil(F.col("n") * percent / 100)
    high = F.least(F.col("n"), F.floor(((100 + percent) * F.col("after") - percent * F.col("n")) / F.lit(percent)))
    asking = (prefix.filter(high >= low)
              .withColumn("class", F.explode(F.sequence(size_class(low), size_class(high)))))
    other = (prefix.filter((100 + percent) * F.col("after") >= 2 * percent * F.col("n"))
             .select(F.col("cls").alias("c"), F.col("root").alias("r"), F.col("n").alias("m"),
                     F.col("after").alias("rest"), "shingle", size_class(F.col("n")).alias("class")))
    sizes = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    # the first shingle that two sets share leaves room for the overlap that the threshold asks of their sizes
    room = (100 + percent) * F.least("after", "rest") >= percent * (F.col("n") + F.col("m"))
    larger = (F.col("n") > F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("cls") < F.col("c")))
    return (asking.join(other, ["shingle", "class"])
            .filter(larger & (F.col("root") != F.col("r")) & sizes & room)
            .select(F.least("cls", "c").alias("a"), F.greatest("cls", "c").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node reachable over ``edges`` (a, b).

    Each round every node takes the least label among itself, its
    neighbours and its label's label, until nothing changes.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-edges")
    labels = written(both.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.min("b"), F.min("a")).alias("root")), "near-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("jump"))
        new = written(labels.join(near, "node").join(jump, "root")
                      .select("node", "root", F.least("root", "near", "jump").alias("new")), "near-labels")
        labels = new.select("node", F.col("new").alias("root"))
        if new.filter("root <> new").isEmpty():
            return labels


def _merge(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after further links between nodes or their roots."""
    for side in ("a", "b"):
        old = labels.select(F.col("node").alias(side), "root")
        edges = edges.join(old, side, "left").withColumn(side, F.coalesce("root", side)).drop("root")
    top = components(edges.filter("a <> b"))
    moved = top.select(F.col("node").alias("root"), F.col("root").alias("new"))
    kept = labels.join(moved, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    return written(kept.union(top.join(labels.select("node"), "node", "left_anti")), "near-labels")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               percent: int = 75) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their
    distinct shingles; component_id is the smallest id reachable over links,
    itself included, and kept tells whether that is the row's own id. A text
    without words has no shingles and is linked with nothing; null text is
    such a text. Null ids come after all others: they never name a component
    unless it has no other id. Rows that repeat an id are judged by their own
    texts. Other columns are ignored, whatever their names. An empty table
    gives an empty result.
    """
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.withColumn("part", F.xxhash64("text"))
    rows = written(sketch_rows(docs, id_col, text_col), "near-rows")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "part", F.col("n_shingles").alias("n"),
                          "registers"))
    classes = written(rows.filter("cls is not null").groupBy("cls").agg(best.alias("x"))
                      .select("cls", "x.id", "x.part", "x.n", "x.registers"), "near-classes")

    bands = F.array(*[F.xxhash64(F.slice("registers", i + 1, BAND), F.lit(i)) for i in range(0, REGISTERS, BAND)])
    member = classes.select("cls", "n", F.explode(bands).alias("bucket"))
    sizes = written(member.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "near-sizes")
    shared = written(member.join(sizes, "bucket"), "near-shared")
    # who shares its bands with many others is the likeliest to be linked with them: it goes first
    fame = shared.groupBy("cls").agg(F.sum("k").alias("fame"))
    buckets = written(shared.join(fame, "cls").select("bucket", "cls", "n", "fame"), "near-buckets")

    def candidates(found: DataFrame) -> DataFrame:
        sizes = F.least("n", "n_a") * 100 >= F.greatest("n", "n_a") * percent
        return (found.filter(sizes).select(F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b"))
                .distinct())

    # whoever shares a bucket may be compared: their texts are fetched once for all rounds
    texts = _class_texts(fame.select("cls"), classes, own)

    def verified(pairs: DataFrame) -> DataFrame:
        likely = written(_likely(pairs, classes, percent), "near-likely")
        return written(_verified(likely, texts, percent), "near-links")

    heads = written(buckets.groupBy("bucket").agg(F.max(F.struct("fame", "cls", "n")).alias("head"))
                    .select("bucket", F.col("head.cls").alias("a"), F.col("head.n").alias("n_a")), "near-heads")
    tried = written(candidates(buckets.join(heads, "bucket").filter("cls <> a")), "near-pairs")
    labels = components(verified(tried))
    # buckets that the star has not brought into one component: the members but for their centres
    placed = buckets.join(labels, buckets["cls"] == labels["node"], "left").select(
        "bucket", "cls", F.coalesce("root", "cls").alias("root"))
    open_ = (placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .filter("lo <> hi").select("bucket"))
    left = written(placed.join(open_, "bucket").select("cls", "root").distinct(), "near-left")
    rest = written(_prefix_pairs(left.join(texts, "cls"), percent).join(tried, ["a", "b"], "left_anti"), "near-pairs")
    links = verified(rest)
    if not links.isEmpty():
        labels = _merge(labels, links)

    named = classes.select("cls", "id").join(labels, F.col("cls") == F.col("node"), "left").select(
        "cls", "id", F.coalesce("root", "cls").alias("root"))
    names = named.groupBy("root").agg(F.min("id").alias("component_id"))
    by_class = written(named.select("cls", "root").join(names, "root").select("cls", "component_id"), "near-names")
    out = rows.select("id", "n_shingles", "cls").join(by_class, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
