"""Merkle manifest of a table, with an inclusion proof per row by pointer jumping.

Every row is a leaf, the SHA-256 of its fields. Per group the leaves, in order
of their ids, are joined in runs of ``ARITY`` into parents until one node is
left, the group's subroot; the subroots, in order of the groups, are joined
likewise into the root.

Nodes are rows of one table: each has the segment of siblings on its way to an
ancestor and a pointer to that ancestor. A block of ``ARITY ** HEIGHT``
neighbours is folded by one aggregate, so a first segment spans ``HEIGHT``
levels. Self-joins then double the distance: a node takes over its ancestor's
segment and pointer, until all pointers have reached the root. The leaves, the
bulk of the nodes, make one jump, the last, to ancestors that have reached the
root. That takes log2(levels / HEIGHT) rounds over a small table and one join
of the leaves. Ancestors near the root are pointed at by most of the table, so
the pointing nodes' places salt the join.

Digests travel as 32 bytes; hashes are taken over their hex text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivet.llm.text import written
from rivet.operators.rank import global_row_number

ARITY = 3
HEIGHT = 3  # levels folded by one aggregate
BLOCK = ARITY ** HEIGHT
SALT = 4096  # neighbouring nodes that look up their ancestor under one key
TOP = -1  # number of the tree over the subroots; a group's tree has the group's number

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_KEY = ["tree", "level", "place"]


def sha(text: Column) -> Column:
    """SHA-256 of a text, 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_hash(values: list[Column]) -> Column:
    """Digest of fields: each ``-`` if null, else its length in UTF-8 bytes,
    ``:`` and the value."""
    told = []
    for v in values:
        v = v.cast("string")
        told.append(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return sha(F.concat(*told))


def levels_above(n: Column) -> Column:
    """Levels until one of ``n`` nodes is left."""
    powers = [ARITY ** k for k in range(64) if ARITY ** k < 1 << 63]
    return reduce(lambda a, b: a + b, [(n > F.lit(p)).cast("int") for p in powers])


def block_levels(n: int) -> int:
    """Tables of nodes that a tree over ``n`` leaves has."""
    return 1 if n <= BLOCK else 1 + block_levels(-(-n // BLOCK))


def _parents(level: Column) -> Column:
    """Digests of the runs of neighbours."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / F.lit(ARITY)).cast("int"))
    return F.transform(runs, lambda i: sha(F.array_join(F.transform(F.slice(level, i * ARITY + 1, ARITY), hexed), "")))


def _segments(nodes: DataFrame, carry: list[str] | tuple = ()) -> DataFrame:
    """Fold each block of neighbours.

    ``nodes`` has tree, place, digest, n (nodes of this level of the tree) and
    the columns to ``carry``. Adds up (the block's digest), is_top (the block
    is the tree's last), steps and siblings: the segment. A step is one
    digit, place in the run times ARITY plus the run's other members, and
    siblings holds the digests of those, level by level, left to right."""
    block = F.floor(F.col("place") / F.lit(BLOCK)).cast("long")
    member = F.struct("place", "digest", *carry)
    b = nodes.groupBy("tree", block.alias("block"), "n").agg(F.array_sort(F.collect_list(member)).alias("members"))
    b = b.select("*", F.least(F.lit(HEIGHT), levels_above(F.col("n"))).alias("folds"),
                 F.transform("members", lambda m: m["digest"]).alias("level0"))
    for k in range(HEIGHT):
        below = F.col(f"level{k}")
        b = b.withColumn(f"level{k + 1}", F.when(F.col("folds") > k, _parents(below)).otherwise(below))
    b = b.select("tree", "n", "folds", F.col(f"level{HEIGHT}")[0].alias("up"), *[f"level{k}" for k in range(HEIGHT)],
                 F.posexplode("members").alias("at", "m"))
    steps, siblings = [], []
    for k in range(HEIGHT):
        own = F.floor(F.col("at") / F.lit(ARITY ** k)).cast("int")
        inside, first = own % ARITY, own - own % ARITY
        others = F.least(F.lit(ARITY), F.size(f"level{k}") - first) - 1
        exists = F.col("folds") > k
        steps.append(F.when(exists, (inside * ARITY + others).cast("string")).otherwise(""))
        siblings += [F.when(exists & (others >= j) & (inside != j), F.get(f"level{k}", first + j)).otherwise(F.lit(bytearray()))
                     for j in range(ARITY)]
    return b.select("tree", F.col("m.place").alias("place"), F.col("m.digest").alias("digest"), "n",
                    *[F.col(f"m.{c}").alias(c) for c in carry], F.concat(*steps).alias("steps"),
                    F.concat(*siblings).alias("siblings"), "up", (F.col("n") <= BLOCK).alias("is_top"))


def _next_level(seg: DataFrame) -> DataFrame:
    """The blocks of ``seg`` as nodes of the level above."""
    return (seg.filter(~F.col("is_top") & (F.col("place") % BLOCK == 0))
            .select("tree", F.floor(F.col("place") / F.lit(BLOCK)).cast("long").alias("place"), F.col("up").alias("digest"),
                    F.ceil(F.col("n") / F.lit(BLOCK)).cast("long").alias("n")))


def _pointing(seg: DataFrame, level: int) -> DataFrame:
    """Node rows of one level with the pointer to the block's digest: a node
    of the level above, a leaf of the top tree, or none for the root."""
    subroot = F.col("is_top") & (F.col("tree") != TOP)
    root = F.col("is_top") & (F.col("tree") == TOP)
    return seg.withColumns({
        "level": F.lit(level),
        "to_tree": F.when(~root, F.when(subroot, F.lit(TOP).cast("long")).otherwise(F.col("tree"))),
        "to_level": F.when(~root, F.when(subroot, 0).otherwise(level + 1)),
        "to_place": F.when(~root, F.when(subroot, F.col("tree")).otherwise(F.floor(F.col("place") / F.lit(BLOCK)).cast("long"))),
        # a leaf of the top tree is a subroot
        "subroot": F.when((F.col("tree") == TOP) & F.lit(level == 0), F.col("digest")),
    }).select(*_KEY, "to_tree", "to_level", "to_place", "steps", "siblings", "subroot")


def _trees(leaves: DataFrame, tables: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Segments of every level of the trees over ``leaves`` above the lowest,
    and the trees' last digests."""
    levels, nodes = [], leaves
    for k in range(tables):
        levels.append(written(_segments(nodes), f"merkle-{name}-{k}"))
        nodes = _next_level(levels[-1])
    tops = reduce(DataFrame.unionByName, [s.filter("is_top and place = 0").select("tree", "up") for s in levels])
    return levels, tops


def _jumped(nodes: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Nodes that point at an ancestor, after the jump to where it points."""
    a = ancestors.select(*[F.col(c).alias(f"to_{c}") for c in _KEY],
                         *[F.col(c).alias(f"a_{c}") for c in ("to_tree", "to_level", "to_place", "steps", "siblings", "subroot")])
    on = ["to_tree", "to_level", "to_place"]
    salted = nodes.withColumn("salt", F.floor(F.col("place") / F.lit(SALT)).cast("long"))
    from_level = [*on, "level", "salt"]
    a = salted.select(*from_level).distinct().join(a, on)
    return salted.join(a, from_level).select(
        *_KEY, *[F.col(f"a_{c}").alias(c) for c in on], F.concat("steps", "a_steps").alias("steps"),
        F.concat("siblings", "a_siblings").alias("siblings"), F.coalesce("subroot", "a_subroot").alias("subroot"))


def fold(digest: Column, steps: Column, siblings: Column) -> Column:
    """Root, in hex, that a proof gives for a leaf."""
    def step(state, i):
        code = F.substring(steps, i, F.lit(1)).cast("int")
        inside, others, at = F.floor(code / ARITY).cast("int"), code % ARITY, state["at"]
        left = F.substring(siblings, at + 1, 32 * inside)
        right = F.substring(siblings, at + 1 + 32 * inside, 32 * (others - inside))
        return F.struct(F.sha2(F.concat(hexed(left), state["digest"], hexed(right)).cast("binary"), 256).alias("digest"),
                        (at + 32 * others).alias("at"))
    start = F.struct(hexed(digest).alias("digest"), F.lit(0).alias("at"))
    walked = F.aggregate(F.sequence(F.lit(1), F.length(steps)), start, step)
    return F.when(F.length(steps) == 0, hexed(digest)).otherwise(walked["digest"])


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
                    presented: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: ``id_col``, leaf, subroot, root (hex), steps and
    siblings (the proof) and folded_root, the root that the proof gives.

    With ``presented``, values that a row is presented with instead of its
    own, folded_root starts from the leaf of those values: it equals root only
    if they are the row's own. A null value of a field is ``-``. Null groups come first, as do null ids
    in a group; rows with one id follow by leaf, and rows that repeat are
    leaves of their own. A group of one row has its leaf as subroot. Long
    texts are hashed once and not moved. Columns that are no field are
    ignored, whatever their names. An empty table gives an empty result.
    """
    own = {c: docs[c] for c in fields}
    given = [(presented or {}).get(c, own[c]) for c in fields]
    leaves = written(docs.select(docs[id_col].alias("id"), docs[group_col].alias("grp"),
                                 leaf_hash(list(own.values())).alias("digest"), leaf_hash(given).alias("presented")),
                     "merkle-leaves")
    ranked = global_row_number(leaves, [F.asc_nulls_first("grp"), F.asc_nulls_first("id"), F.col("digest")], "at")
    groups = written(ranked.groupBy("grp").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "merkle-groups")
    groups = written(global_row_number(groups, [F.asc_nulls_first("grp")], "tree")
                     .withColumn("tree", F.col("tree").cast("long") - 1), "merkle-trees")
    n_groups, most = (x or 1 for x in groups.agg(F.count(F.lit(1)), F.max("n")).first())

    numbered = ranked.join(groups, ranked["grp"].eqNullSafe(groups["grp"])).select(
        "tree", (F.col("at") - F.col("first")).cast("long").alias("place"), "digest", "n", "id", "presented")
    lowest = written(_segments(numbered, ["id", "presented"]), "merkle-lowest")
    levels, tops = _trees(_next_level(lowest), block_levels(most) - 1, "groups") if most > BLOCK else ([], None)
    subroots = lowest.filter("is_top and place = 0").select("tree", "up")
    subroots = subroots if tops is None else subroots.unionByName(tops)
    top_leaves = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"),
                                 F.col("up").alias("digest"), F.lit(n_groups).cast("long").alias("n"))
    top_levels, root = _trees(top_leaves, block_levels(n_groups), "top")

    nodes = reduce(DataFrame.unionByName, [*[_pointing(s, k + 1) for k, s in enumerate(levels)],
                                           *[_pointing(s, k) for k, s in enumerate(top_levels)]])
    for k in range((len(levels) + len(top_levels) - 1).bit_length()):
        there = nodes.filter("to_tree is null")
        nodes = written(there.unionByName(_jumped(nodes.filter("to_tree is not null"), nodes)), f"merkle-jump-{k}")

    ancestors = nodes.select(*[F.col(c).alias(f"to_{c}") for c in _KEY], F.col("steps").alias("a_steps"),
                             F.col("siblings").alias("a_siblings"), "subroot")
    leaf = lowest.withColumns({"to_tree": F.when(F.col("is_top"), F.lit(TOP).cast("long")).otherwise(F.col("tree")),
                               "to_level": F.when(F.col("is_top"), 0).otherwise(1),
                               "to_place": F.when(F.col("is_top"), F.col("tree")).otherwise(
                                   F.floor(F.col("place") / F.lit(BLOCK)).cast("long"))})
    proofs = (leaf.join(ancestors, ["to_tree", "to_level", "to_place"])
              .select("id", "digest", "presented", "subroot", F.concat("steps", "a_steps").alias("steps"),
                      F.concat("siblings", "a_siblings").alias("siblings")))
    return proofs.crossJoin(F.broadcast(root.select(F.col("up").alias("root")))).select(  # one row
        F.col("id").alias(id_col), hexed(F.col("digest")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"), "steps", "siblings",
        fold(F.col("presented"), F.col("steps"), F.col("siblings")).alias("folded_root"))
