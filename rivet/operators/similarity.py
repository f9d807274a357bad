"""Nearest modes by cosine, without all pairs of a hot action.

A mode is the sparse vector of its action counts. An action held by more
than ``hot`` modes is hot; pairs are formed in full only under the others, at
most ``hot`` partners an entry. For the hot actions three facts leave few
pairs to look at, and none that belongs to a top k is lost:

* *Heads.* Counts are positive, so a pair that shares one hot action and
  nothing else has exactly the product of the two weights there. The first
  k + 1 modes of that action by (weight, name) are at least as similar to any
  mode, each of them, as a mode behind them.
* *Profiles.* Of modes with equal counts on all hot actions and equal norms,
  only the first k + 1 by name can be among a mode's top k through hot
  actions.
* *Bounds.* Those candidates give every mode a k-th similarity t to beat. With
  a mode's hot actions in ascending order of their weight, reversed, and s the
  norm of its entries behind one of them, a partner first met there with
  weight y has a dot product of at most x y + s sqrt(1 - y^2). Weights are cut
  into classes, and a mode meets only classes whose bound reaches t.

Hot (action, class) keys are salted by their number of partners. What the
bounds can't rule out is compared, so the cost follows the closeness of the
vectors on hot actions, not the square of an action's modes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivet.session import materialize

HOT_MODES = 256  # modes of an action up to which all its pairs are formed
CLASSES = 64  # of a weight between 0 and 1
SALT_ROWS = 4096  # partners under one (action, class, salt)
HEAD_SALTS = 32
SLACK = 1e-9  # for sums of doubles: bounds are let through by this much


def norms(long: DataFrame) -> DataFrame:
    return long.groupBy("failure_mode").agg(F.sqrt(F.sum(F.col("cnt") * F.col("cnt"))).alias("norm"))


def pair_dots(entries: DataFrame) -> DataFrame:
    """(m1, m2, dot) of all ordered pairs that share an action of ``entries``."""
    a = entries.select(F.col("failure_mode").alias("m1"), "action", F.col("cnt").alias("c1"))
    b = entries.select(F.col("failure_mode").alias("m2"), "action", F.col("cnt").alias("c2"))
    return (a.join(b, "action").filter(F.col("m1") != F.col("m2"))
             .groupBy("m1", "m2").agg(F.sum(F.col("c1") * F.col("c2")).alias("dot")))


def cosines(dots: DataFrame, long: DataFrame) -> DataFrame:
    n = norms(long)
    n1 = n.select(F.col("failure_mode").alias("m1"), F.col("norm").alias("n1"))
    n2 = n.select(F.col("failure_mode").alias("m2"), F.col("norm").alias("n2"))
    return (dots.join(n1, "m1").join(n2, "m2")
                .select(F.col("m1").alias("failure_mode"), F.col("m2").alias("similar_mode"),
                        (F.col("dot") / (F.col("n1") * F.col("n2"))).alias("similarity")))


def _hot_dots(pairs: DataFrame, common: DataFrame) -> DataFrame:
    """(m1, m2, dot) over the hot actions for (m1, m2, head). A head meets
    very many modes, so its entries are copied under every salt."""
    a = common.select(F.col("failure_mode").alias("m1"), "action", F.col("cnt").alias("c1"))
    heads = pairs.filter("head").select(F.col("m2").alias("failure_mode")).distinct()
    b = common.join(heads.withColumn("head", F.lit(True)), "failure_mode", "left").select(
        F.col("failure_mode").alias("m2"), "action", F.col("cnt").alias("c2"),
        F.explode(F.sequence(F.lit(0), F.when(F.col("head"), HEAD_SALTS).otherwise(0))).alias("salt"))
    salt = F.when(F.col("head"), F.pmod(F.xxhash64("m1"), F.lit(HEAD_SALTS)).cast("int") + 1).otherwise(0)
    met = pairs.withColumn("salt", salt).join(a, "m1").join(b, ["m2", "action", "salt"])
    return met.groupBy("m1", "m2").agg(F.sum(F.col("c1") * F.col("c2")).alias("dot"))


def _bound(x: Column, behind: Column, low: Column, high: Column) -> Column:
    """Largest x y + behind sqrt(1 - y^2) over low <= y <= high; it rises up
    to y = x / sqrt(x^2 + behind^2) and falls from there."""
    y = F.least(high, F.greatest(low, x / F.sqrt(x * x + behind * behind)))
    return x * y + behind * F.sqrt(F.greatest(F.lit(0.0), 1.0 - y * y))


def _within_bounds(common: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """(m1, m2) that share two hot actions or more, and whose bound reaches
    the k-th similarity that m1 has in ``known``."""
    w = Window.partitionBy("m1").orderBy(F.col("similarity").desc(), "m2")
    kth = known.withColumn("place", F.row_number().over(w)).filter(F.col("place") == k).select("m1", "similarity")
    # two hot actions or more; the profile is independent of the order of its entries
    entry = F.md5(F.concat_ws("\0", "action", F.col("cnt").cast("string")).cast("binary"))
    part = [F.sum(F.conv(F.substring(entry, at, 8), 16, 10).cast("long")).alias(f"p{at}") for at in (1, 9, 17, 25)]
    modes = common.groupBy("failure_mode", "norm").agg(F.count("*").alias("held"), *part).filter("held > 1")
    profile = Window.partitionBy("norm", "held", "p1", "p9", "p17", "p25").orderBy("failure_mode")
    first = modes.withColumn("at", F.row_number().over(profile)).filter(F.col("at") <= k + 1)
    cls = F.least(F.floor(F.col("weight") * CLASSES), F.lit(CLASSES - 1)).cast("int")
    partners = materialize(common.join(first.select("failure_mode"), "failure_mode", "left_semi").select(
        F.col("failure_mode").alias("m2"), "action", F.col("weight").alias("y"), cls.alias("class")), "similar-partners")
    held = partners.groupBy("action", "class").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts"))

    behind = (Window.partitionBy("failure_mode").orderBy(F.col("weight").desc(), "action")
              .rowsBetween(1, Window.unboundedFollowing))
    probes = (common.join(modes.select("failure_mode"), "failure_mode", "left_semi")
              .withColumn("s", F.sqrt(F.coalesce(F.sum(F.col("weight") * F.col("weight")).over(behind), F.lit(0.0))))
              .withColumnRenamed("failure_mode", "m1").join(kth, "m1")
              .filter(F.sqrt(F.col("weight") * F.col("weight") + F.col("s") * F.col("s")) + SLACK >= F.col("similarity"))
              .select("m1", "action", F.col("weight").alias("x"), "s", "similarity"))
    low, high = F.col("class") / CLASSES, (F.col("class") + 1) / CLASSES
    probes = (probes.withColumn("class", F.explode(F.sequence(F.lit(0), F.lit(CLASSES - 1))))
              .filter(_bound(F.col("x"), F.col("s"), low, high) + SLACK >= F.col("similarity"))
              .join(held, ["action", "class"])
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))))
    salted = (partners.join(held, ["action", "class"])
              .withColumn("salt", F.pmod(F.xxhash64("m2"), F.col("salts")).cast("int")).drop("salts"))
    met = probes.join(salted, ["action", "class", "salt"])
    reach = F.col("x") * F.col("y") + F.col("s") * F.sqrt(F.greatest(F.lit(0.0), 1.0 - F.col("y") * F.col("y")))
    return (met.filter((F.col("m1") != F.col("m2")) & (reach + SLACK >= F.col("similarity")))
            .select("m1", "m2").distinct().join(known.select("m1", "m2"), ["m1", "m2"], "left_anti"))


def nearest_candidates(long: DataFrame, k: int, hot: int = HOT_MODES) -> DataFrame:
    """(failure_mode, similar_mode, similarity): pairs among which are the
    ``k`` most similar others of every mode, ties by name, similarity above 0.

    ``long``: distinct (failure_mode, action, cnt), counts above 0. A null
    mode or action meets nothing; the counts of a null action are part of its
    mode's norm. Without hot actions these are all pairs that share an
    action. Modes whose similarity differs by rounding of doubles alone may
    swap places.
    """
    hot = max(hot, k + 1)
    held = long.filter(F.col("action").isNotNull() & F.col("failure_mode").isNotNull())
    actions = materialize(held.groupBy("action").agg(F.count("*").alias("held")).filter(F.col("held") > hot)
                          .select("action"), "hot-actions")
    if actions.isEmpty():
        return cosines(pair_dots(long), long)
    rare = pair_dots(held.join(actions, "action", "left_anti"))
    common = materialize(held.join(actions, "action").join(norms(long), "failure_mode").select(
        "failure_mode", "action", "cnt", "norm", (F.col("cnt") / F.col("norm")).alias("weight")), "hot-entries")
    by_weight = Window.partitionBy("action").orderBy(F.col("weight").desc(), "failure_mode")
    heads = (common.withColumn("place", F.row_number().over(by_weight)).filter(F.col("place") <= k + 1)
             .groupBy("action").agg(F.collect_list("failure_mode").alias("heads")))  # k + 1 names a row
    met = (common.join(heads, "action").select(F.col("failure_mode").alias("m1"), F.explode("heads").alias("m2"))
           .filter(F.col("m1") != F.col("m2")))
    pairs = materialize(rare.withColumn("head", F.lit(False))
                        .unionByName(met.select("m1", "m2", F.lit(0).cast("long").alias("dot"), F.lit(True).alias("head")))
                        .groupBy("m1", "m2").agg(F.sum("dot").alias("dot"), F.max("head").alias("head")), "similar-pairs")

    def scored(pairs: DataFrame) -> DataFrame:
        dots = (pairs.select("m1", "m2", "dot").unionByName(_hot_dots(pairs, common))
                .groupBy("m1", "m2").agg(F.sum("dot").alias("dot")))
        return cosines(dots, long)
    known = materialize(scored(pairs), "similar-known")
    named = known.withColumnsRenamed({"failure_mode": "m1", "similar_mode": "m2"})
    more = materialize(_within_bounds(common, named, k).select(
        "m1", "m2", F.lit(0).cast("long").alias("dot"), F.lit(False).alias("head")), "similar-more")
    return known.unionByName(scored(more))
