"""Global order without a single-task window (E7, E8, D10, D13 helpers).

``Window.orderBy(...)`` with no partition moves every row into one task.
Here a global order is Spark's own range-partitioned sort, written once:

* ``ordered`` sorts by the full order and writes the rows with the task they
  fell into and their place in it. Keys keep their own types (strings,
  64-bit integers, decimals), nulls go where the order says, and a tie group
  of the first key is cut by the next ones. The number of tasks follows the
  data (adaptive coalescing). As the written table is what later steps read,
  a lost executor cannot move a row.
* ``global_row_number`` adds the number of rows in earlier tasks.
* ``prefix_sums`` adds the sums of earlier tasks to a running sum inside the
  task; one row per task (and group) crosses tasks.
* ``ordered_split`` finds the row at the cut by selection, a few scans of the
  key columns; the split itself is then a plain filter on the input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivet.session import materialize

_PLACE_BITS = 33  # of monotonically_increasing_id


def ordered(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` written in ``order``, with ``_task`` and ``_at`` (0-based inside the task)."""
    rows = materialize(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "order")
    return (rows.withColumn("_task", F.shiftright("_place", _PLACE_BITS))
            .withColumn("_at", F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).drop("_place"))


def _match(a: DataFrame, b: DataFrame, cols: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in cols])


def global_row_number(df: DataFrame, order: list[Column], out: str = "row_number") -> DataFrame:
    """1-based position under ``order``."""
    rows = ordered(df, order)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_task").agg(F.count("*").alias("_n"))  # one row per task
    offsets = counts.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(offsets), "_task")
            .select(*df.columns, (F.col("_before") + F.col("_at") + 1).alias(out)))


def prefix_sums(df: DataFrame, key: str, cols: list[str], part: list[str] | tuple = (),
                descending: bool = False) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over rows of the same ``part`` whose
    key is <= this key (>= when ``descending``); nulls last. ``key`` must be
    unique within ``part``. A group holding most rows spans many tasks."""
    part = list(part)
    last = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
    rows = ordered(df, [*[F.col(p) for p in part], last])
    before = Window.partitionBy(*part).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*part, "_task").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    offsets = totals.select(*part, "_task", *[
        F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in cols])
    # without groups the offsets are one row per task; with groups their size is Spark's to judge
    j = rows.join(offsets if part else F.broadcast(offsets), _match(rows, offsets, [*part, "_task"]))
    inside = (Window.partitionBy(*[rows[c] for c in [*part, "_task"]]).orderBy(rows["_at"])
              .rowsBetween(Window.unboundedPreceding, 0))
    return j.select(*[rows[c] for c in df.columns],
                    *[(F.col(f"_o_{c}") + F.sum(rows[c]).over(inside)).alias(f"cum_{c}") for c in cols])


def _equal_and_before(c: str, value, dtype: str) -> tuple[Column, Column]:
    """(column equals the cut's value, column sorts before it); nulls last."""
    if value is None:
        return F.col(c).isNull(), F.col(c).isNotNull()
    if dtype == "date" or dtype.startswith("timestamp"):
        lit = F.timestamp_micros(F.lit(value))  # epoch microseconds: no time zone in the literal
        lit = lit if dtype == "timestamp" else lit.cast(dtype)
    else:
        lit = F.lit(value).cast(dtype)
    return F.col(c).eqNullSafe(lit), F.coalesce(F.col(c) < lit, F.lit(False))


SAMPLE = 20_000  # keys that one round of the selection looks at
FEW = 50_000  # rows that are sorted to end the selection


def row_at(df: DataFrame, order: list[str], k: int, n: int, few: int = FEW, sample: int = SAMPLE) -> Row | None:
    """Key at position ``k`` (0-based) of ``n`` rows under ascending
    ``order``, nulls last, dates and timestamps as epoch microseconds.

    Selection without a sort of the table: a round takes a hashed sample of
    the keys inside the bracket, picks the two sample keys that enclose the
    position with some room, counts the rows before each, and narrows the
    bracket; once it holds ``few`` rows, those are sorted."""
    types = dict(df.dtypes)

    def exact(c: str) -> Column:
        moment = types[c] == "date" or types[c].startswith("timestamp")
        return F.unix_micros(F.col(c).cast("timestamp")) if moment else F.col(c)
    # structs compare field by field; the null flags put nulls last
    keys = df.select(F.struct(*[x for i, c in enumerate(order) for x in (
        F.col(c).isNull().alias(f"null_{i}"), exact(c).alias(c))]).alias("key"))
    kind = keys.schema["key"].dataType
    bounds = T.StructType([T.StructField("low", kind), T.StructField("high", kind)])
    low = high = None
    below, size, tries, room = 0, n, 0, 4.0

    def inside(low, high) -> DataFrame:
        if low is None and high is None:
            return keys
        edge = df.sparkSession.createDataFrame([(low, high)], bounds)
        held = keys.crossJoin(F.broadcast(edge))  # one row
        if low is not None:
            held = held.filter("key >= low")
        return (held if high is None else held.filter("key <= high")).select("key")
    while size > few and (low is None or low != high):
        tries += 1
        share = min(1.0, sample / size)
        drawn = F.pmod(F.xxhash64("key", F.lit(tries)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
        seen = [r[0] for r in inside(low, high).filter(drawn).orderBy("key").collect()]  # about ``sample`` keys
        if share == 1.0:  # the whole bracket
            return seen[k - below]
        if not seen:
            continue
        q = (k - below) / size
        at, spread = q * len(seen), room * (len(seen) * q * (1 - q)) ** 0.5 + 2
        a = seen[int(at - spread)] if at - spread >= 0 else low
        b = seen[int(at + spread)] if at + spread < len(seen) else high
        edge = df.sparkSession.createDataFrame([(a, b)], bounds)
        before, upto = inside(low, high).crossJoin(F.broadcast(edge)).agg(
            F.count_if(F.col("key") < F.col("low")), F.count_if(F.col("key") <= F.col("high"))).first()
        before, upto = before if a is not None else 0, upto if b is not None else size
        if before <= k - below < upto:
            low, high, below, size, room = a, b, below + before, upto - before, 4.0
        else:  # the sample misled: look again, with more room
            room *= 2
    row = inside(low, high).orderBy("key").offset(k - below).limit(1).first()
    return None if row is None else row["key"]


def before_cut(df: DataFrame, order: list[str], k: int, n: int) -> Column:
    """Predicate of the first ``k`` of ``n`` rows under ascending ``order``,
    nulls last. ``order`` must be a unique composite key; 0 <= k < n."""
    types = dict(df.dtypes)
    row = row_at(df, order, k, n)
    if row is None:
        raise ValueError(f"no row at position {k} under {order}")
    pred = F.lit(False)
    for c in reversed(order):
        equal, before = _equal_and_before(c, row[c], types[c])
        pred = before | (equal & pred)
    return pred


def split_rule(df: DataFrame, order: list[str], share: float) -> tuple[Column, int]:
    """(predicate of the first ``int(n*share)`` rows under ``order``, n)."""
    n = df.count()
    k = int(n * share)
    return (before_cut(df, order, k, n) if k < n else F.lit(True)), n


def ordered_split(df: DataFrame, order: list[str], share: float) -> tuple[DataFrame, DataFrame, int]:
    """First ``int(n*share)`` rows under ``order`` vs the rest (E8); returns
    (reference, current, n). Both sides are filters on the input and every
    row, with or without null keys, is on exactly one of them."""
    pred, n = split_rule(df, order, share)
    return df.filter(pred), df.filter(~pred), n
