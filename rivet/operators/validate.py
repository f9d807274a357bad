"""Data-contract validation.

All row rules are evaluated in one narrow pass: every row yields an array
of violation structs (null when the rule holds), which is filtered and
exploded, so a report row exists per failing cell and no shuffle is
needed. Null cells fail only their not-null rule (range and set rules are
evaluated on present values). Rows are never dropped from the data; the
report travels next to it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivet import constants as K
from rivet.functions.exprs import nan_to_null


@dataclass
class ColumnRule:
    name: str
    dtype: T.DataType
    nullable: bool = False
    isin: list | None = None
    in_range: tuple | None = None


@dataclass
class Contract:
    columns: list[ColumnRule] = field(default_factory=list)
    key: list[str] = field(default_factory=list)


def _num(v) -> str:
    return str(v)


def check_name(rule: ColumnRule, kind: str) -> str:
    if kind == "not_nullable":
        return K.CHECK_NOT_NULL
    if kind == "isin":
        return K.CHECK_ISIN.format(values=", ".join(repr(v) for v in rule.isin))
    if kind == "in_range":
        lo, hi = rule.in_range
        return K.CHECK_IN_RANGE.format(lo=_num(lo), hi=_num(hi))
    raise ValueError(kind)


def sensor_contract() -> Contract:
    """The sensor-reading contract: 12 not-null columns, one set rule and
    inclusive ranges for the 9 numeric channels."""
    cols = [ColumnRule("asset_id", T.StringType()),
            ColumnRule("timestamp", T.TimestampType()),
            ColumnRule("operating_mode", T.StringType(), isin=list(K.OPERATING_MODES))]
    for name, rng in K.SENSOR_RANGES.items():
        cols.append(ColumnRule(name, T.DoubleType(), in_range=rng))
    return Contract(cols, key=["asset_id", "timestamp"])


def _violations(rule: ColumnRule, dtype: T.DataType) -> list[Column]:
    c = F.col(rule.name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        c = nan_to_null(c)  # NaN is a missing value, not one out of range
    txt = c.cast("string")
    out = []

    def v(cond, kind, case):
        return F.when(cond, F.struct(F.lit(rule.name).alias("column"),
                                     F.lit(check_name(rule, kind)).alias("check"),
                                     case.alias("failure_case")))
    if not rule.nullable:
        out.append(v(c.isNull(), "not_nullable", F.lit(None).cast("string")))
    if rule.isin is not None:
        out.append(v(c.isNotNull() & ~c.isin(*rule.isin), "isin", txt))
    if rule.in_range is not None:
        lo, hi = rule.in_range
        out.append(v(c.isNotNull() & ((c < F.lit(lo)) | (c > F.lit(hi))), "in_range", txt))
    return out


def violations(df: DataFrame, contract: Contract, id_cols: list[str]) -> DataFrame:
    """One row per failing cell: id columns, column, check, failure_case."""
    types = {f.name: f.dataType for f in df.schema.fields}
    checks = [x for r in contract.columns if r.name in types for x in _violations(r, types[r.name])]
    arr = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return (df.select(*id_cols, F.explode(arr).alias("v"))
              .select(*id_cols, "v.column", "v.check", "v.failure_case"))


def dtype_violations(df: DataFrame, contract: Contract) -> list[dict]:
    """Schema-level checks (column missing / wrong type); metadata only."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    out = []
    for r in contract.columns:
        if r.name not in types:
            out.append({"column": r.name, "check": "column_in_dataframe", "failure_case": r.name})
        elif types[r.name] != r.dtype and not (
                isinstance(r.dtype, T.TimestampType) and isinstance(types[r.name], T.TimestampNTZType)):
            out.append({"column": r.name, "check": f"dtype('{r.dtype.simpleString()}')",
                        "failure_case": types[r.name].simpleString()})
    return out


def violation_summary(viol: DataFrame) -> DataFrame:
    """Failures per (column, check)."""
    return viol.groupBy("column", "check").agg(F.count("*").alias("failures"))


def missing_profile(df: DataFrame, limit_pct: float = K.MISSING_PCT_LIMIT) -> DataFrame:
    """Percent null (NaN counts as null) per column, rounded half-even to 2
    digits, with ``reported`` = pct > limit (D5). One aggregate pass."""
    def isnull(f):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return c.isNull() | F.isnan(c)
        return c.isNull()
    one = df.agg(*[(F.avg(isnull(f).cast("double")) * 100.0).alias(f.name) for f in df.schema.fields])
    names = [f.name for f in df.schema.fields]
    prof = one.unpivot([], names, "column", "missing_pct")
    prof = prof.withColumn("missing_pct", F.bround("missing_pct", 2))
    return prof.withColumn("reported", F.col("missing_pct") > F.lit(limit_pct))


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key = sum(cnt - 1)."""
    return (df.groupBy(*keys).count()
              .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicate_rows")))


def validation_report(df: DataFrame, contract: Contract, id_cols: list[str]) -> DataFrame:
    """One row: status, cell violations, duplicate rows, columns over the
    missing limit, schema violations (K7). The data itself is passed on
    unchanged by the caller."""
    schema_bad = len(dtype_violations(df, contract))
    v = violations(df, contract, id_cols).agg(F.count("*").alias("cell_violations"))
    d = duplicate_count(df, [k for k in contract.key if k in df.columns])
    m = missing_profile(df).agg(F.sum(F.col("reported").cast("long")).alias("columns_over_missing_limit"))
    out = v.crossJoin(d).crossJoin(m)
    bad = (F.col("cell_violations") > 0) | F.lit(schema_bad > 0)
    return out.select(F.when(bad, F.lit("failed")).otherwise(F.lit("passed")).alias("status"),
                      "cell_violations", "duplicate_rows", "columns_over_missing_limit",
                      F.lit(schema_bad).cast("long").alias("schema_violations"))


def quarantine(df: DataFrame, contract: Contract, id_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rows with at least one violation), split by a semi / anti
    join on the row ids of the violation report. The original passes all
    rows on; the split is an addition for callers that want it."""
    bad = violations(df, contract, id_cols).select(*id_cols).distinct()
    return df.join(bad, id_cols, "left_anti"), df.join(bad, id_cols, "left_semi")
