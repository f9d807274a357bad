"""Health-constrained production allocation and what-if analysis
(K1-K6, B6, B14, B19, C6, C8, D19, E10).

The linear program  max sum x  s.t.  0.3 safe_i <= x_i <= safe_i,
sum x <= pipeline, sum x <= compressor  has the closed-form optimum
x_i = floor_i + clip(rem - headroom_before_i, 0, headroom_i) with
rem = min(pipeline, compressor) - sum floor and wells filled from the
highest well id down (the plan the original solver produced; the optimum
is not unique). That is a running sum per field and scenario, done with
grouped prefix sums, so no field sits in one task.

Capacities are exact decimals, so half-even rounding to 0.1 bpd is the
same in every engine; rounded values feed totals and tolerance tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivet import constants as K
from rivet.functions.exprs import derate
from rivet.operators.rank import global_row_number, prefix_sums

DEC = "decimal(20,4)"


def health_capacity(wells: DataFrame, risk: DataFrame, rul: DataFrame | None,
                    well: str = "well_id", max_cap: str = "max_capacity_bpd",
                    asset: str = "asset_id", risk_col: str = "failure_risk_score",
                    rul_col: str = "predicted_rul_hours") -> DataFrame:
    """Derated safe capacity per well (K6 = A6 + C6 + C8 + B6).

    RUL is attached only to assets that have a risk row (C6). The i-th
    asset by risk (highest first, ties by asset id) is paired with the i-th
    well by id (C8); wells beyond the number of assets keep full capacity
    with status "No health data - assumed healthy". Inside a health row a
    missing risk counts 0.1 and a missing RUL 1000 h (B6).
    """
    h = risk.select(asset, risk_col)
    if rul is not None:
        h = h.join(rul.select(asset, rul_col), asset, "left")
    else:
        h = h.withColumn(rul_col, F.lit(None).cast("double"))
    h = global_row_number(h, [F.col(risk_col).desc_nulls_last(), F.col(asset)], out="_i")
    w = global_row_number(wells, [F.col(well)], out="_i")
    j = w.join(h.select("_i", asset, risk_col, rul_col), "_i", "left")
    factor, status = derate(risk_col, rul_col)
    has = F.col(asset).isNotNull()
    safe = F.when(has, F.bround(F.col(max_cap).cast(DEC) * factor.cast("decimal(3,1)"), 1)) \
        .otherwise(F.bround(F.col(max_cap).cast(DEC), 1))
    return j.select(*wells.columns,
                    F.col(asset).alias("health_asset_id"),
                    safe.cast(DEC).alias("safe_capacity_bpd"),
                    F.when(has, status).otherwise(F.lit(K.NO_HEALTH_STATUS)).alias("health_status"))


def allocate(wells: DataFrame, limits: DataFrame, part: list[str], well: str = "well_id",
             safe: str = "safe_capacity_bpd", floor_share: float = K.FAIRNESS_FLOOR) -> DataFrame:
    """Optimal allocation per group ``part``.

    ``limits``: part + pipeline_capacity_bpd, compressor_capacity_bpd.
    Adds allocated_production_bpd (rounded half-even to 0.1), utilization_pct
    and status ("optimal", or "infeasible" when the floors exceed the cap, in
    which case nothing is allocated).
    """
    w = (wells.withColumn("_safe", F.col(safe).cast(DEC))
              .withColumn("_floor", F.col("_safe") * F.lit(floor_share).cast("decimal(3,2)"))
              .withColumn("_head", F.col("_safe") - F.col("_floor")))
    tot = w.groupBy(*part).agg(F.sum("_floor").alias("_sfloor"))
    lim = (limits.join(tot, part)
                 .select(*part, F.least(F.col("pipeline_capacity_bpd").cast(DEC),
                                        F.col("compressor_capacity_bpd").cast(DEC)).alias("_cap"),
                         "_sfloor"))
    pre = prefix_sums(w, well, ["_head"], part=part, descending=True)
    j = pre.join(lim, part)
    before = F.col("cum__head") - F.col("_head")
    fill = F.least(F.greatest(F.col("_cap") - F.col("_sfloor") - before, F.lit(0)), F.col("_head"))
    feasible = F.col("_sfloor") <= F.col("_cap")
    x = F.when(feasible, F.bround(F.col("_floor") + fill, 1))
    return j.select(*wells.columns,
                    x.cast("double").alias("allocated_production_bpd"),
                    F.bround(F.try_divide(x.cast("double"), F.col("_safe").cast("double")) * 100.0, 1)
                    .alias("utilization_pct"),
                    F.when(feasible, F.lit("optimal")).otherwise(F.lit("infeasible")).alias("status"))


def totals(plan: DataFrame, part: list[str]) -> DataFrame:
    """Total of the rounded allocations per group."""
    return plan.groupBy(*part).agg(
        F.bround(F.sum(F.col("allocated_production_bpd").cast(DEC)), 1).cast("double")
        .alias("total_production"))


def binding_constraints(plan: DataFrame, limits: DataFrame, part: list[str], well: str = "well_id",
                        safe: str = "safe_capacity_bpd", tol: float = K.BINDING_TOL,
                        label: str | None = None) -> DataFrame:
    """Messages for limits within ``tol`` of the total and wells within
    ``tol`` of their safe capacity on the rounded allocation (K2, B19).
    ``seq`` orders them: pipeline 0, compressor 1, then wells (2) by id.
    ``%.0f`` formatting is half-up in Java, so values are rounded half-even
    first. ``label`` names the column shown in well messages (default: the id)."""
    label = label or well
    t = totals(plan, part).join(limits, part)
    wtype = plan.schema[well].dataType
    msgs = []
    def fmt(template: str, **cols):
        # fixed message template -> format_string with %s slots in order
        names = [n for n in ("limit", "capacity", "well", "status") if "{" + n + "}" in template]
        names.sort(key=lambda n: template.index("{" + n + "}"))
        pattern = template
        for n in names:
            pattern = pattern.replace("{" + n + "}", "%s")
        return F.format_string(pattern, *[cols[n] for n in names])

    for i, (col, name) in enumerate(zip(["pipeline_capacity_bpd", "compressor_capacity_bpd"], K.LIMIT_NAMES)):
        msgs.append(t.filter(F.abs(F.col("total_production") - F.col(col)) < tol).select(
            *part, F.lit(i).alias("seq"), F.lit(None).cast(wtype).alias(well),
            fmt(K.LIMIT_MESSAGE, limit=F.lit(name),
                capacity=F.bround(F.col(col).cast(DEC), 0).cast("long").cast("string")).alias("message")))
    msgs.append(plan.filter(F.abs(F.col("allocated_production_bpd") - F.col(safe).cast("double")) < tol).select(
        *part, F.lit(2).alias("seq"), F.col(well),
        fmt(K.WELL_MESSAGE, well=F.col(label).cast("string"),
            capacity=F.bround(F.col(safe).cast(DEC), 0).cast("long").cast("string"),
            status=F.col("health_status")).alias("message")))
    return msgs[0].unionByName(msgs[1]).unionByName(msgs[2])


def kpis(plan: DataFrame, part: list[str]) -> DataFrame:
    """Total, wells at >= 99 % and <= 31 % utilisation."""
    return plan.groupBy(*part).agg(
        F.bround(F.sum(F.col("allocated_production_bpd").cast(DEC)), 1).cast("double").alias("total_production"),
        F.sum((F.col("utilization_pct") >= 99).cast("long")).alias("wells_at_full_capacity"),
        F.sum((F.col("utilization_pct") <= 31).cast("long")).alias("wells_at_fairness_floor"))


def scenarios_table(spark, rows: list[tuple]) -> DataFrame:
    """(scenario, seq, pipeline_delta, compressor_delta, degrade_factor):
    a literal, bounded table of planning questions."""
    return spark.createDataFrame(rows, "scenario string, seq int, pipeline_delta double, "
                                       "compressor_delta double, degrade_factor double")


def what_if(wells: DataFrame, limits: DataFrame, scenarios: DataFrame, part: list[str],
            degrade_target: DataFrame, well: str = "well_id", max_cap: str = "max_capacity_bpd",
            safe: str = "safe_capacity_bpd") -> DataFrame:
    """Every scenario solved in one pass partitioned by (group, scenario).

    ``scenarios`` is broadcast (a handful of rows) against the wells; a
    scenario with ``degrade_factor`` sets the target well of each group
    (``degrade_target``: part + well) to factor x max capacity with status
    "SIMULATED - Further Degraded".
    """
    tgt = degrade_target.select(*part, F.col(well).alias("_target"))
    ww = (wells.join(tgt, part, "left").crossJoin(F.broadcast(scenarios)))
    hit = F.col("degrade_factor").isNotNull() & (F.col(well) == F.col("_target"))
    ww = ww.select(*[c for c in wells.columns if c not in (safe, "health_status")],
                   "scenario", "seq",
                   F.when(hit, F.col(max_cap).cast(DEC) * F.col("degrade_factor").cast("decimal(4,2)"))
                    .otherwise(F.col(safe).cast(DEC)).cast(DEC).alias(safe),
                   F.when(hit, F.lit(K.SIMULATED_STATUS)).otherwise(F.col("health_status"))
                    .alias("health_status"))
    lim = (limits.crossJoin(F.broadcast(scenarios))
                 .select(*part, "scenario",
                         (F.col("pipeline_capacity_bpd") + F.coalesce("pipeline_delta", F.lit(0.0)))
                         .alias("pipeline_capacity_bpd"),
                         (F.col("compressor_capacity_bpd") + F.coalesce("compressor_delta", F.lit(0.0)))
                         .alias("compressor_capacity_bpd")))
    return allocate(ww, lim, part + ["scenario"], well, safe)


def compare_scenarios(plans: DataFrame, part: list[str], baseline: str = "Baseline") -> DataFrame:
    """Per scenario: baseline and scenario totals, delta and percent change (K5)."""
    t = totals(plans, part + ["scenario"])
    base = t.filter(F.col("scenario") == baseline).select(*part, F.col("total_production").alias("_b"))
    s = t.filter(F.col("scenario") != baseline).join(base, part)
    delta = F.col("total_production").cast(DEC) - F.col("_b").cast(DEC)
    return s.select(*part, "scenario",
                    F.col("_b").alias("baseline_production"),
                    F.col("total_production").alias("scenario_production"),
                    F.bround(delta, 1).cast("double").alias("delta_bpd"),
                    F.bround(F.try_divide(delta.cast("double"), F.col("_b")) * 100.0, 2).alias("pct_change"))
