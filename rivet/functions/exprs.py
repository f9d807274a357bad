"""Scalar expression builders (all JVM-side, codegen-friendly).

Each function returns a ``Column``; none of them touches data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivet import constants as K

US_PER_HOUR = 3_600_000_000
US_PER_DAY = 86_400_000_000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(c) -> Column:
    """Microseconds since epoch for TIMESTAMP or TIMESTAMP_NTZ (session UTC)."""
    return F.unix_micros(col(c).cast("timestamp"))


def r6(c, digits: int = 6, nudge: float = 1e-12) -> Column:
    """Oracle hygiene: round to ``digits``, folding -0.0 into 0.0.

    Engines sum in different orders, so a value whose exact decimal sits on
    a rounding tie (a mean over 32 or 64 rows) can land one ulp either side.
    A relative nudge far below the rounding quantum (and far above the
    summation error) sends both sides the same way.
    """
    return F.round(col(c) * F.lit(1.0 + nudge), digits) + F.lit(0.0)


def r2big(c) -> Column:
    """Rounding for large sums of squares (spectral energy), 2 digits."""
    return r6(c, 2, 1e-9)


def nan_to_null(c) -> Column:
    c = col(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def safe_div(num, den, default=0.0) -> Column:
    """num/den, ``default`` when den is 0 or null (ANSI-safe)."""
    return F.coalesce(F.try_divide(col(num), col(den)), F.lit(default))


def zscore(x, mean, std) -> Column:
    """(x-mean)/std, 0.0 when std is not positive."""
    return F.when(col(std) > 0, (col(x) - col(mean)) / col(std)).otherwise(F.lit(0.0))


def clip(c, lower=None, upper=None) -> Column:
    c = col(c)
    if lower is not None:
        c = F.greatest(c, F.lit(lower))
    if upper is not None:
        c = F.least(c, F.lit(upper))
    return c


def risk_category(score) -> Column:
    """Half-open bins (lo, hi]; a score of exactly 0 (or outside) is null."""
    s = col(score)
    out = None
    for lo, hi, name in K.RISK_BINS:
        cond = (s > lo) & (s <= hi)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def advice(score) -> Column:
    """Strict-threshold advice ladder."""
    s = col(score)
    out = None
    for thr, name in K.ADVICE_LADDER:
        out = F.when(s > thr, F.lit(name)) if out is None else out.when(s > thr, F.lit(name))
    return out.otherwise(F.lit(K.ADVICE_DEFAULT))


def risk_marker(category) -> Column:
    """Marker lookup with default."""
    m = F.create_map(*[x for k, v in K.RISK_MARKERS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[col(category)], F.lit(K.RISK_MARKER_DEFAULT))


def normalise_key(c) -> Column:
    """lower-case and spaces to underscores."""
    return F.regexp_replace(F.lower(col(c)), " ", "_")


def derate(risk, rul) -> tuple[Column, Column]:
    """Derate factor and status from (risk, rul) with in-row defaults."""
    r = F.coalesce(col(risk), F.lit(K.DEFAULT_RISK))
    u = F.coalesce(col(rul), F.lit(K.DEFAULT_RUL_HOURS))
    factor = None
    status = None
    for thr_risk, thr_rul, f, st in K.DERATE_LADDER:
        cond = (r > thr_risk) | (u < thr_rul)
        factor = F.when(cond, F.lit(f)) if factor is None else factor.when(cond, F.lit(f))
        status = F.when(cond, F.lit(st)) if status is None else status.when(cond, F.lit(st))
    return factor.otherwise(F.lit(K.DERATE_HEALTHY[0])), status.otherwise(F.lit(K.DERATE_HEALTHY[1]))
