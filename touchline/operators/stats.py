"""Accuracy and correlation aggregates (AGG-10..AGG-15; exact quantiles live in operators/scan).

All are built-in aggregate expressions, so they run as partial (map-side) plus
final aggregation; nothing per-row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_pearson(x, y) -> Column:
    """AGG-12: Pearson r, 0 when n < 2 or either side is constant (plain corr raises, D4)."""
    x, y = _c(x), _c(y)
    den = F.sqrt(F.var_pop(x) * F.var_pop(y))
    return F.coalesce(F.try_divide(F.covar_pop(x, y), F.when(den != 0, den)), F.lit(0.0))


def error_metrics(projected, actual, floor, ceiling) -> list[Column]:
    """AGG-10: n, MAE, RMSE, bias and in-band share; NULL-safe zeros for empty input."""
    e = _c(projected) - _c(actual)
    in_band = ((_c(floor) <= _c(actual)) & (_c(actual) <= _c(ceiling))).cast("double")
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.avg(F.abs(e)), F.lit(0.0)).alias("mae"),
        F.coalesce(F.sqrt(F.avg(e * e)), F.lit(0.0)).alias("rmse"),
        F.coalesce(F.avg(e), F.lit(0.0)).alias("bias"),
        F.coalesce(F.avg(in_band), F.lit(0.0)).alias("band_pct"),
    ]


def coverage(resid, cov, z: float) -> Column:
    """AGG-15: share of residuals inside z * cov."""
    return F.avg((_c(resid) <= F.lit(z) * _c(cov)).cast("double"))

