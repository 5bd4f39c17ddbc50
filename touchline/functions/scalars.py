"""Column-level helpers (SCA-*).  All are plain built-in expressions: no UDFs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.sources import rules


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def canonical_code(col, aliases: Mapping[str, str] | None = None) -> Column:
    """SCA-1 / DOM-19: map legacy codes to their current code, else keep the value."""
    aliases = rules.TEAM_CODE_ALIASES if aliases is None else aliases
    c = _c(col)
    expr = None
    for old, new in aliases.items():
        expr = F.when(c == old, F.lit(new)) if expr is None else expr.when(c == old, F.lit(new))
    return c if expr is None else expr.otherwise(c)


def remap_value(col, src, dst) -> Column:
    """SCA-2: CASE x WHEN src THEN dst ELSE x (e.g. week 23 -> 22)."""
    c = _c(col)
    return F.when(c == src, F.lit(dst)).otherwise(c)


def season_type(col) -> Column:
    """SCA-3: 'REG' stays, everything else (NULL and PRE included) is 'POST'."""
    c = _c(col)
    return F.when(c == "REG", F.lit("REG")).otherwise(F.lit("POST"))


def try_int_from_double(col) -> Column:
    """SCA-4 / D1: double -> int with half-even rounding (matches the reference casts)."""
    return F.bround(_c(col).cast("double"), 0).cast("int")


def try_int_from_text(col: str) -> Column:
    """SCA-4 / D1b: numeric text -> int, half away from zero; '' and junk -> NULL."""
    return F.round(try_double(col), 0).cast("int")


def try_double(col: str) -> Column:
    """Text -> double, NULL on junk (surrounding blanks are ignored)."""
    return F.expr(f"try_cast(trim({_sql(col)}) as double)")


def _sql(col) -> str:
    if isinstance(col, str):
        return f"`{col}`"
    raise TypeError("text casts take a column name")


def try_date(col) -> Column:
    """SCA-4: text -> date, NULL on junk."""
    return F.expr(f"try_cast({_sql(col)} as date)")


def clean_id(col, junk=("", "0")) -> Column:
    """SCA-6: id as text with blanks and placeholder zeros turned into NULL."""
    c = _c(col).cast("string")
    for j in junk:
        c = F.nullif(c, F.lit(j))
    return c


def blank_to_null(col) -> Column:
    """SCA-7: nullif(text, '')."""
    return F.nullif(_c(col), F.lit(""))


def null_safe_sum(*cols) -> Column:
    """SCA-8: coalesce each term to 0 and add."""
    out = None
    for c in cols:
        t = F.coalesce(_c(c), F.lit(0))
        out = t if out is None else out + t
    return out


def kickoff_timestamp(day_col, time_col, default_time: str = "00:00") -> Column:
    """SCA-9: 'YYYY-MM-DD' || ' ' || coalesce(time, '00:00') -> timestamp_ntz (NULL on junk)."""
    text = F.concat_ws(" ", _c(day_col).cast("string"), F.coalesce(_c(time_col), F.lit(default_time)))
    return text.try_cast("timestamp_ntz")  # reads H:mm, HH:mm and HH:mm:ss


def clamp(col, lo, hi) -> Column:
    """SCA-14: max(lo, min(hi, x))."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(col)))


def position_order(col) -> Column:
    """TOP-3: QB, RB, WR, TE first (0..3), anything else after (4)."""
    c = _c(col)
    expr = None
    for i, p in enumerate(rules.SKILL_POSITIONS):
        expr = F.when(c == p, F.lit(i)) if expr is None else expr.when(c == p, F.lit(i))
    return expr.otherwise(F.lit(len(rules.SKILL_POSITIONS)))


def percent_label(col) -> Column:
    """SCA-17: 0.6667 -> '67%'."""
    return F.format_string("%.0f%%", F.bround(_c(col).cast("double") * 100, 0))


def id_label(name_col, id_col) -> Column:
    """JOI-14: display name, else '#<id>'."""
    return F.coalesce(_c(name_col), F.concat(F.lit("#"), _c(id_col).cast("string")))


def safe_ratio(num, den) -> Column:
    """0 when the denominator is 0 or NULL (AGG-8)."""
    return F.coalesce(F.try_divide(_c(num), _c(den)), F.lit(0.0))
