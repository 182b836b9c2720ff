"""Column expression builders.

Everything here returns a ``Column``: the work stays in whole-stage codegen and no
Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- rounding

def round_ratio(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """``ROUND(num / den, digits)`` half away from zero, computed in integers.

    ``num`` and ``den`` are integral. Rounding a double quotient goes wrong at ties
    whose binary value sits just under the half (2.345 is 2.34499..), and two engines
    disagree there; ``floor((2*10^d*|n| + d) / (2d))`` is exact. Null when den = 0.
    """
    n, d = col(num).cast("bigint"), col(den).cast("bigint")
    scale = 10 ** digits
    shifted = F.abs(n) * (2 * scale) + d
    steps = (shifted - F.pmod(shifted, 2 * d)) / (2 * d)  # exact integer
    return F.when(d == 0, F.lit(None)).otherwise(F.signum(n) * steps / scale)


def exact_sum(c: str | Column, scale: int = 2) -> Column:
    """Sum of a money-like double as an exact decimal, returned as double.

    Summing doubles depends on the order rows arrive in; a decimal sum does not.
    """
    return F.sum(col(c).cast(f"decimal(18,{scale})")).cast("double")


def exact_avg(c: str | Column, scale: int = 2) -> Column:
    """Mean of a money-like double: exact decimal sum divided by the count."""
    return exact_sum(c, scale) / F.count(col(c))


def percent(part: str | Column, whole: str | Column) -> Column:
    """A10: ``100 * part / NULLIF(whole, 0)``."""
    return F.lit(100.0) * col(part) / F.nullif(col(whole), F.lit(0))


# ---------------------------------------------------------------- CASE builders

def case_when(branches: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """Searched CASE. Null comparisons are not true, so they fall to ``otherwise``."""
    expr = None
    for cond, value in branches:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    o = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return expr.otherwise(o)


def case_value(c: str | Column, mapping: dict, otherwise: object = None) -> Column:
    """Simple ``CASE x WHEN v THEN r``."""
    x = col(c)
    return case_when([(x == F.lit(k), v) for k, v in mapping.items()], otherwise)


# ---------------------------------------------------------------- binning

def bin_right_closed(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``pd.cut(x, bins=edges, labels=labels)``: intervals (e_i, e_{i+1}], outside -> null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    x = col(c)
    branches = [((x > lo) & (x <= hi), lab) for lo, hi, lab in zip(edges[:-1], edges[1:], labels)]
    return case_when(branches, None)


# Season labels of months 1-3, 4-6, 7-9, 10-12.
SEASON_EDGES = (0, 3, 6, 9, 12)
SEASON_LABELS = ("Winter", "Spring", "Summer", "Fall")


def season(month: str | Column) -> Column:
    return bin_right_closed(month, SEASON_EDGES, SEASON_LABELS)


# The bounds and labels of the decades are inside this expression.
def decade_label(year: str | Column) -> Column:
    """1990s for 1990-1999, 2000s for 2000-2009, 2010s for 2010-2020, else Other (also null)."""
    y = col(year)
    return case_when(
        [
            ((y >= 1990) & (y < 2000), "1990s"),
            ((y >= 2000) & (y < 2010), "2000s"),
            ((y >= 2010) & (y <= 2020), "2010s"),
        ],
        "Other",
    )


def three_way_category(c: str | Column, low_cut: Column, high_cut: Column,
                       labels=("Low", "Medium", "High")) -> Column:
    """x < low -> Low; low <= x <= high -> Medium; otherwise (also null) -> High."""
    x = col(c)
    return case_when([(x < low_cut, labels[0]), ((x >= low_cut) & (x <= high_cut), labels[1])], labels[2])


# ---------------------------------------------------------------- coercion

def to_number(c: str | Column) -> Column:
    """text to double; failures (also blanks) become null instead of raising."""
    return F.trim(col(c).cast("string")).try_cast("double")


def to_timestamp(c: str | Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """text to timestamp by a pattern; text that does not fit it becomes null instead of raising."""
    return F.try_to_timestamp(F.trim(col(c).cast("string")), F.lit(pattern))


def sentinels_to_null(df: DataFrame, sentinels: Sequence[str] = ("Not Available",),
                      columns: Sequence[str] | None = None) -> DataFrame:
    """F8: every string column equal to a sentinel becomes null."""
    string_cols = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    targets = [c for c in (columns or df.columns) if c in string_cols]
    values = list(sentinels)
    return df.select(
        *[
            F.when(F.col(c).isin(values), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
            if c in targets else F.col(c)
            for c in df.columns
        ]
    )


def whole_days_between(start: str | Column, end: str | Column) -> Column:
    """``(end - start).days`` -- floor of the elapsed time in days, may be negative."""
    micros = F.unix_micros(col(end).cast("timestamp")) - F.unix_micros(col(start).cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("bigint")


def month_label(d: str | Column) -> Column:
    """'yyyy-MM'."""
    return F.date_format(col(d), "yyyy-MM")


def month_start(d: str | Column) -> Column:
    """first day of the month as a date."""
    return F.trunc(col(d).cast("date"), "MM")


def cap_at(c: str | Column, cap: Column) -> Column:
    """F16: ``min(x, cap)``; null stays null."""
    x = col(c)
    return F.when(x > cap, cap).otherwise(x)


def millions(c: str | Column) -> Column:
    """F23."""
    return col(c) / F.lit(1_000_000.0)


def corr_safe(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation over rows where both values exist; null (not an error) for a constant side.

    ``corr`` divides by zero on a constant column when ANSI mode is on (the default).
    """
    both = col(a).isNotNull() & col(b).isNotNull()
    x, y = F.when(both, col(a).cast("double")), F.when(both, col(b).cast("double"))
    return F.covar_samp(x, y) / F.nullif(F.stddev_samp(x) * F.stddev_samp(y), F.lit(0.0))
