"""Small SQL text builders shared by the oracle queries.

They mirror expression builders of ``functions.expressions`` so that the Spark plan and
the reference SQL compute identical values (same integer rounding, same exact sums).
"""

from __future__ import annotations


def round_ratio(num: str, den: str, digits: int = 2) -> str:
    """``ROUND(num / den, digits)`` half away from zero, in integers (see ``expressions.round_ratio``)."""
    scale = 10 ** digits
    n, d = f"CAST({num} AS BIGINT)", f"CAST({den} AS BIGINT)"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({n}) AS DOUBLE) * "
            f"CAST((abs({n}) * {2 * scale} + {d}) // (2 * {d}) AS DOUBLE) / CAST({scale} AS DOUBLE) END)")


def exact_sum(expr: str, scale: int = 2) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def exact_avg(expr: str, scale: int = 2) -> str:
    return f"({exact_sum(expr, scale)} / COUNT({expr}))"
