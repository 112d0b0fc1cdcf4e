"""Grouping and display-label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def case_map(x, *branches: tuple[tuple, str], default: str) -> Column:
    """Ordered CASE: the first ``(values, label)`` branch containing the value wins."""
    c = _c(x)
    expr = None
    for values, label in branches:
        cond = c.isin(list(values))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def legal_group(x, domain) -> Column:
    """Business forms -> group 1, sole trader -> group 2, everything else (NULL too) -> 3."""
    g1, g2, g3 = domain.legal_group_labels
    return case_map(x, (domain.business_forms, g1), (domain.sole_trader_forms, g2), default=g3)


def age_group(x, domain) -> Column:
    """Young bands -> group 1, old bands -> group 3, any other band -> working age."""
    young, working, old = domain.age_group_labels
    return case_map(x, (domain.young_bands, young), (domain.old_bands, old), default=working)


def sector_label(code, label, width: int = 60, unassigned: str = "unassigned") -> Column:
    """'<code>-<first width chars of label, trimmed>[...]', or ``unassigned`` when NULL.

    ``concat`` propagates NULL (unlike ``concat_ws``), so a missing code or
    label falls through to the unassigned text.
    """
    lab = _c(label)
    body = F.concat(_c(code), F.lit("-"), F.trim(F.left(lab, F.lit(width))),
                    F.when(F.length(lab) > width, F.lit("...")).otherwise(F.lit("")))
    return F.coalesce(body, F.lit(unassigned))


def half_up_ratio(num, den, scale: int = 1000, decimals: int = 1) -> Column:
    """round(num * scale / den, decimals) with exact half-up rounding, as DOUBLE.

    Integer arithmetic (num, den >= 0) avoids the decimal-vs-double typing
    differences between engines; NULL when den <= 0 or NULL.
    """
    n, d = _c(num).cast("long"), _c(den).cast("long")
    m = 10 ** decimals
    a, b = n * (scale * m * 2) + d, d * 2
    q = (a - F.pmod(a, b)) / b          # exact integer quotient
    return F.when(d > 0, q.cast("double") / F.lit(float(m)))
