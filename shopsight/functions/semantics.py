"""Column-level semantics shared by the KPI jobs.

All helpers return built-in Spark Column expressions (JVM-side, codegen'd).
Money stays DECIMAL to the sink; ratios are rounded exactly on
integers so every engine agrees digit for digit (see ``div_round``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from shopsight.params import EXCLUDED_STATUSES


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_valid(status="order_status", excluded=EXCLUDED_STATUSES) -> Column:
    """``status NOT IN (...)``; a NULL status yields NULL, so filters drop it."""
    return ~col(status).isin(*excluded)


def net_value(quantity="quantity", price="unit_price", discount="discount") -> Column:
    """quantity * unit_price * (1 - COALESCE(discount, 0)/100), exact DECIMAL(38,6).

    Written as ``* (100 - d) * 0.01`` so no division (and no scale loss) happens.
    """
    return (
        col(quantity)
        * col(price)
        * (F.lit(100) - F.coalesce(col(discount), F.lit(Decimal("0.00"))))
        * F.lit(Decimal("0.01"))
    )


def money(c, digits: int = 2) -> Column:
    """ROUND(decimal, digits) (half away from zero), exact DECIMAL(38, digits)."""
    return F.round(col(c), digits).cast(f"decimal(38,{digits})")


def _unscaled(c: Column, scale: int) -> Column:
    # Exact: the value has at most ``scale`` fractional digits.
    if scale == 0:
        return c.cast("decimal(38,0)")
    return (c * F.lit(10**scale)).cast("decimal(38,0)")


def div_round(num, den, digits: int, *, num_scale: int = 0, den_scale: int = 0, mult: int = 1) -> Column:
    """ROUND(num * mult / NULLIF(den, 0), digits) as DECIMAL(38, digits), exact.

    Both operands are scaled to integers N, D and the half-away-from-zero
    quotient is ``sign * ((2|N|K + |D|) div 2|D|)`` with K = mult * 10^digits.
    PostgreSQL NUMERIC gives the same digits; Spark's own decimal division
    would round at a capped scale first and could round twice.
    """
    s = max(num_scale, den_scale)
    n = _unscaled(col(num), s)
    d = _unscaled(col(den), s)
    k = mult * 10**digits
    q = (F.lit(2) * F.abs(n) * F.lit(k) + F.abs(d)).cast("decimal(38,0)")
    # ``div`` (IntegralDivide) divides exactly; ``/`` on DECIMAL(38,0) would
    # round the quotient to 6 digits first (4.9999999 -> 5).
    mag = F.call_function("div", q, (F.lit(2) * F.abs(d)).cast("decimal(38,0)"))
    negative = (n < 0) != (d < 0)
    r = F.when(d == 0, F.lit(None)).when(negative, -mag).otherwise(mag)
    return (r.cast("decimal(38,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(38,{digits})")


def pct(num, den, digits: int = 1, *, num_scale: int = 0, den_scale: int = 0) -> Column:
    """ROUND(num / den * 100, digits), exact; NULL when den is 0."""
    return div_round(num, den, digits, num_scale=num_scale, den_scale=den_scale, mult=100)


def tier(value, tiers, default: str) -> Column:
    """First matching ``value >= threshold`` wins; NULL value falls to default."""
    v = col(value)
    expr = None
    for threshold, label in tiers:
        cond = v >= F.lit(threshold)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)


# Least recency, frequency and money scores of a segment, tried in
# order; then the segments of a recency score of at most 2 by frequency score.
RFM_HIGH = (((4, 4, 4), "Champions"), ((4, 3, 1), "Loyal"), ((4, 1, 4), "Big Spenders"), ((4, 1, 1), "Recent"))
RFM_LOW_RECENCY, RFM_LOW_FREQUENCY, RFM_AT_RISK, RFM_LOST, RFM_ELSE = 2, 3, "At Risk", "Lost", "Potential"


def rfm_segment(r="r_score", f="f_score", m="m_score") -> Column:
    """The first RFM segment whose rule holds."""
    r, f, m = col(r), col(f), col(m)
    low = F.when(f >= RFM_LOW_FREQUENCY, RFM_AT_RISK).when(f < RFM_LOW_FREQUENCY, RFM_LOST).otherwise(RFM_ELSE)
    out = F.when(r <= RFM_LOW_RECENCY, low).otherwise(RFM_ELSE)
    for (least_r, least_f, least_m), label in reversed(RFM_HIGH):
        out = F.when((r >= least_r) & (f >= least_f) & (m >= least_m), label).otherwise(out)
    return out


def stock_status(stock) -> Column:
    from shopsight.params import (IN_STOCK, LOW_STOCK, LOW_STOCK_BELOW, OUT_OF_STOCK,
                                  OVERSTOCK, OVERSTOCK_ABOVE)

    s = col(stock)
    return (
        F.when(s == 0, OUT_OF_STOCK)
        .when(s < LOW_STOCK_BELOW, LOW_STOCK)
        .when(s > OVERSTOCK_ABOVE, OVERSTOCK)
        .otherwise(IN_STOCK)
    )


def as_of_date(as_of) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)
