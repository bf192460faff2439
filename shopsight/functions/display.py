"""Display columns for the serving tables (what the dashboard shows).

Built-in string functions only (no UDF), so they run inside the same
codegen'd projection that writes the table. NULL input gives NULL output
(the dashboard itself would fail on a NULL revenue; the table keeps NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shopsight.functions.semantics import col

# Fixed values of the dashboard formats.
RUPEE = "₹"
CRORE, LAKH = 10_000_000, 100_000
LABEL_CHARS = 20
LABEL_SUFFIX = "..."


def indian_grouping(value) -> Column:
    """Digits grouped the Indian way (12,34,567.5): last three, then pairs.

    Up to three fraction digits, trailing zeros dropped (the en-IN number
    format's defaults).
    """
    v = col(value)
    r = F.round(F.abs(v), 3)
    whole = F.floor(r).cast("decimal(38,0)").cast("string")
    frac = F.regexp_replace(
        F.format_string("%.3f", (r - F.floor(r)).cast("double")).substr(3, 3), "0+$", ""
    )
    head = F.regexp_extract(whole, r"^(\d+)\d{3}$", 1)  # all but the last three digits
    tail = F.regexp_extract(whole, r"(\d{3})$", 1)
    grouped = F.when(
        F.length(whole) > 3,
        F.concat(F.regexp_replace(head, r"(\d)(?=(\d{2})+$)", "$1,"), F.lit(","), tail),
    ).otherwise(whole)
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(
        v.isNotNull(),
        F.concat(sign, grouped, F.when(F.length(frac) > 0, F.concat(F.lit("."), frac)).otherwise(F.lit(""))),
    )


def currency_display(value) -> Column:
    """>= 1 crore: value/1e7 to 2 decimals + ' Cr'; >= 1 lakh: value/1e5 + ' L';
    otherwise Indian-grouped; always prefixed with the rupee sign."""
    v = col(value).cast("double")
    return (
        F.when(v.isNull(), F.lit(None))
        .when(v >= CRORE, F.concat(F.lit(RUPEE), F.format_string("%.2f", v / CRORE), F.lit(" Cr")))
        .when(v >= LAKH, F.concat(F.lit(RUPEE), F.format_string("%.2f", v / LAKH), F.lit(" L")))
        .otherwise(F.concat(F.lit(RUPEE), indian_grouping(v)))
    )


def short_label(text, chars: int = LABEL_CHARS) -> Column:
    """First ``chars`` characters followed by '...' (appended unconditionally)."""
    return F.concat(F.substring(col(text), 1, chars), F.lit(LABEL_SUFFIX))


def status_slug(tier) -> Column:
    """'status-' + lower-cased tier with its first space turned into '-'."""
    lowered = F.lower(col(tier))
    return F.concat(F.lit("status-"), F.regexp_replace(lowered, r"^([^ ]*) ", "$1-"))


def with_display(name: str, df):
    """Dashboard display columns on the serving tables that show them."""
    if name == "store_performance":
        return df.withColumns({
            "revenue_display": currency_display("revenue"),
            "tier_class": status_slug("performance_tier"),
        })
    if name == "export_store_performance":
        return df.withColumns({
            "revenue_display": currency_display("revenue"),
            "orders_display": indian_grouping("orders"),
            "tier_class": status_slug("performance_tier"),
        })
    if name == "export_top_products":
        return df.withColumns({
            "revenue_display": currency_display("revenue"),
            "units_display": indian_grouping("units_sold"),
            "label": short_label("product_name"),
        })
    if name in ("product_performance", "top_products"):
        return df.withColumns({
            "revenue_display": currency_display("revenue"),
            "label": short_label("prod_name"),
        })
    return df
