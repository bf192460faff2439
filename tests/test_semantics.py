"""Column semantics: exact rounding, tiers, RFM rules, stock status, display."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from shopsight.functions.display import currency_display, short_label, status_slug
from shopsight.functions.semantics import div_round, rfm_segment, stock_status, tier
from shopsight.params import CLV_TIERS


def _py_round_div(n: Decimal, d: Decimal, digits: int, mult: int = 1):
    if d == 0:
        return None
    return float((Decimal(n * mult) / Decimal(d)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def test_div_round_exact_against_decimal(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        n = Decimal(rnd.randint(-10**9, 10**9)) / 100
        d = Decimal(rnd.choice([rnd.randint(1, 10**6), rnd.randint(-10**4, -1), 3, 7, 0])) / 100
        rows.append((n, d))
    # exact half-way cases
    rows += [(Decimal("1.25"), Decimal("1")), (Decimal("-1.25"), Decimal("1")),
             (Decimal("0.05"), Decimal("1")), (Decimal("2.345"), Decimal("1"))]
    df = spark.createDataFrame(rows, "n decimal(20,3), d decimal(20,2)")
    got = df.select(div_round("n", "d", 2, num_scale=3, den_scale=2).alias("r"),
                    div_round("n", "d", 1, num_scale=3, den_scale=2, mult=100).alias("p")).collect()
    import decimal
    decimal.getcontext().prec = 60
    for (n, d), g in zip(rows, got):
        assert (g["r"] if g["r"] is None else float(g["r"])) == _py_round_div(n, d, 2), (n, d)
        assert (g["p"] if g["p"] is None else float(g["p"])) == _py_round_div(n, d, 1, 100), (n, d)


@pytest.mark.parametrize("value,label", [
    (None, "New"), (0, "New"), (499.99, "New"), (500, "Bronze"), (1999.99, "Bronze"),
    (2000, "Silver"), (5000, "Gold"), (9999.99, "Gold"), (10000, "Platinum"),
])
def test_clv_tier_thresholds(spark, value, label):
    df = spark.createDataFrame([(Decimal(str(value)) if value is not None else None,)], "v decimal(22,2)")
    assert df.select(tier("v", CLV_TIERS, "New")).first()[0] == label


def _rfm_py(r, f, m):
    if r >= 4 and f >= 4 and m >= 4:
        return "Champions"
    if r >= 4 and f >= 3:
        return "Loyal"
    if r >= 4 and m >= 4:
        return "Big Spenders"
    if r >= 4:
        return "Recent"
    if r <= 2 and f >= 3:
        return "At Risk"
    if r <= 2 and f <= 2:
        return "Lost"
    return "Potential"


def test_rfm_segment_all_125_triples(spark):
    triples = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(triples, "r_score int, f_score int, m_score int")
    got = {(x.r_score, x.f_score, x.m_score): x.s
           for x in df.select("*", rfm_segment().alias("s")).collect()}
    assert got == {t: _rfm_py(*t) for t in triples}


@pytest.mark.parametrize("stock,status", [
    (0, "Out of Stock"), (-3, "Low Stock"), (9, "Low Stock"), (10, "In Stock"),
    (100, "In Stock"), (101, "Overstock"),
])
def test_stock_status(spark, stock, status):
    assert spark.range(1).select(stock_status(F.lit(stock))).first()[0] == status


@pytest.mark.parametrize("value,text", [
    (None, None), (0.0, "₹0"), (999.5, "₹999.5"), (1234.56, "₹1,234.56"),
    (99999.99, "₹99,999.99"), (100000.0, "₹1.00 L"), (1234567.0, "₹12.35 L"),
    (10000000.0, "₹1.00 Cr"), (123456789.0, "₹12.35 Cr"),
])
def test_currency_display(spark, value, text):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(currency_display("v")).first()[0] == text


def test_indian_grouping_long_numbers(spark):
    df = spark.createDataFrame([(-98765.25,), (12345.0,)], "v double")
    from shopsight.functions.display import indian_grouping
    assert [r[0] for r in df.select(indian_grouping("v")).collect()] == ["-98,765.25", "12,345"]


def test_label_and_slug(spark):
    df = spark.createDataFrame([("a very long product name here", "Needs Attention"), ("bolt", "Star")],
                               "n string, t string")
    got = df.select(short_label("n"), status_slug("t")).collect()
    assert got[0][0] == "a very long product ..." and got[0][1] == "status-needs-attention"
    assert got[1][0] == "bolt..." and got[1][1] == "status-star"


def test_money_keeps_its_cents(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from shopsight.functions.semantics import money

    big = Decimal("123456789012345678.91")
    df = spark.createDataFrame([(big,), (Decimal("0.00"),)], "x decimal(28,2)")
    assert df.agg(money(F.sum("x")).alias("m")).first().m == big
