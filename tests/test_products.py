import urllib.parse
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiersmith.functions import products
from tiersmith.plans.prices import unit_price

QUANTITIES = [
    ("Fresh 120ml", "120", "ml"),
    ("3x40ml tabs", "40", "ml"),
    ("3 x 10", "1", "ea"),
    ("Soap 1.5L", "1500", "ml"),
    ("Soap 2 litre", "2000", "ml"),
    ("Cream 75CL", "750", "ml"),
    ("Flour 5kg", "5", "kg"),
    ("Pinch 1.5g", "1.5", "g"),
    ("Cold 4 Sachets", "4", "ea"),
    ("Wipes 20 pads", "20", "ea"),
    ("Tablets 10's", "10", "ea"),
    ("Tablets 16 Pk", "16", "ea"),
    ("5 games", "5", "g"),
    ("nothing 0ml", "0", "ml"),
    ("plain soap", "1", "ea"),
    ("half .5l", "500", "ml"),
    ("nbsp 30 ml", "30", "ml"),
    ("two  30  ml", "1", "ea"),
    ("", "1", "ea"),
]


def test_parse_quantity(spark):
    df = spark.createDataFrame([(n,) for n, _, _ in QUANTITIES] + [(None,)], "name string")
    rows = df.select(products.parse_quantity(F.col("name")).alias("q")).collect()
    got = [(n, r.q.quantity, r.q.unit) for (n, _, _), r in zip(QUANTITIES, rows)]
    assert got == [(n, Decimal(q), u) for n, q, u in QUANTITIES]
    assert all(r.q.multiplier == 1 for r in rows[:-1]) and rows[-1].q is None


@pytest.mark.parametrize(
    "text, expected",
    [
        ("£1.99", "1.99"), (" £ 1.99 ", "1.99"), ("1.99", "1.99"), ("was £3.50\n", "3.50"),
        ("£5", "5"), ("", None), ("n/a", None), ("£1 £2", None), ("£1 ", "1"),
    ],
)
def test_clean_price(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(products.clean_price(F.col("t"))).first()[0]
    assert got == (None if expected is None else Decimal(expected))


def test_price_of_two_parts(spark):
    df = spark.createDataFrame([("£1", ".99")], "p string, q string")
    assert df.select(products.clean_price(F.col("p"), F.col("q"))).first()[0] == Decimal("1.99")


def test_unit_price(spark):
    df = spark.createDataFrame(
        [
            ("Soap &amp; Gel 40ml", "£1.99"), ("Rice 5kg", "£5.00"), ("Pads 20 pads", "£3.00"),
            ("Gel 0ml", "£1.00"), ("Tea 300g", "£1.00"), ("Milk 1L", "n/a"),
        ],
        "name string, price_text string",
    ).selectExpr("*", "'B' AS brand", "'u' AS url")
    rows = {r.product_name: r for r in unit_price(df).collect()}
    per = {n: (r.product_price_per, r.product_price_per_unit) for n, r in rows.items()}
    assert per == {
        "Soap & Gel 40ml": (Decimal("4.975"), "100ml"),
        "Rice 5kg": (Decimal("1"), None),
        "Pads 20 pads": (Decimal("0.15"), "ea"),
        "Gel 0ml": (None, "100ml"),
        "Tea 300g": (Decimal("0.333333333333"), "100g"),
        "Milk 1L": (None, "100ml"),
    }
    assert list(rows["Rice 5kg"].asDict()) == [
        "timestamp", "product_name", "brand_name", "url", "product_price_now", "product_quantity",
        "product_size", "product_size_unit", "product_price_per", "product_price_per_unit",
    ]


@settings(max_examples=25, deadline=None)
@given(names=st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=20), min_size=40, max_size=40))
def test_quote_path_equals_url_quoting(spark, names):
    names = [n.replace("\x00", "") for n in names]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(products.quote_path(F.col("n"))).collect()]
    assert got == [urllib.parse.quote(n) for n in names]


def test_quote_path_of_brands(spark):
    names = ["Hair & Skin", "Calm+", "Big Comb", "Z9", "a/b~c*d"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(products.quote_path(F.col("n"))).collect()]
    assert got == ["Hair%20%26%20Skin", "Calm%2B", "Big%20Comb", "Z9", "a/b~c%2Ad"]
