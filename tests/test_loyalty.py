"""Hand-worked answers of the restaurant case."""

import datetime as dt

import pytest
from conftest import rows

from quern.operators import loyalty
from quern.sources.literal import values_table

# The published rows of the case.
SALES = [
    ("A", "2021-01-01", "1"), ("A", "2021-01-01", "2"), ("A", "2021-01-07", "2"),
    ("A", "2021-01-10", "3"), ("A", "2021-01-11", "3"), ("A", "2021-01-11", "3"),
    ("B", "2021-01-01", "2"), ("B", "2021-01-02", "2"), ("B", "2021-01-04", "1"),
    ("B", "2021-01-11", "1"), ("B", "2021-01-16", "3"), ("B", "2021-02-01", "3"),
    ("C", "2021-01-01", "3"), ("C", "2021-01-01", "3"), ("C", "2021-01-07", "3"),
]
MENU = [("1", "sushi", "10"), ("2", "curry", "15"), ("3", "ramen", "12")]
MEMBERS = [("A", "2021-01-07"), ("B", "2021-01-09")]


@pytest.fixture(scope="module")
def case(spark):
    return (
        values_table(spark, SALES, "customer_id string, order_date date, product_id int"),
        values_table(spark, MENU, "product_id int, product_name string, price int"),
        values_table(spark, MEMBERS, "customer_id string, join_date date"),
    )


def day(text):
    return dt.date.fromisoformat(f"2021-{text}")


def test_totals(case):
    sales, menu, members = case
    assert rows(loyalty.total_spent_by_customer(sales, menu)) == [("A", 76), ("B", 74), ("C", 36)]
    assert rows(loyalty.visit_days(sales)) == [("A", 4), ("B", 6), ("C", 2)]
    assert rows(loyalty.most_purchased_item(sales, menu)) == [(3, "ramen", 8)]
    assert rows(loyalty.pre_member_totals(sales, members, menu)) == [("A", 2, 25), ("B", 3, 40)]


def test_ranks_keep_ties(case):
    sales, menu, members = case
    assert rows(loyalty.first_items(sales, menu), "customer_id", "product_name") == [
        ("A", "curry"), ("A", "sushi"), ("B", "curry"), ("C", "ramen"), ("C", "ramen"),
    ]
    assert rows(loyalty.favourite_items(sales, menu)) == [
        ("A", "ramen", 3), ("B", "curry", 2), ("B", "ramen", 2), ("B", "sushi", 2), ("C", "ramen", 3),
    ]
    assert rows(loyalty.first_after_join(sales, members, menu)) == [
        ("A", "ramen", day("01-10")), ("B", "sushi", day("01-11")),
    ]
    assert rows(loyalty.last_before_join(sales, members, menu)) == [
        ("A", "curry", day("01-01")), ("A", "sushi", day("01-01")), ("B", "sushi", day("01-04")),
    ]
    assert rows(loyalty.last_before_join(sales, members, menu, as_written=True)) == [
        ("A", "curry", day("01-01")), ("A", "sushi", day("01-01")), ("B", "curry", day("01-01")),
    ]


def test_points(case):
    sales, menu, members = case
    assert rows(loyalty.loyalty_points(sales, menu, 1)) == [("A", 860), ("B", 940), ("C", 360)]
    written = loyalty.loyalty_points_promo(
        sales, members, menu, 1, as_written=True, promo_prices={3: 15}
    )
    assert rows(written) == [("A", 1550), ("B", 940), ("C", 360)]
    corrected = loyalty.loyalty_points_promo(sales, members, menu, 1, until=day("01-31"))
    assert rows(corrected) == [("A", 1370), ("B", 820)]
