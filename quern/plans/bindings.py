"""Views that give the provided tables the shapes the operators work on.

Each text runs unchanged in Spark (braces filled with DataFrames) and in DuckDB
(braces filled with table names). Literals such as ``1e2`` are DOUBLE in both.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

VIEWS = {
    # txn: hourly transactions, 720 steps over 30 days, with scores that have ties
    "txn": """
        SELECT event_id + 2 AS source_row_number,
               CAST((extract(day FROM ts) - 1) * 24 + extract(hour FROM ts) AS INT) + 1 AS step,
               CASE event_type WHEN 'click' THEN 'PAYMENT' WHEN 'error' THEN 'DEBIT'
                    WHEN 'purchase' THEN 'TRANSFER' WHEN 'signup' THEN 'CASH_IN' ELSE 'CASH_OUT' END AS type,
               value AS amount,
               'C' || CAST(user_id AS STRING) AS name_orig,
               CASE WHEN event_id % 4 = 0 THEN 'M' ELSE 'C' END || CAST(event_id % 97 AS STRING) AS name_dest,
               CASE WHEN event_id % 7 = 0 THEN 0e0 ELSE (event_id * 37 % 40000) / 1e2 END AS old_balance_orig,
               CASE WHEN event_id % 5 = 0 THEN 0e0 ELSE (event_id * 53 % 40000) / 1e2 END AS old_balance_dest,
               CASE WHEN event_id % 31 = 0 THEN 1 ELSE 0 END AS is_fraud,
               CASE WHEN event_id % 31 = 0 THEN 5e-1 + (event_id * 7919 % 1000) / 2e3
                    ELSE (event_id * 7919 % 1000) / 1e3 END AS probability
        FROM {events}
    """,
    # txn_source: the 11 source columns with injected faults and duplicates
    "txn_source": """
        SELECT source_row_number,
               step,
               CASE WHEN source_row_number % 103 = 0 THEN 'WIRE'
                    WHEN source_row_number % 107 = 0 THEN NULL ELSE type END AS type,
               CASE WHEN source_row_number % 101 = 0 THEN -1e0 ELSE amount END AS amount,
               CASE WHEN source_row_number % 109 = 0 THEN 'X1' ELSE name_orig END AS nameOrig,
               old_balance_orig AS oldbalanceOrg,
               CASE WHEN source_row_number % 113 = 0 THEN -5e0 ELSE 0e0 END AS newbalanceOrig,
               name_dest AS nameDest, old_balance_dest AS oldbalanceDest, 0e0 AS newbalanceDest,
               CASE WHEN source_row_number % 127 = 0 THEN 2 ELSE is_fraud END AS isFraud,
               0 AS isFlaggedFraud
        FROM {txn}
        UNION ALL
        SELECT source_row_number + 100000000, step, type, amount, name_orig, old_balance_orig, 0e0,
               name_dest, old_balance_dest, 0e0, is_fraud, 0
        FROM {txn} WHERE source_row_number % 211 = 0
    """,
    # sales (one row per line item; l_linenumber is not unique within an order)
    "sales": """
        SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date, l.l_partkey AS product_id
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
    """,
    # menu
    "menu": """
        SELECT p_partkey AS product_id, p_name AS product_name, CAST(floor(p_retailprice) AS INT) AS price FROM {part}
    """,
    # members: two customers in three joined
    "members": """
        SELECT c_custkey AS customer_id, DATE '1997-01-01' + CAST(c_custkey % 730 AS INT) AS join_date
        FROM {customer} WHERE c_custkey % 3 <> 0
    """,
    # deaths: 25 locations, some without continent, text-typed death counts
    "deaths": """
        SELECT location, continent, date, population, new_cases,
               CAST(nd AS STRING) AS new_deaths,
               CAST(sum(new_cases) OVER (PARTITION BY location ORDER BY date) AS BIGINT) AS total_cases,
               CAST(CAST(sum(nd) OVER (PARTITION BY location ORDER BY date) AS BIGINT) AS STRING) AS total_deaths
        FROM (SELECT n.n_name AS location,
                     CASE WHEN n.n_nationkey % 10 = 0 THEN NULL ELSE r.r_name END AS continent,
                     CAST(o.o_orderdate AS DATE) AS date,
                     CAST(1000 * (n.n_nationkey + 1) AS BIGINT) AS population,
                     count(*) AS new_cases,
                     count(*) FILTER (WHERE o.o_orderstatus = 'F') AS nd
              FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
                   JOIN {nation} n ON c.c_nationkey = n.n_nationkey
                   JOIN {region} r ON n.n_regionkey = r.r_regionkey
              GROUP BY 1, 2, 3, 4) g
    """,
    # vacc (name pattern for LIKE tests: '%NATION_1%')
    "vacc": """
        SELECT n.n_name AS location, CAST(l.l_shipdate AS DATE) AS date,
               CAST(CAST(sum(l.l_quantity) AS BIGINT) AS STRING) AS new_vaccinations
        FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey JOIN {nation} n ON s.s_nationkey = n.n_nationkey
        GROUP BY 1, 2
    """,
    # housing: null addresses with siblings, repeated business keys, Y/N/Yes/No
    "housing": """
        SELECT o_orderkey AS unique_id, 'P' || CAST(o_custkey % 300 AS STRING) AS parcel_id,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL
                    ELSE CAST(o_custkey % 300 AS STRING) || ' MAIN ST, CITY' || CAST(o_custkey % 7 AS STRING) END AS property_address,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL
                    WHEN o_orderkey % 19 = 0 THEN CAST(o_custkey AS STRING) || ' N. FOX, TOWN, TN'
                    ELSE CAST(o_custkey AS STRING) || ' OAK AVE, TOWN, TN' END AS owner_address,
               o_orderdate AS sale_date, o_custkey % 5 AS sale_price,
               'L' || CAST(o_custkey % 2 AS STRING) AS legal_reference,
               CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'Y' WHEN '2' THEN 'N' WHEN '3' THEN 'Yes' ELSE 'No' END AS sold_as_vacant
        FROM (SELECT o_orderkey, o_custkey, o_orderpriority, CAST(date_trunc('year', o_orderdate) AS DATE) AS o_orderdate FROM {orders}) t
    """,
    # ecom
    "ecom": """
        SELECT o.o_custkey AS cid, p.p_type AS product_category, o.o_orderpriority AS purchase_method,
               n.n_name AS location,
               CASE WHEN l.l_discount > 0 THEN 'Yes' ELSE 'No' END AS discount_availed,
               CASE WHEN l.l_discount > 0 THEN 'D' || CAST(CAST(round(l.l_discount * 100) AS INT) AS STRING) END AS discount_name,
               l.l_extendedprice * l.l_discount AS discount_amount,
               l.l_extendedprice AS gross_amount,
               l.l_extendedprice - l.l_extendedprice * l.l_discount AS net_amount,
               CAST(o.o_orderdate AS DATE) AS purchase_date
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
             JOIN {customer} c ON o.o_custkey = c.c_custkey
             JOIN {nation} n ON c.c_nationkey = n.n_nationkey
             JOIN {part} p ON l.l_partkey = p.p_partkey
    """,
    # providers: one row per provider and year, over all years
    "providers": """
        SELECT o.o_custkey AS prvdr_id, n.n_name AS state, 'PROVIDER' AS smry_ctgry,
               CAST(year(o.o_orderdate) AS INT) AS year,
               CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS pymt,
               CASE WHEN o.o_custkey % 4 = 0 THEN '*' ELSE CAST(o.o_custkey % 100 AS STRING) END AS bene_dual_pct
        FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
        GROUP BY 1, 2, 3, 4, 6
    """,
    # panel_years: the five periods of the balanced panel
    "panel_years": "SELECT * FROM {providers} WHERE year BETWEEN 1996 AND 2000",
    # weather: five stations, more than 2,000 days
    "weather": """
        SELECT 'ST' || CAST(o_custkey % 5 AS STRING) AS name, CAST(o_orderdate AS DATE) AS date,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE (o_orderkey % 50) / 1e2 END AS prcp,
               o_totalprice / 1e4 AS tavg
        FROM {orders}
    """,
    # water: text measures with '<0.10' and NULL; limits 4 / 1 / 4
    "water": """
        SELECT l_orderkey AS sample_number, CAST(l_shipdate AS DATE) AS sample_date,
               CASE WHEN l_orderkey % 13 = 0 THEN '<0.10' WHEN l_orderkey % 29 = 0 THEN NULL
                    ELSE CAST(CAST(l_quantity AS INT) % 6 AS STRING) END AS chlorine,
               CAST(CAST(round(l_discount * 100) AS INT) % 3 AS STRING) AS turbidity,
               CAST(CAST(round(l_tax * 100) AS INT) AS STRING) AS fluoride
        FROM {lineitem}
    """,
    # usage: unique row_id gives the row order the reference takes from the file
    "usage": """
        SELECT o_orderkey AS row_id,
               CASE o_orderstatus WHEN 'F' THEN 'Male' WHEN 'O' THEN 'Female' ELSE 'Other' END AS gender,
               'L' || CAST(o_custkey % 5 AS STRING) AS location,
               CAST(18 + o_custkey % 50 AS INT) AS age,
               (o_orderkey * 7 % 120) / 1e1 AS screen,
               CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE (o_orderkey * 11 % 60) / 1e1 END AS social,
               (o_orderkey * 17 % 50) / 1e1 AS productivity,
               (o_orderkey % 13) * 1e0 AS gaming,
               (o_orderkey % 13) * 2e0 + (o_orderkey * 7 % 120) * 3e-2 + o_totalprice / 1e5 AS total_usage
        FROM {orders}
    """,
}

#: Declared schemas save the job that would read the file footers first.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
TABLES = tuple(SCHEMAS)


def _inputs(view: str) -> list[str]:
    """Tables and views a view reads."""
    return [name for name in (*TABLES, *VIEWS) if "{" + name + "}" in VIEWS[view]]


class Bindings:
    """Views over one data folder, built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._built: dict[str, DataFrame] = {}
        self._shared: dict[str, object] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def once(self, name: str, make: Callable[[Bindings], T]) -> T:
        """A value several steps of one query share, made on first use."""
        if name not in self._shared:
            self._shared[name] = make(self)
        return self._shared[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in VIEWS:
                inputs = {i: self[i] for i in _inputs(name)}
                self._built[name] = self.spark.sql(VIEWS[name], **inputs)
            else:
                self._built[name] = self.table(name)
        return self._built[name]


def view_ctes(views: tuple[str, ...]) -> list[str]:
    """``name AS (text)`` for the views and the views they read, in order."""
    ordered: list[str] = []

    def visit(view: str) -> None:
        for name in _inputs(view):
            if name in VIEWS:
                visit(name)
        if view not in ordered:
            ordered.append(view)

    for view in views:
        visit(view)
    plain = {name: name for name in (*TABLES, *VIEWS)}
    return [f"{view} AS ({VIEWS[view].format(**plain)})" for view in ordered]
