"""Reports, joins, aggregates, ranks, cleaning and panel queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quern.operators import cleaning, commerce, epidemic, loyalty, providers
from quern.plans.registry import oracle, register, rounded
from quern.sources.literal import publish_view, values_table

# Ratios and means are compared at six digits: at fewer, the engines break ties apart.

# ---- sales reports -------------------------------------------------------------

_DISCOUNTED = "WHERE discount_availed = 'Yes'"
_USAGE = (
    "count(*) AS transactions, count(*) FILTER (WHERE discount_availed = 'Yes') AS discounted, "
    "round(count(*) FILTER (WHERE discount_availed = 'Yes') / count(*) * 1e2, 6) AS discounted_pct"
)


def _ecom(name, build, select):
    register(name, oracle("ecom", select=select))(lambda b: rounded(build(b["ecom"]), 4))


_ecom(
    "sales_by_category", commerce.sales_by_category,
    "SELECT product_category, round(sum(net_amount), 4) AS total_sales FROM ecom GROUP BY ALL",
)
_ecom(
    "avg_discount_by_location", commerce.avg_discount_by_location,
    f"SELECT location, round(avg(discount_amount), 4) AS avg_discount FROM ecom {_DISCOUNTED} GROUP BY ALL",
)
_ecom(
    "top_cities", commerce.top_cities,
    "SELECT location, round(sum(net_amount), 4) AS total_sales FROM ecom GROUP BY 1 "
    "ORDER BY 2 DESC, 1 LIMIT 5",
)
_ecom(
    "top_customers", commerce.top_customers,
    "SELECT cid, round(sum(net_amount), 4) AS total_spending FROM ecom GROUP BY 1 "
    "ORDER BY 2 DESC, 1 LIMIT 10",
)
register(
    "discount_usage_by_method",
    oracle("ecom", select=f"SELECT purchase_method, {_USAGE} FROM ecom GROUP BY 1"),
)(lambda b: rounded(commerce.discount_usage(b["ecom"], "purchase_method")))
register(
    "discount_usage_by_category",
    oracle("ecom", select=f"SELECT product_category, {_USAGE} FROM ecom GROUP BY 1"),
)(lambda b: rounded(commerce.discount_usage(b["ecom"], "product_category")))
_ecom(
    "revenue_before_after", commerce.revenue_before_after,
    "SELECT round(sum(gross_amount), 4) AS gross_revenue, round(sum(net_amount), 4) AS net_revenue, "
    "round(sum(gross_amount - net_amount), 4) AS discount_given FROM ecom",
)
_ecom(
    "popular_discounts", commerce.popular_discounts,
    f"SELECT discount_name, count(*) AS uses FROM ecom {_DISCOUNTED} GROUP BY 1",
)
_ecom(
    "monthly_sales", commerce.monthly_sales,
    "SELECT strftime(purchase_date, '%Y-%m') AS month, round(sum(net_amount), 4) AS total_sales "
    "FROM ecom GROUP BY 1",
)
_ecom(
    "avg_gross_net_by_category", commerce.avg_gross_net_by_category,
    "SELECT product_category, round(avg(gross_amount), 4) AS avg_gross, "
    "round(avg(net_amount), 4) AS avg_net FROM ecom GROUP BY 1",
)
_ecom(
    "discount_impact", commerce.discount_impact,
    "SELECT discount_availed, round(avg(net_amount), 4) AS avg_net FROM ecom GROUP BY 1",
)
_ecom(
    "discount_by_category", commerce.discount_by_category,
    f"SELECT product_category, round(sum(discount_amount), 4) AS total_discount FROM ecom {_DISCOUNTED} GROUP BY 1",
)
_ecom(
    "purchase_method_counts", commerce.purchase_method_counts,
    "SELECT purchase_method, count(*) AS transactions FROM ecom GROUP BY 1",
)
_ecom(
    "sales_by_weekday", commerce.sales_by_weekday,
    "SELECT dayname(purchase_date) AS weekday, round(sum(net_amount), 4) AS total_sales FROM ecom GROUP BY 1",
)
_ecom(
    "discount_vs_gross", commerce.discount_vs_gross,
    "SELECT CAST(discount_amount AS DECIMAL(18,4)) AS discount_amount, "
    f"round(avg(gross_amount), 4) AS avg_gross FROM ecom {_DISCOUNTED} GROUP BY 1",
)

# ---- loyalty -------------------------------------------------------------------

_BONUS = 1  # product whose points always count double
_UNTIL = dt.date(1998, 1, 31)
_DINE = ("sales", "menu", "members")
_EDGE = (
    "SELECT s.customer_id, m.product_name, s.order_date FROM (SELECT s.*, rank() OVER "
    "(PARTITION BY s.customer_id ORDER BY s.order_date {direction}) AS rnk FROM sales s JOIN members mb "
    "ON s.customer_id = mb.customer_id WHERE s.order_date {side} mb.join_date) s "
    "JOIN menu m ON s.product_id = m.product_id WHERE s.rnk = 1"
)
_IN_WEEK = "coalesce(order_date >= join_date AND order_date < join_date + 7, FALSE)"


@register(
    "join_inner_dim",
    oracle("sales", "menu", select="SELECT product_id, customer_id, order_date, product_name, price FROM sales JOIN menu USING (product_id)"),
)
def _(b):
    return loyalty.join_inner_dim(b["sales"], b["menu"])


for _name, _side, _op in (
    ("join_after_event", ">", loyalty.join_after_event),
    ("join_before_event", "<", loyalty.join_before_event),
):
    register(
        _name,
        oracle("sales", "members", select="SELECT customer_id, order_date, product_id, join_date FROM sales "
               f"JOIN members USING (customer_id) WHERE order_date {_side} join_date"),
    )(lambda b, op=_op: op(b["sales"], b["members"]))


@register(
    "join_full_outer",
    oracle(*_DINE, select="SELECT product_id, customer_id, order_date, join_date, product_name, price FROM "
           "(SELECT coalesce(s.customer_id, mb.customer_id) AS customer_id, s.order_date, s.product_id, mb.join_date "
           "FROM sales s FULL JOIN members mb ON s.customer_id = mb.customer_id) JOIN menu USING (product_id)"),
)
def _(b):
    return loyalty.join_full_outer(b["sales"], b["members"], b["menu"])


@register(
    "total_spent_by_customer",
    oracle("sales", "menu", select="SELECT customer_id, CAST(sum(price) AS BIGINT) AS total_spent "
           "FROM sales JOIN menu USING (product_id) GROUP BY 1"),
)
def _(b):
    return loyalty.total_spent_by_customer(b["sales"], b["menu"])


@register(
    "visit_days",
    oracle("sales", select="SELECT customer_id, count(DISTINCT order_date) AS order_days FROM sales GROUP BY 1"),
)
def _(b):
    return loyalty.visit_days(b["sales"])


@register(
    "most_purchased_item",
    oracle("sales", "menu", select="SELECT product_id, product_name, count(customer_id) AS purchases "
           "FROM sales JOIN menu USING (product_id) GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 1"),
)
def _(b):
    return loyalty.most_purchased_item(b["sales"], b["menu"])


@register(
    "pre_member_totals",
    oracle(*_DINE, select="SELECT s.customer_id, count(*) AS items, CAST(sum(price) AS BIGINT) AS total_spent "
           "FROM sales s JOIN members mb ON s.customer_id = mb.customer_id AND s.order_date < mb.join_date "
           "JOIN menu m ON m.product_id = s.product_id GROUP BY 1"),
)
def _(b):
    return loyalty.pre_member_totals(b["sales"], b["members"], b["menu"])


@register(
    "loyalty_points",
    oracle("sales", "menu", select="SELECT customer_id, CAST(sum(CASE WHEN product_id = 1 THEN 20 * price ELSE 10 * price END) AS BIGINT) "
           "AS total_points FROM sales JOIN menu USING (product_id) GROUP BY 1"),
)
def _(b):
    return loyalty.loyalty_points(b["sales"], b["menu"], _BONUS)


_PROMO = (
    "SELECT customer_id, CAST(sum(CASE WHEN product_id = 1 OR {week} THEN 20 * price ELSE 10 * price END) "
    "AS BIGINT) AS total_points FROM sales {join} members USING (customer_id) JOIN menu USING (product_id) "
    "{where} GROUP BY 1"
)


@register(
    "loyalty_points_promo",
    oracle(*_DINE, select=_PROMO.format(week=_IN_WEEK, join="JOIN", where="WHERE order_date <= DATE '1998-01-31'")),
)
def _(b):
    return loyalty.loyalty_points_promo(b["sales"], b["members"], b["menu"], _BONUS, until=_UNTIL)


@register(
    "loyalty_points_promo_as_written",
    oracle(*_DINE, select=_PROMO.format(week=_IN_WEEK, join="LEFT JOIN", where="").replace(
        "THEN 20 * price", "THEN 20 * CASE WHEN product_id = 3 THEN 15 ELSE price END")),
)
def _(b):
    return loyalty.loyalty_points_promo(
        b["sales"], b["members"], b["menu"], _BONUS, as_written=True, promo_prices={3: 15}
    )


@register(
    "first_items",
    oracle("sales", "menu", select="SELECT customer_id, product_name, order_date FROM (SELECT s.customer_id, m.product_name, "
           "s.order_date, rank() OVER (PARTITION BY s.customer_id ORDER BY s.order_date) AS rnk "
           "FROM sales s JOIN menu m ON m.product_id = s.product_id) WHERE rnk = 1"),
)
def _(b):
    return loyalty.first_items(b["sales"], b["menu"])


@register(
    "favourite_items",
    oracle("sales", "menu", select="SELECT customer_id, product_name, purchases FROM (SELECT *, rank() OVER "
           "(PARTITION BY customer_id ORDER BY purchases DESC) AS rnk FROM (SELECT customer_id, product_name, "
           "count(*) AS purchases FROM sales JOIN menu USING (product_id) GROUP BY 1, 2)) WHERE rnk = 1"),
)
def _(b):
    return loyalty.favourite_items(b["sales"], b["menu"])


@register("first_after_join", oracle(*_DINE, select=_EDGE.format(direction="ASC", side=">")))
def _(b):
    return loyalty.first_after_join(b["sales"], b["members"], b["menu"])


@register("last_before_join", oracle(*_DINE, select=_EDGE.format(direction="DESC", side="<")))
def _(b):
    return loyalty.last_before_join(b["sales"], b["members"], b["menu"])


@register("last_before_join_as_written", oracle(*_DINE, select=_EDGE.format(direction="ASC", side="<")))
def _(b):
    return loyalty.last_before_join(b["sales"], b["members"], b["menu"], as_written=True)


# ---- epidemic ------------------------------------------------------------------

_PATTERN = "%nation_1%"  # lower case on purpose: matching ignores case


@register("select_star_where_order", oracle("deaths", select="SELECT * FROM deaths WHERE continent IS NOT NULL"))
def _(b):
    return epidemic.select_star_where_order(b["deaths"])


@register(
    "project_order",
    oracle("deaths", select="SELECT location, date, total_cases, new_cases, total_deaths, population FROM deaths"),
)
def _(b):
    return epidemic.project_order(b["deaths"])


@register(
    "case_fatality_pct",
    oracle("deaths", select="SELECT location, date, total_cases, total_deaths, round(CAST(total_deaths AS DOUBLE) "
           "/ nullif(total_cases, 0) * 100, 6) AS death_pct FROM deaths "
           f"WHERE continent IS NOT NULL AND location ILIKE '{_PATTERN}'"),
)
def _(b):
    return epidemic.case_fatality_pct(b["deaths"], _PATTERN, digits=6)


@register(
    "infection_pct",
    oracle("deaths", select="SELECT location, date, total_cases, population, round(CAST(total_cases AS DOUBLE) "
           "/ nullif(population, 0) * 100, 6) AS infected_pct FROM deaths "
           f"WHERE continent IS NOT NULL AND location ILIKE '{_PATTERN}'"),
)
def _(b):
    return epidemic.infection_pct(b["deaths"], _PATTERN, digits=6)


@register(
    "infection_rate_rank",
    oracle("deaths", select="SELECT location, population, max(total_cases) AS max_cases, round(max(CAST(total_cases AS DOUBLE) "
           "/ population) * 100, 6) AS infection_rate FROM deaths WHERE continent IS NOT NULL GROUP BY 1, 2"),
)
def _(b):
    return epidemic.infection_rate_rank(b["deaths"], digits=6)


for _name, _key in (("max_deaths_by_country", "location"), ("max_deaths_by_continent", "continent")):
    register(
        _name,
        oracle("deaths", select=f"SELECT {_key}, max(try_cast(total_deaths AS BIGINT)) AS max_deaths FROM deaths "
               "WHERE continent IS NOT NULL GROUP BY 1"),
    )(lambda b, key=_key: epidemic.max_deaths_by(b["deaths"], key))


@register(
    "new_cases_by_date",
    oracle("deaths", select="SELECT date, CAST(sum(new_cases) AS BIGINT) AS new_cases, "
           "CAST(sum(CAST(new_deaths AS BIGINT)) AS BIGINT) AS new_deaths, round(CAST(sum(CAST(new_deaths AS BIGINT)) AS DOUBLE) "
           "/ nullif(sum(new_cases), 0) * 100, 6) AS death_pct FROM deaths WHERE continent IS NOT NULL GROUP BY 1"),
)
def _(b):
    return epidemic.new_cases_by_date(b["deaths"], digits=6)


_VACC = ("deaths", "vacc")
_JOINED = "FROM deaths d JOIN vacc v ON d.location = v.location AND d.date = v.date WHERE d.continent IS NOT NULL"
_RUNNING = (
    "SELECT d.location, d.date, d.population, v.new_vaccinations, CAST(sum(CAST(v.new_vaccinations AS BIGINT)) "
    f"OVER (PARTITION BY d.location ORDER BY d.date) AS BIGINT) AS total_vaccinations {_JOINED}"
)
_VACC_PCT = (
    "SELECT *, round(CAST(total_vaccinations AS DOUBLE) / nullif(population, 0) * 100, 6) AS vaccinated_pct FROM running"
)


@register("join_inner_composite", oracle(*_VACC, select=f"SELECT d.location, d.date, v.new_vaccinations {_JOINED}"))
def _(b):
    return epidemic.join_inner_composite(b["deaths"], b["vacc"])


@register("running_vaccinations", oracle(*_VACC, select=_RUNNING))
def _(b):
    return epidemic.running_vaccinations(b["deaths"], b["vacc"])


@register("vaccination_pct", oracle(*_VACC, steps={"running": _RUNNING}, select=_VACC_PCT))
def _(b):
    return epidemic.vaccination_pct(b["deaths"], b["vacc"], digits=6)


@register("publish_view", oracle(*_VACC, steps={"running": _RUNNING}, select=_VACC_PCT))
def _(b):
    running = epidemic.running_vaccinations(b["deaths"], b["vacc"])
    publish_view("quern_vaccinations", running)
    return b.spark.sql(
        "SELECT *, round(try_divide(double(total_vaccinations), double(population)) * 100, 6) AS vaccinated_pct "
        "FROM quern_vaccinations"
    )


# ---- cleaning ------------------------------------------------------------------

_HOUSE_KEYS = ("parcel_id", "property_address", "sale_price", "sale_date", "legal_reference")
_OWNER_PARTS = "string_split(replace(owner_address, ',', '.'), '.')"


def _owner_part(place):
    return (
        f"CASE WHEN len({_OWNER_PARTS}) <= 4 THEN nullif({_OWNER_PARTS}[-{place}], '') END"
    )


@register(
    "to_date_column",
    oracle("housing", select="SELECT h.*, CAST(sale_date AS DATE) AS sale_day, CASE WHEN unique_id % 41 <> 0 THEN CAST(sale_date AS DATE) END AS text_day, "
           "unique_id % 41 = 0 AS text_unread FROM housing h"),
)
def _(b):
    # The same days once more as texts of three formats, some of them unreadable.
    day, pick = F.col("sale_day"), F.col("unique_id") % 3
    text = F.when(F.col("unique_id") % 41 == 0, "some day").when(pick == 0, F.date_format(day, "MMMM d, yyyy"))
    text = text.when(pick == 1, F.date_format(day, "M/d/yyyy")).otherwise(day.cast("string"))
    dated = cleaning.to_date_column(b["housing"], "sale_date", "sale_day").withColumn("_text", text)
    return cleaning.to_date_column(dated, "_text", "text_day", failed="text_unread").drop("_text")


@register(
    "backfill_self_join",
    oracle("housing", select="SELECT unique_id, parcel_id, coalesce(property_address, min_by(property_address, unique_id) "
           "FILTER (WHERE property_address IS NOT NULL) OVER (PARTITION BY parcel_id)) AS property_address FROM housing"),
)
def _(b):
    return cleaning.backfill_self_join(
        b["housing"].select("unique_id", "parcel_id", "property_address"),
        "parcel_id", "unique_id", "property_address",
    )


@register(
    "split_address_at_comma",
    oracle("housing", select="SELECT unique_id, property_address, CASE WHEN strpos(property_address, ',') > 0 THEN "
           "substr(property_address, 1, strpos(property_address, ',') - 1) END AS property_street, "
           "CASE WHEN strpos(property_address, ',') > 0 THEN substr(property_address, strpos(property_address, ',') + 1) END "
           "AS property_city FROM housing"),
)
def _(b):
    return cleaning.split_address_at_comma(
        b["housing"].select("unique_id", "property_address"), "property_address"
    )


@register(
    "split_owner_address",
    oracle("housing", select=f"SELECT unique_id, owner_address, {_owner_part(3)} AS owner_street, "
           f"{_owner_part(2)} AS owner_city, {_owner_part(1)} AS owner_state FROM housing"),
)
def _(b):
    return cleaning.split_owner_address(
        b["housing"].select("unique_id", "owner_address"), "owner_address"
    )


_RECODED = "CASE sold_as_vacant WHEN 'Y' THEN 'Yes' WHEN 'N' THEN 'No' ELSE sold_as_vacant END AS sold_as_vacant"


@register("recode_yes_no", oracle("housing", select=f"SELECT unique_id, {_RECODED} FROM housing"))
def _(b):
    return cleaning.recode_yes_no(b["housing"].select("unique_id", "sold_as_vacant"), "sold_as_vacant")


@register(
    "category_counts",
    oracle("housing", select="SELECT property_address, count(property_address) AS occurrences FROM housing GROUP BY 1"),
)
def _(b):
    return cleaning.category_counts(b["housing"], "property_address")


_NUMBERED = (
    f"SELECT *, row_number() OVER (PARTITION BY {', '.join(_HOUSE_KEYS)} ORDER BY unique_id) AS row_num FROM housing"
)


@register("duplicate_rows", oracle("housing", steps={"n": _NUMBERED}, select="SELECT * FROM n WHERE row_num > 1"))
def _(b):
    return cleaning.duplicate_rows(b["housing"], _HOUSE_KEYS, "unique_id")


@register(
    "dedupe_keep_first",
    oracle("housing", steps={"n": _NUMBERED}, select="SELECT * EXCLUDE (row_num) FROM n WHERE row_num = 1"),
)
def _(b):
    return cleaning.dedupe_keep_first(b["housing"], _HOUSE_KEYS, "unique_id")


@register(
    "drop_columns",
    oracle("housing", select="SELECT unique_id, parcel_id, sale_price, legal_reference, sold_as_vacant FROM housing"),
)
def _(b):
    return cleaning.drop_columns(b["housing"], ("owner_address", "property_address", "sale_date"))


@register(
    "sort_limit",
    oracle("menu", select="SELECT product_id, product_name, price FROM menu ORDER BY price DESC NULLS LAST, product_id LIMIT 5"),
)
def _(b):
    return cleaning.sort_limit(b["menu"], "price", 5, "product_id")


@register(
    "values_table",
    "SELECT v.priority_code, v.label, count(*) AS orders FROM orders o JOIN (VALUES ('1', 'rush'), ('2', 'soon'), "
    "('3', 'normal')) v(priority_code, label) ON substr(o.o_orderpriority, 1, 1) = v.priority_code GROUP BY 1, 2",
)
def _(b):
    labels = values_table(
        b.spark,
        [("1", "rush"), ("2", "soon"), ("3", "normal")],
        "priority_code string, label string",
    )
    coded = b["orders"].select(F.substring("o_orderpriority", 1, 1).alias("priority_code"))
    return coded.join(labels, "priority_code").groupBy("priority_code", "label").agg(
        F.count("*").alias("orders")
    )


# ---- provider panel ------------------------------------------------------------

_ONE_YEAR = "FROM providers WHERE smry_ctgry = 'PROVIDER'"
_PANEL = {
    "panel": "SELECT * FROM panel_years WHERE prvdr_id IN (SELECT prvdr_id FROM panel_years GROUP BY 1 "
    "HAVING count(DISTINCT year) = 5)"
}


@register(
    "summary_category_counts",
    oracle("providers", select="SELECT smry_ctgry, count(*) AS row_count FROM providers GROUP BY 1"),
)
def _(b):
    return providers.summary_category_counts(b["providers"])


@register(
    "payment_summary",
    oracle("providers", select="SELECT count(pymt) AS provider_count, round(avg(pymt), 6) AS mean_pymt, "
           "round(stddev_samp(pymt), 6) AS std_pymt, round(min(pymt), 6) AS min_pymt, "
           + ", ".join(f"round(quantile_cont(pymt, {q}), 6) AS {n}" for q, n in ((0.25, "p25_pymt"), (0.5, "median_pymt"), (0.75, "p75_pymt")))
           + f", round(max(pymt), 6) AS max_pymt {_ONE_YEAR}"),
)
def _(b):
    return providers.payment_summary(b["providers"], digits=6)


@register(
    "top_bottom_groups",
    oracle("providers", steps={
        "means": f"SELECT state, count(*) AS provider_count, round(avg(pymt), 6) AS mean_pymt {_ONE_YEAR} GROUP BY 1",
        "ranked": "SELECT *, row_number() OVER (ORDER BY mean_pymt, state) AS low, "
                  "row_number() OVER (ORDER BY mean_pymt DESC, state) AS high FROM means",
    }, select="SELECT state, provider_count, mean_pymt, CASE WHEN low <= 5 THEN 'Bottom 5' ELSE 'Top 5' END AS category "
              "FROM ranked WHERE low <= 5 OR high <= 5"),
)
def _(b):
    return providers.top_bottom_groups(b["providers"], digits=6)


_DUAL = "CASE WHEN try_cast(bene_dual_pct AS DOUBLE) >= 50 THEN 'High Dual (>= 50%)' ELSE 'Low Dual (< 50%)' END AS dual_category"
_PUBLISHED = f"{_ONE_YEAR} AND pymt IS NOT NULL AND try_cast(bene_dual_pct AS DOUBLE) IS NOT NULL"


@register("suppressed_category", oracle("providers", select=f"SELECT *, {_DUAL} {_PUBLISHED}"))
def _(b):
    return providers.suppressed_category(b["providers"])


@register(
    "dual_comparison",
    oracle("providers", select=f"SELECT {_DUAL}, count(*) AS provider_count, round(avg(pymt), 6) AS mean_pymt, "
           f"round(stddev_samp(pymt), 6) AS std_pymt {_PUBLISHED} GROUP BY 1"),
)
def _(b):
    return providers.dual_comparison(b["providers"], digits=6)


@register(
    "suppression_share",
    oracle("providers", select="SELECT count(*) AS total_providers, count(*) FILTER (WHERE try_cast(bene_dual_pct AS DOUBLE) IS NULL) "
           "AS suppressed, round(100e0 * count(*) FILTER (WHERE try_cast(bene_dual_pct AS DOUBLE) IS NULL) / count(*), 1) "
           f"AS suppressed_pct {_ONE_YEAR}"),
)
def _(b):
    return providers.suppression_share(b["providers"])


@register("rows_by_year", oracle("providers", select="SELECT year, count(*) AS provider_rows FROM providers GROUP BY 1"))
def _(b):
    return providers.rows_by_year(b["providers"])


@register("join_semi_balanced", oracle("panel_years", steps=_PANEL, select="SELECT * FROM panel"))
def _(b):
    return providers.join_semi_balanced(b["panel_years"])


@register("panel_size", oracle("panel_years", steps=_PANEL, select="SELECT count(DISTINCT prvdr_id) AS providers FROM panel"))
def _(b):
    return providers.panel_size(providers.join_semi_balanced(b["panel_years"]))


@register(
    "panel_balance_check",
    oracle("panel_years", steps=_PANEL, select="SELECT year, count(DISTINCT prvdr_id) AS providers FROM panel GROUP BY 1"),
)
def _(b):
    return providers.panel_balance_check(providers.join_semi_balanced(b["panel_years"]))


@register(
    "payment_trend",
    oracle("panel_years", steps=_PANEL, select="SELECT year, count(*) AS providers, round(avg(pymt), 6) AS mean_pymt "
           "FROM panel WHERE pymt IS NOT NULL GROUP BY 1"),
)
def _(b):
    return providers.payment_trend(providers.join_semi_balanced(b["panel_years"]), digits=6)


@register(
    "union_all_years",
    oracle("providers", select="SELECT prvdr_id, state, smry_ctgry, pymt, year FROM providers WHERE smry_ctgry = 'PROVIDER'"),
)
def _(b):
    frame = b["providers"]
    years = sorted(r["year"] for r in frame.select("year").distinct().collect())
    yearly = {y: frame.where(F.col("year") == y).drop("year") for y in years}
    return providers.union_all_years(yearly, ("prvdr_id", "state", "smry_ctgry", "pymt"))


_NULL_KEYS = ("prvdr_id", "state", "pymt", "bene_dual_pct")


@register(
    "null_key_check",
    oracle("providers", select="SELECT count(*) AS total_rows, "
           + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in _NULL_KEYS) + f" {_ONE_YEAR}"),
)
def _(b):
    return providers.null_key_check(b["providers"], _NULL_KEYS)


_REPEATED = f"SELECT prvdr_id, count(*) AS occurrences {_ONE_YEAR} GROUP BY 1 HAVING count(*) > 1"


@register("duplicate_key_check", oracle("providers", select=_REPEATED))
def _(b):
    return providers.duplicate_key_check(b["providers"], "prvdr_id")


@register("duplicate_ids_top10", oracle("providers", select=f"{_REPEATED} ORDER BY 2 DESC, 1 LIMIT 10"))
def _(b):
    return providers.duplicate_ids_top10(b["providers"], "prvdr_id")
