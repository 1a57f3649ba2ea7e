"""Case, death and vaccination reports per location and day.

deaths(location, continent, date, population, total_cases, new_cases, total_deaths
text, new_deaths text), vacc(location, date, new_vaccinations text). Rows without a
continent are summary rows of the source and excluded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.scalar import ratio_pct


def _countries(deaths: DataFrame) -> DataFrame:
    return deaths.where(F.col("continent").isNotNull())


def _long(column: str) -> Column:
    return F.expr(f"try_cast({column} AS BIGINT)")


def select_star_where_order(df: DataFrame) -> DataFrame:
    return _countries(df).orderBy(*df.columns[:2])


def project_order(deaths: DataFrame) -> DataFrame:
    columns = ["location", "date", "total_cases", "new_cases", "total_deaths", "population"]
    return deaths.select(*columns).orderBy("location", "date")


def case_fatality_pct(deaths: DataFrame, pattern: str, digits: int = 3) -> DataFrame:
    """Deaths as a percentage of cases for matching names, whatever their case."""
    return (
        _countries(deaths)
        .where(F.col("location").ilike(pattern))
        .select(
            "location", "date", "total_cases", "total_deaths",
            ratio_pct(F.expr("try_cast(total_deaths AS DOUBLE)"), "total_cases", digits).alias("death_pct"),
        )
        .orderBy("location", "date")
    )


def infection_pct(deaths: DataFrame, pattern: str, digits: int = 3) -> DataFrame:
    return (
        _countries(deaths)
        .where(F.col("location").ilike(pattern))
        .select(
            "location", "date", "total_cases", "population",
            ratio_pct("total_cases", "population", digits).alias("infected_pct"),
        )
        .orderBy("location", "date")
    )


def infection_rate_rank(deaths: DataFrame, digits: int = 3) -> DataFrame:
    rate = F.try_divide(F.col("total_cases").cast("double"), F.col("population").cast("double"))
    return (
        _countries(deaths)
        .groupBy("location", "population")
        .agg(
            F.max("total_cases").alias("max_cases"),
            F.round(F.max(rate) * 100, digits).alias("infection_rate"),
        )
        .orderBy(F.desc_nulls_last("infection_rate"))
    )


def max_deaths_by(deaths: DataFrame, key: str) -> DataFrame:
    """Highest cumulative count per key; for continents that is one country's count."""
    return (
        _countries(deaths)
        .groupBy(key)
        .agg(F.max(_long("total_deaths")).alias("max_deaths"))
        .orderBy(F.desc_nulls_last("max_deaths"))
    )


def new_cases_by_date(deaths: DataFrame, digits: int = 3) -> DataFrame:
    cases, died = F.sum("new_cases"), F.sum(_long("new_deaths"))
    return (
        _countries(deaths)
        .groupBy("date")
        .agg(
            cases.alias("new_cases"),
            died.alias("new_deaths"),
            ratio_pct(died, cases, digits).alias("death_pct"),
        )
        .orderBy(F.desc_nulls_last("death_pct"))
    )


def join_inner_composite(deaths: DataFrame, vacc: DataFrame) -> DataFrame:
    """New vaccinations by location and day."""
    return (
        _countries(deaths)
        .join(vacc, ["location", "date"])
        .select("location", "date", "new_vaccinations")
        .orderBy("location", "date")
    )


def running_vaccinations(deaths: DataFrame, vacc: DataFrame) -> DataFrame:
    """Vaccinations up to and including each day, rows of the same day sharing a value.

    Days are summed first, so the window runs over one row per location and calendar
    day however many rows a location has; the totals return on the join's own key.
    """
    rows = (
        _countries(deaths)
        .join(vacc, ["location", "date"])
        .select("location", "date", "population", "new_vaccinations")
    )
    daily = rows.groupBy("location", "date").agg(F.sum(_long("new_vaccinations")).alias("_day"))
    upto = Window.partitionBy("location").orderBy("date")
    totals = daily.select(
        "location", "date", F.sum("_day").over(upto).alias("total_vaccinations")
    )
    return rows.join(totals, ["location", "date"])


def vaccination_pct(deaths: DataFrame, vacc: DataFrame, digits: int = 3) -> DataFrame:
    return running_vaccinations(deaths, vacc).withColumn(
        "vaccinated_pct", ratio_pct("total_vaccinations", "population", digits)
    )
