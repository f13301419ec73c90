"""US federal holidays from rules, generated for the years asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed-date holidays (name, month, day, first year).
FIXED_DATES = [
    ("New Year's Day", 1, 1, 1871),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, 1871),
    ("Veterans Day", 11, 11, 1978),
    ("Christmas Day", 12, 25, 1871),
]
# N-th weekday holidays (name, month, Monday = 0, n with -1 = last, first year).
NTH_WEEKDAYS = [
    ("Martin Luther King Jr. Day", 1, 0, 3, 1986),
    ("Washington's Birthday", 2, 0, 3, 1971),
    ("Memorial Day", 5, 0, -1, 1971),
    ("Labor Day", 9, 0, 1, 1894),
    ("Columbus Day", 10, 0, 2, 1971),
    ("Thanksgiving Day", 11, 3, 4, 1942),
]


def _nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    if n > 0:
        return F.date_add(first, (F.pmod(F.lit(weekday) - F.weekday(first), F.lit(7)) + 7 * (n - 1)).cast("int"))
    last = F.last_day(first)
    return F.date_sub(last, F.pmod(F.weekday(last) - F.lit(weekday), F.lit(7)).cast("int"))


def _observed(d: Column) -> Column:
    """Saturday moves to Friday, Sunday to Monday; null on weekdays."""
    return F.when(F.weekday(d) == 5, F.date_sub(d, 1)).when(F.weekday(d) == 6, F.date_add(d, 1))


def dim_holiday(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Holiday dates of the years, observed days included (a New Year's Saturday is observed the year before)."""
    year = F.col("y").cast("int")
    entries = []
    for name, month, day, since in FIXED_DATES:
        d = F.make_date(year, F.lit(month), F.lit(day))
        entries.append(F.struct(F.lit(name).alias("name"), F.when(year >= since, d).alias("d")))
        entries.append(
            F.struct(F.lit(f"{name} (observed)").alias("name"), F.when(year >= since, _observed(d)).alias("d"))
        )
    for name, month, weekday, n, since in NTH_WEEKDAYS:
        entries.append(
            F.struct(
                F.lit(name).alias("name"),
                F.when(year >= since, _nth_weekday(year, month, weekday, n)).alias("d"),
            )
        )
    years = spark.range(first_year, last_year + 2).withColumnRenamed("id", "y")
    return (
        years.select(F.explode(F.array(*entries)).alias("h"))
        .select(F.col("h.d").alias("holiday_date"), F.col("h.name").alias("holiday_name"))
        .filter(
            F.col("holiday_date").isNotNull()
            & F.year("holiday_date").between(first_year, last_year)
        )
    )


def is_holiday(date_sql: str) -> Column:
    """The same calendar as a predicate on one date: a map-only test, no join, no year range needed.

    A fixed date also counts on the Friday before it (Saturday holidays) and on the
    Monday after it (Sunday holidays). An n-th weekday is found by its week of the month.
    """
    d = f"({date_sql})"

    def on(day: str, month: int, dom: int, since: int) -> str:
        return f"(month({day}) = {month} and day({day}) = {dom} and year({day}) >= {since})"

    tests = []
    for _, month, dom, since in FIXED_DATES:
        tests += [
            on(d, month, dom, since),
            f"(weekday({d}) = 4 and {on(f'date_add({d}, 1)', month, dom, since)})",
            f"(weekday({d}) = 0 and {on(f'date_sub({d}, 1)', month, dom, since)})",
        ]
    for _, month, weekday, n, since in NTH_WEEKDAYS:
        place = f"(day({d}) + 6) div 7 = {n}" if n > 0 else f"day(last_day({d})) - day({d}) < 7"
        tests.append(
            f"(month({d}) = {month} and weekday({d}) = {weekday} and {place} and year({d}) >= {since})"
        )
    return F.expr(" or ".join(tests))
