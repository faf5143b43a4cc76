"""Dates, terms and billing schedules. The clock is always an argument."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from brasstally.functions.text import _col, strip

# Last month of the first and the second term band.
BAND_LIMITS = (("Y1", 17), ("Y2", 29))
LAST_BAND = "Y3"

# Schedule families, the words that select them, in order of precedence.
SCHEDULE_WORDS = (
    ("Semi-Annual", ("SEMI", "HALF")),
    ("Quarterly", ("QUARTER",)),
    ("Annual", ("ANNUAL", "UPFRONT", "UP FRONT")),
    ("Monthly", ("MONTH",)),
)
SCHEDULE_YEARS = 3
SCHEDULE_REVIEW = "REVIEW NEEDED"
SCENARIO_ONE_YEAR = "Scenario 1: 1 Year"
SCENARIO_MULTI_YEAR = "Scenario 2: Multi-Year"
SCENARIO_OTHER = "Scenario 3: Non-Standard"
SCENARIO_NO_DATES = "Invalid/Missing Dates"


def stamp(moment: datetime | str) -> Column:
    """Zone-free timestamp literal."""
    return F.to_timestamp_ntz(F.lit(str(moment)))


def cutoff(as_of: datetime, window: timedelta) -> Column:
    return stamp(as_of - window)


def day(value: date | datetime | str) -> Column:
    return F.to_date(F.lit(str(value)[:10]))


def parse_date(c: Column | str) -> Column:
    """Date in the first ten characters of an ISO string; null when there is none."""
    found = F.try_to_date(F.substring(_col(c), 1, 10), "yyyy-M-d")
    return F.when(F.year(found) > 0, found)


def as_date(c: Column | str) -> Column:
    """Day of a date, a timestamp or ISO text; null for text that is none."""
    return _col(c).try_cast("date")


def month_start(c: Column | str) -> Column:
    return F.trunc(as_date(c), "month")


def month_diff(start: Column | str, end: Column | str) -> Column:
    """Calendar months between two dates, whatever the days."""
    start, end = _col(start), _col(end)
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def term_months(start: Column | str, end: Column | str) -> Column:
    """Whole months, a part counting as one; month ends meet; 0 if the end comes first."""
    start, end = _col(start), _col(end)
    part = F.when(F.dayofmonth(end) > F.dayofmonth(start), 1).otherwise(0)
    return F.when(end < start, 0).otherwise(month_diff(start, end) + part)


def term_band(months: Column | str) -> Column:
    """Band of a term; no term, no band."""
    months = _col(months)
    band = F.when(months.isNull(), F.lit(None).cast("string"))
    for name, last in BAND_LIMITS:
        band = band.when(months <= last, name)
    return band.otherwise(LAST_BAND)


def us_date(c: Column | str) -> Column:
    return F.date_format(_col(c), "MM/dd/yyyy")


def schedule_family(frequency: Column | str) -> Column:
    """Family named by a free-typed billing frequency, null when none is."""
    text = F.replace(F.upper(strip(F.coalesce(_col(frequency), F.lit("")))), F.lit("_"), F.lit(" "))
    family = F.when(F.lit(False), "")
    for name, words in SCHEDULE_WORDS:
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        family = family.when(hit, name)
    return family


def with_billing_schedule(
    df: DataFrame, frequency: Column | str, contract_start: Column | str, service_start: Column | str
) -> DataFrame:
    """Adds the suggested schedule, its contract year (from 0), the scenario and a review flag.

    Family and month count are columns of their own first, so that the labels
    built from them do not repeat the text matching.
    """
    staged = df.withColumns(
        {"_family": schedule_family(frequency), "_months": month_diff(contract_start, service_start)}
    ).withColumn("_year", F.when(F.col("_months") >= 0, F.floor(F.col("_months") / 12).cast("int")))
    year, family = F.col("_year"), F.col("_family")
    mapped = family.isNotNull() & F.coalesce(year.between(0, SCHEDULE_YEARS - 1), F.lit(False))
    label = F.concat(family, F.lit(" - Yr "), (year + 1).cast("string"))
    return staged.withColumns(
        {
            "billing_schedule_suggested": F.when(mapped, label).otherwise(SCHEDULE_REVIEW),
            "billing_schedule_year_offset": year,
            "billing_schedule_scenario": F.when(F.col("_months").isNull(), SCENARIO_NO_DATES)
            .when(year == 0, SCENARIO_ONE_YEAR)
            .when(year.between(1, SCHEDULE_YEARS - 1), SCENARIO_MULTI_YEAR)
            .otherwise(SCENARIO_OTHER),
            "billing_schedule_needs_review": ~mapped,
        }
    ).drop("_family", "_months", "_year")
