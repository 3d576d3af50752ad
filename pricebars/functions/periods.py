"""Calendar arithmetic on DATE columns (time-zone free)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_start(timeframe: Column, date: Column) -> Column:
    """First day of the day / ISO week (Monday) / month / year that holds ``date``."""
    return (
        F.when(timeframe == "week", F.trunc(date, "week"))
        .when(timeframe == "month", F.trunc(date, "month"))
        .when(timeframe == "year", F.trunc(date, "year"))
        .otherwise(date)
    )


def project_date(timeframe: Column, last: Column, k: Column) -> Column:
    """The date ``k`` periods from ``last``; months and years land on their first day."""
    k = k.cast("int")
    return (
        F.when(timeframe == "week", F.date_add(last, k * 7))
        .when(timeframe == "month", F.add_months(F.trunc(last, "month"), k))
        .when(timeframe == "year", F.add_months(F.trunc(last, "year"), k * 12))
        .otherwise(F.date_add(last, k))
    )


def to_local(ts: Column, zone: str) -> Column:
    """Show a UTC instant as wall-clock time of ``zone``."""
    return F.from_utc_timestamp(ts, zone)
