"""Calendar expressions over the payment timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def transaction_date(fact: DataFrame) -> Column:
    """The day of the payment; the physical partition column when the table has one, so that
    date filters prune partitions."""
    if "transaction_date" in fact.columns:
        return F.col("transaction_date")
    return F.to_date("transaction_timestamp").alias("transaction_date")


def transaction_month(fact: DataFrame) -> Column:
    return F.trunc(transaction_date(fact), "MM").alias("month")


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def month_word(day: Column) -> Column:
    """Number of the 64-month word that holds the month of ``day``."""
    return F.floor(_month_number(day) / 64)


def month_bit(day: Column) -> Column:
    """The month's bit in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(_month_number(day), F.lit(64)))


def epoch_second(fact: DataFrame) -> Column:
    """Whole seconds since the epoch. A timestamp without a zone is taken as it stands, so that
    the session's zone and its clock changes do not move it."""
    stamp = F.col("transaction_timestamp")
    without_zone = isinstance(fact.schema["transaction_timestamp"].dataType, TimestampNTZType)
    if without_zone and fact.sparkSession.conf.get("spark.sql.session.timeZone") != "UTC":
        return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), stamp)
    return F.unix_timestamp(stamp)  # the same in UTC, and cheaper


def months_of_tenure(since: Column, reference: Column) -> Column:
    """Whole average months (30.4375 days) from ``since`` to ``reference``, never negative."""
    return F.greatest(F.lit(0), (F.datediff(reference, since) / F.lit(30.4375)).cast("int"))


def event_time(day: Column, hour: Column, minute: Column, second: Column) -> Column:
    clock = hour.cast("bigint") * 3600 + minute.cast("bigint") * 60 + second.cast("bigint")
    return F.timestamp_add("SECOND", clock, day.cast("timestamp_ntz"))
