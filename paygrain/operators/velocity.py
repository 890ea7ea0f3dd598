"""Trailing time windows per customer whose work is bounded however hot a customer is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrain.functions.dates import epoch_second
from paygrain.functions.money import as_double, fraction, units

SLICE_REACHES = 8  # slice length, in multiples of the longest window


def trailing_totals(fact: DataFrame, windows: dict[str, int]) -> DataFrame:
    """Count and USD value per customer and second over trailing windows, both ends inclusive.

    ``windows`` maps a suffix to a length in seconds. One output row per customer and second
    that has a payment: all payments of one second see the same window, so this is the finest
    grain there is.

    A customer's history is cut into slices of time. Each slice also receives the seconds
    from the end of the slice before that its windows reach back to. Payments are summed per
    second before they are moved, so a slice never holds more rows than it has seconds, even
    if one customer makes most of the payments.

    Inside a slice a window's total is the running sum up to now less the running sum up to
    just before the window: two frames that only ever grow, hence linear in the rows, where a
    moving frame would add up each window from its beginning. Sums are whole numbers, so
    the difference is exact.
    """
    reach = max(windows.values())
    slice_seconds = SLICE_REACHES * reach
    second = F.col("second")
    per_second = (
        fact.select("customer_id", epoch_second(fact).alias("second"), F.col("transaction_amount_usd").alias("usd"))
        .groupBy("customer_id", "second")
        .agg(
            F.count(F.lit(1)).alias("n"), F.count("usd").alias("valued"),
            F.coalesce(F.sum(units("usd")), F.lit(0)).alias("units"),
            F.coalesce(F.sum(fraction("usd")), F.lit(0)).alias("millionths"),
        )
    )
    own = F.floor(second / slice_seconds)
    needed_next = F.pmod(second, F.lit(slice_seconds)) >= slice_seconds - reach
    placed = per_second.withColumn(
        "slice", F.explode(F.when(needed_next, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    by_time = Window.partitionBy("customer_id", "slice").orderBy("second")
    start = Window.unboundedPreceding

    def within(column: str, length: int) -> Column:
        up_to_now = F.sum(column).over(by_time.rangeBetween(start, 0))
        before = F.sum(column).over(by_time.rangeBetween(start, -length - 1))
        # Payments without a time are one row per customer, in a slice of their own.
        return F.when(second.isNull(), F.col(column)).otherwise(up_to_now - F.coalesce(before, F.lit(0)))

    totals = {}
    for suffix, length in windows.items():
        totals[f"customer_transactions_{suffix}"] = within("n", length)
        totals[f"customer_value_usd_{suffix}"] = F.when(
            within("valued", length) > 0, as_double(within("units", length), within("millionths", length))
        )
    return (
        placed.withColumns(totals)
        .where(F.col("slice").eqNullSafe(own))
        .select("customer_id", "second", *totals)
    )


def with_trailing_totals(fact: DataFrame, windows: dict[str, int]) -> DataFrame:
    """Attach the trailing totals to every payment."""
    totals = trailing_totals(fact, windows)
    names = totals.columns[2:]
    totals = totals.withColumnsRenamed({"customer_id": "_customer", "second": "_second"})
    same = F.col("customer_id").eqNullSafe(F.col("_customer")) & epoch_second(fact).eqNullSafe(F.col("_second"))
    return fact.join(totals, same, "inner").select(*fact.columns, *names)
