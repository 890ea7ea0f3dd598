"""Exact global ranks, positions and running totals without putting all rows into one task.

A window without PARTITION BY moves every row to a single task. Here Spark partitions the rows
by ranges of the sort key followed by a hash of the row, which cuts equal keys into as many
ranges as they need: a value held by a third of all rows does no harm. The rows are sorted inside
the ranges and stored so, once per order; a row's place is read from that layout, as the number of
its range and its number within. What the lower ranges add is worked out from one row per range and
joined to the rows as a small table. A rank is the smallest position of its key: keys that are there
more than once are grouped, which tasks combine, and joined to the rows. Only running totals
need a window, and with it a second shuffle, by range.

There is one path for every size. The number of ranges is that of the session's shuffle
partitions, of which adaptive execution merges the small ones, unless ``ranges`` is given.

Results are snapshots: placing the rows runs jobs when the function is called, and the placed
rows are kept in the checkpoint folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrain.session import materialise

RANGE, PLACE, OFFSET = "_range", "_place", "_offset"
RANGE_SHIFT = 33  # monotonically_increasing_id counts the rows of a partition in the lower 33 bits


def _laid_out(rows: DataFrame, order: list[Column], ranges: int | None) -> DataFrame:
    """``rows`` sorted by ranges, with the number of their range and their number in it, stored.

    Ranges are numbered in the order of their keys, rows from 1. One shuffle and one stored copy;
    the numbers are stored with the rows, so that a repeated task cannot number them anew.
    """
    spread = F.xxhash64(*rows.columns)
    parts = [] if ranges is None else [ranges]
    sorted_ = rows.repartitionByRange(*parts, *order, spread).sortWithinPartitions(*order, spread)
    number = F.monotonically_increasing_id()
    within = number.bitwiseAND(F.lit((1 << RANGE_SHIFT) - 1)) + 1
    return materialise(sorted_.withColumns({RANGE: F.shiftright(number, RANGE_SHIFT).cast("int"), PLACE: within}))


def _placed(rows: DataFrame, order: list[Column], ranges: int | None, made: dict[str, Column]) -> DataFrame:
    """``rows`` with the number of their range and the columns ``made`` in windows inside it, stored.

    Ranges hold at least one row and are numbered in the order of their keys.
    """
    spread = F.xxhash64(*rows.columns)
    parts = [] if ranges is None else [ranges]
    placed = rows.repartitionByRange(*parts, *order, spread).withColumn(RANGE, F.spark_partition_id())
    # Stored before it is shuffled by range, so that a repeated task cannot number rows anew.
    return materialise(materialise(placed).withColumns(made))


def _with_offsets(rows: DataFrame, offsets: dict[int, tuple], names: list[str]) -> DataFrame:
    """Join figures per range; their table has one row per shuffle partition at most."""
    kinds = ", ".join(f"{name} bigint" for name in names)
    table = rows.sparkSession.createDataFrame(
        [(number, *values) for number, values in offsets.items()], f"{RANGE} int, {kinds}"
    )
    return rows.join(F.broadcast(table), RANGE)


def _inside(order: list[Column]) -> Window:
    return Window.partitionBy(RANGE).orderBy(*order)


def _running(found: list, out: str) -> dict[int, int]:
    """Total of all ranges below each range."""
    offsets, total = {}, 0
    for row in found:
        offsets[row[RANGE]] = total
        total += row[out] or 0
    return offsets


def _per_range(rows: DataFrame, *totals: Column) -> list:
    return rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n"), *totals).orderBy(RANGE).collect()


def with_global_ranks(
    rows: DataFrame, orders: dict[str, list[Column]], ranges: int | None = None
) -> tuple[DataFrame, int]:
    """Add one ``rank()`` column per entry of ``orders`` and return it with the row count.

    An order is a list of columns to sort ascending, nulls first; equal keys share the lowest
    rank.
    """
    n = None
    for name, order in orders.items():
        rows, n = with_positions(rows, order, name, ranges)
        # Keys that several rows have, with the smallest position; equality as in sorting.
        keys = {f"_key{i}": column for i, column in enumerate(order)}
        first = rows.select(*(column.alias(key) for key, column in keys.items()), F.col(name).alias("_at"))
        first = first.groupBy(*keys).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        first = first.where("_n > 1").drop("_n")
        same = reduce(lambda a, b: a & b, [column.eqNullSafe(F.col(key)) for key, column in keys.items()])
        rows = rows.join(first, same, "left").withColumn(name, F.coalesce("_first", name)).drop("_first", *keys)
    return rows, rows.count() if n is None else n


def with_positions(
    rows: DataFrame, order: list[Column], name: str, ranges: int | None = None
) -> tuple[DataFrame, int]:
    """Add the 1-based position of every row in the given order; equal keys go by a hash of the row."""
    placed = _laid_out(rows, order, ranges)
    found = _per_range(placed)
    offsets = {number: (total,) for number, total in _running(found, "_n").items()}
    positioned = _with_offsets(placed, offsets, [OFFSET]).withColumn(name, F.col(PLACE) + F.col(OFFSET))
    return positioned.drop(RANGE, PLACE, OFFSET), sum(row["_n"] for row in found)


def keys_at(rows: DataFrame, order: list[Column], positions: list[int], ranges: int | None = None) -> list:
    """The sort keys at the given 1-based positions of the sorted rows, one per position.

    A position beyond the last row has the last key. Only the rows at the positions are returned.
    """
    key = F.struct(*[column.alias(f"k{i}") for i, column in enumerate(order)])
    # Equal keys are interchangeable here, so a number of the row spreads them as well as a hash.
    keyed = rows.select(key.alias("key"), F.monotonically_increasing_id().alias("_row"))
    placed = _laid_out(keyed, [F.col("key")[f"k{i}"] for i in range(len(order))], ranges)
    found = _per_range(placed)
    below, n = _running(found, "_n"), sum(row["_n"] for row in found)
    place = {p: max(r for r, total in below.items() if total < min(p, n)) for p in positions}
    wanted = [(F.col(RANGE) == r) & (F.col(PLACE) == min(p, n) - below[r]) for p, r in place.items()]
    hits = placed.where(reduce(lambda left, right: left | right, wanted)).collect() if wanted else []
    located = {(hit[RANGE], hit[PLACE]): hit["key"] for hit in hits}
    return [located[place[p], min(p, n) - below[place[p]]] for p in positions]


def with_running_totals(
    rows: DataFrame, order: list[Column], totals: dict[str, str], ranges: int | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Add inclusive running sums of bigint columns over rows with distinct sort keys.

    ``totals`` maps a new column to the column it accumulates. Also returns the grand totals.
    """
    window = _inside(order).rowsBetween(Window.unboundedPreceding, 0)
    placed = _placed(rows, order, ranges, {out: F.sum(column).over(window) for out, column in totals.items()})
    found = _per_range(placed, *[F.sum(column).alias(out) for out, column in totals.items()])
    names = {out: f"_{out}" for out in totals}
    below = {out: _running(found, out) for out in totals}
    offsets = {row[RANGE]: tuple(below[out][row[RANGE]] for out in totals) for row in found}
    summed = _with_offsets(placed, offsets, list(names.values()))
    summed = summed.withColumns({out: F.col(out) + F.col(offset) for out, offset in names.items()})
    return summed.drop(RANGE, *names.values()), {out: sum(row[out] or 0 for row in found) for out in totals}


def percent_rank(rank: str, n: int) -> Column:
    """(rank - 1) / (n - 1); zero for a single row."""
    if n <= 1:
        return F.lit(0.0)
    return (F.col(rank) - 1) / F.lit(n - 1)


def ntile(rank: str, n: int, tiles: int) -> Column:
    """Tile of a unique rank; the first ``n % tiles`` tiles hold one row more."""
    size, larger = divmod(n, tiles)
    if size == 0:
        return F.col(rank).cast("int")
    position = F.col(rank) - 1
    in_larger = larger * (size + 1)
    head = F.floor(position / (size + 1))
    tail = larger + F.floor((position - in_larger) / size)
    return (F.when(position < in_larger, head).otherwise(tail) + 1).cast("int")


def dense_ids(
    rows: DataFrame, order: list[Column], start: int = 1, name: str = "dense_id", ranges: int | None = None
) -> DataFrame:
    """Contiguous ids from ``start`` in the given order; equal keys go by a hash of the row."""
    positioned, _ = with_positions(rows, order, name, ranges)
    return positioned.withColumn(name, F.col(name) + (start - 1))


def share_of_total(rows: DataFrame, column: str | Column, name: str) -> DataFrame:
    """Add each row's share of the column total; the total is a scalar subquery."""
    value = F.col(column) if isinstance(column, str) else column
    total = rows.agg(F.sum(value)).scalar()
    return rows.withColumn(name, F.try_divide(value, total))


def share_of_few(rows: DataFrame, column: str | Column, name: str) -> DataFrame:
    """The same for a result of few rows (one per category or day): a window over all of them
    reads the rows once, where a subquery would compute what they come from a second time."""
    value = F.col(column) if isinstance(column, str) else column
    return rows.withColumn(name, F.try_divide(value, F.sum(value).over(Window.partitionBy())))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), frames)
