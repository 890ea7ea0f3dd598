"""Writing tables, samples, reports and fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from paygrain.functions.dates import transaction_date
from paygrain.session import materialise

ROWS_PER_FILE = 250_000
CLUSTER_BY = ["merchant_id", "customer_id", "transaction_status"]


def write_table(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_parts(table: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Part files of at most ``rows_per_file`` rows; earlier parts are replaced."""
    (
        table.write.mode("overwrite")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def write_fact(
    fact: DataFrame,
    path: str,
    cluster_by: list[str] | None = None,
    rows_per_file: int = 0,
    replace: str = "days",
) -> None:
    """The fact table partitioned by day and sorted within files.

    The rebalance hint brings a day's rows together and lets AQE split a busy day, and merge
    quiet ones, to tasks of ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: that is the size
    of a file before encoding. ``rows_per_file`` limits the rows of a file as well (0: no limit).
    ``replace`` is ``days``, which leaves days alone that ``fact`` does not have, or ``table``.
    """
    if replace not in ("days", "table"):
        raise ValueError("replace is 'days' or 'table'")
    dated = fact.withColumn("transaction_date", transaction_date(fact))
    (
        dated.hint("rebalance", "transaction_date")
        .sortWithinPartitions("transaction_date", *(cluster_by or CLUSTER_BY))
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", rows_per_file)
        .option("partitionOverwriteMode", "dynamic" if replace == "days" else "static")
        .partitionBy("transaction_date")
        .parquet(path)
    )


def write_sample(table: DataFrame, key: str, n: int, path: str) -> None:
    """The first ``n`` rows by key as CSV with a header."""
    table.orderBy(key).limit(n).write.mode("overwrite").option("header", True).csv(path)


def write_report(table: DataFrame, path: str, kind: str = "json") -> None:
    """A small result table as one JSON or CSV file.

    The result is computed by as many tasks as it takes and stored; one task then writes it.
    """
    writer = materialise(table).coalesce(1).write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
