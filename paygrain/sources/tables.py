"""Reading tables and describing what was read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paygrain.operators.ordering import union_all
from paygrain.schema import TABLE_COLUMNS, table_schema

PART_GLOB = "*.parquet"
NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


class MissingTables(ValueError):
    """One or more input tables do not exist."""

    def __init__(self, names: Iterable[str]):
        self.names = sorted(names)
        super().__init__("Missing tables: " + ", ".join(self.names))


def _load(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Parquet files. Timestamps in nanoseconds, which Spark does not have, come as whole numbers.

    The setting for that has to hold until the rows are read, so it is left on.
    """
    spark.conf.set(NANOS_AS_LONG, "true")
    reader = spark.read if pattern is None else spark.read.option("pathGlobFilter", pattern)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingTables([path]) from error
        raise


def from_nanoseconds(column: Column) -> Column:
    """The time of no zone that is so many nanoseconds after 1970 began, to the microsecond."""
    micros = F.floor(column / F.lit(1000).cast("decimal(19,0)"))
    seconds = (micros.cast("decimal(19,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def conform(table: DataFrame, declared: T.StructType) -> DataFrame:
    """Bring the declared columns to their types; others stay as they are.

    A whole number where a timestamp is declared is a time in nanoseconds, of no zone.
    """
    wanted = {field.name: field.dataType.simpleString() for field in declared.fields}
    changed = {}
    for name, kind in table.dtypes:
        want = wanted.get(name, kind)
        if want.startswith("timestamp"):
            if kind == "bigint":
                changed[name] = from_nanoseconds(F.col(name))
        elif kind != want:
            changed[name] = F.col(name).cast(want)
    return table.withColumns(changed) if changed else table


def read_table(spark: SparkSession, source: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet path or the name of a registered table or view; a missing one is named."""
    if "/" in source:
        table = _load(spark, source)
    else:
        try:
            table = spark.table(source)
        except AnalysisException as error:
            if error.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
                raise MissingTables([source]) from error
            raise
    return table if schema is None else conform(table, schema)


def read_tables(spark: SparkSession, sources: dict[str, str]) -> dict[str, DataFrame]:
    """Read every table, or raise one error that names all the missing ones.

    Tables of the star schema, by name, are brought to their declared types.
    """
    found, missing = {}, []
    for name, source in sources.items():
        declared = table_schema(name) if name in TABLE_COLUMNS else None
        try:
            found[name] = read_table(spark, source, declared)
        except MissingTables:
            missing.append(name)
    if missing:
        raise MissingTables(missing)
    return found


def read_fact(spark: SparkSession, directory: str, pattern: str = PART_GLOB) -> DataFrame:
    """The part files of the fact table below ``directory`` that match ``pattern``."""
    return conform(_load(spark, directory, pattern), table_schema("fact_transactions"))


def with_part(table: DataFrame, name: str = "part") -> DataFrame:
    """Add the file a row was read from."""
    return table.withColumn(name, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def part_manifest(table: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows and first id of every part file."""
    return (
        with_part(table, "file")
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias(f"start_{key}"))
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, table in tables.items()
        ]
    ).orderBy("table_name")


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            table.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table_name"), "rows", F.lit(len(table.columns)).alias("columns")
            )
            for name, table in tables.items()
        ]
    )


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    for name, view in views.items():
        view.createOrReplaceTempView(name)


def drop_columns(table: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns that may or may not be there."""
    return table.drop(*names)


def describe_columns(table: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Column names and types, all or only those of ``names`` that exist."""
    rows = [(name, kind) for name, kind in table.dtypes if names is None or name in names]
    return table.sparkSession.createDataFrame(rows, "column_name string, data_type string")
