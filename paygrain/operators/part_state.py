"""Validation that goes on from stored summaries of part files, and scans only files it has not seen.

A summary is one row per part file of figures that add up: the counts of the row rules, the report
measures, the range of ids and the number of repeated ones, and payments per reference whose value is
unknown. Summaries are appended to a Parquet table. A run lists the files, drops those whose
summary is there (same path, size, time of change, and the same dimension keys), summarises the
others, and makes the report from the summaries of the files that exist, so it equals the report of
a run over all files.

Defined cases: a file that was written again, or a change of a dimension's keys, makes a new summary,
and the old one is left unread; a file without rows is seen once and has no checks of its own; a
column that a file lacks is read as null, which the required fields report; summaries that two runs
wrote of one file count once. Checks per file are named by the last part of its path. The list of
new files, not their rows, goes through the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrain import check_names as names
from paygrain.functions.dates import transaction_date
from paygrain.functions.measures import additive_columns, roll_up
from paygrain.functions.money import ratio
from paygrain.operators import quality
from paygrain.operators.ordering import union_all
from paygrain.schema import FOREIGN_KEYS, table_schema
from paygrain.sources.tables import NANOS_AS_LONG, PART_GLOB, conform

FILE = ["path", "size", "changed"]  # what tells a file from a later one of the same name
RULES = ["nulls", "status", "reason", "amount", "loss", "digits", "time"]
SAME_KEYS = "same_keys"


def _references(dimensions: dict[str, DataFrame]) -> dict[str, tuple[str, str]]:
    """(table, key) of each reference whose table is given."""
    wanted = {**FOREIGN_KEYS, quality.CALENDAR: ("dim_date", "date")}
    return {label: where for label, where in wanted.items() if where[0] in dimensions}


def keys_mark(spark: SparkSession, dimensions: dict[str, DataFrame]) -> DataFrame:
    """One row that is the same as long as the dimensions have the same keys and attributes in use."""
    columns = {table: [key] for table, key in _references(dimensions).values()}
    for table, attribute in (("dim_merchant", "merchant_country"), ("dim_customer", "home_country")):
        if table in columns:
            columns[table].append(attribute)
    marks = [
        dimensions[table].agg(F.concat_ws(
            ":", F.lit(table), F.count(F.lit(1)), F.bit_xor(F.xxhash64(*used)), F.sum(F.xxhash64(*used).cast("decimal(38,0)"))
        ).alias("mark"))
        for table, used in sorted(columns.items())
    ]
    rows = union_all([*marks, spark.range(1).select(F.lit("").alias("mark"))])
    return rows.agg(F.md5(F.concat_ws(";", F.array_sort(F.collect_list("mark"))).cast("binary")).alias(SAME_KEYS))


def part_files(spark: SparkSession, directory: str, pattern: str = PART_GLOB) -> DataFrame:
    """(path, size, changed) of the part files; their contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    return listed.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def _unknown(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """(part, unknown): payments per reference whose value is null or not known, and wrong flags."""
    references = {
        label: (transaction_date(fact) if label == quality.CALENDAR else F.col(key), dimensions[table].select(key))
        for label, (table, key) in _references(dimensions).items()
    }
    found = [quality.unknown_values(fact, references, ["part"])] if references else []
    if {"dim_merchant", "dim_customer"} <= set(dimensions):
        wrong = quality.wrong_flags(fact, dimensions["dim_merchant"], dimensions["dim_customer"], ["part"])
        found.append(wrong.select("part", F.lit(names.CROSS_BORDER_RULE).alias("reference"), "n"))
    if not found:
        return fact.select("part").limit(0).withColumn("unknown", F.lit(None).cast("map<string,bigint>"))
    sums = union_all(found).groupBy("part", "reference").agg(F.sum("n").alias("n"))
    return sums.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("reference", "n"))).alias("unknown"))


def part_summaries(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """One row per value of the column ``part``; summaries of different rows of the fact unite by ``unionByName``."""
    figures = [c.alias(n) for n, c in quality.rule_counts().items()]
    ids = [F.min("transaction_id").alias("low"), F.max("transaction_id").alias("high")]
    counts = fact.groupBy("part").agg(*additive_columns(), *figures, *ids)
    repeated = fact.groupBy("part", "transaction_id").agg(F.count(F.lit(1)).alias("n")).groupBy("part")
    counts = counts.join(repeated.agg(F.sum(F.col("n") - 1).alias("extra")), "part")
    return counts.join(_unknown(fact, dimensions), "part", "left")


def _reference_rows(prefix: Column, dimensions: dict[str, DataFrame]) -> list[Column]:
    def count(label: str) -> Column:
        return F.coalesce(F.try_element_at("unknown", F.lit(label)), F.lit(0))

    rows = []
    for label, (_, key) in _references(dimensions).items():
        n = count(label)
        name, detail = (
            (names.DATES_IN_CALENDAR, "rows outside calendar=%d") if label == quality.CALENDAR
            else (f"{label} {names.FOREIGN_KEY}", f"rows with an unknown {key}: %d")
        )
        rows.append(quality.check_row(F.concat(prefix, F.lit(f": {name}")), n, F.format_string(detail, n)))
    if {"dim_merchant", "dim_customer"} <= set(dimensions):
        n = count(names.CROSS_BORDER_RULE)
        name = F.concat(prefix, F.lit(f": {names.CROSS_BORDER_RULE}"))
        rows.append(quality.check_row(name, n, F.format_string("rows with wrong flag=%d", n)))
    return rows


def totals(summaries: DataFrame) -> DataFrame:
    """The report measures of all parts in one row, from which ``quality`` and ``measures`` report."""
    bounds = [F.min("low").alias("low"), F.max("high").alias("high")]
    return roll_up(summaries, extra=bounds).withColumns({
        "rows": F.coalesce("n", F.lit(0)),
        "approval_rate": ratio("approved_n", "n"), "fraud_rate": ratio("fraud_n", "n"), "cross_border_rate": ratio("cross_n", "n"),
    })


def report(summaries: DataFrame, dimensions: dict[str, DataFrame], expected_rows: int | None = None) -> DataFrame:
    """All checks per part file, and those of the whole table, from the summaries."""
    parts = summaries.where("n > 0")
    per_part = quality.row_rule_rows(F.col("part")) + _reference_rows(F.col("part"), dimensions)
    whole = quality.total_rows(expected_rows) if expected_rows is not None else []
    return union_all([
        quality.rows_of(parts, per_part),
        quality.rows_of(quality.with_prior(parts), quality.part_key_rows()),
        quality.rows_of(totals(summaries), [*whole, *quality.plausibility_rows()]),
    ])


def stored(spark: SparkSession, state_dir: str) -> DataFrame | None:
    try:
        return spark.read.parquet(state_dir)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def seen_parts(spark: SparkSession, directory: str, state_dir: str, dimensions: dict[str, DataFrame], pattern: str = PART_GLOB) -> DataFrame:
    """The summaries of the files that exist; files without one are summarised first, and only they are read."""
    files = part_files(spark, directory, pattern).withColumn(SAME_KEYS, keys_mark(spark, dimensions).scalar())
    known = stored(spark, state_dir)
    same = [*FILE, SAME_KEYS]
    missing = files if known is None else files.join(known.select(same), same, "left_anti")
    paths = [row.path for row in missing.select("path").collect()]
    if paths:
        spark.conf.set(NANOS_AS_LONG, "true")
        rows = spark.read.option("mergeSchema", "true").parquet(*paths)
        declared = table_schema("fact_transactions")
        absent = {f.name: F.lit(None).cast(f.dataType) for f in declared.fields if f.name not in rows.columns}
        fact = conform(rows.withColumns(absent) if absent else rows, declared)
        found = part_summaries(fact.withColumn("part", _file_of_row()), dimensions).withColumnRenamed("part", "own")
        whole = missing.withColumn("part", _last("path")).join(found, _plain(F.col("path")) == F.col("own"), "left").drop("own")
        whole.fillna(0, subset=["n", *RULES, "extra"]).coalesce(1).write.mode("append").parquet(state_dir)
        known = spark.read.parquet(state_dir)
    if known is None:
        raise ValueError(f"no part files in {directory}")
    return known.dropDuplicates(same).join(files.select(same), same, "left_semi")


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def _file_of_row() -> Column:
    """The path of the file a row was read from. The scan gives an address, in which some characters are escaped."""
    return _plain(F.url_decode(F.regexp_replace("_metadata.file_path", "\\+", "%2B")))


def _last(path: str) -> Column:
    return F.element_at(F.split(F.col(path), "/"), -1)


def validate_parts(
    spark: SparkSession, directory: str, state_dir: str, dimensions: dict[str, DataFrame],
    expected_rows: int | None = None, pattern: str = PART_GLOB,
) -> DataFrame:
    """The report of all part files in a folder; files seen by an earlier run are not read again."""
    return report(seen_parts(spark, directory, state_dir, dimensions, pattern), dimensions, expected_rows)
