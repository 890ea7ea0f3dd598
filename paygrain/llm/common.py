"""What several operators share: words, first bindings, lookups that a hot key cannot slow down."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrain.session import use_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARACTERS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOOKUP_SALTS = 32


def documents(spark, directory: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/documents.parquet")


def text_of(column: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(column.cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lookup(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], salt_by: Sequence[str], salts: int = LOOKUP_SALTS
) -> DataFrame:
    """``rows`` left-joined to ``table`` (one row per key; null keys match nothing).

    Rows of one key are dealt to ``salts`` parts by a hash of ``salt_by``; the table is joined
    to the distinct (part, key) pairs first, so that each key is there once per part, and
    carried from there to the rows. No task sees more than one part of a key.
    """
    keys = list(keys)
    part = "__part"
    dealt = rows.withColumn(part, F.pmod(F.xxhash64(*salt_by), F.lit(salts)))
    pairs = dealt.select(part, *keys).distinct()
    found = pairs.join(table, keys)
    return dealt.join(found, [part, *keys], "left").drop(part)


def free_name(frame: DataFrame, wish: str) -> str:
    """``wish``, or a variant of it that ``frame`` does not have as a column."""
    taken = {c.lower() for c in frame.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


class Scratch:
    """Tables in a folder of their own beside the checkpoints, deleted when the block ends, on failure too.

    A frame read back from such a table starts anew: no lineage, and none of the constraints that
    the optimizer carries from one checkpoint to the next and that grow in loops.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        use_checkpoint_dir(spark)
        self.spark, self.made = spark, 0
        self.folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def table(self, frame: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.made}"
        self.made += 1
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def __exit__(self, *_: object) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
