"""Session defaults and the place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # AQE sizes shuffle partitions at run time and splits the oversized ones of a join.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join side is only broadcast when Spark has measured it below this size.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # A shuffled join builds hash maps instead of sorting the fact where every partition of the
    # smaller side turned out to fit.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Nanosecond timestamps, which pandas writes, are read as whole numbers and converted.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # Checkpoints that nothing refers to any more are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Rows that go to Python go in batches of bounded size, however long their texts are.
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
    "spark.ui.enabled": "false",
    # Column calls need not record where they were made.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


MEGABYTE = 1 << 20
SHUFFLED_SHARE = 0.5  # of the input, the most that a report's widest shuffle carries
PARTITION_BYTES = 256 * MEGABYTE
LEAST_PARTITIONS = 200


def sizing(input_bytes: int, partition_bytes: int = PARTITION_BYTES, scan_bytes: int = 128 * MEGABYTE) -> dict[str, str]:
    """Partition settings for a fact table of ``input_bytes``.

    A shuffle partition holds ``partition_bytes`` at most, which one task can sort in memory,
    whatever the size of the input; AQE merges what turns out smaller. ``scan_bytes`` is what a
    scan task reads: 512 MB make a fourth of the tasks of 128 MB, which helps beyond some 10 TB.
    """
    partitions = -(-int(input_bytes * SHUFFLED_SHARE) // partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(max(LEAST_PARTITIONS, partitions)),
        "spark.sql.files.maxPartitionBytes": f"{scan_bytes // MEGABYTE}m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    }


def build_session(
    app: str = "paygrain", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the defaults above; ``input_bytes`` sizes its partitions for the data."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = sizing(input_bytes) if input_bytes else {}
    for key, value in {**SETTINGS, **sized, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure ``DataFrame.checkpoint`` has a folder that every executor can reach.

    A cluster names one in ``spark.checkpoint.dir``. Only a local master, where driver and
    executors share one machine, falls back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return
    if context.getCheckpointDir() is not None:
        return
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="paygrain-checkpoint-"))


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and continue from the files.

    Used on aggregated tables that several jobs read, so that the fact table is scanned once
    and every job sees the same rows even when executors are lost in between.
    """
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet into the shared checkpoint folder and continue from the files.

    For what joins make of whole tables and several jobs then read: compressed, and each job reads
    only its columns. The files stay until the checkpoint folder is deleted.
    """
    use_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
