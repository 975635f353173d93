"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every query relies on. They are set only where the session has not chosen its own value.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even if a later operator then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows take more memory than their compressed files; what is broadcast for its size passes through the driver.
    "spark.sql.sources.fileCompressionFactor": "8",
}
TUNED = "spark.martloom.tuned"


def tune(spark: SparkSession) -> SparkSession:
    """Fill in, once per session, the settings that still have Spark's default."""
    if spark.conf.get(TUNED, None) is None:
        chosen = {row["key"] for row in spark.sql("SET").collect()}
        for name, value in RUNTIME_SETTINGS.items():
            if name not in chosen:
                spark.conf.set(name, value)
        spark.conf.set(TUNED, "true")
    return spark


# What Spark takes rows of unknown size for is more than this.
UNKNOWN = 1 << 60


def scanned_bytes(*queries: DataFrame) -> int:
    """Size of the files that some queries read, as Spark listed them; 0 for those that do not read files."""
    found = 0
    for query in queries:
        leaves = query._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        found += sum(n for n in sizes if n < UNKNOWN)
    return int(found / float(queries[0].sparkSession.conf.get("spark.sql.sources.fileCompressionFactor")))


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Shuffled rows may take six times their compressed files, and some thirty times in a sort.
FINE_BYTES, FINE_PARTITIONS = 16 << 20, 1 << 11
BYTES_PER_PARTITION = 1 << 30


def stored_bytes(*tables: DataFrame) -> int:
    """Size of the files behind plain file scans, as Spark listed them."""
    sizes = [int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables]
    return int(sum(sizes) / float(tables[0].sparkSession.conf.get("spark.sql.sources.fileCompressionFactor")))


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Start shuffles with one partition per 16 MB of input files, up to 2,048, and from 2 TB on with one per GB; never with
    fewer than the session asks for.

    What one task sorts so stays the same up to 32 GB. Adaptive execution merges partitions that turn out small.
    """
    wanted = max(min(-(-input_bytes // FINE_BYTES), FINE_PARTITIONS), -(-input_bytes // BYTES_PER_PARTITION))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    spark.conf.set(INITIAL_PARTITIONS, str(partitions))
    return partitions


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new, empty folder every executor can reach.

    Clusters name the shared folder in ``spark.checkpoint.dir``. Only a local session, where all tasks share one
    machine, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="martloom-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(*sessions: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind: each job's are deleted when it ends, and not when the driver
    happens to collect garbage. For steps that follow one another and keep what they have found as stored rows."""
    with ExitStack() as after:
        for spark in sessions:
            after.callback(spark.conf.set, CLEANUP, spark.conf.get(CLEANUP))
            spark.conf.set(CLEANUP, "true")
        yield
