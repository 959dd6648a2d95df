"""Where intermediate tables live, and the size limits every join decision uses."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# A lookup side whose measured rows take at most so many bytes may be broadcast.
BROADCAST_BYTES = 32 << 20

# A key with more rows than this is more than a task should read: it is set apart.
HOT_ROWS = 1_000_000

# Rows to a file of a landed batch.  What follows then runs in as many tasks as the rows need, however few files
# or bytes the source had: the work on text columns grows with the rows, not with the compressed bytes.
FILE_ROWS = 50_000

# Session settings that suit these plans; pass them to the session builder.
SESSION_SETTINGS = {
    # Wide projections of text functions exceed what the JVM compiles as one method;
    # beyond this size Spark evaluates them as several methods, about twice as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python line of every column call makes building plans much slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master falls back to a temporary folder, because there the driver
    and the executors share one disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tidegate-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path for an intermediate table."""
    return f"{shared_dir(spark)}/tidegate-scratch/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """Write ``df`` once to the shared folder and return the stored table, ``file_rows`` rows to a file if given.

    Cuts lineage, so a lost executor re-reads files instead of recomputing the plan,
    several consumers do not repeat the work, and the optimizer sees the real size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").option("maxRecordsPerFile", file_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int = FILE_ROWS) -> DataFrame:
    """``df`` dealt out to tasks of so many rows, for work on its rows that costs more than moving them.

    A small file of many rows is one split, whose single task would otherwise do all of that work.
    """
    tasks = -(-df.count() // rows)
    return df if tasks < 2 else df.repartition(tasks)


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes in memory: the bytes of its texts and 8 for any other value."""
    sizes = []
    for field in df.schema:
        kind, value = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, (StructType, ArrayType, MapType)):
            value, kind = F.to_json(F.struct(value)), StringType()
        text = isinstance(kind, (StringType, BinaryType))
        sizes.append(F.coalesce(F.octet_length(value), F.lit(0)) if text else F.lit(8))
    return sum(sizes, F.lit(16)).cast("long")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the rows of ``df`` take at most ``BROADCAST_BYTES``.

    Each task sums up its own rows, so that one number per task is all that moves.
    """
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= BROADCAST_BYTES
