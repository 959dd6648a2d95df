"""State kept between runs: load log, current state per entity, target rows, watermarks, decisions.

Every table lies in folders of Parquet files, one per commit and bucket of the key.  A manifest names the
folders that count.  A commit writes any number of tables and then adds one file to the manifest, so that all
of it is seen at once or not at all; folders that no manifest row names are left over from a run that
ended early and mean nothing.  A read of a batch's keys opens the folders of their buckets only.

Target rows and the log only grow.  The current state, what the next batch needs to know of an entity, is
replaced bucket by bucket: buckets without a changed entity keep their files.  One writer at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.conflict import apply_decisions
from tidegate.operators.load import backfill_log, log_history, target_ids
from tidegate.operators.watermark import current_watermark
from tidegate.runtime import fits_broadcast
from tidegate.schemas import CONFLICTS, CURRENT_STATE, LOAD_LOG, NONE, UPDATE, WATERMARK_STATE

BUCKETS = 16  # of a new store; choose more for a large one
MAX_FOLDERS = 16  # of a bucket; a commit that would add one more writes the bucket anew

_MANIFEST = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("folder", T.StringType()),
    T.StructField("added", T.BooleanType()),
    T.StructField("high", T.LongType()),
])


def read_or_empty(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """A stored table, or an empty one when nothing has been stored yet."""
    if not path:
        return empty_table(spark, schema)
    try:
        return spark.read.schema(schema).parquet(*([path] if isinstance(path, str) else path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, schema)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Known to be empty when a plan is made, so that what joins it falls away."""
    return spark.range(1).where("false").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


@dataclass
class Snapshot:
    """What the manifest says at one moment."""

    version: int
    folders: dict[str, dict[int, list[str]]]
    highs: dict[str, int]


@dataclass(frozen=True)
class StateStore:
    """``on_step`` is told the name of each write before it is made; tests of recovery raise from it."""

    spark: SparkSession
    root: str
    buckets: int = BUCKETS
    max_folders: int = MAX_FOLDERS
    on_step: Callable[[str], None] = field(default=lambda step: None)

    def manifest(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/manifest", _MANIFEST)

    def snapshot(self) -> Snapshot:
        """Current folders of every table: at most tables x buckets x ``max_folders`` names."""
        latest = self.manifest().groupBy("table", "bucket", "folder").agg(
            F.max_by("added", F.struct("version", "added")).alias("added"), F.min("version").alias("since"),
            F.max("version").alias("version"), F.max("high").alias("high"))
        # Of folders no longer in use only the greatest number given out, and the version, still count.
        rows = latest.groupBy("table", "bucket", F.when(F.col("added"), F.col("folder")).alias("folder")).agg(
            F.min("since").alias("since"), F.max("version").alias("version"), F.max("high").alias("high")).collect()
        folders: dict[str, dict[int, list[str]]] = {}
        highs: dict[str, int] = {}
        for r in sorted(rows, key=lambda r: r["since"]):
            if r["folder"] is not None:
                folders.setdefault(r["table"], {}).setdefault(r["bucket"], []).append(r["folder"])
            highs[r["table"]] = max(highs.get(r["table"], 0), r["high"] or 0)
        return Snapshot(max((r["version"] for r in rows), default=0), folders, highs)

    def published(self, batch_id: str) -> bool:
        """Whether a commit of this name is there; a repeated epoch of a stream has its first one's name."""
        return not self.manifest().where(F.col("batch_id") == batch_id).isEmpty()

    def bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.buckets)).cast("int")

    def buckets_of(self, keys: DataFrame, key: str) -> set[int]:
        """The buckets that a batch's keys fall into."""
        return {r[0] for r in keys.select(self.bucket(key)).distinct().collect()}

    def read(
        self, table: str, schema: T.StructType, buckets: Iterable[int] | None = None, at: Snapshot | None = None,
    ) -> DataFrame:
        """The table's rows, those of the given buckets only if some are given."""
        known = (at or self.snapshot()).folders.get(table, {})
        wanted = known if buckets is None else [b for b in known if b in set(buckets)]
        paths = [f"{self.root}/{table}/{folder}/_bucket={b}" for b in wanted for folder in known[b]]
        return read_or_empty(self.spark, paths, schema)

    def begin(self, batch_id: str) -> Commit:
        return Commit(self, batch_id, self.snapshot())

    def adopt(self, entity: str, log: DataFrame, target: DataFrame, schema: T.StructType, ref: str) -> None:
        """Start from an existing load log and target table, as one commit; both keep their numbers."""
        commit = self.begin(f"adopt-{entity}")
        rows = backfill_log(log).where(F.col("entity_type") == entity)
        existing = target_ids(target, ref)
        current = log_history(rows, entity).join(existing, "entity_id", "full_outer").select(
            "entity_id", F.coalesce("was_loaded", F.lit(False)).alias("was_loaded"), "last_id",
            F.coalesce("attempts", F.lit(0)).alias("attempts"), "existing_id", F.lit(None).cast("string").alias("last_hash"))
        commit.append("load_log", rows, "entity_id", LOAD_LOG, rows.agg(F.max("log_id")).first()[0])
        commit.append(f"target_{entity}", target, ref, schema, target.agg(F.max("id")).first()[0])
        commit.merge(f"current_{entity}", current, "entity_id", CURRENT_STATE)
        commit.publish()

    # Tables by name.

    def load_log(self) -> DataFrame:
        return backfill_log(self.read("load_log", LOAD_LOG))

    def watermarks(self) -> DataFrame:
        return self.read("watermarks", WATERMARK_STATE)

    def watermark(self, table_name: str) -> tuple[int, int]:
        """Current (last_upmj, last_upmt); zeros when the table was never synced."""
        asked = self.spark.range(1).select(F.lit(table_name).alias("table_name"))
        row = current_watermark(self.watermarks(), asked).first()
        return row["last_upmj"], row["last_upmt"]

    def append_watermark(self, rows: DataFrame) -> None:
        commit = self.begin(f"watermark-{uuid.uuid4()}")
        commit.append("watermarks", rows, "table_name", WATERMARK_STATE)
        commit.publish()

    def set_watermark(
        self, table_name: str, upmj: int, upmt: int, records: int, run_at: Column
    ) -> None:
        self.append_watermark(watermark_row(self.spark, table_name, (upmj, upmt), F.lit(records), run_at))

    def target(self, entity: str, schema: T.StructType) -> DataFrame:
        """Every stored version of the target rows; versions of a row share its id."""
        return self.read(f"target_{entity}", schema)

    def current_target(self, entity: str, schema: T.StructType, columns: Iterable[str] | None = None) -> DataFrame:
        """Latest version of each target row: its id and the ``columns`` asked for, else all; no others are moved."""
        rows = self.target(entity, schema)
        others = [c for c in columns or rows.columns if c != "id"]
        latest = F.max_by(F.struct(*others), F.col("version")).alias("_row")
        return rows.groupBy("id").agg(latest).select("id", *[f"_row.{c}" for c in others])

    def current(self, entity: str, buckets: Iterable[int] | None = None, at: Snapshot | None = None) -> DataFrame:
        """One row per entity id that a batch logged, loaded or found in the target."""
        return self.read(f"current_{entity}", CURRENT_STATE, buckets, at)

    def conflicts(self) -> DataFrame:
        """Decision on each row that a sync found in the target already."""
        return self.read("conflicts", CONFLICTS)


def watermark_row(
    spark: SparkSession, table_name: str, mark: tuple[int, int], records: Column, run_at: Column
) -> DataFrame:
    return spark.range(1).select(
        F.lit(table_name).alias("table_name"),
        F.lit(mark[0]).cast("bigint").alias("last_upmj"),
        F.lit(mark[1]).cast("bigint").alias("last_upmt"),
        run_at.cast("timestamp").alias("last_run_at"),
        records.cast("bigint").alias("records_synced"),
    )


class Commit:
    """Writes that become visible together, by ``publish``.  Never published, it leaves no trace to readers."""

    def __init__(self, store: StateStore, batch_id: str, at: Snapshot):
        self.store, self.batch_id, self.at = store, batch_id, at
        self._rows: list[tuple] = []

    def high(self, table: str) -> int:
        """Greatest number given out in the table by published commits."""
        return self.at.highs.get(table, 0)

    def _write(self, table: str, rows: DataFrame, key: str, schema: T.StructType, high: int | None) -> list[int]:
        store = self.store
        store.on_step(table)
        folder = uuid.uuid4().hex
        path = f"{store.root}/{table}/{folder}"
        shaped = rows.select(*schema.names).select("*", store.bucket(key).alias("_bucket"))
        # Few files for a small batch, while a large bucket is still written by many tasks.
        shaped.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(path)
        files = store.spark.read.schema(schema).parquet(path).inputFiles()
        written = sorted({int(b) for f in files for b in re.findall(r"/_bucket=(\d+)/", f)})
        self._rows += [(table, b, folder, True, high) for b in written]
        return written

    def append(
        self, table: str, rows: DataFrame, key: str, schema: T.StructType, high: int | None = None
    ) -> None:
        """Add rows.  ``high`` is the greatest number these rows were given, see ``high()``."""
        full = {b: f for b, f in self.at.folders.get(table, {}).items() if len(f) >= self.store.max_folders}
        touched = self.store.buckets_of(rows, key) & set(full) if full else set()
        if touched:
            rows = rows.select(*schema.names).unionByName(self.store.read(table, schema, touched, self.at))
        self._write(table, rows, key, schema, high)
        self._drop(table, touched)

    def replace(self, table: str, rows: DataFrame, key: str, schema: T.StructType, buckets: set[int]) -> None:
        """Make ``rows`` all that the given buckets hold; other buckets keep their files."""
        written = self._write(table, rows, key, schema, None)
        if not set(written) <= buckets:
            raise ValueError("rows outside the buckets to be replaced")
        self._drop(table, buckets)

    def _drop(self, table: str, buckets: Iterable[int]) -> None:
        known = self.at.folders.get(table, {})
        self._rows += [(table, b, folder, False, None) for b in buckets for folder in known.get(b, [])]

    def merge(self, table: str, changed: DataFrame, key: str, schema: T.StructType) -> set[int]:
        """Put ``changed``, one row per key, in place of the rows of the same keys; return the buckets rewritten."""
        touched = self.store.buckets_of(changed, key)
        if touched:
            keys = changed.select(key)
            old = self.store.read(table, schema, touched, self.at).join(
                F.broadcast(keys) if fits_broadcast(keys) else keys, key, "left_anti")
            self.replace(table, changed.select(*schema.names).unionByName(old), key, schema, touched)
        return touched

    def apply(self, table: str, decided: DataFrame, fields: list[str], ref: str, schema: T.StructType) -> set[int]:
        """Decisions on a stored target table, in the buckets that hold a row to create or update."""
        acting = decided.where(F.col("action").isin(NONE, UPDATE))
        touched = self.store.buckets_of(acting, "entity_id")
        if touched:
            old = self.store.read(table, schema, touched, self.at)
            self.replace(table, apply_decisions(acting, old, fields, ref), ref, schema, touched)
        return touched

    def publish(self) -> None:
        self.store.on_step("manifest")
        rows = [(self.at.version + 1, self.batch_id, *row) for row in self._rows]
        # A commit without rows is still known by its name.
        rows = rows or [(self.at.version + 1, self.batch_id, None, None, None, False, None)]
        self.store.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(
            f"{self.store.root}/manifest")
