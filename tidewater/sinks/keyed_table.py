"""A keyed table on plain parquet files: last write per key wins, and a
replayed micro-batch changes nothing.

Spark's file sinks only append, and no table format with MERGE is assumed to be
present.  The table is two folders that Spark writes and reads as partitioned tables:

    <path>/segments/seg_writer=<w>/seg_batch=<b>/part-*     one per batch
    <path>/base/base_bucket=<k>/base_version=<v>/part-*     keys of one hash bucket

* `upsert(df, b)` keeps the last row per key of the batch and writes it to the
  batch's own partition (dynamic partition overwrite): Spark puts the finished
  folder in place as a whole, and a replay replaces it.  Other writers' and other
  batches' folders are not touched, so there is no log to keep.
* `current()` is base and segments together, reduced to the last row per key by the
  envelope order, e.g. `(timestamp, partition, offset)`.  Batch, writer and version
  are no part of the order, so it does not matter how input was cut into batches,
  and a row that stands in two folders is the same row.
* `compact()` folds the segments into the base, bucket by bucket
  (`pmod(xxhash64(key), buckets)`): only buckets that the segments touch are read
  and written, as a new version beside the old one.  Once Spark has committed it, the
  folded segments and the old versions of those buckets are deleted.  A crash at any
  point leaves rows twice, never none, and the next compaction clears them away.

One compaction at a time; writers may go on meanwhile.  A frame from `current()`
names files, so evaluate it before a compaction, or `catalog.publish_view` it.

When a table format with MERGE INTO is available, `upsert` is the one
function to replace.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.keyed import latest_per_key

BUCKETS = 64  # hash buckets of a new base; about one per GB of the table
#: What Spark reports for a folder that is not there yet, or that holds no file any more.
NOTHING_YET = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class KeyedTable:
    """`history=True` keeps every segment, so that `snapshot(before=b)` can go back;
    such a table is not compacted."""

    def __init__(self, spark: SparkSession, path: str, key: str | Sequence[str],
                 order: Sequence[str], buckets: int = BUCKETS, history: bool = False):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = [key] if isinstance(key, str) else list(key)
        self.order = list(order)
        self.buckets, self.history = buckets, history

    # -- writing ---------------------------------------------------------
    def upsert(self, df: DataFrame, batch_id: int | None = None, writer: str = "") -> None:
        """Write one batch.  (writer, batch_id) identifies it: only a replay by the
        same writer replaces it.  A streaming query passes its checkpoint as the
        writer; a one-off write leaves `batch_id` out and gets a writer of its own."""
        if batch_id is None:
            writer, batch_id = "once-" + uuid.uuid4().hex, 0
        rows = latest_per_key(df, self.key, self.order)
        # the prefix keeps a writer of digits a text when Spark reads the folder's name
        rows = rows.withColumn("seg_writer", F.lit(f"w-{writer}")).withColumn("seg_batch", F.lit(int(batch_id)))
        self._write(rows, "overwrite", "segments", ["seg_writer", "seg_batch"])

    def compact(self) -> None:
        """Fold the segments written so far into the base."""
        segments = [] if self.history else self._segment_folders()
        if not segments:
            return
        rows = (self.spark.read.option("basePath", f"{self.path}/segments").parquet(*segments)
                .drop("seg_writer", "seg_batch"))
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        touched = rows.select(bucket.alias("base_bucket")).distinct()
        base = self._read("base")
        if base is not None:  # Spark prunes the other buckets' folders by the joined values
            old = base.join(touched, "base_bucket", "left_semi").drop("base_bucket", "base_version")
            rows = old.unionByName(rows)
        version = 1 + max((v for vs in self._base_versions().values() for v in vs), default=0)
        merged = (latest_per_key(rows, self.key, self.order)
                  .withColumn("base_bucket", bucket).withColumn("base_version", F.lit(version)))
        self._write(merged.repartition("base_bucket"), "append", "base", ["base_bucket", "base_version"])
        for k, versions in self._base_versions().items():
            if version in versions:
                for v in versions - {version}:
                    self._delete(f"{self.path}/base/base_bucket={k}/base_version={v}")
        for folder in segments:
            self._delete(folder)

    def _write(self, rows: DataFrame, mode: str, part: str, by: list[str]) -> None:
        (rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by)
            .parquet(f"{self.path}/{part}"))

    # -- folders (names only; the rows stay with Spark) ---------------------
    def _store(self, path: str):
        """Spark's own file system for `path`."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _folders(self, path: str) -> list[str]:
        store, at = self._store(path)
        if not store.exists(at):
            return []
        return [s.getPath().getName() for s in store.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]

    def _delete(self, path: str) -> None:
        store, at = self._store(path)
        store.delete(at, True)

    def _segment_folders(self) -> list[str]:
        root = f"{self.path}/segments"
        return [f"{root}/{w}/{b}" for w in self._folders(root) for b in self._folders(f"{root}/{w}")]

    def _base_versions(self) -> dict[int, set[int]]:
        root = f"{self.path}/base"
        return {int(k.split("=")[1]): {int(v.split("=")[1]) for v in self._folders(f"{root}/{k}")} for k in self._folders(root)}

    def written(self) -> list:
        """(batch, writer) of the segments."""
        names = [f.rsplit("/", 2)[1:] for f in self._segment_folders()]
        return [(int(b.split("=")[1]), unquote(w.split("=", 1)[1]).removeprefix("w-")) for w, b in names]

    # -- reading ---------------------------------------------------------
    def _read(self, part: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{part}")
        except AnalysisException as e:  # nothing there; any other failure is one
            if e.getCondition() in NOTHING_YET:
                return None
            raise

    def snapshot(self, before: int | None = None) -> DataFrame | None:
        """The table as of now, or with `before=b` (tables with history) as it was
        before batch `b`.  None when nothing is written yet."""
        if before is not None and not self.history:
            raise ValueError("only a table with history can go back")
        base, segments = self._read("base"), self._read("segments")
        if before is not None and segments is not None:
            if not any(b < before for b, _ in self.written()):
                return None
            segments = segments.where(F.col("seg_batch") < before)
        parts = [df.drop("base_bucket", "base_version", "seg_writer", "seg_batch") for df in (base, segments) if df is not None]
        if not parts:
            return None
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return latest_per_key(rows, self.key, self.order)

    def current(self, before: int | None = None) -> DataFrame:
        view = self.snapshot(before)
        if view is None:
            raise ValueError(f"keyed table at {self.path} has nothing written"
                             + ("" if before is None else f" before batch {before}"))
        return view


def writer_of(checkpoint: str) -> str:
    """The writer id of a streaming query: fixed by its checkpoint."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()


def write_dead_letters(rejected: DataFrame, path: str, batch_id: int, writer: str = "") -> None:
    """Dead-letter rows of one batch; overwriting the folder of (writer, batch)
    makes a replay idempotent and leaves other writers' rows alone."""
    rejected.write.mode("overwrite").parquet(f"{path.rstrip('/')}/writer={writer or 'none'}/batch={int(batch_id)}")


def write_split(decoded: DataFrame, table: KeyedTable, dead_letter_path: str,
                batch_id: int, columns: Sequence[str], writer: str = "") -> None:
    """Route one decoded batch: accepted rows to the keyed table, rejected
    ones to the dead-letter folder.  The batch is persisted, and the first write
    materialises it before the second one reads it."""
    from tidewater.operators.decode import rejected

    decoded.persist()
    try:
        good = decoded.where(F.col("reject_reason").isNull()).select(*columns)
        table.upsert(good, batch_id, writer)
        write_dead_letters(rejected(decoded), dead_letter_path, batch_id, writer)
    finally:
        decoded.unpersist()
