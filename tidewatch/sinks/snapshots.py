"""A small keyed table kept as one snapshot per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class SnapshotTable:
    """Snapshot N holds the table after batch N; repeating a batch rewrites the same snapshot."""

    def __init__(self, spark: SparkSession, base: str, keep: int = 2):
        self.spark = spark
        self.base = base.rstrip("/")
        self.keep = keep

    def _path(self, batch_id: int) -> str:
        return f"{self.base}/snapshot={batch_id:012d}"

    def _filesystem(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), root

    def batches(self) -> list[int]:
        """Ids of the complete snapshots, oldest first."""
        files, root = self._filesystem()
        if not files.exists(root):
            return []
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        found = []
        for status in files.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("snapshot=") and files.exists(path(status.getPath(), "_SUCCESS")):
                found.append(int(name.removeprefix("snapshot=")))
        return sorted(found)

    def read(self, before: int | None = None) -> DataFrame | None:
        """The newest snapshot, or the newest one older than batch `before`."""
        ids = [i for i in self.batches() if before is None or i < before]
        return self.spark.read.parquet(self._path(ids[-1])) if ids else None

    def update(self, changes: DataFrame, batch_id: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Merge `changes` into the state before `batch_id` and store the result under it."""
        current = self.read(before=batch_id)
        base = changes.limit(0) if current is None else current
        merge(base, changes).write.mode("overwrite").parquet(self._path(batch_id))
        self._drop_old(batch_id)

    def replace(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(self._path(batch_id))
        self._drop_old(batch_id)

    def _drop_old(self, batch_id: int) -> None:
        files, _ = self._filesystem()
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for old in [i for i in self.batches() if i <= batch_id][: -self.keep]:
            files.delete(path(self._path(old)), True)
