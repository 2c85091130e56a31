"""Cut lineage through tables written to the cluster's shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Spark's setting that has shuffle files deleted at the end of a query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for local masters."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="txwarden-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Staging:
    """Tables written by one job; ``close`` deletes them through the Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark).rstrip('/')}/txwarden/{uuid.uuid4().hex}"
        atexit.register(self._close_at_exit)

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write ``df`` as parquet and read it back: later passes prune columns and
        survive lost executors without repeating the plan behind ``df``. Its shuffle files go as
        soon as it is written: nothing reads them again, and on their own they stay until the
        driver happens to collect its garbage."""
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        with _without_shuffle_files(self.spark):
            rebalanced(df, partition_by).write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*map(quoted, df.columns))

    def part(self) -> Staging:
        """A folder inside, which can go earlier."""
        inner = Staging(self.spark)
        inner.path = f"{self.path}/part-{uuid.uuid4().hex[:8]}"
        return inner

    def close(self) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        target.getFileSystem(hadoop).delete(target, True)

    def _close_at_exit(self) -> None:
        try:
            self.close()
        except Exception:  # the session is gone; a local folder can go without it
            scheme, _, path = self.path.rpartition(":")
            if scheme in ("", "file"):
                shutil.rmtree(path, ignore_errors=True)

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *exc) -> None:
        self.close()


@contextmanager
def _without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def rebalanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Gather rows by folder key before a partitioned write, so that tasks do not each
    write a small file per folder; adaptive execution splits a heavy key over tasks."""
    return df.hint("rebalance", *keys) if keys else df


#: Jobs whose steps' tables go with them, the innermost last.
_briefly: ContextVar[tuple[Staging, ...]] = ContextVar("briefly", default=())


@contextmanager
def staged_briefly(spark: SparkSession) -> Iterator[Staging]:
    """Tables that :func:`stage` writes in here are deleted at the end, as those of the staging given;
    what is computed from them has to be stored by then."""
    with Staging(spark) as staging:
        token = _briefly.set((*_briefly.get(), staging))
        try:
            yield staging
        finally:
            _briefly.reset(token)


def stage(df: DataFrame, name: str = "table", partition_by: Sequence[str] = ()) -> DataFrame:
    """One-off staged table for lazily returned results; it lives as long as the folder, or as the
    :func:`staged_briefly` around it."""
    staging = _briefly.get()[-1] if _briefly.get() else Staging(df.sparkSession)
    return staging.write(df, name, partition_by)


def quoted(name: str) -> str:
    """Column name quoted for names holding dots or spaces."""
    return "`" + name.replace("`", "``") + "`"
