"""Session helpers: where written intermediate tables go."""

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}  # application id -> folder of a local session


def shared_dir(spark: SparkSession) -> str:
    """The folder for lineage-cutting tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    it may be unset, gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="run-"))
    return base.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_writing: dict[str, tuple[int, str]] = {}  # session -> writes going on, and the setting before the first of them


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes begun inside remove their shuffle files when they end, not when the driver happens to collect its garbage.

    A written table needs them no more. Outside, the session's own setting holds.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        n, before = _writing.get(session, (0, spark.conf.get(_CLEANUP, "false")))
        _writing[session] = n + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            n, before = _writing.pop(session)
            if n > 1:
                _writing[session] = n - 1, before
            else:
                spark.conf.set(_CLEANUP, before)


class Workspace:
    """Named parquet tables in one fresh folder under the shared directory."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def table(self, name: str, df: DataFrame, by: str | None = None) -> DataFrame:
        """Write ``df`` once and read it back, so later stages restart from files.

        ``by`` names a column of few values that gets a folder for each, so that a filter on it reads no more.
        """
        path = f"{self.path}/{name}"
        with shuffles_removed(df.sparkSession):
            (df.write.partitionBy(by) if by else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_only(self, *names: str) -> None:
        """Remove the tables no result reads any more; the named ones stay."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for status in files.listStatus(folder):
            if status.getPath().getName() not in names:
                files.delete(status.getPath(), True)
