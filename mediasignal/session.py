"""Session settings and the staging area for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_root: list[str] = []
_scope: ContextVar[list[str] | None] = ContextVar("staged_tables", default=None)


# Shuffled bytes one task should get before adaptive execution merges small partitions.
SHUFFLE_TASK_BYTES = 256 * 1024 * 1024


def build_session(app: str, master: str | None = None, input_bytes: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; the caller's ``conf`` wins.

    ``input_bytes`` sizes the shuffles: they start with a partition per 256 MB of
    input, and adaptive execution merges those that turn out small.
    """
    if input_bytes:
        parts = min(max(input_bytes // SHUFFLE_TASK_BYTES, 200), 400_000)
        conf = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts), **conf}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A private temporary folder is used only in local mode, where the driver's
    disk is the executors' disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="mediasignal-"))
        return _local_root[0]
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the staging folder and read it back.

    Cuts lineage: later branches prune columns of the stored table instead of
    computing ``df`` again, and a lost executor costs only a re-read. The table
    stays unless a ``staging_scope`` is open.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end; what was computed from them must be written by then."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
