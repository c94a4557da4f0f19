"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where this costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
}


#: Bytes of input for each shuffle partition.
PARTITION_BYTES = 128 << 20


def build_session(app: str, input_bytes: int | None = None, **overrides: str) -> SparkSession:
    """A session with the settings the jobs are tuned for.

    ``input_bytes``, the size of what the job reads, sets the number of shuffle partitions; the
    adaptive planner joins those that turn out small.  Keyword names use ``__`` for the dots:
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    sized = {}
    if input_bytes is not None:
        sized["spark.sql.shuffle.partitions"] = str(max(200, math.ceil(input_bytes / PARTITION_BYTES)))
    settings = DEFAULTS | sized | {key.replace("__", "."): value for key, value in overrides.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Where it is not set, as in tests, one below the warehouse is used.  A warehouse on the disk of
    one machine does not do on a cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if urlsplit(warehouse).scheme in ("", "file") and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir: {warehouse} is a folder of one machine")
        folder = f"{warehouse}/_scratch"
    return folder.rstrip("/")


#: Paths that were handed out inside :func:`scratch`, innermost last.
_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open scratch folders", default=())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _OPEN.get()[-1:]:
        paths.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end.

    For jobs that write their result: frames made inside must not be read after it.
    """
    paths: list[str] = []
    token = _OPEN.set((*_OPEN.get(), paths))
    try:
        yield
    finally:
        _OPEN.reset(token)
        jvm = spark.sparkContext._jvm
        for path in paths:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
