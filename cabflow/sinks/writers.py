"""Writers.

Overwriting replaces the whole target folder or partition, also when the result is
empty, so that a job can be run again for the same day.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.operators.joins import upsert
from cabflow.session import scratch, scratch_path


def balanced(df: DataFrame, *by: str) -> DataFrame:
    """Few files per partition value, and several where a value is hot.

    Without this every task writes a file per value.  Other writes keep the tasks they
    have: they follow a scan or a shuffle whose parts are already of an even size.
    """
    return df.hint("rebalance", *by)


def partition_path(base: str, **parts: int) -> str:
    return "/".join([base.rstrip("/"), *[f"{name}={value}" for name, value in parts.items()]])


def write_partition(df: DataFrame, base: str, by: Sequence[str] = (), **parts: int) -> str:
    """Replace one partition, for instance ``dt=20170409``.

    With ``by=["hour"]`` all hours of the day are written by one job.
    """
    path = partition_path(base, **parts)
    writer = (balanced(df, *by) if by else df).write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
    return path


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet", files: int | None = None) -> None:
    """Replace a folder; ``files`` fixes the number of files.

    The files are made behind a shuffle, so the work before it keeps all its tasks.  Without
    ``files`` the result keeps the parts it has.
    """
    df = df if files is None else df.repartition(files)
    df.write.mode("overwrite").format(fmt).save(path)


def write_repartitioned(df: DataFrame, path: str, files: int) -> None:
    """Replace a folder by a given number of even files."""
    df.repartition(files).write.mode("overwrite").parquet(path)


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session that hold for one write; names use ``__`` for the dots."""
    named = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key) for key in named}
    for key, value in named.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def write_sized(df: DataFrame, path: str, part_bytes: int = 256 << 20, fmt: str = "parquet") -> None:
    """Replace a folder by even files of about ``part_bytes`` of rows each.

    How many files there are follows the data: twice the rows, twice the files.  ``part_bytes``
    counts rows as they are shuffled; a file in columns is about a third of that.  The rows are
    dealt out by the adaptive planner, which cuts large parts and joins small ones.
    """
    prefix = "spark__sql__adaptive__"
    settings = {
        f"{prefix}advisoryPartitionSizeInBytes": f"{part_bytes}b",
        f"{prefix}coalescePartitions__minPartitionSize": f"{min(part_bytes, 1 << 20)}b",
        f"{prefix}coalescePartitions__parallelismFirst": "false",
    }
    with _settings(df.sparkSession, **settings):
        balanced(df).write.mode("overwrite").format(fmt).save(path)


def write_dealt(df: DataFrame, path: str, by: Sequence[str], open_files: int = 256) -> None:
    """Write rows by partition without a shuffle or a sort.

    Every task keeps a file open for each partition value it meets; with more values than
    ``open_files`` it sorts the rest.  For few values: there is a file for each task and value.
    """
    with _settings(df.sparkSession, spark__sql__maxConcurrentOutputFileWriters=str(open_files)):
        df.write.partitionBy(*by).parquet(path)


def write_table(df: DataFrame, name: str, fmt: str = "orc", path: str | None = None) -> None:
    """Drop and recreate a catalog table."""
    writer = df.write.mode("overwrite").format(fmt)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace the rows of a relational table."""
    df.write.mode("overwrite").format("jdbc").options(url=url, dbtable=table, **options).save()


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    For results that are read more than once: they are computed once, and the loss of an
    executor does not bring their plan back.
    """
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_by(spark: SparkSession, df: DataFrame, label: str, key: str) -> DataFrame:
    """The same in buckets of a key, as many as the session has shuffle partitions.

    What reads it is dealt by the key already, so that wide rows are not shuffled to be joined by
    it.  The catalog knows the buckets, and the table is dropped from there at once: the frame goes
    on reading the files.  Rows that are dealt by the key already meet a bucket or two in a task,
    so they are not sorted to be written.
    """
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").bucketBy(buckets, key)
    with _settings(spark, spark__sql__maxConcurrentOutputFileWriters="8"):
        writer.option("path", path).option("compression", "zstd").saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows


# -- keyed merge -----------------------------------------------------------------
#
# A merged table is a plain folder of Parquet files.  Its rows are dealt into buckets by a hash of
# their key, and the name of a file starts with its bucket and how many there are.  A merge reads
# and writes only the buckets that the new rows fall into; the files of all others stay.

_BUCKET_FILE = re.compile(r"b(\d+)of(\d+)-.*")
_SWAP, _STAGE = "_swap-", "_merge-"
_BUCKET = "_bucket"
#: Bytes of files for each bucket of a new table.
BUCKET_BYTES = 128 << 20


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _files(spark: SparkSession, path: str) -> list[str]:
    target, fs = _hadoop_path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)]


def _data_files(names: Sequence[str]) -> list[str]:
    return [n for n in names if not n.startswith(("_", "."))]


def _finish_swaps(spark: SparkSession, path: str) -> None:
    """Go on with merges that were interrupted after their new files were complete."""
    for name in sorted(n for n in _files(spark, path) if n.startswith(_SWAP)):
        _swap(spark, path, name)
    # What is left over from merges that never came so far holds nothing the table needs.
    for name in (n for n in _files(spark, path) if n.startswith(_STAGE)):
        target, fs = _hadoop_path(spark, f"{path}/{name}")
        fs.delete(target, True)


def _swap(spark: SparkSession, path: str, journal: str) -> None:
    """Put new files in the place of old ones as the journal says; may be run again at any point."""
    target, fs = _hadoop_path(spark, f"{path}/{journal}")
    stream = fs.open(target)
    plan = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    for name in plan["remove"]:
        fs.delete(_hadoop_path(spark, f"{path}/{name}")[0], False)
    for source, name in plan["add"]:
        here = _hadoop_path(spark, f"{path}/{source}")[0]
        if fs.exists(here) and not fs.rename(here, _hadoop_path(spark, f"{path}/{name}")[0]):
            raise OSError(f"{source} could not become {name} in {path}; the next merge goes on")
    fs.delete(target, False)


def _write_buckets(
    spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str], buckets: int, remove: Sequence[str]
) -> None:
    """Write rows by bucket beside the table, then swap them in for the files in ``remove``."""
    mark = uuid.uuid4().hex
    stage = f"{_STAGE}{mark}"
    dealt = rows.withColumn(_BUCKET, _bucket_of(keys, buckets))
    balanced(dealt, _BUCKET).write.partitionBy(_BUCKET).parquet(f"{path}/{stage}")
    folders = [f for f in _files(spark, f"{path}/{stage}") if f.startswith(f"{_BUCKET}=")]
    if not folders:
        # Without rows one empty file still says what the columns are.
        folders = [f"{_BUCKET}=0"]
        spark.createDataFrame([], rows.schema).write.parquet(f"{path}/{stage}/{folders[0]}")
    add = []
    for folder in folders:
        bucket = int(folder.partition("=")[2])
        for i, name in enumerate(sorted(_data_files(_files(spark, f"{path}/{stage}/{folder}")))):
            add.append([f"{stage}/{folder}/{name}", f"b{bucket:05d}of{buckets:05d}-{mark}-{i:05d}.parquet"])
    # The journal appears under its name only when it is complete.
    target, fs = _hadoop_path(spark, f"{path}/_{mark}.tmp")
    out = fs.create(target, True)
    out.write(bytearray(json.dumps({"remove": list(remove), "add": add}).encode()))
    out.close()
    fs.rename(target, _hadoop_path(spark, f"{path}/{_SWAP}{mark}")[0])
    _swap(spark, path, f"{_SWAP}{mark}")
    fs.delete(_hadoop_path(spark, f"{path}/{stage}")[0], True)


def merge_path(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    keep: Column | None = None,
    buckets: int | None = None,
) -> list[int]:
    """Merge rows into a Parquet folder by key; creates it if it is not there.

    New rows replace old ones of the same key (whose columns have the same types).  Old and new rows for which ``keep`` does not hold
    are let go.  Returns the buckets that were written; the files of others are not touched.  A
    new table has ``buckets`` of them, by default one for each ``BUCKET_BYTES`` of its first rows.

    The new files are complete before the first old one goes, and a journal says which belong
    together: a merge that is cut off in between is ended by the next one.  Until then a reader
    may miss rows of the buckets that were being swapped.  One merge at a time.
    """
    with scratch(spark):
        return _merged(spark, staged(spark, new, "delta"), path.rstrip("/"), keys, keep, buckets)


def _merged(
    spark: SparkSession, new: DataFrame, path: str, keys: Sequence[str], keep: Column | None, buckets: int | None
) -> list[int]:
    target, fs = _hadoop_path(spark, path)
    if fs.exists(target):
        _finish_swaps(spark, path)
    else:
        fs.mkdirs(target)
    files = _data_files(_files(spark, path))
    found = {name: _BUCKET_FILE.fullmatch(name) for name in files}
    if not files or not all(found.values()):
        # A new table, or one whose files are not in buckets yet: all of it is dealt.
        merged = upsert(spark.read.parquet(path), new, keys) if files else new
        merged = staged(spark, merged if keep is None else merged.where(keep), "first")
        size = sum(fs.getFileStatus(_hadoop_path(spark, name)[0]).getLen() for name in merged.inputFiles())
        count = buckets or max(1, -(-size // BUCKET_BYTES))
        _write_buckets(spark, merged, path, keys, count, files)
        return list(range(count))
    count = int(next(iter(found.values())).group(2))
    touched = {r[0] for r in new.select(_bucket_of(keys, count)).distinct().collect()}
    old = spark.read.parquet(path)
    if keep is not None:
        # Only the columns of the condition and the key are read.
        gone = old.where(~F.coalesce(keep, F.lit(False))).select(_bucket_of(keys, count)).distinct()
        touched |= {r[0] for r in gone.collect()}
    if not touched:
        return []
    mine = [name for name, match in found.items() if int(match.group(1)) in touched]
    before = spark.read.schema(old.schema).parquet(*[f"{path}/{n}" for n in mine]) if mine else old.limit(0)
    merged = upsert(before, new, keys)
    _write_buckets(spark, merged if keep is None else merged.where(keep), path, keys, count, mine)
    return sorted(touched)


# -- partitions ----------------------------------------------------------------


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop_path(spark, path)
    return fs.exists(target)


def drop_partition(spark: SparkSession, base: str, day: str, older_than: bool = False) -> list[str]:
    """Remove the files of one day, or of it and all days before; returns what went."""
    target, fs = _hadoop_path(spark, base)
    if not fs.exists(target):
        return []
    gone = []
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if not name.startswith("dt="):
            continue
        found = name.removeprefix("dt=")
        if found == day or (older_than and found < day):
            fs.delete(status.getPath(), True)
            gone.append(found)
    return sorted(gone)


def add_partitions(spark: SparkSession, table: str) -> None:
    """Make partitions that were written as folders known to the catalog."""
    spark.catalog.recoverPartitions(table)


def drop_table_partition(spark: SparkSession, table: str, day: str, files: bool = False) -> None:
    """Take one day out of the catalog, with its ``files`` if the table is external and they are
    to go too; otherwise :func:`add_partitions` finds the day again."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (dt={int(day)})")
    if files:
        drop_partition(spark, table_location(spark, table), day)


def table_details(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog knows about a table, such as ``Provider`` and ``Location``."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {row["col_name"]: row["data_type"] for row in rows}


def table_location(spark: SparkSession, table: str) -> str:
    return table_details(spark, table)["Location"]
