"""What several operators share: words, hashes, buckets of ids, spans, staged tables."""

from __future__ import annotations

import gc
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.session import scratch_path

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed, return.
WORD_BREAK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order; an empty array if there are none."""
    return F.filter(F.split(text, WORD_BREAK, -1), lambda w: w != "")


def word_hashes(text: Column) -> Column:
    """One 64-bit hash for each word."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    text = F.col(column).cast("string")
    return F.coalesce(F.pmod(F.crc32(text), F.lit(modulus)), F.lit(-1).cast("bigint"))


def id_remainder_local(doc_id: int, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus


def stage(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back, so that it is computed once."""
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nobody holds any more.

    It removes them when the driver's JVM collects the plans, which for a large job on a quiet
    driver may be long after they were of use.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def hashed_share(df: DataFrame, share: Column | float, *columns: str, seed: int = 0) -> DataFrame:
    """The rows whose hash falls into a share (0 to 1); the same rows on every run."""
    draw = F.pmod(F.xxhash64(*[F.col(c) for c in columns], F.lit(seed)), F.lit(1 << 30))
    share = F.lit(share) if isinstance(share, float) else share
    return df.where(draw < share * float(1 << 30))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted structs of that form, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
