"""Mixing sources to target weights by systematic sampling.

Every source has a target number of words: its weight's share of the whole, but at most ``most``
times what it has; what is cut off is shared among the others by weight until none is above.  A
document's expected number of copies is its source's target over its size.  Within a source the
documents stand in the order of their size (then of a hash); the expected copies are summed along
that order, one random offset per source is added, and a document is taken once for every whole
number that the running sum passes at it.  As neighbours are of like size, the words of those
taken and of those left differ by no more than about the longest document of the source.

The running sum is exact: expected copies are whole units of 2 ** -40.  It is made on two levels
(ranges of documents, then sums of ranges), so a source may hold most of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import stage, text_of
from cabflow.operators.numbering import running_total

WEIGHTS = (5, 2, 1)
#: Times that a document may be taken, and a target may pass its source's size.
MOST = 3
UNITS = 1 << 40
WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds ``target`` to rows of ``weight`` and ``source_size``: all sizes shared by weight.

    Each pass fixes the sources above ``most`` times their size and shares the rest among the
    others; it ends when none is above.  A pass is one aggregate.
    """
    cap = F.col("source_size") * F.lit(most)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    # What a weight of one gets.  It only rises, and a source that is above stays above.
    level, settled = 0.0, False
    while not settled:
        above = cap <= F.col("weight") * F.lit(level)
        fixed, weight = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))
        ).first()
        raised = (total - int(fixed)) / int(weight) if weight else level
        settled = raised <= level
        level = max(level, raised)
    return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))))


def weighed(docs: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Size and weight of every source; weights go round in the order of the names, null last."""
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    ranked = running_total(sizes, [], order, "rank")
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int"))
    return ranked.select("source", "source_size", weight.alias("weight"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = 13) -> DataFrame:
    """``copies`` of every row of ``docs`` (``doc_id``, ``source``, ``text``), with what led to it.

    Columns ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.
    A null or empty text has size 0 and is taken without words; a null source is one of its own,
    as is the empty one; null ids and rows of one id are documents like others, and of rows equal
    in id and text either may be the one that is taken.  Without a word anywhere all targets are 0.
    """
    spark = docs.sparkSession
    text = text_of()
    size = F.regexp_count(text, F.lit(WORD)).cast("bigint")
    rows = docs.select("doc_id", "source", size.alias("size"), F.xxhash64(text, F.lit(seed)).alias("text_hash"))
    rows = stage(spark, rows, "mix-sizes")
    sources = stage(spark, targets(stage(spark, weighed(rows, weights), "mix-sources"), most), "mix-targets")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = F.least(F.floor(share * float(UNITS)), F.lit(most * UNITS)).cast("decimal(20,0)")
    # A null source is a value here; a few sources meet many rows, of which one may be hot.
    key = lambda c: F.struct(F.col(c).isNull().alias("none"), F.coalesce(F.col(c), F.lit("")).alias("name"))
    known = sources.select(key("source").alias("of"), "source_size", "target", units.alias("units"))
    rows = rows.withColumn("of", key("source")).join(known, "of")
    drawn = F.xxhash64("doc_id", F.lit(seed))
    placed = running_total(
        rows.withColumn("drawn", drawn), ["of"], ["size", "drawn"], "sum", value="units", tiebreak=["doc_id", "text_hash"]
    )
    offset = F.pmod(F.xxhash64("of", F.lit(seed)), F.lit(UNITS)).cast("decimal(20,0)")
    # ``div`` is exact; a division of decimals rounds.
    passed = F.expr(f"cast((sum + start) div {UNITS}L - (sum - units + start) div {UNITS}L as int)")
    return placed.withColumn("start", offset).withColumn("copies", passed).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("bigint").alias("taken")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """One row per copy, numbered from 1."""
    each = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies")))
    return mixed.withColumn("copy", F.explode(each)).drop("copies")
