"""Repeated passages by suffix trees over words, partitioned by variable-length prefixes.

Every word starts a suffix.  Only repeats of ``length`` words count, so suffixes are cut at that
depth.  The sorted order of the suffixes is cut into ranges of an even size by bounds from a
sample: a bound is a prefix as long as it must be, so a frequent prefix is divided and rare ones
go together.  Each range is a group of subtrees that one task goes through in order, holding
only the path to the current leaf.  Neighbours with a common prefix of full depth are leaves of
one deep internal node, the node of a repeat; repeats longer than ``length`` are the nodes of
suffixes that follow each other.  A node that would fill ranges by itself needs no tree: its
least id comes from an aggregate, and its leaves are marked where they are read.

A suffix can only repeat if its minimizer (least hash of the 5-word runs in its first ``length``
words) occurs in another text, so only such suffixes are sorted.  Copies of a whole text are one
text from the start: all but the first are repeats as a whole.

A suffix is carried as one byte for each of its first seven words, the path in the tree, and a
64-bit hash of all its words, which orders and tells apart what lies below.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.arrays import as_lists, lists, mixed, runs_of
from cabflow.llm.common import hashed_share, text_of, word_hashes

LENGTH = 13
#: Words of the runs from which a minimizer is taken.
RUN = 5
WORD = re.compile(r"[^\x20\x09-\x0d]+")
NO_ID = -(1 << 63)
NODE = ("path", "whole")
#: Suffixes of one range, and texts from which the bounds of the ranges are drawn.
RANGE_ROWS = 200_000
SAMPLE_TEXTS = 2_000
SAMPLE_ROWS = 200_000
ROW = "range int, path long, whole long, id long, spot long"

I64 = pa.int64()
Batches = Iterator[pa.RecordBatch]


def minimizers(hashes: np.ndarray, length: int) -> np.ndarray:
    """The minimizer of every window of ``length`` words."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    least = runs_of(hashes, RUN)
    # The minimum over a window, from minima over windows of half the width.
    left, width = length - RUN + 1, 1
    while width < left:
        step = min(width, left - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    # 48 bits are shuffled; a coincidence only adds candidates.
    return least >> np.uint64(16)


def _minimizers(length: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [np.unique(minimizers(h, length)).view(np.int64) for h in lists(batch.column("hashes"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), as_lists(found, I64)], names=["id", "minimizers"])

    return run


def nodes(hashes: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Path and hash of the suffixes that start at some words."""
    codes = mixed(hashes, 41) >> np.uint64(56)
    path = codes[at]
    for j in range(1, 7):
        # Seven bytes leave the number positive, so it sorts as the path does.
        path = (path << np.uint64(8)) | codes[at + j]
    return path.view(np.int64), runs_of(hashes, length)[at].view(np.int64)


NODE_TYPE = [("path", "i8"), ("whole", "i8")]


def node_keys(path: np.ndarray, whole: np.ndarray) -> np.ndarray:
    keys = np.empty(len(path), NODE_TYPE)
    keys["path"], keys["whole"] = path, whole
    return keys


class Bounds:
    """Nodes at which ranges begin, and the nodes that are too frequent for a range."""

    def __init__(self, keys: np.ndarray, frequent: np.ndarray):
        self.keys, self.frequent = keys, frequent
        #: Least id of each frequent node.
        self.least = np.zeros(len(frequent), np.int64)

    def range_of(self, path: np.ndarray, whole: np.ndarray) -> np.ndarray:
        # Nearly always the path decides; only where it equals that of a bound does the rest.
        low = np.searchsorted(self.keys["path"], path, "left")
        found = np.searchsorted(self.keys["path"], path, "right")
        ties = np.flatnonzero(low < found)
        if len(ties):
            found[ties] = np.searchsorted(self.keys, node_keys(path[ties], whole[ties]), "right")
        return found.astype(np.int32)

    def frequent_at(self, path: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Number of the frequent node of each suffix, or -1."""
        found = np.full(len(path), -1)
        if len(self.frequent):
            maybe = np.flatnonzero(np.isin(whole, self.frequent["whole"]))
            keys = node_keys(path[maybe], whole[maybe])
            at = np.minimum(np.searchsorted(self.frequent, keys), len(self.frequent) - 1)
            same = self.frequent[at] == keys
            found[maybe[same]] = at[same]
        return found


def _sampled(length: int, share: float) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            parts = []
            for id_, hashes in zip(batch.column("id").to_pylist(), lists(batch.column("hashes")), strict=True):
                starts = np.arange(max(0, len(hashes) - length + 1))
                draw = mixed(np.full(len(starts), id_).view(np.uint64) ^ mixed(starts.astype(np.uint64), 3), 5)
                starts = starts[draw < np.uint64(min(share, 0.999999) * 2**64)]
                path, whole = nodes(hashes, starts, length)
                parts.append((path, whole))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts, strict=True)], names=list(NODE)
            )

    return run


def _least_ids(length: int, bounds: Bounds) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            least: dict[int, int] = {}
            for id_, hashes in zip(batch.column("id").to_pylist(), lists(batch.column("hashes")), strict=True):
                starts = np.arange(max(0, len(hashes) - length + 1))
                for node in np.unique(bounds.frequent_at(*nodes(hashes, starts, length))).tolist():
                    least[node] = min(id_, least.get(node, id_))
            least.pop(-1, None)
            arrays = [pa.array(list(least), pa.int32()), pa.array(list(least.values()), I64)]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "id"])

    return run


def draw_bounds(hashed: DataFrame, length: int) -> Bounds:
    """Bounds from the suffixes of about ``SAMPLE_TEXTS`` texts, at most ``SAMPLE_ROWS`` of them.

    A node that takes up a whole range of the sample is frequent: all texts are then read once
    for the least ids of such nodes, of which there are at most as many as ranges.
    """
    total, words_ = hashed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()
    ranges = min(SAMPLE_ROWS // 50, 16 + words_ // RANGE_ROWS)
    share = min(1.0, SAMPLE_TEXTS / max(total, 1))
    rows = hashed_share(hashed.select("id", "hashes"), share, "id")
    inner = min(1.0, SAMPLE_ROWS / max(words_ * share, 1))
    drawn = rows.mapInArrow(_sampled(length, inner), "path long, whole long").toArrow()
    keys = np.sort(node_keys(*(drawn.column(c).to_numpy() for c in NODE)))
    if not len(keys):
        return Bounds(keys, keys)
    at = np.unique(np.arange(1, ranges) * len(keys) // ranges)
    different, times = np.unique(keys, return_counts=True)
    bounds = Bounds(np.unique(keys[at]), different[times > max(20, len(keys) // ranges)])
    if len(bounds.frequent):
        found = hashed.mapInArrow(_least_ids(length, bounds), "node int, id long").groupBy("node").agg(F.min("id").alias("id"))
        for row in found.collect():
            bounds.least[row["node"]] = row["id"]
    return bounds


def _suffixes(length: int, shared) -> Callable[[Batches], Batches]:
    """The suffixes of each text whose minimizer is repeated."""

    def rows(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        path, whole, ids, spot = (np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True))
        bounds = shared.value
        frequent = bounds.frequent_at(path, whole)
        # A leaf of a frequent node is marked at once, if it is not of the least id.
        known = frequent >= 0
        ranges = np.where(known, -1, bounds.range_of(path, whole)).astype(np.int32)
        keep = np.ones(len(ids), bool)
        keep[known] = ids[known] > bounds.least[frequent[known]]
        arrays = [pa.array(x[keep]) for x in (ranges, path, whole, ids, spot)]
        return pa.RecordBatch.from_arrays(arrays, names=["range", "path", "whole", "id", "spot"])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            each = zip(
                batch.column("id").to_pylist(),
                batch.column("mark").to_pylist(),
                lists(batch.column("hashes")),
                lists(batch.column("repeated")),
                strict=True,
            )
            parts, size = [], 0
            for id_, mark, hashes, repeated in each:
                at = np.flatnonzero(np.isin(minimizers(hashes, length), repeated.view(np.uint64)))
                if not len(at):
                    continue
                # The place, and the text's mark in case an id has several texts.
                spot = (at.astype(np.int64) << 32) | (mark & 0xFFFFFFFF)
                parts.append((*nodes(hashes, at, length), np.full(len(at), id_), spot))
                size += len(at)
                if size >= 200_000:
                    yield rows(parts)
                    parts, size = [], 0
            if parts:
                yield rows(parts)

    return run


def _deep_nodes(batches: Batches) -> Batches:
    """Leaves of the deep internal nodes, in order, whose node has a smaller id."""
    last, least = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        path, whole, ids = (batch.column(c).to_numpy() for c in ("path", "whole", "id"))
        new = np.ones(len(ids), bool)
        # A common prefix that ends above full depth: another node begins.
        new[1:] = (path[1:] != path[:-1]) | (whole[1:] != whole[:-1])
        new[0] = (int(path[0]), int(whole[0])) != last
        start = np.maximum.accumulate(np.where(new, np.arange(len(ids)), -1))
        of = np.where(start >= 0, ids[np.maximum(start, 0)], least)
        last, least = (int(path[-1]), int(whole[-1])), int(of[-1])
        # Leaves of a frequent node (range -1) are here only if they are repeats.
        use = np.flatnonzero((batch.column("range").to_numpy() < 0) | (ids > of))
        yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(use)) for c in ("id", "spot")], names=["id", "spot"])


def _kept(length: int):
    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def run(texts: pd.Series, marks: pd.Series, spots: pd.Series, copies: pd.Series) -> pd.DataFrame:
        rows = []
        for text, mark, spot, copy in zip(texts, marks, spots, copies, strict=True):
            words = WORD.findall(text)
            keep = np.ones(len(words), bool)
            if copy and len(words) >= length:
                keep[:] = False
            elif spot is not None and len(spot):
                spot = np.asarray(spot)
                at = spot[(spot & 0xFFFFFFFF) == (mark & 0xFFFFFFFF)] >> 32
                change = np.zeros(len(words) + 1, int)
                np.add.at(change, at, 1)
                np.add.at(change, at + length, -1)
                keep = np.cumsum(change[:-1]) == 0
            kept = " ".join(words if keep.all() else [words[i] for i in np.flatnonzero(keep)])
            rows.append((len(words), int((~keep).sum()), hashlib.sha256(kept.encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])

    return run


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The texts, with the word places at which a repeat starts.

    Columns ``id``, ``text``, ``mark``, ``copy`` (whether an equal text has a smaller id) and
    ``spots`` (null if there are none): the place in the upper half of each number, the mark of
    the text it belongs to in the lower.  A repeat is a run of ``length`` words that also starts
    in a text with a smaller id.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), text_of().alias("text"))
    texts = texts.withColumn("mark", F.hash("text"))
    bounds = docs.sparkSession.sparkContext.broadcast(
        draw_bounds(texts.select("id", word_hashes(F.col("text")).alias("hashes")), length)
    )
    sizes = texts.select("id", "mark", F.xxhash64("text").alias("hash"), F.octet_length("text").alias("size"))
    # An id has one text as a rule, but may have several.
    firsts = sizes.groupBy("mark", "hash", "size").agg(F.min("id").alias("id"))
    firsts = firsts.groupBy("id").agg(F.collect_set("mark").alias("firsts"))
    found = texts.select("id", word_hashes(F.col("text")).alias("hashes"))
    found = found.mapInArrow(_minimizers(length), "id long, minimizers array<long>")
    found = found.select("id", F.explode("minimizers").alias("minimizer"))
    repeated = found.groupBy("minimizer").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("minimizer")
    marks = found.join(repeated, "minimizer").groupBy("id").agg(F.collect_list("minimizer").alias("repeated"))

    # Joins by the id alone let one shuffle of the texts serve both passes over them.
    texts = texts.repartition("id").join(firsts, "id", "left")
    is_first = F.coalesce(F.array_contains("firsts", F.col("mark")), F.lit(False))
    first = texts.where(is_first).dropDuplicates(["id", "mark"])
    marked = first.join(marks, "id").select("id", "mark", word_hashes(F.col("text")).alias("hashes"), "repeated")
    candidates = marked.mapInArrow(_suffixes(length, bounds), ROW)
    # Marked leaves have no range; they are dealt by id.
    deal = F.when(F.col("range") < 0, F.pmod(F.xxhash64("id"), F.lit(1 << 20)).cast("int") * -1 - 1).otherwise(F.col("range"))
    groups = candidates.withColumn("range", deal).repartition("range").sortWithinPartitions("range", *NODE, "id", "spot")
    covered = groups.mapInArrow(_deep_nodes, "id long, spot long")
    spots = covered.groupBy("id").agg(F.collect_list("spot").alias("spots"))
    return texts.join(spots, "id", "left").select("id", "text", "mark", (~is_first).alias("copy"), "spots")


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: ``doc_id``, the number of words, how many are removed, and the digest of the rest.

    A word goes if it lies in a repeat (see :func:`repeats`), judged on the input.  Null texts
    count as empty, a null id comes before all others, rows of one id do not remove each other's
    words, and texts of fewer than ``length`` words stay whole.
    """
    rows = repeats(docs, length)
    result = rows.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        _kept(length)("text", "mark", "spots", "copy").alias("r"),
    )
    return result.select("doc_id", "r.n_words", "r.n_removed", "r.kept_sha256")


