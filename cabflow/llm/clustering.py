"""Centroid clustering with the threshold algorithm for the nearest centroid.

Vectors are integers.  For every dimension the centroids stand in a list sorted by that
component.  A vector walks each list outward from its own value, one centroid a step; every
centroid that comes into sight the first time gets its exact distance.  What has not been seen in
any list is at least as far as the frontier: the sum over all dimensions of the squared distance
to the next centroid in the list.  The walk ends when that sum strictly exceeds the best exact
distance, so a centroid of equal distance and smaller number is never missed.  All vectors of a
batch walk at once, and leave as they are done.

Each round reads the vectors once and adds up sums and counts per centroid in the tasks; the
driver sees the centroids only, which are as many as asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.llm.arrays import as_lists
from cabflow.llm.common import stage

SCALE = 1024
#: Components stay below this, so that a squared distance of 256 dimensions fits 64 bits.
LARGEST = 1 << 26
#: Vectors that walk together.
BATCH = 2048

Batches = Iterator[pa.RecordBatch]


def whole_vectors(vectors: DataFrame, dimensions: int, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v``: the vectors with exactly that many components, none of them null or
    non-finite, as floor(scale * x).  A component beyond ``LARGEST`` stops the job."""
    x = F.col("embedding")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    kept = vectors.where((F.size(x) == dimensions) & F.forall(x, finite))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * float(scale)))
    too_large = F.exists(x, lambda c: F.abs(c.cast("double")) * float(scale) >= float(LARGEST))
    checked = F.when(too_large, F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}"))).otherwise(scaled)
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), checked.cast("array<bigint>").alias("v"))


def first_centroids(vectors: DataFrame, k: int, salt: str = "3") -> np.ndarray:
    """The vectors with the ``k`` least hashes of their id, in the order of the hashes.

    A null id is hashed as the word ``null``; rows of one id follow by their components.
    """
    text = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    rows = vectors.select(F.sha2(text, 256).alias("hash"), "v").orderBy("hash", "v").limit(k).collect()
    return np.array([row["v"] for row in rows], np.int64)


class Lists:
    """The centroids of every dimension in the order of that component."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        #: (dimensions, k): numbers of the centroids, and their components, in order.
        self.order = np.argsort(centroids, axis=0, kind="stable").T.copy()
        self.values = np.sort(centroids, axis=0).T.copy()

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid (ties: the smaller number), and
        how many exact distances each vector has computed."""
        n, dims = vectors.shape
        k = len(self.centroids)
        best, at = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
        computed = np.zeros(n, np.int64)
        rows = np.arange(n)
        # The next centroid to the right in each list; the next to the left is the one before.
        right = np.empty((n, dims), np.int64)
        for d in range(dims):
            right[:, d] = np.searchsorted(self.values[d], vectors[:, d], "left")
        left = right - 1
        seen = np.zeros((n, k), bool)
        dim = np.arange(dims)
        far = np.iinfo(np.int64).max
        for _ in range(k):
            # After i steps a list has shown i centroids, so one at least is left on some side.
            x = vectors[rows]
            gap_left = np.where(left >= 0, x - self.values[dim, np.maximum(left, 0)], far)
            gap_right = np.where(right < k, self.values[dim, np.minimum(right, k - 1)] - x, far)
            gap = np.minimum(gap_left, gap_right)
            # What is out of sight of all lists is as far as the frontier at least.
            frontier = (gap**2).sum(axis=1)
            go = frontier <= best[rows]
            if not go.all():
                rows, left, right, seen = rows[go], left[go], right[go], seen[go]
                x, gap_left, gap_right = x[go], gap_left[go], gap_right[go]
            if not len(rows):
                break
            to_left = gap_left <= gap_right
            place = np.where(to_left, left, right)
            shown = self.order[dim, place]
            new = np.zeros_like(seen)
            new[np.arange(len(rows))[:, None], shown] = True
            new &= ~seen
            seen |= new
            left, right = left - to_left, right + ~to_left
            which, number = np.nonzero(new)
            distance = ((x[which] - self.centroids[number]) ** 2).sum(axis=1)
            computed[rows] += new.sum(axis=1)
            # By distance, then number; of each vector the first.
            turn = np.lexsort((number, distance, which))
            which, number, distance = which[turn], number[turn], distance[turn]
            head = np.flatnonzero(np.r_[True, which[1:] != which[:-1]]) if len(which) else np.zeros(0, np.int64)
            row, number, distance = rows[which[head]], number[head], distance[head]
            better = (distance < best[row]) | ((distance == best[row]) & (number < at[row]))
            best[row[better]], at[row[better]] = distance[better], number[better]
        return at, best, computed


def _parts(batches: Batches) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            part = batch.slice(start, BATCH)
            ids, column = part.column("vec_id"), part.column("v")
            flat = column.flatten().to_numpy(zero_copy_only=False)
            yield ids, flat.reshape(len(ids), -1)


def _sums(lists: Lists) -> Callable[[Batches], Batches]:
    """Per centroid the number of its vectors and the sum of every component."""
    k, dims = lists.centroids.shape

    def run(batches: Batches) -> Batches:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, vectors in _parts(batches):
            at, _, _ = lists.nearest(vectors)
            counts += np.bincount(at, minlength=k)
            for c in np.unique(at):
                sums[c] += vectors[at == c].sum(axis=0)
        found = np.flatnonzero(counts)
        arrays = [pa.array(found.astype(np.int32)), pa.array(counts[found]), as_lists(list(sums[found]), pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["cluster", "n", "sums"])

    return run


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid that has vectors becomes floor(sum / count) of their components."""
    parts = vectors.mapInArrow(_sums(Lists(centroids)), "cluster int, n long, sums array<long>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("dim", "x"))
    # Sums over all rows may pass 64 bits.
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    totals = each.groupBy("cluster", "dim").agg(wide("n").alias("n"), wide("x").alias("x")).collect()
    out = centroids.copy()
    for row in totals:
        out[row["cluster"], row["dim"]] = int(Decimal(row["x"])) // int(row["n"])
    return out


def fit(vectors: DataFrame, k: int, rounds: int) -> np.ndarray:
    """Centroids after ``rounds`` rounds; fewer than ``k`` if there are fewer vectors."""
    centroids = first_centroids(vectors, k)
    if len(centroids):
        for _ in range(rounds):
            moved = _moved(vectors, centroids)
            if (moved == centroids).all():
                # Later rounds would change nothing either.
                break
            centroids = moved
    return centroids


def _assigned(lists: Lists) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for ids, vectors in _parts(batches):
            at, distance, computed = lists.nearest(vectors)
            arrays = [ids, pa.array(at.astype(np.int32)), pa.array(distance), pa.array(computed.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cluster", "distance", "computed"])

    return run


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cluster``, squared ``distance`` and the number of distances ``computed`` per vector."""
    kind = "vec_id long, cluster int, distance long, computed int"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], kind)
    return vectors.mapInArrow(_assigned(Lists(centroids)), kind)


def _chosen(numbers: Column, values: dict[int, str]) -> Column:
    """The value of a number, from a small table."""
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return table[numbers]


def cluster(vectors: DataFrame, dimensions: int = 64, k: int = 8, rounds: int = 10) -> DataFrame:
    """Nearest centroid of every kept vector, with sums over its cluster and over all.

    Columns ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``,
    ``centroid_sha256`` and ``computed``.  Vectors that are null, of another length or with a null
    or non-finite component are left out; null ids and repeated rows are vectors like others.
    """
    spark = vectors.sparkSession
    kept = stage(spark, whole_vectors(vectors, dimensions), "vectors")
    centroids = fit(kept, k, rounds)
    found = stage(spark, assign(kept, centroids), "clusters")
    wide = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()
    inertia = {row["cluster"]: int(row["d"]) for row in wide}
    digests = {i: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for i, c in enumerate(centroids)}
    number = F.col("cluster")
    own = _chosen(number, {i: str(d) for i, d in inertia.items()}) if inertia else F.lit(None)
    digest = _chosen(number, digests) if digests else F.lit(None)
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        own.cast("bigint").alias("cluster_inertia"),
        F.lit(str(sum(inertia.values()))).cast("bigint").alias("inertia"),
        digest.cast("string").alias("centroid_sha256"),
        "computed",
    )
