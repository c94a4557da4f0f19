"""Exact Jaccard join of word n-gram sets by token-combination prefixes.

Texts with equal sets are one class, and only one of each is looked at.  For the rest:

1. *Extended prefix.*  Two sets that link share all but ``t`` of the tokens of the smaller
   one, so of the first ``t + s`` tokens in hash order at least ``s`` are also in another
   document.  Documents that fail this have no partner.
2. *Signatures.*  Tokens are rare or frequent by a table of hashed counts.  A document indexes
   its ``t + 1`` rarest rare tokens one by one; if it has fewer, it also deals its frequent
   tokens into more classes than two linked sets can differ in tokens, and indexes for each
   class the combination of all its tokens: one class at least is then the same in both.  The
   number of classes depends on the size level, and a document takes part in its own level and
   the next, so that any two that may link use one scheme.
3. *Filter.*  Pairs of a bucket are compared by odd sketches: each token flips one bit, so the
   bits in which two sketches differ never exceed the tokens in which the sets differ.  A
   bucket gives only a forest of the pairs that pass; large buckets are cut into blocks.
4. *Verify.*  The sets of each edge of the forests are compared token by token, and those that
   link join into components.  Then the buckets are gone through again for pairs that pass but lie
   in different components: neighbours in the order of the sets first, then ever wider distances,
   until every bucket has been gone through in full.  What links is joined at once, so the pairs
   within a component are not looked at one by one.
5. *Count.*  The links of a set all lie in its component; they are counted in blocks of a
   bounded size.

No step drops a pair that may link, whatever the sizes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cabflow.llm.arrays import as_lists, lists, mixed, runs_of
from cabflow.llm.common import ascii_lower, release, stage, text_of, word_hashes
from cabflow.llm.components import components

#: The table of hashed counts has 2 ** FREQUENCY_BITS numbers.
FREQUENCY_BITS = 22
#: A token is rare up to so many documents, besides the load of its place in the table.
RARE = 8
#: 64-bit words of an odd sketch, and of the wide one that pairs are compared by once more.
SKETCH = 8
WIDE_SKETCH = 64
#: Members of a bucket, and tokens and sets of a component, that one block holds.
BUCKET_BLOCK = 512
FAMILY_BLOCK = 2_000_000
FAMILY_SETS = 8192
#: Bytes of a table of bits, beyond which links are counted by lists of the sets that hold a token.
TABLE_BYTES = 64 << 20
#: Growth of the distances at which the members of a bucket are compared.
WIDER = 16
#: Least ratio of the sizes of two levels.
LEVEL = 1.25
NO_ID = -(1 << 63)

#: A text is told apart by its id, a hash and its length; a class of equal sets by two hashes and its size.
TEXT_KEY = ["id", "hash", "length"]
CLASS_KEY = ["set1", "set2", "n"]

I64, I32 = pa.int64(), pa.int32()
Batches = Iterator[pa.RecordBatch]


class Bounds:
    """What two linked sets can differ in; ``percent`` is the least similarity."""

    def __init__(self, percent: int):
        self.percent = percent
        # Linked sets are at most one level apart.
        self.ratio = max(LEVEL, 100 / percent)

    def missing(self, n: int) -> int:
        """Tokens of a set of ``n`` that a linked set may lack."""
        return n * (100 - self.percent) // 100

    def differing(self, n: int) -> int:
        """Tokens in one of two linked sets but not in both; ``n`` is the size of either."""
        return n * (100 - self.percent) // self.percent

    def slack(self, n: int) -> int:
        return max(1, self.missing(n) // 3)

    def alone(self, n: int) -> bool:
        """Whether only an equal set could link."""
        return self.differing(n) == 0

    def level(self, n: int) -> int:
        return int(math.log(n) / math.log(self.ratio) + 1e-9)

    def classes(self, level: int) -> int:
        return self.differing(int(self.ratio ** (level + 1)) + 1) + 1

    def linked(self, shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * shared >= self.percent * (a + b - shared)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``k`` words; a shorter text is one run."""
    if len(hashes) == 0:
        return np.zeros(0, np.uint64)
    runs = runs_of(hashes, k) if len(hashes) >= k else runs_of(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return np.unique(runs)


def _describe(k: int, bounds: Bounds) -> Callable[[Batches], Batches]:
    """Size, identity and extended prefix of every set."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sizes, first, second, prefixes, needs = [], [], [], [], []
            for hashes in lists(batch.column("hashes")):
                tokens = shingles(hashes, k)
                n = len(tokens)
                sizes.append(n)
                first.append(mixed(tokens, 7).sum(dtype=np.uint64))
                second.append(mixed(tokens, 8).sum(dtype=np.uint64))
                alone = bounds.alone(n)
                needs.append(0 if alone else bounds.slack(n))
                prefixes.append(tokens[: 0 if alone else bounds.missing(n) + bounds.slack(n)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in TEXT_KEY],
                    pa.array(np.array(sizes, np.int64)),
                    pa.array(np.array(first, np.uint64).view(np.int64)),
                    pa.array(np.array(second, np.uint64).view(np.int64)),
                    pa.array(np.array(needs, np.int32)),
                    as_lists(prefixes, I64),
                ],
                names=[*TEXT_KEY, "n", "set1", "set2", "need", "prefix"],
            )

    return run


def _sets(k: int) -> Callable[[Batches], Batches]:
    """Tokens and odd sketch of every set."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sets = [shingles(h, k) for h in lists(batch.column("hashes"))]
            sizes = pa.array(np.array([len(s) for s in sets], np.int64))
            sketches = as_lists([odd_sketch(s) for s in sets], I64)
            tokens = as_lists([s.view(np.int64) for s in sets], I64)
            yield pa.RecordBatch.from_arrays([batch.column("node"), sizes, tokens, sketches], names=["node", "n", "tokens", "sketch"])

    return run


def signatures(tokens: np.ndarray, counts: np.ndarray, rare: float, bounds: Bounds) -> np.ndarray:
    """Hashes under which a set is indexed."""
    n = len(tokens)
    seen = counts[tokens & np.uint64(len(counts) - 1)]
    is_rare = seen <= rare
    order = np.lexsort((tokens[is_rare], seen[is_rare]))
    allowed = bounds.missing(n)
    single = mixed(tokens[is_rare][order][: allowed + 1], 11)
    if is_rare.sum() > allowed:
        return single
    frequent = tokens[~is_rare]
    found = [single]
    for level in (bounds.level(n), bounds.level(n) + 1):
        m = bounds.classes(level)
        of = (mixed(frequent, 100 + level) % np.uint64(m)).astype(np.int64)
        combined = mixed(np.arange(m, dtype=np.uint64), 200 + level)
        np.add.at(combined, of, mixed(frequent, 12))
        found.append(mixed(combined, 13))
    return np.concatenate(found)


def odd_sketch(tokens: np.ndarray, words: int = SKETCH) -> np.ndarray:
    bits = (mixed(tokens, 21) % np.uint64(64 * words)).astype(np.int64)
    odd = (np.bincount(bits, minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _with_wide_sketch(batches: Batches) -> Batches:
    for batch in batches:
        wide = [odd_sketch(t.view(np.uint64), WIDE_SKETCH) for t in lists(batch.column("tokens"))]
        yield pa.RecordBatch.from_arrays([*batch.columns, as_lists(wide, I64)], names=[*batch.schema.names, "wide"])


def _index(counts, rare: float, bounds: Bounds) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        table = counts.value
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            found = [signatures(t.view(np.uint64), table, rare, bounds).view(np.int64) for t in lists(batch.column("tokens"))]
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            arrays = [pa.array(flat), pa.array(np.repeat(nodes, [len(f) for f in found]))]
            yield pa.RecordBatch.from_arrays(arrays, names=["signature", "node"])

    return run


def _forest(near: Callable[[int], np.ndarray], n: int) -> list[tuple[int, int]]:
    """A spanning forest; ``near(i)`` tells the members that ``i`` links to."""
    left = np.ones(n, bool)
    tree = []
    for root in range(n):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            i = queue.pop()
            fresh = np.flatnonzero(near(i) & left)
            left[fresh] = False
            tree += [(i, int(j)) for j in fresh]
            queue += fresh.tolist()
    return tree


#: A bucket, or one block or two blocks of a large one.
BUCKET = ["signature", "i", "j"]
BUCKET_TYPE = "signature long, i int, j int"
EDGE = f"{BUCKET_TYPE}, a long, b long"


class _Members:
    """The members of one bucket, in the order of their nodes, so that buckets with the same members
    give the same pairs; ``near`` tells which may link to one of them."""

    def __init__(self, values: pa.StructArray, share: float):
        field = lambda name: values.field(name).to_numpy(zero_copy_only=False)
        order = np.argsort(field("node"))
        self.nodes, self.sizes = field("node")[order], field("n")[order]
        self.labels = field("label")[order] if values.type.get_field_index("label") >= 0 else self.nodes
        # Sliced structs keep all of their lists' values, so the lists are flattened.
        self.sketches = values.field("sketch").flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH)[order]
        self.share = share

    def passes(self, x: np.ndarray | slice, y: np.ndarray | slice | int) -> np.ndarray:
        differ = np.bitwise_count(self.sketches[x] ^ self.sketches[y]).sum(axis=1)
        return differ <= np.floor((self.sizes[x] + self.sizes[y]) * self.share + 1e-9)

    def near(self, i: int) -> np.ndarray:
        return self.passes(slice(None), i)


def _share(bounds: Bounds) -> float:
    """Most of the tokens of both sets that may stand in one of them only."""
    return (100 - bounds.percent) / (100 + bounds.percent)


def _edges_of(pairs: Callable[[_Members], tuple[np.ndarray, np.ndarray]], share: float) -> Callable[[Batches], Batches]:
    """Pairs of each bucket, with the bucket."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in BUCKET]
            a, b, times = [], [], []
            column = batch.column("members")
            offsets = column.offsets.to_numpy()
            for start, end in zip(offsets, offsets[1:], strict=False):
                members = _Members(column.values.slice(start, end - start), share)
                x, y = pairs(members)
                times.append(len(x))
                a.append(members.nodes[x])
                b.append(members.nodes[y])
            if a:
                of = np.repeat(np.arange(len(times)), times)
                arrays = [pa.array(k[of]) for k in keys] + [pa.array(np.concatenate(x)) for x in (a, b)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*BUCKET, "a", "b"])

    return run


def _forest_of(members: _Members) -> tuple[np.ndarray, np.ndarray]:
    tree = np.array(_forest(members.near, len(members.nodes)), np.int64).reshape(-1, 2)
    return tree[:, 0], tree[:, 1]


def _apart(first: int, last: int) -> Callable[[_Members], tuple[np.ndarray, np.ndarray]]:
    """Pairs of different components that may link, at a distance of ``first`` to ``last`` places
    in the order of the members."""

    def pairs(members: _Members) -> tuple[np.ndarray, np.ndarray]:
        order = np.arange(len(members.nodes))
        found = [(order[:0], order[:0])]
        for d in range(first, min(last, len(order) - 1) + 1):
            x, y = order[:-d], order[d:]
            use = members.labels[x] != members.labels[y]
            x, y = x[use], y[use]
            use = members.passes(x, y)
            found.append((x[use], y[use]))
        x, y = (np.concatenate(c) for c in zip(*found, strict=True))
        return x, y

    return pairs


def _degrees(bounds: Bounds) -> Callable[[tuple, pa.Table], pa.Table]:
    """Links of each set of a component's block, or across a pair of blocks."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        across = key[1].as_py() != key[2].as_py()
        table = table.combine_chunks()
        nodes, sizes, block = (table.column(c).to_numpy() for c in ("node", "n", "block"))
        sets = [t for chunk in table.column("tokens").chunks for t in lists(chunk)]
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        _, token, seen = np.unique(flat, return_inverse=True, return_counts=True)
        # Tokens of one set alone are in no intersection.
        use = seen[token] > 1
        token, owner = (np.cumsum(seen > 1) - 1)[token[use]], owner[use]
        width = int((seen > 1).sum())
        common = _by_bits if len(sets) * width <= 8 * TABLE_BYTES else _by_lists
        degree = np.zeros(len(sets), np.int64)
        for i, shared in common(owner, token, len(sets), width):
            good = bounds.linked(shared, sizes, sizes[i])
            good &= (block != block[i]) if across else (np.arange(len(sets)) != i)
            degree[i] = good.sum()
        return pa.table({"node": pa.array(nodes, I64), "links": pa.array(degree, I64)})

    return run


def _by_bits(owner: np.ndarray, token: np.ndarray, n: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Tokens that each set has in common with all others, from a table of bits."""
    bits = np.zeros((n, (width + 63) // 64), np.uint64)
    np.bitwise_or.at(bits, (owner, token // 64), np.uint64(1) << (token % 64).astype(np.uint64))
    for i in range(n):
        yield i, np.bitwise_count(bits & bits[i]).sum(axis=1).astype(np.int64)


def _by_lists(owner: np.ndarray, token: np.ndarray, n: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """The same from the list of sets of every token."""
    turn = np.argsort(token, kind="stable")
    holders, starts = owner[turn], np.searchsorted(token[turn], np.arange(width + 1))
    of_set = np.searchsorted(owner, np.arange(n + 1))
    for i in range(n):
        shared = np.zeros(n, np.int64)
        for t in token[of_set[i] : of_set[i + 1]]:
            # A set stands once in the list of a token.
            shared[holders[starts[t] : starts[t + 1]]] += 1
        yield i, shared


def _blocked(df: DataFrame, group: str, blocks: Column, *salt: str) -> DataFrame:
    """Rows dealt into blocks, each once for every pair of blocks it belongs to.

    A group of one block stays as it is.
    """
    rows = df.withColumn("blocks", blocks.cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(*salt), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("blocks", "other")


def _survivors(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes whose extended prefix is shared enough, with the text that stands for them."""
    rows = sets.where("need > 0").join(classes.select("node", *CLASS_KEY, *TEXT_KEY), [*CLASS_KEY, *TEXT_KEY])
    # Rows equal in id and text count twice here, which only keeps more.
    tokens = rows.select("node", "need", F.explode("prefix").alias("token"))
    repeated = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1").select("token")
    shared = tokens.join(repeated, "token").groupBy("node").agg(F.count(F.lit(1)).alias("shared"), F.first("need").alias("need"))
    return classes.join(shared.where("shared >= need").select("node"), "node").select("node", *TEXT_KEY)


def _buckets(spark, members: DataFrame, bounds: Bounds) -> DataFrame:
    """Rows of the buckets: ``signature``, ``i``, ``j``, ``node``, ``n``, ``sketch``."""
    bits = 1 << FREQUENCY_BITS
    places = members.select(F.explode("tokens").alias("t")).groupBy(F.col("t").bitwiseAND(F.lit(bits - 1)).cast("int").alias("place"))
    # At most as many rows as the table has places.
    seen = places.agg(F.least(F.count(F.lit(1)), F.lit(1 << 30)).cast("int").alias("seen")).toArrow()
    counts = np.zeros(bits, np.int32)
    counts[seen.column("place").to_numpy()] = seen.column("seen").to_numpy()
    load = counts.sum(dtype=np.int64) / bits
    shared = spark.sparkContext.broadcast(counts)
    index = members.select("node", "tokens").mapInArrow(_index(shared, RARE + 4 * load, bounds), "signature long, node long")
    index = stage(spark, index, "signatures")
    shared.destroy()
    sized = index.groupBy("signature").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = _blocked(index.join(sized, "signature"), "signature", F.ceil(F.col("size") / BUCKET_BLOCK), "node", "signature")
    return rows.select(*BUCKET, "node").join(members.select("node", "n", "sketch"), "node")


def _checked(edges: DataFrame, members: DataFrame, bounds: Bounds) -> DataFrame:
    """Those of the edges whose sets link; the edges are written, so that few are known to be few.

    Wide sketches leave out most that do not, the longer sets above all; of the others the sets at
    both ends travel, each once for an edge.
    """
    side = lambda c: members.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("wide").alias(f"wide_{c}"))
    bits = F.zip_with("wide_a", "wide_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0), lambda total, one: total + one)
    allowed = F.floor((F.col("n_a") + F.col("n_b")) * F.lit(_share(bounds)) + F.lit(1e-9))
    edges = edges.join(side("a"), "a").join(side("b"), "b").where(differ <= allowed).select("a", "b")
    edges = stage(edges.sparkSession, edges, "likely")
    ends = edges.select("a", "b", F.explode(F.array("a", "b")).alias("node"))
    found = members.select("node", "n", "tokens").join(ends, "node").groupBy("a", "b")
    both = found.agg(F.collect_list(F.struct("n", "tokens")).alias("sets"))
    shared = F.size(F.array_intersect(F.col("sets")[0]["tokens"], F.col("sets")[1]["tokens"])).cast("bigint")
    both = both.select("a", "b", F.col("sets")[0]["n"].alias("n_a"), F.col("sets")[1]["n"].alias("n_b"), shared.alias("shared"))
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    links = both.where(F.lit(100) * F.col("shared") >= F.lit(bounds.percent) * union)
    return stage(edges.sparkSession, links.select("a", "b"), "linked")


def _groups(spark, members: DataFrame, bounds: Bounds) -> tuple[DataFrame, DataFrame]:
    """``node`` and ``label`` of every set with a link to another (equal labels are a component),
    and the members that may have had one."""
    share = _share(bounds)
    buckets = _buckets(spark, members, bounds).groupBy(*BUCKET).agg(F.collect_list(F.struct("node", "n", "sketch")).alias("members"))
    forests = stage(spark, buckets.mapInArrow(_edges_of(_forest_of, share), EDGE), "forests")
    # Sets without a pair that passes in any bucket are done with.
    rows = stage(spark, forests.select(*BUCKET, F.explode(F.array("a", "b")).alias("node")).distinct(), "rows")
    near = stage(spark, rows.select("node").distinct(), "near")
    near = members.join(near, "node", "left_semi").select("node", "n", "tokens", "sketch")
    kind = "node long, n long, tokens array<long>, sketch array<long>, wide array<long>"
    near = stage(spark, near.mapInArrow(_with_wide_sketch, kind), "near")
    release(spark)
    # One edge of each set to begin with: most others then lie within a component.
    edges = forests.groupBy(F.greatest("a", "b").alias("b")).agg(F.min(F.least("a", "b")).alias("a"))
    linked_ = _checked(stage(spark, edges.select("a", "b"), "edges"), near, bounds)
    labels = _labels(linked_)
    of_bucket = W.partitionBy(*BUCKET)
    first = 1
    while True:
        # A bucket holds a bounded number of rows.
        known = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        known = known.withColumns({f: g("label").over(of_bucket) for f, g in (("low", F.min), ("high", F.max), ("size", F.count))})
        rows = stage(spark, known.where((F.col("low") != F.col("high")) & (F.col("size") > first)).select(*BUCKET, "node", "label"), "mixed")
        if not rows.head(1):
            return labels, near
        last = first * WIDER - 1
        grouped = rows.join(near.select("node", "n", "sketch"), "node").groupBy(*BUCKET)
        grouped = grouped.agg(F.collect_list(F.struct("node", "n", "sketch", "label")).alias("members"))
        edges = grouped.mapInArrow(_edges_of(_apart(first, last), share), EDGE).select("a", "b").distinct()
        linked_, labels = _joined(stage(spark, edges, "candidates"), near, linked_, labels, bounds)
        rows, first = rows.drop("label"), last + 1
        release(spark)


def _joined(pairs: DataFrame, members: DataFrame, links: DataFrame, labels: DataFrame, bounds: Bounds) -> tuple[DataFrame, DataFrame]:
    """Links and labels once all ``pairs`` are either within a component or found not to link.

    Of the pairs between two components a few are compared at a time: if one of them links, the
    others need not be looked at.
    """
    spark = pairs.sparkSession
    label = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
    first_of = W.partitionBy("low", "high").orderBy("a", "b")
    few = 1
    while True:
        known = pairs.join(label("a"), "a", "left").join(label("b"), "b", "left")
        known = known.select("a", "b", F.coalesce("label_a", "a").alias("x"), F.coalesce("label_b", "b").alias("y")).where("x != y")
        known = stage(spark, known.select("a", "b", F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high")), "open")
        if not known.head(1):
            return links, labels
        # Spark cuts each task's rows to as many before they meet.
        chosen = known.withColumn("turn", F.row_number().over(first_of)).where(F.col("turn") <= few).select("a", "b")
        chosen = stage(spark, chosen, "chosen")
        found = _checked(chosen, members, bounds)
        if found.head(1):
            links = links.unionByName(found)
            labels = _labels(links)
        pairs, few = known.select("a", "b").join(chosen, ["a", "b"], "left_anti"), few * WIDER
        release(spark)


def _labels(links: DataFrame) -> DataFrame:
    """Written, so that the plans that use it stay short."""
    spark = links.sparkSession
    found = components(links).select(F.col("id").alias("node"), F.col("component_id").alias("label"))
    found = stage(spark, found, "components")
    release(spark)
    return found


def _links(members: DataFrame, labels: DataFrame, bounds: Bounds) -> DataFrame:
    """``node`` and ``links``, the number of other sets it links to."""
    sized = members.select("node", "n").join(labels, "node").groupBy("label")
    totals = sized.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("sets"))
    blocks = F.ceil(F.greatest(F.col("total") / FAMILY_BLOCK, F.col("sets") / FAMILY_SETS))
    rows = _blocked(members.join(labels.join(totals, "label"), "node"), "label", blocks, "node")
    rows = rows.select("label", "i", "j", "node", "n", "tokens", "block")
    degrees = rows.groupBy("label", "i", "j").applyInArrow(_degrees(bounds), "node long, links long")
    return degrees.groupBy("node").agg(F.sum("links").alias("n_links"))


def linked(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """One row per row of ``docs``, with what tells its text apart (:data:`TEXT_KEY`): ``n`` (size
    of its set), ``component`` (least id in it), ``n_links`` and ``stands``, which is true for the
    text that stands for its component: the first by id, hash and length (and texts equal to it).
    """
    spark = docs.sparkSession
    bounds = Bounds(percent)
    text = text_of()
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text).alias("hash"),
        F.octet_length(text).alias("length"),
        text.alias("text"),
    )
    hashes = word_hashes(ascii_lower(F.col("text"))).alias("hashes")
    kind = "id long, hash long, length int, n long, set1 long, set2 long, need int, prefix array<long>"
    sets = stage(spark, texts.select(*TEXT_KEY, hashes).mapInArrow(_describe(k, bounds), kind), "sets")
    classes = sets.where("n > 0").groupBy(*CLASS_KEY).agg(F.min(F.struct(*TEXT_KEY)).alias("first"))
    # The numbers of the classes are fixed by writing them.
    classes = classes.select(F.monotonically_increasing_id().alias("node"), *CLASS_KEY, "first.*")
    classes = stage(spark, classes, "classes")
    survivors = stage(spark, _survivors(sets, classes), "survivors")
    release(spark)
    chosen = texts.join(survivors, TEXT_KEY).dropDuplicates(TEXT_KEY).select("node", hashes)
    members = chosen.mapInArrow(_sets(k), "node long, n long, tokens array<long>, sketch array<long>")
    members = stage(spark, members, "members")
    release(spark)

    labels, near = _groups(spark, members, bounds)
    labels = labels.join(_links(near, labels, bounds), "node")
    first = classes.join(labels, "node").groupBy("label").agg(F.min(F.struct(*TEXT_KEY)).alias("first"))
    labels = labels.join(first, "label").select("node", "n_links", F.col("first").alias("group_first"))
    named = classes.join(labels, "node", "left").select(
        *CLASS_KEY,
        F.coalesce("group_first", F.struct(*TEXT_KEY)).alias("first"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
    )
    named = stage(spark, named, "labels")
    with_words = sets.where("n > 0").select(*TEXT_KEY, *CLASS_KEY).join(named, CLASS_KEY)
    stands = F.struct(*TEXT_KEY) == F.col("first")
    with_words = with_words.select(*TEXT_KEY, "n", F.col("first.id").alias("component"), "n_links", stands.alias("stands"))
    return with_words.unionByName(
        sets.where("n = 0").select(
            *TEXT_KEY, "n", F.col("id").alias("component"), F.lit(0).cast("bigint").alias("n_links"), F.lit(True).alias("stands")
        )
    )


def join(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` and ``n_links``.

    Words are told apart by white space and case is folded for A to Z.  ``n_links`` counts the
    other sets that the document's set links to; documents of equal sets are in one component.
    Texts without a word, or null, link with nothing and are their own component.  Rows of one
    id, or without an id, are documents of their own: each links by its own text.  A null id
    comes before all others, so it names the component it is in.
    """
    shown = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return linked(docs, k, percent).select(
        shown("id").alias("doc_id"), F.col("n").alias("n_shingles"), shown("component").alias("component_id"), "n_links"
    )
