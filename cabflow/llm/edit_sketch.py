"""Order MinHash fingerprints, with DataFrame functions only.

A text is a sequence of tokens (runs without white space, cut after 12 characters), its k-mers
are ``k`` tokens in a row, and the i-th occurrence of a k-mer counts as an element of its own.
Each tuple orders the elements of the whole text by a hash of its own (the element's hash, hashed
again with the number of the tuple) and takes the ``length`` least.  They are put in the order in
which they stand in the text and hashed together.  Two texts agree in a tuple only if they share
its elements in the same order, so the share of equal tuples falls with the edit distance and not
only with the overlap.  A fingerprint is one hex number per tuple, ``-`` for a text without a
token.

Occurrences are numbered in an array per text, which holds eight bytes a token; then chunks of
elements are rows, one for each tuple, which stay in the partition of their document while they
are reduced.  A text and its edited form share the elements of the part that is the same; the
least of those are found once for both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cabflow.llm.common import stage, text_of

TOKEN = r"[^\x20\x09-\x0D]{1,12}"
#: Bits of an element's number that hold its place in the text.
PLACE_BITS = 28
PLACE = (1 << PLACE_BITS) - 1
#: Elements that one row holds; few enough for the JVM to compile the stage (methods under 8,000 bytes).
CHUNK = 12
#: Rows of a text and tuple that are reduced at once are two to this power.
PART_BITS = 8
#: The same for the parts of a text that begins like another.
BOTH_BITS = 4


def _kmers(tokens: Column, k: int) -> Column:
    """Hashes of the k-mers; a shorter sequence is one k-mer, no token gives none."""
    size = F.size(tokens)
    starts = F.when(size == 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(0), F.greatest(size - k, F.lit(0)))
    )
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(tokens, i + j) for j in range(k)]))


def _packed(kmers: Column) -> Column:
    """K-mers with their places in one number, sorted, so that equal k-mers stand together."""
    return F.sort_array(F.transform(kmers, lambda h, i: F.shiftleft(h, PLACE_BITS).bitwiseOR(i.cast("bigint"))))


def _with_place(hashed: Column, packed: Column) -> Column:
    """The high bits of a hash over the place of a packed element."""
    return hashed.bitwiseAND(F.lit(~PLACE)).bitwiseOR(packed.bitwiseAND(F.lit(PLACE)))


def _numbered(ordered: Column) -> Column:
    """A hash and the place of every k-mer occurrence, packed; ``ordered`` must be a plain column.

    The number of an occurrence is its distance to the first of its k-mer, found by halving
    steps, as equal k-mers before a place are an unbroken run.
    """
    steps = F.array(*[F.lit(1 << p) for p in range(PLACE_BITS - 1, -1, -1)])
    kmer = lambda i: F.shiftright(F.get(ordered, i), PLACE_BITS)

    def element(v: Column, i: Column) -> Column:
        mine = F.shiftright(v, PLACE_BITS)
        farther = lambda d, p: F.when((i >= d + p) & (kmer(i - d - p) == mine), d + p).otherwise(d)
        before = F.when((i > 0) & (kmer(i - 1) == mine), F.aggregate(steps, F.lit(0), farther)).otherwise(F.lit(0))
        return _with_place(F.xxhash64(mine, before), v)

    return F.transform(ordered, element)


def _number(members: Column) -> Column:
    """One number for packed elements, hashed in the order of their places."""
    element = lambda m: F.struct(m.bitwiseAND(F.lit(PLACE)).alias("at"), F.shiftright(m, PLACE_BITS).alias("high"))
    in_text = F.sort_array(F.transform(members, element))
    return F.pmod(F.xxhash64(F.transform(in_text, lambda e: e["high"])), F.lit(1 << 32))


def _of_chunks(chunks: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The least elements of each chunk and slot, as columns."""
    hashed = lambda v: F.when(v.isNotNull(), _with_place(F.xxhash64(F.shiftright(v, PLACE_BITS), "slot"), v))
    mixed = [f"x{i}" for i in range(CHUNK)]
    rows = chunks.select(*keys, "slot", "number", *[hashed(F.get("chunk", F.lit(i))).alias(x) for i, x in enumerate(mixed)])
    for j, name in enumerate(names):
        left = [F.col(x) if j == 0 else F.when(F.col(x) > F.col(names[j - 1]), F.col(x)) for x in mixed]
        rows = rows.select("*", F.least(*left).alias(name))
    return rows.select(*keys, "slot", "number", *names)


def _least(rows: DataFrame, keys: Sequence[str], names: Sequence[str], most_bits: int) -> DataFrame:
    """The least elements of each slot and part of a text; a part is 2 ** ``most_bits`` numbers.

    The two least of a text are the two least of one row, or stand in rows whose numbers
    differ in a bit: then they are the minima of the rows with and without that bit.  Plain
    minima thus give both, and any other pair that they give is greater.
    """
    bits = range(most_bits if len(names) == 2 else 0)
    part = F.shiftright("number", len(bits)).alias("part")
    rows = rows.select(*keys, "slot", part, "number", *names)
    has = lambda b: F.col("number").bitwiseAND(F.lit(1 << b)) != 0
    split = [F.min(F.when(has(b) == bool(v), F.col(names[0]))).alias(f"b{b}_{v}") for b in bits for v in (0, 1)]
    found = rows.groupBy(*keys, "slot", "part").agg(*[F.min(m).alias(m) for m in names], *split)
    if bits:
        pair = lambda x, y: F.when(x.isNotNull() & y.isNotNull(), F.greatest(x, y))
        pairs = [pair(F.col(f"b{b}_0"), F.col(f"b{b}_1")) for b in bits]
        found = found.withColumn(names[1], F.least(names[1], *pairs))
    return found.select(*keys, "slot", "part", *names)


def _elements(texts: DataFrame, keys: Sequence[str], k: int, **columns: str) -> DataFrame:
    """Numbered elements of texts, as columns; ``columns`` are their names and those of the texts."""
    tokens = {name: F.regexp_extract_all(text_of(text), F.lit(TOKEN), F.lit(0)).alias(name) for name, text in columns.items()}
    split = texts.select(*keys, *tokens.values())
    split = split.select(*keys, *[_packed(_kmers(F.col(name), k)).alias(name) for name in columns])
    return split.select(*keys, *[_numbered(F.col(name)).alias(name) for name in columns])


def _least_of_parts(split: DataFrame, keys: Sequence[str], tuples: int, names: Sequence[str]) -> DataFrame:
    """The least of ``elements``: chunks of them are rows, one for each slot."""
    last = F.floor((F.size("elements") - 1) / CHUNK).cast("int")
    starts = F.when(F.size("elements") > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    cut = F.transform(starts, lambda c: F.slice("elements", c * CHUNK + 1, CHUNK))
    # Not a column of its own: for one, the optimizer would add a filter that computes all of it again.
    chunks = split.select(*keys, F.posexplode(cut).alias("number", "chunk"))
    chunks = chunks.select("*", F.explode(F.sequence(F.lit(0), F.lit(tuples - 1))).alias("slot"))
    return _least(_of_chunks(chunks, keys, names), keys, names, PART_BITS)


def _sketched(least: DataFrame, keys: Sequence[str], tuples: int, names: Sequence[str]) -> DataFrame:
    """One number per slot from the least elements of a text's parts."""
    members = F.array_compact(F.array(*names))
    entry = F.struct("slot", "part", members.alias("members"), _number(members).alias("number"))
    found = least.groupBy(*keys).agg(F.collect_list(entry).alias("entries"))
    # Only texts of several parts have their parts put together.
    slots = F.sequence(F.lit(0), F.lit(tuples - 1))
    mine = lambda i: F.flatten(F.transform(F.filter("entries", lambda e: e["slot"] == i), lambda e: e["members"]))
    merged = F.transform(slots, lambda i: _number(F.slice(F.sort_array(mine(i)), 1, len(names))))
    ordered = F.transform(F.array_sort(F.transform("entries", lambda e: F.struct(e["slot"], e["number"]))), lambda e: e["number"])
    sketch = F.when(F.size("entries") == tuples, ordered).otherwise(merged)
    return found.select(*keys, sketch.alias("sketch"))


def _names(length: int) -> list[str]:
    return [f"m{j}" for j in range(length)]


def sketches(texts: DataFrame, keys: Sequence[str], k: int = 3, tuples: int = 64, length: int = 2) -> DataFrame:
    """``keys`` and ``sketch`` (array of numbers below 2 ** 32) of every text with a token.

    ``texts`` has ``keys`` (unique) and ``text`` and is partitioned by one or more of the keys,
    which keeps all steps without a shuffle.  A text with fewer than ``length`` elements takes
    all of them into each tuple.
    """
    split = _elements(texts, keys, k, elements="text")
    names = _names(length)
    return _sketched(_least_of_parts(split, keys, tuples, names), keys, tuples, names)


def sketches_of_two(
    texts: DataFrame, keys: Sequence[str], start: Column, k: int = 3, tuples: int = 64, length: int = 2
) -> DataFrame:
    """``keys``, ``side`` (0 or 1) and ``sketch`` of ``text`` and ``edited``.

    Both begin with ``start``.  The elements that lie in it, up to its last token, are the same
    in both and stand in the same places, so the least of them are found once: the least of a text
    are among those and the least of the rest of it.
    """
    names, side = _names(length), [*keys, "side"]
    # The last token may go on after the start.
    tokens = F.size(F.regexp_extract_all(start, F.lit(TOKEN), F.lit(0))) - 1
    rows = texts.select(*keys, "text", "edited", F.greatest(tokens - (k - 1), F.lit(0)).cast("bigint").alias("same"))
    both = _elements(rows, [*keys, "same"], k, own="text", changed="edited")
    place = lambda e: e.bitwiseAND(F.lit(PLACE))
    parts = [
        F.filter("own", lambda e: place(e) < F.col("same")),
        F.filter("own", lambda e: place(e) >= F.col("same")),
        F.filter("changed", lambda e: place(e) >= F.col("same")),
    ]
    parts = [F.struct(F.lit(i).alias("side"), e.alias("elements")) for i, e in enumerate(parts)]
    split = both.select(*keys, F.explode(F.array(*parts)).alias("s")).select(*keys, "s.side", "s.elements")
    least = _least_of_parts(split, side, tuples, names)
    # The common part belongs to both texts, the others to one.
    of = F.when(F.col("side") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.col("side") - 1))
    number = F.col("part") * 2 + F.when(F.col("side") == 0, 0).otherwise(1)
    least = least.select(*keys, F.explode(of).alias("side"), "slot", number.alias("number"), *names)
    return _sketched(_least(least, side, names, BOTH_BITS), side, tuples, names)


def fingerprint(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda v: F.coalesce(F.lpad(F.hex(v), 8, "0"), F.lit("-"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples among those that either text has; 1 for two empty texts."""
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    either = F.size(F.filter(pairs, lambda p: p["x"].isNotNull() | p["y"].isNotNull()))
    equal = F.size(F.filter(pairs, lambda p: p["x"] == p["y"]))
    return F.when(either == 0, F.lit(1.0)).otherwise(equal / either)


KEYS = ("id", "crc", "n_chars")
#: Stands for a null id: such rows come first.
NO_ID = -(1 << 63)


def in_order(rows: DataFrame) -> DataFrame:
    """Distinct keys with their number in the order of the keys, how often they occur, and
    how many there are.

    The keys alone are cut into ranges; each part is counted and starts where those before it
    end.  The parts are written, because their numbers must not change when a task runs again.
    """
    parts = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("copies"))
    parts = parts.repartitionByRange(*KEYS).withColumn("part", F.spark_partition_id())
    parts = stage(rows.sparkSession, parts, "ids")
    # One row for each part, so the window without a key stays small.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        parts.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "part",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
            F.sum("n").over(W.partitionBy()).alias("total"),
        )
    )
    within = F.row_number().over(W.partitionBy("part").orderBy(*KEYS))
    return parts.join(starts, "part").select(*KEYS, "copies", (F.col("start") + within - 1).alias("number"), "total")


def _renamed(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in columns])


def fingerprints(docs: DataFrame, k: int = 3, tuples: int = 64, length: int = 2) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    In the edited text the last quarter is replaced by as much of the start of the next text,
    in the order of the ids; after the last comes the first.  Null texts count as empty, rows
    with a null id come first, and rows of one id go by checksum and length.  Rows that are
    equal count as one text in that order, and each gets the result.
    """
    spark = docs.sparkSession
    text = text_of()
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.crc32(text).alias("crc"),
        F.length(text).alias("n_chars"),
        text.alias("text"),
    )
    numbered = stage(spark, in_order(rows.select(*KEYS)), "order")
    following = _renamed(numbered, "next_", *KEYS, "number")
    preceding = _renamed(numbered, "previous_", *KEYS, "number")
    links = numbered.join(
        following, F.pmod(F.col("number") + 1, F.col("total")) == F.col("next_number")
    ).join(preceding, F.pmod(F.col("number") - 1, F.col("total")) == F.col("previous_number"))
    links = stage(spark, links.drop("number", "total", "next_number", "previous_number"), "links")

    quarter = lambda n: F.floor(F.col(n) / 4).cast("int")
    linked = rows.join(links, list(KEYS))
    first = [F.first(c).alias(c) for c in linked.columns if c not in KEYS]
    linked = linked.groupBy(*KEYS).agg(*first)
    heads = linked.select(
        *[F.col(f"previous_{c}").alias(c) for c in KEYS], F.left("text", quarter("previous_n_chars")).alias("head")
    )
    start = F.left("text", F.col("n_chars") - quarter("n_chars"))
    edited = F.concat(start, F.col("head"))
    both = linked.join(heads, list(KEYS)).withColumn("edited", edited)
    drawn = sketches_of_two(both, KEYS, start, k, tuples, length)
    side = lambda i: F.first(F.when(F.col("side") == i, F.col("sketch")), ignorenulls=True)
    drawn = drawn.groupBy(*KEYS).agg(side(0).alias("own"), side(1).alias("changed"))
    about = both.select(
        *KEYS, *[f"next_{c}" for c in KEYS], "copies", F.sha2(F.col("edited"), 256).alias("edited_sha256")
    )
    nothing = F.array_repeat(F.lit(None).cast("bigint"), tuples)
    known = about.join(drawn, list(KEYS), "left").withColumns(
        {"own": F.coalesce("own", nothing), "changed": F.coalesce("changed", nothing)}
    )
    known = stage(spark, known, "sketches")
    other = known.select(*[F.col(c).alias(f"next_{c}") for c in KEYS], F.col("own").alias("other"))
    result = known.join(other, [f"next_{c}" for c in KEYS])
    return result.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("other")).alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
