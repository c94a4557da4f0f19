"""Phrases by direct-address tiling: pairs of ranked ids are counted in tiles of a pair matrix.

1. Texts are read once.  A task turns its texts into chunks: a sequence of local word numbers,
   with -1 where a piece ends, and the words themselves with their counts.
2. Words are counted per language and ranked by frequency over all languages.  Only words that
   occur as often as a phrase must get an id; others cannot be in one.
3. Chunks become sequences of ids, by a join of each chunk's distinct words with the ranks.
4. Neighbours are pairs of ids.  The matrix of pairs is cut into tiles of ``SIDE`` by ``SIDE``
   cells; each chunk sends its distinct pairs, with their counts, to the parts that hold their
   tiles.  A part counts a tile that is filled well by ``numpy.bincount`` over its cells, and
   sparse tiles by sorting (tile, cell, count) triples.  It also writes down which chunk's pairs
   turned out frequent.
5. Frequent pairs are ranked like words.  The parts look the ranks up for the chunks' frequent
   pairs, which take their place in the sequences, and the same count over neighbours gives
   phrases of one word more, as two phrases that overlap in all but one word each.  This goes on
   to the longest phrases.

A tile of two frequent blocks of ids may hold a third of all pairs.  How much it holds at most is
known from the frequencies, so it is dealt over as many parts as that takes; each counts it
densely, and the partial tiles, of ``SIDE`` squared cells each, are added up.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from cabflow.llm.arrays import Batches, as_lists, lists, mixed, released
from cabflow.llm.common import stage
from cabflow.operators.numbering import running_total, top_k_per_key

#: Words of a chunk, after which a task begins the next one.
CHUNK_WORDS = 1_000_000
#: Ids of one side of a tile are two to this power.
SIDE_BITS = 9
SIDE = 1 << SIDE_BITS
#: Ids are below two to the power of both, so that the two block numbers of a tile fit 62 bits.
BLOCK_BITS = 31
#: Words of the corpus for each part that counts tiles.
PART_WORDS = 2_000_000

#: Bytes of the rows that a Python worker is sent at once; Spark's default is 64 MB.
BATCH_BYTES = 4 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

BREAK, NOTHING = -1, -2
#: A-Z in lower case, tab as space, all ends of a piece as line feed.
BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")

CHUNK = "chunk long, n int, data binary, lang array<string>, word array<string>, times array<long>"
SEQUENCE = "chunk long, n int, data binary"
#: Cells of tiles by part: pairs of a chunk (with their number in it), or counts or ids of pairs.
CELLS = "part int, kind int, chunk long, tile array<long>, cell array<int>, number array<long>, local array<int>"
#: Kinds of such rows, in the order in which they are worked through.
COUNTS, PARTIAL, OF_CHUNK = 0, 1, 2


def packed(numbers: np.ndarray) -> bytes:
    return pa.compress(numbers.tobytes(), codec="zstd", asbytes=True)


def unpacked(n: int, data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


# -- texts to chunks -------------------------------------------------------------------


class _Numbers(dict):
    """Numbers the words of a language in a chunk as they come."""

    def __init__(self, lang: str, words: list[tuple[str, bytes]]):
        super().__init__({b"": NOTHING, b"\n": BREAK})
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append((self.lang, word))
        return number


class _Chunk:
    def __init__(self):
        self.words: list[tuple[str, bytes]] = []
        self.numbers: dict[str, _Numbers] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        numbers = self.numbers.get(lang)
        if numbers is None:
            numbers = self.numbers[lang] = _Numbers(lang, self.words)
        tokens = text.translate(BYTES).replace(b"\n", b" \n ").split(b" ")
        tokens.append(b"\n")
        found = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
        found = found[found != NOTHING]
        self.parts.append(found)
        self.size += len(found)

    def row(self, chunk: int) -> pa.RecordBatch:
        symbols = np.concatenate(self.parts)
        times = np.bincount(symbols[symbols >= 0], minlength=len(self.words))
        langs = pa.array([[lang for lang, _ in self.words]], pa.list_(pa.string()))
        words = pa.array([[word for _, word in self.words]], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
        arrays = [
            pa.array([chunk], pa.int64()),
            pa.array([len(symbols)], pa.int32()),
            pa.array([packed(symbols)], pa.binary()),
            langs,
            words,
            as_lists([times], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["chunk", "n", "data", "lang", "word", "times"])


def _chunks(chunk_words: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for lang, text in zip(batch.column("lang"), texts, strict=True):
                chunk.add(lang.as_py(), text.as_py())
                if chunk.size >= chunk_words:
                    yield chunk.row(number)
                    number, chunk = number + 1, _Chunk()
        if chunk.size:
            yield chunk.row(number)

    return run


# -- sequences of ids ------------------------------------------------------------------


def neighbours(ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places with a known id there and at the next place; the distinct pairs of ids (two arrays)
    with their counts; and for each place the number of its pair."""
    at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
    known, local = np.unique(np.concatenate([ids[at], ids[at + 1]]), return_inverse=True)
    codes = local[: len(at)].astype(np.int64) * max(len(known), 1) + local[len(at) :]
    codes, pair, times = np.unique(codes, return_inverse=True, return_counts=True)
    return at, known[codes // max(len(known), 1)], known[codes % max(len(known), 1)], times, pair


def _rows(batches: Batches, kind: type) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        for chunk, n, data in zip(*(batch.column(c) for c in ("chunk", "n", "data")), strict=True):
            yield chunk.as_py(), unpacked(n.as_py(), data.as_py(), kind)


def _of_words(data: bytes, n: int) -> tuple[int, Callable[[np.ndarray], np.ndarray]]:
    symbols = unpacked(n, data, np.int32)
    size = int(symbols.max(initial=-1)) + 1
    # The end of a piece is the last place of the table.
    return size, lambda ids: np.append(ids, -1)[symbols]


def _of_pairs(data: bytes, n: int) -> tuple[int, Callable[[np.ndarray], np.ndarray]]:
    at, a, _, _, pair = neighbours(unpacked(n, data, np.int64))

    def placed(ids: np.ndarray) -> np.ndarray:
        out = np.full(n, -1, np.int64)
        out[at] = ids[pair]
        return out

    return len(a), placed


def _replaced(opened: Callable, in_lists: bool) -> Callable[[Batches], Batches]:
    """Puts the ids of a chunk's words or pairs in their places; -1 for those without one.

    Rows come by chunk: the chunk itself first, then its ids, one or a list of them a row.
    """

    def row(chunk: int, ids: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array([chunk], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([packed(ids)], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["chunk", "n", "data"])

    def run(batches: Batches) -> Batches:
        chunk, ids, placed = None, None, None
        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            if in_lists:
                each = list(zip(lists(batch.column("local")), lists(batch.column("id")), strict=True))
            else:
                local, id_ = (batch.column(c).to_numpy() for c in ("local", "id"))
            bounds = np.flatnonzero(np.r_[True, chunks[1:] != chunks[:-1], True]) if len(chunks) else []
            for start, end in zip(bounds, bounds[1:], strict=False):
                if chunks[start] != chunk:
                    if placed is not None:
                        yield row(chunk, placed(ids))
                    chunk = int(chunks[start])
                    size, placed = opened(batch.column("data")[start].as_py(), batch.column("n")[start].as_py())
                    ids = np.full(size, -1, np.int64)
                    start += 1
                if in_lists:
                    for local_, id_ in each[start:end]:
                        ids[local_] = id_
                else:
                    ids[local[start:end]] = id_[start:end]
        if placed is not None:
            yield row(chunk, placed(ids))

    return run


def with_ids(sequences: DataFrame, found: DataFrame, opened: Callable) -> DataFrame:
    """Sequences of the ids in ``found`` (``chunk``, and ``local`` and ``id`` or lists of them)."""
    kind = found.schema["local"].dataType
    in_lists = isinstance(kind, ArrayType)
    zero = lambda name: (F.array() if in_lists else F.lit(0)).cast(found.schema[name].dataType).alias(name)
    first = sequences.select("chunk", F.lit(0).alias("turn"), zero("local"), zero("id"), "n", "data")
    none = [F.lit(None).cast("int").alias("n"), F.lit(None).cast("binary").alias("data")]
    then = found.select("chunk", F.lit(1).alias("turn"), "local", "id", *none)
    rows = first.unionByName(then).repartition("chunk").sortWithinPartitions("chunk", "turn")
    return rows.mapInArrow(released(_replaced(opened, in_lists)), SEQUENCE)


# -- tiles -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Tiles:
    """Where the pairs of ids are counted."""

    parts: int
    #: Blocks of ids with more than a part's share of all words, and the parts that take.
    blocks: np.ndarray
    shares: np.ndarray

    def copies(self, tile: np.ndarray) -> np.ndarray:
        """Over how many parts each tile is dealt: a tile holds no more than either block."""
        if not len(self.blocks):
            return np.ones(len(tile), np.int64)

        def share(block: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(self.blocks, block), len(self.blocks) - 1)
            return np.where(self.blocks[at] == block, self.shares[at], 1)

        return np.minimum(share(tile >> BLOCK_BITS), share(tile & ((1 << BLOCK_BITS) - 1)))

    def part(self, tile: np.ndarray, copy: np.ndarray) -> np.ndarray:
        # The copies of a tile go to parts that follow each other.
        start = mixed(tile.view(np.uint64), 11) % np.uint64(self.parts)
        return ((start.astype(np.int64) + copy) % self.parts).astype(np.int32)


def tiles_for(ranked: DataFrame, words: int) -> Tiles:
    """``ranked`` has ``id`` and ``f``.  There are fewer frequent blocks than parts."""
    parts = 16 + words // PART_WORDS
    mass = ranked.groupBy(F.shiftright("id", SIDE_BITS).alias("block")).agg(F.sum("f").alias("mass"))
    share = max(1, words // parts)
    rows = sorted((r["block"], min(parts, math.ceil(r["mass"] / share))) for r in mass.where(F.col("mass") > share).collect())
    blocks, shares = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    return Tiles(parts, blocks, shares)


def summed(tile: np.ndarray, cell: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """Adds up equal cells of equal tiles: tile, cell and sum, and for each entry that came in the
    sum it is part of."""
    turn = np.argsort(tile, kind="stable")
    tile, cell, times = tile[turn], cell[turn], times[turn]
    bounds = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1], True]) if len(tile) else np.zeros(1, np.int64)
    dense = np.flatnonzero(np.diff(bounds) >= SIDE * SIDE // 16)
    sparse, of_entry = np.ones(len(tile), bool), np.zeros(len(tile), np.int64)
    out = [(tile[:0], cell[:0], times[:0].astype(np.int64))]
    for i in dense:
        here = slice(bounds[i], bounds[i + 1])
        sparse[here] = False
        # Sums stay below 2 ** 53, up to which they are exact.
        counts = np.bincount(cell[here], weights=times[here], minlength=SIDE * SIDE).astype(np.int64)
        cells = np.flatnonzero(counts)
        out.append((np.full(len(cells), tile[bounds[i]]), cells.astype(np.int32), counts[cells]))
        of_entry[turn[here]] = counts[cell[here]]
    if sparse.any():
        place = np.flatnonzero(sparse)
        place = place[np.lexsort((cell[place], tile[place]))]
        tile, cell, times = tile[place], cell[place], times[place]
        new = np.r_[True, (tile[1:] != tile[:-1]) | (cell[1:] != cell[:-1])]
        first = np.flatnonzero(new)
        sums = np.add.reduceat(times, first)
        out.append((tile[first], cell[first], sums))
        of_entry[turn[place]] = sums[np.cumsum(new) - 1]
    return *(np.concatenate(c) for c in zip(*out, strict=True)), of_entry


def _cells(kind: int, part: np.ndarray, chunk: int, *columns: np.ndarray) -> pa.RecordBatch:
    """Rows of entries by part; ``columns`` are tile, cell and number, and may be local numbers."""
    turn = np.argsort(part, kind="stable")
    part = part[turn]
    bounds = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
    cut = lambda x: np.split(x[turn], bounds[1:]) if len(bounds) else []
    columns = [*columns, *[part[:0]] * (4 - len(columns))]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32())
    filled = [as_lists(cut(c) if len(c) == len(turn) else [c] * len(bounds), k) for c, k in zip(columns, kinds, strict=True)]
    one = lambda value, k: pa.array([value] * len(bounds), k)
    arrays = [pa.array(part[bounds].astype(np.int32)), one(kind, pa.int32()), one(chunk, pa.int64()), *filled]
    return pa.RecordBatch.from_arrays(arrays, names=["part", "kind", "chunk", "tile", "cell", "number", "local"])


def _in_tile(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(a) and max(a.max(), b.max()) >> (SIDE_BITS + BLOCK_BITS):
        raise OverflowError("more ids than a tile's number can hold")
    tile = (a >> SIDE_BITS) << BLOCK_BITS | (b >> SIDE_BITS)
    return tile, ((a & (SIDE - 1)) << SIDE_BITS | (b & (SIDE - 1))).astype(np.int32)


def _sent(shared) -> Callable[[Batches], Batches]:
    """The distinct pairs of every chunk, by the part that counts them."""

    def run(batches: Batches) -> Batches:
        tiles: Tiles = shared.value
        for chunk, ids in _rows(batches, np.int64):
            _, a, b, times, _ = neighbours(ids)
            tile, cell = _in_tile(a, b)
            copy = mixed(np.array([chunk]), 7).astype(np.int64)[0] % tiles.copies(tile)
            yield _cells(OF_CHUNK, tiles.part(tile, copy), chunk, tile, cell, times, np.arange(len(tile), dtype=np.int32))

    return run


def _by_part(batches: Batches) -> Iterator[tuple[int, list[tuple[int, int, np.ndarray, ...]]]]:
    """Rows of one part after the other: (kind, chunk, tile, cell, number, local)."""
    now, held = None, []
    for batch in batches:
        flat = [batch.column(c).to_pylist() for c in ("part", "kind", "chunk")]
        columns = [lists(batch.column(c)) for c in ("tile", "cell", "number", "local")]
        for part, *row in zip(*flat, *columns, strict=True):
            if part != now:
                if held:
                    yield now, held
                now, held = part, []
            held.append(tuple(row))
    if held:
        yield now, held


def _counted(shared, least: int, look_up: bool) -> Callable[[Batches], Batches]:
    """Counts the tiles of each part, of which the rows come together.

    Cells below ``least`` go.  A tile that is dealt over parts is not known as a whole: all its
    cells stay, as partial counts and (for ``look_up``) in the chunks they are from.
    """

    def run(batches: Batches) -> Batches:
        tiles: Tiles = shared.value
        for part, rows in _by_part(batches):
            of_rows = [np.concatenate(c) for c in zip(*(r[2:5] for r in rows), strict=True)]
            tile, cell, times, of_entry = summed(*of_rows)
            dealt = tiles.copies(tile) > 1
            often = ~dealt & (times >= least)
            yield _cells(COUNTS, np.full(int(often.sum()), part), -1, tile[often], cell[often], times[often])
            if dealt.any():
                # Partial tiles meet again in the part of their first copy.
                meet = tiles.part(tile[dealt], np.zeros(int(dealt.sum()), np.int64))
                yield _cells(PARTIAL, meet, -1, tile[dealt], cell[dealt], times[dealt])
            if look_up:
                keep = (of_entry >= least) | (tiles.copies(of_rows[0]) > 1)
                start = 0
                for _, chunk, tile, cell, number, local in rows:
                    here = keep[start : start + len(tile)]
                    start += len(tile)
                    to = np.full(int(here.sum()), part)
                    yield _cells(OF_CHUNK, to, chunk, tile[here], cell[here], number[here], local[here])

    return run


def _added(least: int) -> Callable[[Batches], Batches]:
    """Counts of tiles from their parts."""

    def run(batches: Batches) -> Batches:
        for part, rows in _by_part(batches):
            tile, cell, times, _ = summed(*(np.concatenate(c) for c in zip(*(r[2:5] for r in rows), strict=True)))
            often = times >= least
            yield _cells(COUNTS, np.full(int(often.sum()), part), -1, tile[often], cell[often], times[often])

    return run


def _dealt(cells: DataFrame, parts: int) -> DataFrame:
    return cells.repartition(parts, "part").sortWithinPartitions("part", "kind")


@dataclass(frozen=True)
class Counted:
    """Frequent pairs (``a``, ``b``, ``f``), and the chunks' pairs that may be among them."""

    pairs: DataFrame
    of_chunks: DataFrame
    parts: int
    shared: Broadcast


def count_pairs(sequences: DataFrame, ranked: DataFrame, least: int, words: int, look_up: bool) -> Counted:
    """Ids that stand next to each other ``least`` times or more, and how often."""
    spark = sequences.sparkSession
    tiles = tiles_for(ranked, words)
    shared = spark.sparkContext.broadcast(tiles)
    sent = sequences.mapInArrow(released(_sent(shared)), CELLS)
    counted = stage(spark, _dealt(sent, tiles.parts).mapInArrow(released(_counted(shared, least, look_up)), CELLS), "tiles")
    added = _dealt(counted.where(F.col("kind") == PARTIAL), tiles.parts).mapInArrow(_added(least), CELLS)
    cells = counted.where(F.col("kind") == COUNTS).unionByName(added)
    cells = cells.select(F.explode(F.arrays_zip("tile", "cell", "number")).alias("c"))
    low, in_low = F.col("c.tile").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)), F.col("c.cell").bitwiseAND(F.lit(SIDE - 1))
    high, in_high = F.shiftright("c.tile", BLOCK_BITS), F.shiftright("c.cell", SIDE_BITS)
    pairs = cells.select(
        (F.shiftleft(high, SIDE_BITS) + in_high).alias("a"), (F.shiftleft(low, SIDE_BITS) + in_low).alias("b"), F.col("c.number").alias("f")
    )
    return Counted(pairs, counted.where(F.col("kind") == OF_CHUNK), tiles.parts, shared)


def _listed(shared) -> Callable[[Batches], Batches]:
    """Ids of pairs by the parts that hold the pairs; a tile that is dealt goes to all its parts."""

    def run(batches: Batches) -> Batches:
        tiles: Tiles = shared.value
        for batch in batches:
            a, b, ids = (batch.column(c).to_numpy() for c in ("a", "b", "id"))
            tile, cell = _in_tile(a, b)
            copies = tiles.copies(tile)
            each = np.repeat(np.arange(len(tile)), copies)
            copy = np.arange(len(each)) - np.repeat(np.cumsum(copies) - copies, copies)
            yield _cells(COUNTS, tiles.part(tile[each], copy), -1, tile[each], cell[each], ids[each])

    return run


def _looked_up(batches: Batches) -> Batches:
    """Ids of the chunks' pairs: rows of one part come together, its ids first."""
    for _, rows in _by_part(batches):
        known = [r[2:5] for r in rows if r[0] == COUNTS]
        if not known:
            continue
        tile, cell, ids = (np.concatenate(c) for c in zip(*known, strict=True))
        names = np.unique(tile)
        key = np.searchsorted(names, tile) << (2 * SIDE_BITS) | cell
        turn = np.argsort(key)
        key, ids = key[turn], ids[turn]
        for kind, chunk, tile, cell, _, local in rows:
            if kind != OF_CHUNK:
                continue
            at = np.minimum(np.searchsorted(names, tile), len(names) - 1)
            wanted = at << (2 * SIDE_BITS) | cell
            place = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            same = (names[at] == tile) & (key[place] == wanted)
            arrays = [pa.array([chunk], pa.int64()), as_lists([local[same]], pa.int32()), as_lists([ids[place[same]]], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "local", "id"])


def ids_of_pairs(counted: Counted, pairs: DataFrame) -> DataFrame:
    """``chunk`` and lists of ``local`` and ``id`` for the pairs with an ``id``."""
    ids = pairs.select("a", "b", "id").mapInArrow(_listed(counted.shared), CELLS)
    rows = _dealt(counted.of_chunks.unionByName(ids), counted.parts)
    return rows.mapInArrow(released(_looked_up), "chunk long, local array<int>, id array<long>")


# -- phrases ---------------------------------------------------------------------------


def by_frequency(rows: DataFrame, names: list[str], label: str) -> DataFrame:
    """Adds ``id``, from 0 for the most frequent."""
    ranked = running_total(rows, [], [F.desc("f"), *names], "id")
    return stage(rows.sparkSession, ranked.withColumn("id", F.col("id") - 1), label)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)); decimals, as the products may pass 64 bits."""
    wide = lambda c: c.cast("decimal(16,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(left) * wide(right))


def phrases(docs: DataFrame, longest: int = 3, least: int = 10, percent: int = 50, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """All phrases of 2 to ``longest`` words that occur ``least`` times or more, per language.

    Columns ``lang``, ``phrase``, ``words``, ``a`` (occurrences), ``l`` and ``r`` (of the two
    parts of the cut that scores lowest; the shortest first part of equal ones), ``n`` (words of
    the language), ``score``, ``dropped`` (whether a longer phrase that contains it occurs
    ``percent`` of ``a`` times or more).  Null texts count as empty, a null language is ``und``,
    ids are not read, and repeated rows count as often as they are there.

    Lowers the session's bytes per Arrow batch to ``BATCH_BYTES`` and leaves it there, as the plan runs later.
    """
    spark = docs.sparkSession
    spark.conf.set(ARROW_BYTES, BATCH_BYTES)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    chunks = stage(spark, texts.mapInArrow(released(_chunks(chunk_words)), CHUNK), "chunks")
    listed = chunks.select("chunk", F.posexplode(F.arrays_zip("lang", "word", "times")).alias("local", "w"))
    listed = listed.select("chunk", "local", "w.lang", "w.word", "w.times")
    counts = stage(spark, listed.groupBy("lang", "word").agg(F.sum("times").alias("f")), "words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    total = counts.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]

    ranked = by_frequency(counts.where(F.col("f") >= least), ["lang", "word"], "ranks")
    found = listed.join(ranked.select("lang", "word", "id"), ["lang", "word"]).select("chunk", "local", "id")
    sequences = stage(spark, with_ids(chunks.select("chunk", "n", "data"), found, _of_words), "sequences")
    # A phrase with the counts of its first 1, 2, ... words and of its last 1, 2, ... words.
    own = F.array("f")
    known = ranked.select("id", "f", "lang", F.array("word").alias("words"), own.alias("firsts"), own.alias("lasts"))
    levels: list[DataFrame] = []
    for size in range(2, longest + 1):
        counted = count_pairs(sequences, ranked, least, total, look_up=size < longest)
        pairs = by_frequency(counted.pairs, ["a", "b"], f"phrases-{size}")
        left = known.select(F.col("id").alias("a"), "lang", F.col("words").alias("head"), "firsts")
        right = known.select(F.col("id").alias("b"), F.element_at("words", -1).alias("tail"), "lasts")
        joined = pairs.join(left, "a").join(right, "b")
        known = joined.select(
            "id",
            "f",
            "lang",
            F.concat("head", F.array("tail")).alias("words"),
            F.concat("firsts", F.array("f")).alias("firsts"),
            F.concat("lasts", F.array("f")).alias("lasts"),
            "a",
            "b",
        )
        known = stage(spark, known, f"known-{size}")
        levels.append(known)
        if size < longest:
            sequences = with_ids(sequences, ids_of_pairs(counted, pairs), _of_pairs)
            if size + 1 < longest:
                sequences = stage(spark, sequences, "sequences")
            ranked = pairs

    out = []
    for i, level in enumerate(levels):
        # What contains a phrase and is longer by more is no more frequent than what is by one.
        if i + 1 < len(levels):
            longer = levels[i + 1]
            inside = longer.select(F.col("a").alias("id"), "f").unionByName(longer.select(F.col("b").alias("id"), "f"))
            best = inside.groupBy("id").agg(F.max("f").alias("best"))
            level = level.join(best, "id", "left")
            dropped = F.coalesce(100 * F.col("best") >= percent * F.col("f"), F.lit(False))
        else:
            dropped = F.lit(False)
        cuts = [
            F.struct(
                _score(F.col("f"), F.get("firsts", F.lit(k - 1)), F.get("lasts", F.lit(i + 1 - k))).alias("score"),
                F.lit(k).alias("k"),
                F.get("firsts", F.lit(k - 1)).alias("l"),
                F.get("lasts", F.lit(i + 1 - k)).alias("r"),
            )
            for k in range(1, i + 2)
        ]
        cut = F.array_min(F.array(*cuts))
        out.append(
            level.select("lang", F.array_join("words", " ").alias("phrase"), "words", F.col("f").alias("a"), cut.alias("cut"), dropped.alias("dropped"))
        )
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    every = every.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score", "dropped")
    return every.join(totals, "lang")


def report(found: DataFrame, top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of each language that are not dropped, with their ``rank``."""
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # Most go in the tasks they are in; what is left of a language is numbered over many.
    salted = found.where(~F.col("dropped")).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(16)))
    first = top_k_per_key(salted, ["lang", "salt"], order, top)
    ranked = running_total(first, ["lang"], order, "rank")
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
