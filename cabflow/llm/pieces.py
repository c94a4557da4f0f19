"""SentencePiece encoding and decoding over a relational lattice.

A text is written with a space in front and cut into segments (spaces with the run behind them,
or a line end) that no piece crosses.  The lattice of a segment is a relation: its substrings up
to the length of the longest piece are exploded and equi-joined with the piece table.  Each match
is an edge, and a character that is no piece has an edge of its own (its bytes).  Edges are
grouped by segment and place of their end, and a fold over the places keeps the best total of
each (Viterbi); a second fold walks back.

Segments are cut further into parts, between neighbours that stand together in no piece.  Parts that
many documents share are encoded once and sent to all tasks, at most ``frequent`` characters of
them; the others are encoded where their document is, once for each document: there the same
relation is made batch by batch, so that texts are not shuffled.  A part of one character has a
single edge and needs no fold.  Which way a part takes does not change its pieces.  Decoding
concatenates pieces and bytes and gives the text back exactly.

The score of a piece is its log probability.  A merge vocabulary has no probabilities, only
ranks; there it is that of Zipf's law, ``-log(rank + 1)``, and the pieces are those of the best
path, which need not be those that the merges would leave.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.arrays import released
from cabflow.llm.common import stage, text_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEGMENT = r" +[^ \n]*|\n|[^ \n]+"
#: Characters of the frequent segments that are sent to all tasks.
FREQUENT = 2_500_000
#: Characters of those that one task encodes.
PART_CHARS = 50_000
#: Longer segments are encoded where they stand.
MOST_CHARS = 64
#: Stands between the parts of a text while it is cut.
MARK = "\U0010ffff"
#: Characters of the segments whose lattices one batch holds (a longer document is a batch).
BATCH_CHARS = 100_000
#: Documents that a Python worker is sent at once; Spark's default would be all of a task's.
BATCH_ROWS = 500
#: Pieces of the texts that are filled in at once (a longer document by itself).
BATCH_PIECES = 200_000
#: A vocabulary of more pieces is not sent to all tasks.
MOST_PIECES = 1_000_000
SPELLED = -1
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
EDGE = "struct<len: int, id: int, score: double>"


@dataclass
class Vocabulary:
    """The pieces of a model: text (with real spaces), id and score; and the ids of bytes."""

    pieces: list[tuple[str, int, float]]
    byte_ids: list[int]
    unknown: int

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        """Reads the file on the driver; the tasks get its table."""
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        if n > MOST_PIECES:
            raise ValueError(f"{n} pieces are too many to send to every task")
        byte_ids = {sp.id_to_piece(i): i for i in range(n) if sp.is_byte(i)}
        usual = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        # Scores of a merge vocabulary are whole numbers that fall by one.
        ranked = all(float(sp.get_score(i)).is_integer() for i in usual)
        score = lambda i: -math.log(1 - sp.get_score(i) + 1) if ranked else sp.get_score(i)
        pieces = [(sp.id_to_piece(i).replace("▁", " "), i, score(i)) for i in usual]
        if any("\n" in p or " " in p.lstrip(" ") for p, _, _ in pieces):
            raise ValueError("a piece crosses the bounds of segments")
        return cls(pieces, [byte_ids.get(f"<0x{b:02X}>", sp.unk_id()) for b in range(256)], sp.unk_id())

    @property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.pieces), default=1)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.pieces, "piece string, id int, score double")

    @property
    def pairs(self) -> frozenset[str]:
        """Neighbouring characters that some piece holds together."""
        return frozenset(p[a : a + 2] for p, _, _ in self.pieces for a in range(len(p) - 1))

    @property
    def spelled_score(self) -> float:
        return min((s for _, _, s in self.pieces), default=0.0) - 10.0


def written(text: Column) -> Column:
    """The text as it is encoded: with a space in front, or empty."""
    return F.when(text != "", F.concat(F.lit(" "), text)).otherwise(F.lit(""))


def segments(text: Column) -> Column:
    return F.regexp_extract_all(written(text), F.lit(SEGMENT), F.lit(0))


class Cuts:
    """Cuts a text where no piece crosses, which is at all bounds of segments and often within them."""

    def __init__(self, vocabulary: Vocabulary):
        pairs = vocabulary.pairs
        chars = sorted({c for pair in pairs for c in pair})
        number = {c: k for k, c in enumerate(chars, 1)}
        # Characters that stand in no pair have the number 0.
        self.number = np.zeros(0x110000, np.uint16)
        self.number[[ord(c) for c in chars]] = range(1, len(chars) + 1)
        self.together = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for one, two in pairs:
            self.together[number[one], number[two]] = True

    def parts(self, text: str) -> list[str]:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        numbers = self.number[codes]
        at = np.flatnonzero(~self.together[numbers[:-1], numbers[1:]]) + 1
        if MARK in text:
            return [text[a:b] for a, b in zip([0, *at], [*at, len(text)], strict=True)]
        return np.insert(codes, at, ord(MARK)).tobytes().decode("utf-32-le").split(MARK)


def lattice(rows: DataFrame, keys: tuple[str, ...], vocabulary: Vocabulary) -> DataFrame:
    """``keys`` and ``places`` of each segment: the edges that end at each; ``rows`` has the keys, the last is ``segment``.

    A long segment is cut into blocks that overlap by the longest piece before its substrings
    are taken, so that finding a place does not start at the beginning each time.
    """
    longest, block = vocabulary.longest, 256
    offsets = F.sequence(F.lit(0), F.length("segment") - 1, F.lit(block))
    blocks = F.transform(
        offsets, lambda o: F.struct(o.alias("at"), F.substring(F.col("segment"), o + 1, F.lit(block + longest)).alias("text"))
    )
    starts = lambda b: F.sequence(F.lit(1), F.least(F.length(b["text"]), F.lit(block)))
    windows = F.transform(
        starts(F.col("b")),
        lambda i: F.struct((F.col("b.at") + i).alias("start"), F.substring(F.col("b.text"), i, F.lit(longest)).alias("text")),
    )
    cut = rows.select(*keys, F.explode(blocks).alias("b")).select(*keys, F.explode(windows).alias("w"))
    cut = cut.select(*keys, "w.start", "w.text", F.explode(F.sequence(F.lit(1), F.length("w.text"))).alias("len"))
    cut = cut.select(*keys, "start", "len", F.left("text", F.col("len")).alias("piece"))
    matched = cut.join(F.broadcast(vocabulary.table(rows.sparkSession)), "piece", "left")
    matched = matched.where(F.col("id").isNotNull() | (F.col("len") == 1))
    edge = F.struct(
        "len",
        F.coalesce("id", F.lit(SPELLED)).alias("id"),
        F.coalesce("score", F.lit(vocabulary.spelled_score)).alias("score"),
    )
    end = (F.col("start") + F.col("len") - 1).alias("end")
    by_end = matched.select(*keys, end, edge.alias("edge")).groupBy(*keys, "end").agg(F.collect_list("edge").alias("edges"))
    places = by_end.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("end", "edges"))).alias("places"))
    return places.withColumn("places", F.col("places.edges"))


def best_totals(places: Column) -> Column:
    """The best total score up to every place, the last place first and the start last.

    Totals alone are numbers: comparing them, and putting one in front, costs far less than with
    the pieces beside them.  The walk back looks again at the edges of the places it comes through.
    """

    def step(done, edges):
        return F.array_prepend(done, F.array_max(F.transform(edges, lambda e: F.get(done, e["len"] - 1) + e["score"])))

    return F.aggregate(places, F.array(F.lit(0.0)), step)


def best_path(places: Column, totals: Column) -> Column:
    """Ids along the best path; ties go to the longer piece.  Both must be plain columns or fields."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ids"))
    size = F.size(places)

    def back(state, _):
        # As far from the end as ``at`` says.
        edges = F.get(places, size - 1 - state["at"])
        ways = F.transform(
            edges, lambda e: F.struct((F.get(totals, state["at"] + e["len"]) + e["score"]).alias("total"), e["len"].alias("len"), e["id"].alias("id"))
        )
        moved = F.transform(
            F.array(F.array_max(ways)),
            lambda way: F.struct((state["at"] + way["len"]).alias("at"), F.array_prepend(state["ids"], way["id"]).alias("ids")),
        )
        return F.when(state["at"] < size, F.get(moved, F.lit(0))).otherwise(state)

    return F.aggregate(places, start, back, lambda s: s["ids"])


def best_ids(places: Column) -> Column:
    """Ids of the best path through the lattice of a segment (Viterbi)."""
    # Through an array, so that the totals are folded once and not for every edge that reads them.
    both = F.array(F.struct(places.alias("places"), best_totals(places).alias("totals")))
    return F.get(F.transform(both, lambda o: best_path(o["places"], o["totals"])), F.lit(0))


def encoded(rows: DataFrame, keys: tuple[str, ...], vocabulary: Vocabulary, parts: int) -> DataFrame:
    """``keys`` and ``ids`` of each segment."""
    # Dealt before the substrings are taken, so that the edges stay where they are.  The number of
    # parts is given: the adaptive planner would go by the size of the segments, not of their edges.
    rows = rows.repartition(parts, *keys)
    return lattice(rows, keys, vocabulary).select(*keys, best_ids(F.col("places")).alias("ids"))


def _parts_of(vocabulary: Vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The parts of each word with a space in front, with its count; not those of one character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = Cuts(vocabulary)
        for batch in (b for b in batches if b.num_rows):
            # A word holds no space, so each begins with the part that does.
            parts = cuts.parts(" " + " ".join(batch.column(0).to_pylist()))
            word = np.cumsum([p[0] == " " for p in parts]) - 1
            use = np.array([len(p) > 1 for p in parts])
            n = batch.column(1).to_numpy()[word[use]]
            yield pa.RecordBatch.from_arrays([pa.array([p for p in parts if len(p) > 1], pa.string()), pa.array(n)], names=["segment", "n"])

    return run


def frequent_segments(texts: DataFrame, most: int, vocabulary: Vocabulary) -> DataFrame:
    """The parts that occur most, of at most ``most`` characters: those above a count.

    That bounds their table.  What stands between two spaces is counted whole, if it is not longer than
    ``MOST_CHARS`` and occurs more than once; only the distinct ones are cut.  The count decides speed only.
    """
    every = texts.select(F.explode(F.split("text", " ")).alias("word")).where(F.length("word").between(1, MOST_CHARS))
    counts = every.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = counts.mapInArrow(released(_parts_of(vocabulary)), "segment string, n long")
    counts = stage(texts.sparkSession, counts.groupBy("segment").agg(F.sum("n").alias("n")), "segments")
    # Counts are few: their number is that of distinct frequencies.
    by_count = counts.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.sum(F.length("segment")).alias("chars"))
    least, total = None, 0
    for row in sorted(by_count.collect(), key=lambda r: -r["n"]):
        total += row["chars"]
        if total > most:
            break
        least = row["n"]
    return counts.where(F.col("n") >= least).select("segment") if least else counts.where("false").select("segment")


class Known:
    """Segments with their ids as bytes; looked up in the tasks, where the table is made once a worker."""

    def __init__(self, segment: pa.Array, ids: pa.Array):
        self.segment, self.ids = segment, ids

    @cached_property
    def table(self) -> dict[str, bytes]:
        flat, ends = self.ids.flatten().to_numpy(), np.cumsum(pc.list_value_length(self.ids).to_numpy(zero_copy_only=False))
        flat, found, at = flat.astype(np.int32).tobytes(), {}, 0
        for segment, end in zip(self.segment.to_pylist(), (4 * ends).tolist(), strict=True):
            found[segment] = flat[at:end]
            at = end
        self.segment = self.ids = None
        return found


class Bytes:
    """Puts the ids of bytes where a character is no piece."""

    def __init__(self, vocabulary: Vocabulary):
        self.byte_ids = vocabulary.byte_ids
        self.lengths = {i: len(p) for p, i, _ in vocabulary.pieces}

    def spell(self, segment: str, ids: list[int]) -> list[int]:
        out, at = [], 0
        for i in ids:
            if i == SPELLED:
                out += [self.byte_ids[b] for b in segment[at].encode()]
                at += 1
            else:
                out.append(i)
                at += self.lengths[i]
        return out

    def spell_all(self, segment: pa.Array, ids: pa.ListArray) -> pa.ListArray:
        """The same for a column; most segments have no such character and are left alone."""
        flat = ids.flatten().to_numpy()
        if not (flat == SPELLED).any():
            return ids
        out = [self.spell(s, i) if SPELLED in i else i for s, i in zip(segment.to_pylist(), ids.to_pylist(), strict=True)]
        return pa.array(out, pa.list_(pa.int32()))


class Edges:
    """The join of substrings with pieces for segments that are encoded where their document is."""

    def __init__(self, vocabulary: Vocabulary):
        pieces = [*vocabulary.pieces, ("", SPELLED, vocabulary.spelled_score)]
        self.sizes = np.array([len(p) for p, _, _ in pieces[:-1]] + [1], np.int32)
        self.ids = np.array([i for _, i, _ in pieces], np.int32)
        self.scores = np.array([s for _, _, s in pieces])
        self.spelled, self.longest = len(pieces) - 1, vocabulary.longest
        # A substring that ends no piece is not made longer to the left.
        self.row = {p[a:]: None for p, _, _ in vocabulary.pieces for a in range(len(p))}
        self.row |= {p: k for k, (p, _, _) in enumerate(vocabulary.pieces)}

    def places(self, segments: list[str]) -> pa.ListArray:
        """For each segment the edges that end at each place."""
        row, longest, spelled = self.row, self.longest, self.spelled
        rows, ends = [], [0]
        for s in segments:
            for end in range(1, len(s) + 1):
                one = row.get(s[end - 1], spelled)
                rows.append(spelled if one is None else one)
                for start in range(end - 2, max(-1, end - longest - 1), -1):
                    k = row.get(s[start:end], spelled)
                    if k == spelled:
                        break
                    if k is not None:
                        rows.append(k)
                ends.append(len(rows))
        rows = np.array(rows, np.int64)
        columns = [pa.array(x[rows]) for x in (self.sizes, self.ids, self.scores)]
        edges = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, names=["len", "id", "score"]))
        return pa.ListArray.from_arrays(_offsets([len(s) for s in segments]), edges)


def _offsets(lengths: list[int]) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(lengths)), pa.int32())


def _look_up(known, vocabulary: Vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``ids``, with -2 - k for the k-th part that is not known, and ``own``: those parts, once each, with their edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, cuts = Edges(vocabulary), Cuts(vocabulary)
        table = known.value.table
        table |= {p: np.int32(i).tobytes() for p, i, _ in vocabulary.pieces if len(p) == 1}

        @lru_cache(10_000)
        def spelled(char: str) -> bytes:
            return np.array([vocabulary.byte_ids[b] for b in char.encode()], np.int32).tobytes()

        def block(batch: pa.RecordBatch, first: int, ids: list[bytes], own: list[list[str]]) -> pa.RecordBatch:
            flat = [s for segments in own for s in segments]
            pairs = pa.StructArray.from_arrays([pa.array(flat, pa.string()), edges.places(flat)], names=["segment", "places"])
            part = batch.slice(first, len(own))
            found = pa.ListArray.from_arrays(_offsets([len(x) // 4 for x in ids]), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            own = pa.ListArray.from_arrays(_offsets([len(segments) for segments in own]), pairs)
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), found, own], names=["doc_id", "text", "ids", "own"])

        for batch in batches:
            first, chars, ids, own = 0, 0, [], []
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                here: dict[str, int] = {}
                found = cuts.parts(f" {text}") if text else []
                parts = list(map(table.get, found))
                k = -1
                for _ in range(parts.count(None)):
                    k = parts.index(None, k + 1)
                    if len(found[k]) == 1:
                        parts[k] = spelled(found[k])
                    else:
                        parts[k] = (-2 - here.setdefault(found[k], len(here))).to_bytes(4, sys.byteorder, signed=True)
                ids.append(b"".join(parts))
                own.append(list(here))
                chars += sum(map(len, here)) + len(text) // 8
                if chars >= BATCH_CHARS:
                    yield block(batch, first, ids, own)
                    first, chars, ids, own = i + 1, 0, [], []
            if own:
                yield block(batch, first, ids, own)

    return run


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``BATCH_PIECES`` ids."""
    total = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + BATCH_PIECES, "right")))
        yield batch.slice(first, last - first)
        first = last


def _fill_in(vocabulary: Vocabulary, decoded: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The ids of each text, with those of its own parts in their places, and the text they decode to."""
    letters, texts = Bytes(vocabulary), Texts(vocabulary) if decoded else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _parts(whole)):
            ids, own = batch.column(2), batch.column(3)
            flat = ids.flatten().to_numpy()
            sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
            pairs = own.flatten()
            found = letters.spell_all(pairs.field(0), pairs.field(1))
            lengths = pc.list_value_length(found).to_numpy(zero_copy_only=False)
            found, starts = found.flatten().to_numpy(), np.cumsum(lengths) - lengths
            firsts = np.cumsum(pc.list_value_length(own).to_numpy(zero_copy_only=False))
            firsts = np.append(0, firsts)[:-1]
            # Which of all own parts of the batch stands at each place.
            at = np.flatnonzero(flat <= -2)
            document = np.repeat(np.arange(len(sizes)), sizes)
            segment = -2 - flat[at] + firsts[document[at]]
            width = np.ones(len(flat), np.int64)
            width[at] = lengths[segment]
            out = np.repeat(flat, width)
            begin = (np.cumsum(width) - width)[at]
            within = np.arange(width[at].sum()) - np.repeat(np.cumsum(width[at]) - width[at], width[at])
            out[np.repeat(begin, width[at]) + within] = found[np.repeat(starts[segment], width[at]) + within]
            ends = np.append(0, np.cumsum(width))[np.append(0, np.cumsum(sizes))]
            full = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out, pa.int32()))
            columns = {"doc_id": batch.column(0), "text": batch.column(1), "ids": full}
            if texts is not None:
                columns["decoded"] = texts.of(full)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary, frequent: int = FREQUENT, decoded: bool = False) -> DataFrame:
    """``doc_id``, ``text`` and ``ids`` of every row; a null text counts as empty and has no ids.

    Rows of one id are encoded each by itself.  With ``decoded`` there is a column of that name, the
    same as :func:`decode` gives for the ids; made where the ids are, it needs no further Python worker.

    Lowers the session's rows per Arrow batch to ``BATCH_ROWS`` and leaves it there, as the plan runs later.
    """
    spark = docs.sparkSession
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, BATCH_ROWS)
    texts = docs.select("doc_id", text_of().alias("text"))
    parts = max(1, math.ceil(frequent / PART_CHARS))
    common = encoded(frequent_segments(texts, frequent, vocabulary), ("segment",), vocabulary, parts)
    rows = common.toArrow().combine_chunks()
    segment, ids = (rows.column(c).combine_chunks() for c in ("segment", "ids"))
    shared = spark.sparkContext.broadcast(Known(segment, Bytes(vocabulary).spell_all(segment, ids)))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    own = f"array<struct<segment: string, places: array<array<{EDGE}>>>>"
    rows = texts.mapInArrow(released(_look_up(shared, vocabulary)), f"doc_id {id_type}, text string, ids array<int>, own {own}")
    paths = F.transform("own", lambda o: F.struct(o["segment"].alias("segment"), best_ids(o["places"]).alias("ids")))
    rows = rows.select("doc_id", "text", "ids", paths.alias("own"))
    kind = f"doc_id {id_type}, text string, ids array<int>" + (", decoded string" if decoded else "")
    return rows.mapInArrow(released(_fill_in(vocabulary, decoded)), kind)


class Texts:
    """The texts of lists of ids."""

    def __init__(self, vocabulary: Vocabulary):
        table = {i: p.encode() for p, i, _ in vocabulary.pieces}
        table |= {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids) if i != vocabulary.unknown}
        self.size = max(table, default=-1) + 1
        # The last entry stands for ids that are not there.
        self.pieces = pa.array([table.get(i, b"\xef\xbf\xbd") for i in range(self.size + 1)], pa.binary())

    def of(self, column: pa.Array) -> pa.Array:
        out = []
        for numbers in column:
            if not numbers.is_valid:
                out.append(None)
                continue
            # A null number is an id of no piece.
            flat = pc.fill_null(numbers.values, -1).to_numpy(zero_copy_only=False)
            flat = np.where((flat < 0) | (flat > self.size), self.size, flat)
            # The bytes of pieces that are taken stand one behind the other.
            _, ends, data = self.pieces.take(pa.array(flat, pa.int32())).buffers()
            last = np.frombuffer(ends, np.int32)[len(flat)]
            text = data.to_pybytes()[:last].decode("utf-8", "replace") if last else ""
            out.append(text.removeprefix(" "))
        return pa.array(out, pa.string())


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The text of ids; null for null.  Bytes that are no UTF-8, and ids of no piece, become U+FFFD."""
    texts = Texts(vocabulary)

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return texts.of(column)

    return run(ids)
