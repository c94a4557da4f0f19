"""Texts that hold a benchmark item up to a few edits.

An item of ``n`` characters may differ by ``k = floor(n * error_rate)`` edits.  It is cut into
``k + 1`` pieces; with at most ``k`` edits one piece at least is untouched (pigeonhole).  All
pieces are looked for at once in every whole text, and each exact hit is verified by the
bit-parallel edit distance of Myers over the stretch around it.  Case and runs of white
space do not count; places are those in the text so normalised.  Items of fewer than
``LEAST_CHARS`` characters are looked for as they are, and not inside of words.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import stage

ERROR_RATE = 0.05
#: A shorter item allows no edits and must stand between word bounds.
LEAST_CHARS = 20
#: Characters of items that one pass over the texts looks for.
BLOCK_CHARS = 4_000_000
MATCHES = "array<struct<item_id: bigint, distance: int, start: int, end: int>>"


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of even length with their offsets."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@dataclass
class Pattern:
    """An item prepared for Myers' search."""

    text: str
    k: int

    def __post_init__(self) -> None:
        self.masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(self.text):
            self.masks[c] |= 1 << i
        self.masks = dict(self.masks)

    def search(self, text: str) -> tuple[int, int]:
        """Least distance of the item to any stretch of the text, and where that ends."""
        m = len(self.text)
        full, top = (1 << m) - 1, 1 << (m - 1)
        plus, minus, score = full, 0, m
        best, end = m, 0
        masks = self.masks
        for at, c in enumerate(text, 1):
            same = masks.get(c, 0)
            xv = same | minus
            xh = (((same & plus) + plus) ^ plus) | same
            up = (minus | ~(xh | plus)) & full
            down = plus & xh
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up = (up << 1) & full
            down = (down << 1) & full
            plus = (down | ~(xv | up)) & full
            minus = up & xv
            if score < best:
                best, end = score, at
        return best, end

    def start_of(self, text: str, end: int) -> int:
        """Where the best match that ends at ``end`` begins."""
        back = Pattern(self.text[::-1], self.k)
        _, length = back.search(text[max(0, end - len(self.text) - self.k) : end][::-1])
        return end - length


class Finder:
    """Some items, looked for in texts.  The automaton of their pieces is built where it is used."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float = ERROR_RATE):
        self.given = items, error_rate

    def __reduce__(self):
        """Only the items travel to the tasks."""
        return Finder, self.given

    @cached_property
    def patterns(self) -> dict[int, Pattern]:
        items, error_rate = self.given
        return {item_id: Pattern(text, math.floor(len(text) * error_rate)) for item_id, text in items}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, item in self.patterns.items():
            for offset, piece in pieces(item.text, item.k):
                where[piece].append((item_id, offset))
        automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            automaton.add_word(piece, (len(piece), at))
        if where:
            automaton.make_automaton()
        return automaton

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """For each item found: id, least distance, start and end; by item id."""
        if not text or not self.patterns:
            return []
        text = normalised(text)
        starts: dict[int, list[int]] = defaultdict(list)
        for last, (length, at) in self.automaton.iter(text):
            for item_id, offset in at:
                starts[item_id].append(last + 1 - length - offset)
        found = []
        for item_id, begins in sorted(starts.items()):
            item = self.patterns[item_id]
            verify = self._alone if len(item.text) < LEAST_CHARS else self._verify
            best = verify(item, sorted(set(begins)), text)
            if best is not None:
                found.append((item_id, *best))
        return found

    @staticmethod
    def _alone(item: Pattern, begins: list[int], text: str) -> tuple[int, int, int] | None:
        """The first hit of a short item that is no part of a word."""
        for start in begins:
            end = start + len(item.text)
            before, after = text[start - 1 : start] if start else "", text[end : end + 1]
            if not (before.isalnum() and item.text[0].isalnum()) and not (after.isalnum() and item.text[-1].isalnum()):
                return 0, start, end
        return None

    @staticmethod
    def _verify(item: Pattern, begins: list[int], text: str) -> tuple[int, int, int] | None:
        """The best match near the places where the item would begin."""
        m, k, best = len(item.text), item.k, None
        group = [begins[0], begins[0]]
        groups = [group]
        for b in begins[1:]:
            if b - group[1] <= m:
                group[1] = b
            else:
                group = [b, b]
                groups.append(group)
        for first, last in groups:
            low = max(0, first - k)
            distance, end = item.search(text[low : last + m + k])
            if distance <= k and (best is None or distance < best[0]):
                stop = low + end
                best = (distance, item.start_of(text, stop), stop)
        return best


def _blocks(items: DataFrame, error_rate: float) -> Iterator[Finder]:
    """Finders over blocks of items of a bounded size; one block for a usual benchmark.

    The driver holds one block at a time.
    """
    clean = (
        items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
        .select(F.col("item_id").cast("bigint").alias("item_id"), "text")
        .dropDuplicates(["item_id", "text"])
    )
    total = clean.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_CHARS))
    for block in range(n):
        rows = clean.where(F.pmod(F.xxhash64("text"), F.lit(n)) == block).collect()
        texts = [(r["item_id"], normalised(r["text"])) for r in rows]
        # An id that stands for several texts is found by any of them.
        by_round: list[dict[int, str]] = []
        for item_id, text in sorted(texts):
            if not text:
                continue
            for known in by_round:
                if item_id not in known:
                    known[item_id] = text
                    break
            else:
                by_round.append({item_id: text})
        for known in by_round:
            yield Finder(sorted(known.items()), error_rate)


def _search(shared):
    keys = ("item_id", "distance", "start", "end")

    @F.pandas_udf(MATCHES)
    def run(texts: pd.Series) -> pd.Series:
        finder = shared.value
        return pd.Series([[dict(zip(keys, m, strict=True)) for m in finder.find(t)] for t in texts], dtype=object)

    return run


def matches(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """``doc_id``, ``item_id``, ``distance``, ``start``, ``end``: one row for each item that a row holds.

    Items too large for one block are looked for block by block, each by a written pass over the
    texts.  Null and empty texts hold nothing; an item with a null id, or a null or blank text,
    is not looked for; repeated items count once; rows of one id are looked through each by itself.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    blocks = _blocks(items, error_rate)
    found, finder = None, next(blocks, Finder([], error_rate))
    while finder is not None:
        following = next(blocks, None)
        shared = spark.sparkContext.broadcast(finder)
        hits = rows.select("doc_id", F.explode(_search(shared)(F.col("text"))).alias("m")).select("doc_id", "m.*")
        if following is not None or found is not None:
            hits = stage(spark, hits, "hits")
            shared.destroy()
        found = hits if found is None else found.unionByName(hits)
        finder = following
    return found


def without_items(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs`` that hold no item (see :func:`matches`); after each block but the last
    the rows that are left are written."""
    spark = docs.sparkSession
    blocks = _blocks(items, error_rate)
    finder = next(blocks, None)
    while finder is not None:
        following = next(blocks, None)
        shared = spark.sparkContext.broadcast(finder)
        docs = docs.where(F.size(_search(shared)(F.col("text"))) == 0)
        if following is not None:
            docs = stage(spark, docs, "clean")
            shared.destroy()
        finder = following
    return docs
