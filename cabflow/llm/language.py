"""Language of a text by its words, with character n-grams for words never seen.

Fit: on a bounded sample of labelled texts (``sample_docs`` per language, drawn by hash),
Spark counts words and the character n-grams of words per language.  A word counted twice
or more is known and scores by its log frequency in each language.  Any other word falls
back to its n-grams of four letters, and where none of those is known to three, two and one.
A letter is what ``str.isalpha`` takes for one; marks that follow it, such as vowel signs, belong
to the word.
All scores are taken relative to their mean over the languages, so that words and n-grams
are on one scale; a text scores the sum over its words.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import hashed_share

UNKNOWN = "und"
LONGEST = 4
#: Characters of the texts whose words are scored together, each distinct word once.
BATCH_CHARS = 8_000_000


@cache
def letter_pattern() -> re.Pattern[str]:
    """Words: a letter (as ``str.isalpha`` says), then letters and marks such as vowel signs.

    Numbers that are no digits, such as superscripts and fractions, are no letters.
    """

    def ranges(wanted: Callable[[str], bool]) -> str:
        inside = [wanted(chr(i)) for i in range(sys.maxunicode + 1)]
        edges = [i for i in range(sys.maxunicode + 1) if inside[i] != (inside[i - 1] if i else False)]
        edges += [sys.maxunicode + 1] if len(edges) % 2 else []
        return "".join(f"{re.escape(chr(x))}-{re.escape(chr(y - 1))}" for x, y in zip(edges[::2], edges[1::2], strict=True))

    letters = ranges(str.isalpha)
    marks = ranges(lambda c: unicodedata.category(c)[0] == "M")
    return re.compile(f"[{letters}][{letters}{marks}]*")


#: The same for texts of ASCII only.
ASCII_WORDS = re.compile("[a-z]+")


def letter_words(text: str) -> list[str]:
    return (ASCII_WORDS if text.isascii() else letter_pattern()).findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    """n-grams of the word with its edges marked; single letters without edges."""
    padded = word if n == 1 else f"^{word}$"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


@dataclass
class LanguageModel:
    """``scores`` has a row for each known word and n-gram; ``known`` and ``grams`` say which."""

    languages: list[str]
    known: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray
    prior: np.ndarray

    def of_word(self, word: str) -> np.ndarray:
        """Its own score, or the mean of its longest n-grams of which at least one is known."""
        at = self.known.get(word)
        if at is not None:
            return self.scores[at]
        for n in range(LONGEST, 0, -1):
            found = [at for g in grams(word, n) if (at := self.grams.get(g)) is not None]
            if found:
                return self.scores[found].mean(axis=0)
        return np.zeros(len(self.languages), np.float32)

    def predict_all(self, texts: Iterable[str | None]) -> list[tuple[str, float]]:
        """The language and its posterior for each text; ``und`` and 0 without letters or languages.

        Nothing is remembered beyond the texts, so that an idle worker holds the model alone.
        """
        numbers = _Numbers()
        each = [np.fromiter(map(numbers.__getitem__, letter_words(t)), np.int64) if t else np.zeros(0, np.int64) for t in texts]
        if not self.languages or not numbers:
            return [(UNKNOWN, 0.0)] * len(each)
        scores = np.array([self.of_word(w) for w in numbers], np.float64)
        out = []
        for words in each:
            if not len(words):
                out.append((UNKNOWN, 0.0))
                continue
            total = scores[words].sum(axis=0) + self.prior
            share = np.exp(total - total.max())
            best = int(np.argmax(share))
            out.append((self.languages[best], float(share[best] / share.sum())))
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of words (``n`` 0) and of their n-grams, per language, of each batch."""
    for batch in batches:
        counts: Counter[tuple[str, int, str]] = Counter()
        for lang, part in batch.groupby("lang"):
            tokens: Counter[str] = Counter()
            for text in part["text"]:
                tokens.update(letter_words(text))
            for word, times in tokens.items():
                counts[lang, 0, word] += times
                for n in range(1, LONGEST + 1):
                    for g in grams(word, n):
                        counts[lang, n, g] += times
        rows = [(lang, n, unit, times) for (lang, n, unit), times in counts.items()]
        yield pd.DataFrame(rows, columns=["lang", "n", "unit", "times"])


def fit(labelled: DataFrame, sample_docs: int = 1200, smoothing: float = 0.5) -> LanguageModel:
    """A model from rows with ``doc_id``, ``text`` and ``lang``; null in either is left out.

    ``sample_docs`` bounds the texts per language (drawn by the hash of the id) and with
    them the size of the model.  No rows give a model without languages.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], {}, {}, np.zeros((0, 0)), np.zeros(0))
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_docs / sizes[lang]))).otherwise(share)
    per_language = [
        F.sum(F.when(F.col("lang") == lang, F.col("times")).otherwise(0)).alias(f"c{i}")
        for i, lang in enumerate(languages)
    ]
    counted = (
        hashed_share(rows, share, "doc_id")
        .select("lang", "text")
        .mapInPandas(_count, "lang string, n int, unit string, times long")
        .groupBy("n", "unit")
        .agg(*per_language)
    )
    enough = sum((F.col(f"c{i}") for i in range(len(languages))), F.lit(0)) >= 2
    table = counted.where(enough).toPandas()
    counts = table[[f"c{i}" for i in range(len(languages))]].to_numpy(np.float64)
    order = table["n"].to_numpy()
    scores = np.zeros_like(counts)
    for n in range(LONGEST + 1):
        part = counts[order == n]
        if len(part):
            logs = np.log((part + smoothing) / (part.sum(axis=0) + smoothing * len(part)))
            scores[order == n] = logs - logs.mean(axis=1, keepdims=True)
    units = table["unit"].to_numpy()
    is_word = order == 0
    known = {units[i]: int(i) for i in np.flatnonzero(is_word)}
    parts = {units[i]: int(i) for i in np.flatnonzero(~is_word)}
    # Frequent languages win where the words say nothing.
    n_docs = np.array([sizes[lang] for lang in languages], float)
    prior = np.log(n_docs / n_docs.sum())
    return LanguageModel(languages, known, parts, scores.astype(np.float32), prior)


def predict(model: LanguageModel, docs: DataFrame, text: str = "text") -> Column:
    """Struct of ``lang`` and ``score`` for each row."""
    # The model is bounded by the sample it was fitted on.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        found, part, chars = [], [], 0
        for text in texts:
            part.append(text)
            chars += len(text or "")
            if chars >= BATCH_CHARS:
                found += shared.value.predict_all(part)
                part, chars = [], 0
        found += shared.value.predict_all(part)
        return pd.DataFrame(found, columns=["lang", "score"])

    return guess(F.col(text))
