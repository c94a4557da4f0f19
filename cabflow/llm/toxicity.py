"""Toxicity by multiple-instance learning: sentence scores joined by noisy-or.

Only documents carry labels.  A sentence gets ``p = sigmoid(bias + sum of word weights)`` and
a document ``1 - prod(1 - p)`` over its sentences, so a document is toxic if any sentence is.
The weights are trained from the document labels through this product, and the sentence with
the largest score then shows where the offence is.  A sentence without any word of the
vocabulary says nothing and has score 0, so a long clean text does not add up to a toxic one.

The vocabulary is chosen by chi-square of word and label over the distinct sentences of a
bounded sample of labelled rows (``sample_docs``, drawn by hash; equal texts count once), so a
passage that many copies share does not make its words telling.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import hashed_share, stage

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
#: Lengths of the prefixes that stand for the forms of a word.
PREFIXES = (5, 7)
SCHEMA = "score double, sentence_start int, sentence_end int, sentence_score double"


def features(sentence: str) -> set[str]:
    """The words of a sentence in lower case, and their prefixes with a mark."""
    found = set(WORD.findall(sentence.lower()))
    return found.union(*[{w[:n] + "~" for w in found if len(w) >= n} for n in PREFIXES])


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float
    #: Score of every text if there was nothing to learn from.
    base: float

    def sentence(self, text: str) -> float:
        """Score of one sentence; 0 without a word of the vocabulary."""
        found = self.weights.keys() & features(text)
        if not found:
            return 0.0
        return 1 / (1 + float(np.exp(-(self.bias + sum(self.weights[w] for w in found)))))

    def document(self, text: str | None) -> tuple[float, int | None, int | None, float | None]:
        """Score, and span and score of the worst sentence (null if no sentence scores)."""
        if not self.weights:
            return self.base, None, None, None
        clean, best = 1.0, (0.0, None, None)
        for m in SENTENCE.finditer(text or ""):
            p = self.sentence(m[0])
            if p > 0:
                clean *= 1 - p
                if p > best[0]:
                    best = (p, m.start(), m.end())
        return 1 - clean, best[1], best[2], best[0] or None


def _sentences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(s.lower(), int(t)) for x, t in zip(batch["text"], batch["toxic"], strict=True) for s in SENTENCE.findall(x)]
        yield pd.DataFrame(rows, columns=["sentence", "toxic"])


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many sentences of clean and of toxic documents each word is."""
    for batch in batches:
        counts = {0: Counter(), 1: Counter()}
        for sentence, toxic in zip(batch["sentence"], batch["toxic"], strict=True):
            counts[int(toxic)].update(features(sentence))
        rows = [(w, counts[0][w], counts[1][w]) for w in counts[0].keys() | counts[1].keys()]
        yield pd.DataFrame(rows, columns=["word", "clean", "toxic"])


def _bags(vocabulary: dict[str, int]):
    """For each text its sentences as lists of word numbers, those with none left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                found = [vocabulary.keys() & features(s) for s in SENTENCE.findall(text)]
                rows.append((int(toxic), [sorted(vocabulary[w] for w in f) for f in found if f]))
            yield pd.DataFrame(rows, columns=["toxic", "sentences"])

    return run


def train(bags: list[list[list[int]]], labels: np.ndarray, size: int, steps: int = 400, penalty: float = 0.02, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the log likelihood of the labels under noisy-or."""
    doc_of = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    sentences = [s for b in bags for s in b]
    row = np.repeat(np.arange(len(sentences)), [len(s) for s in sentences])
    column = np.array([w for s in sentences for w in s], int)
    theta = np.zeros(size + 1)
    theta[-1] = -1.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = theta[-1] + np.bincount(row, theta[column], len(sentences))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        # log(1 - P) = sum log(1 - p); d log(1 - p) / dz = -p.
        log_clean = np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-9)), len(bags))
        total = np.clip(-np.expm1(log_clean), 1e-9, 1.0)
        by_doc = np.where(labels == 1, -np.exp(log_clean) / total, 1.0)
        dz = by_doc[doc_of] * p
        grad = np.append(np.bincount(column, dz[row], size), dz.sum()) / max(1, len(bags)) * 10
        grad[:-1] += penalty * theta[:-1] / size
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        theta -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit(labelled: DataFrame, sample_docs: int = 12_000, vocabulary_size: int = 2000, least_sentences: int = 4, least_chi: float = 20.0) -> ToxicityModel:
    """A model from rows with ``text`` and ``toxic`` (0 or 1); null in either is left out.

    ``sample_docs`` bounds the rows that are learned from, ``vocabulary_size`` the words.
    Without both kinds of label or without a telling word every text gets the share of toxic
    rows as its score.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("toxic").isin(0, 1)).select("text", "toxic")
    sample = stage(labelled.sparkSession, rows.dropDuplicates(["text"]), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    n = n_clean + n_toxic
    base = n_toxic / n if n else 0.0
    if not n_clean or not n_toxic:
        return ToxicityModel({}, 0.0, base)
    if n > sample_docs:
        sample = hashed_share(sample, sample_docs / n, "text")
    # Sentences that copies share count once; one that is also in a clean text counts as clean.
    sentences = sample.mapInPandas(_sentences, "sentence string, toxic int").groupBy("sentence").agg(F.min("toxic").alias("toxic"))
    sentences = stage(labelled.sparkSession, sentences, "toxicity-sentences")
    n_sentences = {r["toxic"]: r["n"] for r in sentences.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = (
        sentences.mapInPandas(_word_counts, "word string, clean long, toxic long")
        .groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("clean") + F.col("toxic") >= least_sentences)
    )
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    c, d = float(n_sentences.get(1, 0)) - a, float(n_sentences.get(0, 0)) - b
    chi = (a + b + c + d) * (a * d - b * c) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d) + 1e-9)
    words = table.withColumn("chi", chi).where((F.col("chi") >= least_chi) & (a * d > b * c)).orderBy(F.desc("chi"), "word").limit(vocabulary_size)
    vocabulary = {r["word"]: i for i, r in enumerate(words.select("word").collect())}
    if not vocabulary:
        return ToxicityModel({}, 0.0, base)
    bags = sample.mapInPandas(_bags(vocabulary), "toxic int, sentences array<array<int>>").toPandas()
    lists = [[list(s) for s in bag] for bag in bags["sentences"]]
    weights, bias = train(lists, bags["toxic"].to_numpy(), len(vocabulary))
    return ToxicityModel({w: float(weights[i]) for w, i in vocabulary.items()}, bias, base)


def score(model: ToxicityModel, text: str = "text") -> Column:
    """Struct of the document's score and its worst sentence; null texts count as empty."""

    @F.pandas_udf(SCHEMA)
    def run(texts: pd.Series) -> pd.DataFrame:
        found = pd.DataFrame([model.document(t) for t in texts], columns=["score", "sentence_start", "sentence_end", "sentence_score"])
        return found.astype({"score": "float64", "sentence_start": "Int32", "sentence_end": "Int32", "sentence_score": "float64"})

    return run(F.col(text))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> DataFrame:
    """Texts with their label, of at most about ``most`` labelled rows drawn by hash.

    The bound is on the label side, which is small enough to be sent to every task.
    """
    rows = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", "toxic").dropDuplicates(["doc_id"])
    n = rows.count()
    if n > most:
        rows = hashed_share(rows, most / n, "doc_id")
    return docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select("text", "toxic")
