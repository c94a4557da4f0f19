"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans (email, ip, card, phone).  The random field looks at every token
with a digit or an ``@``; all other tokens are outside by definition, so leaving them out
changes nothing.  Its potentials are features of a token and its neighbours' shapes, a
chain potential between tokens that follow each other, and a skip potential between a token
and the last one of the same form before it in the document, so that repeated or similar
tokens tend to one label.  Marginals come from loopy message passing over all documents of a
batch at once.  Tokens under a base span are clamped to its kind; another token becomes a
span if the marginal of a kind reaches ``least``.

Weights are fitted by pseudo-likelihood on the base spans of a bounded sample of documents.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import hashed_share

KINDS = ("email", "ip", "card", "phone")
LABELS = ("outside", *KINDS)
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is tried from its first digit only; the later ones end the same way.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TELLING = re.compile(r"[0-9@]\S*")
ANY = re.compile(r"[0-9@]")
FEATURES = 4096
#: Features of one token.
PER_TOKEN = 9
SPANS = "array<struct<kind: string, start: int, end: int>>"

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the run of name characters before each ``@`` and the domain behind."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            found.append((start, m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    return found


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the patterns' matches, by start and kind."""
    found = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def tokens(text: str) -> list[tuple[int, int]]:
    """Runs without white space that hold a digit or an ``@``."""
    found, last = [], 0
    for m in TELLING.finditer(text):
        start = m.start()
        while start > last and not text[start - 1].isspace():
            start -= 1
        found.append((start, m.end()))
        last = m.end()
    return found


def _shape(token: str) -> str:
    """Digits as 9 and letters as a, runs of up to three kept, the rest cut to three."""
    kinds = "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in token[:48])
    return re.sub(r"(.)\1{3,}", r"\1\1\1", kinds)


def _features(text: str, start: int, end: int) -> list[int]:
    token = text[start:end].strip(".,;:!?\"'")
    digits = "".join(c for c in token if c in "0123456789")
    before = text[max(0, start - 32) : start].split()[-1:] or [""]
    after = text[end : end + 32].split()[:1] or [""]
    names = (
        "bias",
        f"shape={_shape(token)}",
        f"digits={min(len(digits), 20)}",
        f"at={token.count('@')}",
        f"dots={min(token.count('.'), 5)}",
        f"plus={token[:1] == '+'}",
        f"luhn={14 <= len(digits) <= 19 and luhn(digits)}",
        f"before={_shape(before[0])}",
        f"after={_shape(after[0])}",
    )
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


def _form(token: str) -> str:
    """What makes tokens similar: their letters and digits."""
    return "".join(c for c in token.lower() if c.isalnum())


@dataclass
class Graph:
    """Tokens of many documents, and the edges between those of one document."""

    doc: list[int]
    span: list[tuple[int, int]]
    features: np.ndarray
    label: np.ndarray
    edges: np.ndarray
    skip: np.ndarray


def graph(texts: list[str], base: list[list[Span]]) -> Graph:
    doc, span, features, label, edges, skip = [], [], [], [], [], []
    for d, text in enumerate(texts):
        last_of: dict[str, int] = {}
        spans, at = base[d], 0
        previous_end = None
        for start, end in tokens(text) if text else []:
            me = len(doc)
            doc.append(d)
            span.append((start, end))
            features.append(_features(text, start, end))
            while at < len(spans) and spans[at][2] <= start:
                at += 1
            # A base span that began earlier may still reach into this token.
            over = [k for a, k, b in spans[max(0, at - 3) : at + 4] if a < end and start < b]
            label.append(over[0] + 1 if over else 0)
            follows = previous_end is not None and not text[previous_end:start].strip()
            if follows:
                edges.append((me - 1, me))
                skip.append(0)
            previous_end = end
            form = _form(text[start:end])
            if form in last_of and not (follows and last_of[form] == me - 1):
                edges.append((last_of[form], me))
                skip.append(1)
            last_of[form] = me
    return Graph(
        doc,
        span,
        np.array(features, int).reshape(len(doc), PER_TOKEN),
        np.array(label, int),
        np.array(edges, int).reshape(-1, 2),
        np.array(skip, int),
    )


@dataclass
class FieldModel:
    unary: np.ndarray
    #: Potentials of chain (0) and skip (1) edges, by label before and after.
    pair: np.ndarray

    def marginals(self, g: Graph, rounds: int = 10) -> np.ndarray:
        """Label marginals of all tokens by loopy message passing (sums in log space)."""
        n, k = len(g.doc), len(LABELS)
        score = self.unary[g.features].sum(axis=1)
        clamped = g.label > 0
        score[clamped] = -50.0
        score[clamped, g.label[clamped]] = 0.0
        if len(g.edges):
            source = np.concatenate([g.edges[:, 0], g.edges[:, 1]])
            target = np.concatenate([g.edges[:, 1], g.edges[:, 0]])
            m = len(g.edges)
            back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
            forward = self.pair[g.skip]
            potential = np.concatenate([forward, forward.transpose(0, 2, 1)])
            messages = np.zeros((2 * m, k))
            for _ in range(rounds):
                into = np.zeros((n, k))
                np.add.at(into, target, messages)
                belief = (score + into)[source] - messages[back]
                new = np.logaddexp.reduce(belief[:, :, None] + potential, axis=1)
                new -= np.logaddexp.reduce(new, axis=1)[:, None]
                messages = 0.5 * messages + 0.5 * new
            np.add.at(score, target, messages)
        score -= score.max(axis=1, keepdims=True)
        share = np.exp(score)
        return share / share.sum(axis=1, keepdims=True)

    def added(self, texts: list[str], base: list[list[Span]], least: float) -> list[list[Span]]:
        """Spans beyond the base ones, of tokens that no base span touches."""
        g = graph(texts, base)
        found: list[list[Span]] = [[] for _ in texts]
        if not g.doc:
            return found
        marginal = self.marginals(g)
        best = marginal[:, 1:].argmax(axis=1)
        for i in np.flatnonzero((g.label == 0) & (marginal[:, 1:].max(axis=1) >= least)):
            d, (start, end) = g.doc[i], g.span[i]
            token = texts[d][start:end]
            start += len(token) - len(token.lstrip(".,;:!?\"'()[]"))
            end = start + len(token.strip(".,;:!?\"'()[]"))
            if end > start:
                found[d].append((start, int(best[i]), end))
        return found


def _pseudo_likelihood(g: Graph, steps: int = 150, rate: float = 0.1, penalty: float = 1e-3) -> FieldModel:
    n, k = len(g.doc), len(LABELS)
    unary, pair = np.zeros((FEATURES, k)), np.zeros((2, k, k))
    one_hot = np.eye(k)[g.label]
    a, b = (g.edges[:, 0], g.edges[:, 1]) if len(g.edges) else (np.zeros(0, int), np.zeros(0, int))
    state = [np.zeros_like(unary), np.zeros_like(unary), np.zeros_like(pair), np.zeros_like(pair)]
    flat = g.features.ravel()
    for step in range(1, steps + 1):
        score = unary[g.features].sum(axis=1)
        np.add.at(score, b, pair[g.skip, g.label[a]])
        np.add.at(score, a, pair[g.skip, :, g.label[b]])
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        p /= p.sum(axis=1, keepdims=True)
        off = (p - one_hot) / n
        each = np.repeat(off, g.features.shape[1], axis=0)
        grad_unary = np.stack([np.bincount(flat, each[:, y], FEATURES) for y in range(k)], axis=1) + penalty * unary
        grad_pair = penalty * pair
        np.add.at(grad_pair, (g.skip, g.label[a]), off[b])
        np.add.at(grad_pair.transpose(0, 2, 1), (g.skip, g.label[b]), off[a])
        for theta, grad, m, v in ((unary, grad_unary, 0, 1), (pair, grad_pair, 2, 3)):
            state[m] = 0.9 * state[m] + 0.1 * grad
            state[v] = 0.999 * state[v] + 0.001 * grad**2
            theta -= rate * (state[m] / (1 - 0.9**step)) / (np.sqrt(state[v] / (1 - 0.999**step)) + 1e-8)
    return FieldModel(unary, pair)


def fit(docs: DataFrame, sample_docs: int = 3000, sample_chars: int = 20_000_000, text: str = "text") -> FieldModel:
    """Weights from the base spans of at most about ``sample_docs`` telling documents.

    ``sample_chars`` bounds the sample where documents are very long.  With no such document
    all weights are zero, and no marginal reaches a threshold above one fifth.
    """
    telling = docs.where(F.col(text).rlike("[0-9@]")).select(F.col(text).alias("text"))
    n, chars = telling.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    share = min(1.0, sample_docs / max(n, 1), sample_chars / max(chars, 1))
    # One text may be longer than the whole bound.
    sample = hashed_share(telling.where(F.length("text") <= sample_chars // 10), share, "text").dropDuplicates()
    texts = [r["text"] for r in sample.collect()]
    if not texts:
        return FieldModel(np.zeros((FEATURES, len(LABELS))), np.zeros((2, len(LABELS), len(LABELS))))
    return _pseudo_likelihood(graph(sorted(texts), [base_spans(t) for t in sorted(texts)]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find(model: FieldModel, docs: DataFrame, text: str = "text", least: float = 0.9) -> Column:
    """Struct of ``base`` and ``added`` spans of each text, by start; null texts have none."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def structs(spans: list[Span]) -> list[dict]:
        return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(spans)]

    @F.pandas_udf(f"base {SPANS}, added {SPANS}")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            base = [base_spans(t) if ANY.search(t) else [] for t in texts]
            added = shared.value.added(texts, base, least)
            yield pd.DataFrame({"base": [structs(s) for s in base], "added": [structs(s) for s in added]})

    return run(F.col(text))


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
