"""Secrets by pattern and by entropy, with DataFrame functions only.

Patterns: assignments of a password, secret, token or key, access ids, and runs of hex
digits.  On top of these, candidate strings (runs of letters, digits, ``+ / _ -``) are
scanned by the Shannon entropy of a sliding window.  The window's counts are kept per
symbol of its character class (hex, alphanumeric, base64) and changed by the symbol that
enters and the one that leaves; the entropy follows from the counts.  A candidate whose
highest window reaches the threshold of its class is a secret, unless the allow-list
suppresses it.  Places are code points, the end exclusive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "entropy")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

WINDOW = 20
#: Bits per symbol that the best window of a class must reach, of at most log2(20) = 4.32.
THRESHOLDS = {"hex": 3.0, "alphanumeric": 3.5, "base64": 3.7}
#: Strings of high entropy that are no secrets: paths, links' parts, ids with dashes.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[a-z]+([/_-][a-z]+)+$",
    r"^[0-9_/+-]+$",
)
SPANS = "array<struct<kind: string, start: int, end: int>>"


def _runs(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Spans of all matches of a pattern.

    The text is cut at the matches; lengths of gaps and matches add up to the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(state, pair):
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"))
        good = F.lit(True) if keep is None else keep(pair["match"])
        spans = F.when(good, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    pairs = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
    pairs = F.filter(pairs, lambda p: p["match"].isNotNull())
    return F.aggregate(pairs, zero, step, lambda s: s["spans"])


def _term(count: Column) -> Column:
    """c * log2(c), the part of the entropy that a count brings."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def best_entropy(string: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy (bits per symbol) of the windows of a string.

    ``counts`` holds how often each symbol is in the window.  A step takes one symbol in and,
    once the window is full, one out, and changes ``total``, the sum of c * log2(c) over the
    symbols, by the two counts that change.  A string shorter than the window is one window.
    """
    symbols = F.filter(F.split(string, ""), lambda s: s != "")
    # Each symbol with the one that leaves the window when it enters (null until it is full).
    late = F.concat(F.array_repeat(F.lit(None).cast("string"), window), symbols)
    pairs = F.zip_with(symbols, F.slice(late, 1, F.size(symbols)), lambda s, o: F.struct(s.alias("symbol"), o.alias("leaving")))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    zero = F.struct(
        empty.alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0).alias("at"),
        F.lit(0.0).alias("best"),
        F.least(F.lit(window), F.length(string)).alias("whole"),
    )

    def put(counts: Column, symbol: Column, count: Column) -> Column:
        rest = F.map_filter(counts, lambda k, _: k != symbol)
        return F.map_concat(rest, F.create_map(symbol, count))

    def step(state, pair):
        symbol, leaving = pair["symbol"], pair["leaving"]
        full = leaving.isNotNull()
        old = F.when(full, F.coalesce(F.try_element_at(state["counts"], leaving), F.lit(0)))
        counts = F.when(full, put(state["counts"], leaving, old - 1)).otherwise(state["counts"])
        total = state["total"] - F.when(full, _term(old) - _term(old - 1)).otherwise(0.0)
        now = F.coalesce(F.try_element_at(counts, symbol), F.lit(0))
        total = total - _term(now) + _term(now + 1)
        width = F.least(state["at"] + 1, F.lit(window)).cast("double")
        whole = state["at"] + 1 >= state["whole"]
        bits = F.when(whole, F.log2(width) - total / width).otherwise(0.0)
        return F.struct(
            put(counts, symbol, now + 1).alias("counts"),
            total.alias("total"),
            (state["at"] + 1).alias("at"),
            F.greatest(state["best"], bits).alias("best"),
            state["whole"].alias("whole"),
        )

    return F.aggregate(pairs, zero, step, lambda s: s["best"])


def is_random(string: Column, thresholds: dict[str, float] = THRESHOLDS, allowed: Sequence[str] = ALLOWED) -> Column:
    """Whether a candidate string is a secret by its entropy.

    Its class is the narrowest of hex, alphanumeric and base64 that holds it.  A string
    without a digit, or of digits alone, is no candidate.
    """
    threshold = (
        F.when(string.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit(thresholds["hex"]))
        .when(string.rlike("^[0-9A-Za-z]+$"), F.lit(thresholds["alphanumeric"]))
        .otherwise(F.lit(thresholds["base64"]))
    )
    mixed = string.rlike("[0-9]") & string.rlike("[A-Za-z]")
    suppressed = F.lit(False)
    for pattern in allowed:
        suppressed = suppressed | string.rlike(pattern)
    # Entropy is computed only for what is left.
    return F.when(mixed & ~suppressed, best_entropy(string) >= threshold).otherwise(F.lit(False))


def scan(text: Column, allowed: Sequence[str] = ALLOWED) -> Column:
    """The spans of a text by pattern (``base``) and by entropy (``candidates``).

    Null and empty texts have none.
    """
    text = F.coalesce(text, F.lit(""))
    none = F.array().cast(SPANS)
    lower = F.lower(text)
    named = F.lit(False)
    for word in WORDS:
        named = named | F.contains(lower, F.lit(word))
    long_value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 6
    assign = F.when(named, _runs(text, ASSIGN, "assign", long_value)).otherwise(none)
    access = F.when(
        F.contains(text, F.lit("AKIA")), _runs(text, ACCESS, "access", lambda m: F.length(m) >= 20)
    ).otherwise(none)
    hexes = F.when(text.rlike(HEX), _runs(text, HEX, "hex")).otherwise(none)
    # Whether a run has a digit and a letter is left to is_random, whatever stands around it.
    candidates = F.when(
        text.rlike(CANDIDATE), _runs(text, CANDIDATE, "entropy", lambda m: is_random(m, allowed=allowed))
    ).otherwise(none)
    base = F.concat(assign, access, hexes)
    return F.struct(base.alias("base"), candidates.alias("candidates"))


def ordered(spans: Column) -> Column:
    """Spans by start, then in the order of ``KINDS``, then by end."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(s["start"], rank(s).alias("rank"), s["end"], s["kind"].alias("kind")))
    back = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    return F.transform(F.array_sort(keyed), back)


def all_spans(base: Column, candidates: Column) -> Column:
    """The base spans and those candidates that they do not cover, together, from end to end."""
    by_start = ordered(base)

    def covered(c: Column) -> Column:
        farther = lambda at, b: F.when((b["start"] <= at) & (b["end"] > at), b["end"]).otherwise(at)
        return F.aggregate(by_start, c["start"], farther) >= c["end"]

    return ordered(F.concat(base, F.filter(candidates, lambda c: ~covered(c))))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch of spans that touch or overlap replaced by a mark."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(state, span):
        gap = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        fresh = (span["start"] > state["at"]) | ((span["start"] == 0) & (state["at"] == 0))
        done = F.when(fresh, F.concat(state["done"], gap, F.lit(mark))).otherwise(state["done"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), done.alias("done"))

    rest = lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, zero, step, rest)).otherwise(text)
