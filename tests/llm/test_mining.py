"""Collocations, clustering and mixing against plain versions of each contract."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabflow.llm import clustering, collocations, mixing, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, f long, chunk string, part string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _docs() -> list[tuple]:
    rng = random.Random(3)
    words = ["The", "cat", "SAT", "on", "a", "mat", "é", "É", "naïve", "x"]
    rows = []
    for i in range(150):
        text = " ".join(rng.choices(words, range(10, 0, -1), k=rng.randrange(40)))
        text = re.sub("mat", rng.choice(["mat.", "mat\n", "mat\t,", "mat"]), text)
        rows.append((i, text, rng.choice(["en", "de", "und", None]), rng.choice(["s1", "s2", "s3", "", None])))
    rows += [(500 + i, "new york city hall " * 12, "en", "hot") for i in range(60)]
    # Nulls, empty and long texts, repeated rows, several texts under one id, odd white space.
    rows += [(None, None, None, None), (None, "a null id", "en", "s1"), (900, "", "en", "s2"), (901, None, "de", "s2")]
    rows += [(902, "same row same row", "en", "s3")] * 3 + [(902, "another text", "en", "s3")]
    rows += [(903, "long " * 20000, "en", "s1"), (904, "tab\tand\x0bmore\x0c\r\n ;:!?.,", "fr", "s4"), (905, "a b a b", "fr", "s4")]
    return [(i, t, lang, s, 0, 7, 9, "clash", "clash") for i, t, lang, s in rows]


def _split(text: str | None) -> list[list[str]]:
    pieces = re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER))
    return [re.findall(r"[^\x20\x09]+", p) for p in pieces]


def _phrases(rows, longest=3, least=10, percent=50) -> list[tuple]:
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for words in _split(text):
            totals[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        lost = set()
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * a >= percent * f[p[i : i + size]]:
                        lost.add(p[i : i + size])
        kept = []
        for p, a in found.items():
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if p not in lost:
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:2000], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(("chunk_words", "longest", "least"), [(1_000_000, 3, 10), (300, 3, 10), (100, 5, 4), (5000, 2, 1)])
def test_phrases_are_those_of_a_plain_count(spark, chunk_words, longest, least):
    rows = _docs()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = collocations.report(collocations.phrases(docs, longest, least, 50, chunk_words))
    assert sorted(map(tuple, found.collect())) == _phrases(rows, longest, least)


def test_phrases_of_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert collocations.report(collocations.phrases(docs)).count() == 0
    none = spark.createDataFrame([(1, None, None, None, 0, 0, 0, "", "")], SCHEMA)
    assert collocations.report(collocations.phrases(none)).count() == 0


def test_tiles_are_summed_densely_or_sorted():
    rng = np.random.default_rng(1)
    n = 300_000
    # One tile that is filled, and many that are not.
    tile = np.where(rng.random(n) < 0.3, 5, rng.integers(0, 1 << 40, n) % 50_000)
    cell = rng.integers(0, collocations.SIDE**2, n).astype(np.int32)
    times = rng.integers(1, 1 << 30, n)
    want = Counter()
    for t, c, k in zip(tile.tolist(), cell.tolist(), times.tolist(), strict=True):
        want[t, c] += k
    got = collocations.summed(tile, cell, times)
    assert dict(zip(zip(got[0].tolist(), got[1].tolist(), strict=True), got[2].tolist(), strict=True)) == want
    assert len(got[0]) == len(want)
    assert [want[t, c] for t, c in zip(tile.tolist(), cell.tolist(), strict=True)] == got[3].tolist()
    assert [len(x) for x in collocations.summed(tile[:0], cell[:0], times[:0])] == [0, 0, 0, 0]


def test_a_tile_of_two_hot_blocks_is_dealt_over_parts():
    tiles = collocations.Tiles(20, np.array([0, 3]), np.array([9, 4]))
    tile = np.array([0, 3, 3 << collocations.BLOCK_BITS, 1, 1 << collocations.BLOCK_BITS, 77])
    assert tiles.copies(tile).tolist() == [9, 4, 4, 1, 1, 1]
    parts = {int(tiles.part(tile[:1], np.array([i]))[0]) for i in range(9)}
    assert len(parts) == 9 and max(parts) < 20


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_001, 3_000_000_000_007, 5_000_000_000_003
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    got = df.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 1_000_000 * a * a // (left * right)


# -- clustering ------------------------------------------------------------------------


def _nearest(v, centroids):
    return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))


def _kmeans(vectors, dims, k, rounds):
    kept = []
    for id_, v in vectors:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((id_, [math.floor(1024 * x) for x in v]))
    digest = lambda id_: hashlib.sha256(f"3:{'null' if id_ is None else id_}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    for step in range(rounds + 1):
        found = [_nearest(v, centroids) for _, v in kept]
        if step < rounds:
            for c in range(len(centroids)):
                own = [v for (_, v), (_, n) in zip(kept, found, strict=True) if n == c]
                if own:
                    centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    total = Counter()
    for d, c in found:
        total[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((id_, c, d, total[c], sum(total.values()), sha[c]) for (id_, _), (d, c) in zip(kept, found, strict=True)), key=repr
    )


def _vectors(dims: int) -> list[tuple]:
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, rng.gauss(0, 1)]) for _ in range(dims)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(1000, 1100)]
    rows += [rows[5]] * 3 + [(7, [1.0] * dims), (None, [0.5] * dims), (None, [0.25] * dims)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * (dims + 1)), (2003, [None] + [1.0] * (dims - 1))]
    rows += [(2004, [float("nan")] * dims), (2005, [float("inf")] + [0.0] * (dims - 1)), (2006, [-float("inf")] * dims)]
    return rows


@pytest.mark.parametrize(("dims", "k", "rounds"), [(4, 8, 10), (1, 5, 3), (6, 1, 2), (3, 500, 2)])
def test_clusters_are_those_of_all_distances(spark, dims, k, rounds):
    rows = _vectors(dims)
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<double>, cluster string")
    found = clustering.cluster(df.repartition(3), dims, k, rounds).drop("computed")
    assert sorted(map(tuple, found.collect()), key=repr) == _kmeans(rows, dims, k, rounds)


def test_walk_stops_early_and_keeps_ties():
    rng = np.random.default_rng(2)
    centroids = rng.integers(-9, 9, (40, 3))
    centroids[30] = centroids[10]
    vectors = np.concatenate([rng.integers(-12, 12, (500, 3)), centroids])
    at, distance, computed = clustering.Lists(centroids).nearest(vectors)
    every = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (at == every.argmin(axis=1)).all()
    assert computed.mean() < 25 and computed.min() >= 1


def test_clusters_of_nothing_and_of_large_components(spark):
    kind = "vec_id long, embedding array<float>"
    none = clustering.cluster(spark.createDataFrame([(1, None)], kind))
    assert none.count() == 0 and "centroid_sha256" in none.columns
    with pytest.raises(Exception, match="beyond"):
        clustering.cluster(spark.createDataFrame([(1, [1e9])], kind), 1, 1, 1).collect()


# -- mixing ----------------------------------------------------------------------------


def _targets(sizes: dict, most=3) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    free, out, left = set(names), {}, sum(sizes.values())
    while free:
        over = [s for s in free if left * weights[s] / sum(weights[x] for x in free) > most * sizes[s]]
        if not over:
            break
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(most * sizes[s] for s in over)
        free -= set(over)
    return out | {s: left * weights[s] / sum(weights[x] for x in free) for s in free}


def test_mix_meets_its_targets(spark):
    rows = _docs()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(docs.repartition(4)).collect()
    again = mixing.mix(docs.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    count = lambda text: len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == sorted(
        (r[0], count(r[1])) for r in rows if r[0] is not None
    )
    sizes, taken, longest = Counter(), Counter(), Counter()
    for _, text, _, source, *_ in rows:
        sizes[source] += count(text)
        longest[source] = max(longest[source], count(text))
    want = _targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        expected = want[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert math.floor(expected - 1e-9) <= r["copies"] <= math.ceil(expected + 1e-9)
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= longest[source] + 1e-6
    copies = mixing.emit(mixing.mix(docs)).groupBy("source").agg(F.sum("size").alias("words")).collect()
    assert {r["source"]: r["words"] for r in copies if r["words"]} == {s: n for s, n in taken.items() if n}


@pytest.mark.parametrize("sizes", [[10, 0, 0], [1, 1000, 1, 1000], [7], [0, 0], [100, 5, 5, 5, 5, 5]])
def test_targets_are_shared_by_weight_below_a_limit(spark, sizes):
    named = {f"s{i}": n for i, n in enumerate(sizes)}
    df = spark.createDataFrame([(s, n, (5, 2, 1)[i % 3]) for i, (s, n) in enumerate(named.items())], "source string, source_size long, weight int")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(_targets(named))
    assert sum(got.values()) == pytest.approx(sum(sizes))


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", ["op11_collocations", "op12_centroids", "op13_systematic_mix"])
def test_registered(name):
    assert name in queries.queries()
