"""Ranked peaks against a walk in order, and tails of the Poisson distribution."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from sitemill.functions.stats import poisson_sf
from sitemill.operators import peaks as P


def test_poisson_tail(spark):
    cases = [(0, 2.0), (1, 0.5), (5, 0.01), (3, 7.5), (30, 4.0), (40, 45.0), (200, 20.0), (2, 0.0), (7, 7.0)]
    got = spark.createDataFrame(cases, "k long, m double").select(poisson_sf(F.col("k"), F.col("m"))).collect()
    for (x,), (k, m) in zip(got, cases):
        term = lambda i, m=m: math.exp(i * math.log(m) - m - math.lgamma(i + 1)) if m else float(i == 0)
        want = math.fsum(term(i) for i in range(k, k + 400)) if k > m else 1 - math.fsum(term(i) for i in range(k))
        assert x == pytest.approx(want, rel=1e-9, abs=1e-15)


def walk(cells, dist):
    out = []
    for key in {c[0] for c in cells}:
        taken = []
        for n, p in sorted(((c[2], c[1]) for c in cells if c[0] == key), key=lambda x: (-x[0], x[1])):
            if all(abs(p - q) > dist for q in taken):
                taken.append(p)
                out.append((key, p, n))
    return sorted(out)


@pytest.mark.parametrize("step", [60, 256, 1 << 20])
def test_greedy_by_rank(spark, step):
    r = random.Random(step)
    cells = [(k, p, r.choice([1, 2, 2, 3, r.randint(1, 50)])) for k in ("a", "b") for p in r.sample(range(900), 250)]
    cells += [("c", p, p) for p in range(0, 400, 7)] + [("d", p, 1000 - p) for p in range(0, 400, 7)] + [("e", p, 5) for p in range(0, 200, 3)]  # chains either way, and ties
    df = spark.createDataFrame(cells, "chrom string, pos long, n long")
    got = sorted((x["chrom"], x["pos"], x["n"]) for x in P.greedy_by_rank(df, 20, ["chrom"], step).collect())
    assert got == walk(cells, 20)
    assert P.greedy_by_rank(df.limit(0), 20, ["chrom"]).count() == 0


@pytest.mark.parametrize("by", [None, ["sample"]])
def test_ranked_peaks(spark, by):
    r = random.Random(4)
    genome = {"chr1": 20_000, "chr2": 9_000}
    tags = [(s, c, st, x, x + 30) for s, n in (("s1", 300), ("s2", 60)) for c, size in genome.items() for st in "+-" for x in (r.randrange(size - 40) for _ in range(n))]
    tags += [("s1", "chr1", "+", 5_000 + r.randrange(8), 5_030) for _ in range(40)] + [("s2", "chr2", "-", 700, 730) for _ in range(9)] + [("s1", "chr2", "+", 2, 4) for _ in range(30)]
    df = spark.createDataFrame(tags, "sample string, chrom string, strand string, start long, end long")
    sizes = spark.createDataFrame(list(genome.items()), "chrom string, length long")
    size, dist, local, fold, fdr = 20, 50, 1000, 2.0, 0.05
    want = []
    for group in {t[0] for t in tags} if by else {None}:
        own = [t for t in tags if group in (None, t[0])]
        centres = {}
        for _, c, st, a, b in own:
            centres.setdefault((c, st), []).append((a + b) // 2)
        cells, around = [], {}
        for key, xs in centres.items():
            for p in set(xs):
                cells.append((key, p, sum(abs(x - p) <= size // 2 for x in xs)))
                around[key, p] = sum(abs(x - p) <= local // 2 for x in xs)
        found = walk(cells, dist)
        mean, windows = len(own) * 21 / (2 * sum(genome.values())), 2 * sum(genome.values()) / 21
        tail = lambda k, m=mean: math.fsum(math.exp(i * math.log(m) - m - math.lgamma(i + 1)) for i in range(k, k + 200))
        rates = {n: windows * tail(n) / sum(f[2] >= n for f in found) for n in {f[2] for f in found}}
        least = min((n for n, x in rates.items() if x <= fdr), default=None)
        want += [(group, *key, max(p - 10, 0), n) for key, p, n in found if least is not None and n >= least and n * local >= fold * around[key, p] * size]
    got = P.ranked_peaks(df, sizes, size, dist, fdr, local, fold, by, step=1500)
    assert sorted((x["sample"] if by else None, x["chrom"], x["strand"], x["start"], x["score"]) for x in got.collect()) == sorted(want)
    assert want and all(x["expected_rate"] <= fdr for x in got.collect())
    assert P.ranked_peaks(df.limit(0), sizes, by=by).count() == 0
