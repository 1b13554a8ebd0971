"""Band joins against loops over all pairs."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from sitemill.llm import band_join as bj
from sitemill.llm.common import cut


def low(v):
    return v - 3 - v // 10


def high(v):
    return v + 2 + v // 10


def pairs_of(left, right):
    return Counter((a, b) for a in left for b in right if a[0] is not None and b[1] is not None and int(low(np.int64(a[0]))) <= b[1] <= int(high(np.int64(a[0]))))


@pytest.mark.parametrize("regions,least,bins", [(1, 1, 16), (7, 10, 16), (64, 5, 64), (512, 100_000, 4096)])
def test_all_pairs(spark, regions, least, bins):
    r = random.Random(regions)
    left = [(r.choice([r.randint(0, 400), 50, 50, r.randint(0, 10)]), i % 5) for i in range(150)] + [(None, 1), (7, 7), (7, 7)]
    right = [(i % 4, r.choice([r.randint(-20, 10_000), 52, 52, r.randint(0, 60)])) for i in range(200)] + [(1, None), (2, 51), (2, 51)]
    a, b = spark.createDataFrame(left, "v long, cell int"), spark.createDataFrame(right, "lo int, v long")
    got = bj.band_join(a, b, "v", "v", low, high, "v long, cell int, lo int, w long", regions=regions, least=least, bins=bins)
    assert Counter(((x["v"], x["cell"]), (x["lo"], x["w"])) for x in got.collect()) == pairs_of(left, right)


def test_hot_values_are_cut_as_a_grid(spark):
    a = cut(spark.range(400).selectExpr("CAST(IF(id % 2 = 0, 50, id) AS long) AS l_v"))
    b = cut(spark.range(600).selectExpr("CAST(IF(id % 3 = 0, 51, id * 7) AS long) AS r_v"))
    cells = bj.plan_cells(a, b, "l_v", "r_v", low, high, regions=64, least=200, bins=128)
    hot = [i for i in range(len(cells)) if cells.across[i] * cells.down[i] > 1]
    assert hot and all(cells.start[i] <= 50 for i in hot)
    # estimated loads come down to a 64th of the whole, a part more for rounding
    assert cells.loads.max() < 2.5 * max(200, (200 * 200 + 200 * 100) / 64) and len(cells) <= 64


def test_empty_sides(spark):
    some, none = spark.createDataFrame([(1,)], "v long"), spark.createDataFrame([], "v long")
    for a, b in ((some, none), (none, some), (none, none)):
        assert bj.band_join(a, b, "v", "v", low, high, "a long, b long").count() == 0


# --- items and lines --------------------------------------------------------------------------
def cents(x):
    return None if x is None or not math.isfinite(x) else math.floor(100.0 * x + 0.5)


def brute(items, lines):
    out = []
    for item, price in items:
        p, got = cents(price), []
        for sale, no, other, q, amount in lines:
            a = cents(amount)
            if None in (sale, other, q, a, p, item) or q == 0 or other == item:
                continue
            u = (2 * a + q) // (2 * q)
            gap = abs(u - p)
            if gap <= 50 or 1000 * gap <= 5 * min(u, p):
                got.append((gap, u, sale, -1 if no is None else no, other))
        got.sort()
        crc = sum(zlib.crc32(f"{s},{'' if n == -1 else n},{o}".encode()) for _, _, s, n, o in got)
        sums = (len(got), sum(g[0] for g in got), crc)
        out += [(item, k + 1, *g[:3], None if g[3] == -1 else g[3], g[4], *sums) for k, g in enumerate(got[:10])] or [(item, 0, *[None] * 5, 0, 0, 0)]
    return Counter(out)


COLUMNS = ("item_id", "rank", "gap", "u", "sale_id", "line_no", "line_item_id", "n_pairs", "gap_sum", "lines_crc")
ITEMS, LINES = "item_id long, price double, p string, part string, u int", "sale_id long, line_no int, item_id long, quantity int, amount double, u string, t int, b int, k int"


def answer(spark, items, lines, **options):
    a = spark.createDataFrame([(*x, "p", "q", 0) for x in items], ITEMS)
    b = spark.createDataFrame([(*x, "u", 1, 2, 3) for x in lines], LINES)
    return Counter(tuple(r[c] for c in COLUMNS) for r in bj.near_prices(a, b, **options).collect())


@pytest.mark.parametrize("options", [{}, {"regions": 40, "least": 3}])
def test_near_prices(spark, options):
    r = random.Random(5)
    items = [(i, r.choice([round(r.uniform(0, 9), 2), 3.0, 250.0, round(r.uniform(200, 300), 2)])) for i in range(60)]
    items += [(60, None), (61, float("nan")), (62, 9_000.0), (None, 3.0), (63, -1.0), (63, -1.0), (64, 3.0)]
    lines = []
    for i in range(700):
        item = 3 if i % 3 == 0 else r.randrange(70)
        price = 3.0 if i % 4 == 0 else r.choice([r.uniform(0, 9), r.uniform(200, 300)])
        q = r.choice([1, 2, 7, 50, -2])
        lines.append((r.randrange(40), r.choice([1, 2, 3, None]), item, q, round(price * q, 2)))
    lines += lines[:30] + [(None, 1, 1, 1, 3.0), (1, 1, None, 1, 3.0), (1, 1, 1, None, 3.0), (1, 1, 1, 1, None), (1, 1, 1, 0, 3.0), (1, 1, 1, 1, float("inf")), (9, 1, 7, 3, -3.0)]
    assert answer(spark, items, lines, **options) == brute(items, lines)


def test_an_item_that_has_every_line_near(spark):
    """Ten lines of other items are found behind any number of its own."""
    lines = [(s, 1, 1, 1, 3.0 + s / 1000) for s in range(200)] + [(s, 2, 2, 1, 3.2) for s in range(12)] + [(1, 3, 4, 1, 3.4)]
    items = [(1, 3.0), (2, 3.0), (3, 3.0)]
    assert answer(spark, items, lines) == brute(items, lines)


def test_empty_tables(spark):
    assert answer(spark, [], [(1, 1, 1, 1, 3.0)]) == Counter()
    assert answer(spark, [(1, 3.0), (2, None)], []) == brute([(1, 3.0), (2, None)], [])


def test_bounds_are_the_rule():
    v = np.arange(-300, 60_000)
    for p in (*range(-200, 300), 9_999, 10_000, 10_001, 20_050, 40_343):
        gap = abs(v - p)
        near = v[(gap <= 50) | (1000 * gap <= 5 * np.minimum(v, p))]
        assert (near.min(), near.max()) == (bj.price_low(np.array([p]))[0], bj.price_high(np.array([p]))[0]) and len(near) == near.max() - near.min() + 1
