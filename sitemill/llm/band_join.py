"""Joins on a numeric band, by adaptive recursive partitioning of the value range.

A left row with value v pairs with every right row whose value lies in [low(v), high(v)]. Bounded
histograms of both sides, refined where they are heavy, give the estimated load of any region of left
values: left rows times the right rows in its band. The heaviest region is split again and again;
one that is a single value is cut as a grid of left and right parts. A right row goes to each region whose
band holds it, so regions overlap at their borders and each pair is found in one cell. Inside a cell
DuckDB runs the range join.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

Bound = Callable[[np.ndarray], np.ndarray]

#: At most so many regions, so that their table is small whatever the input.
REGIONS = 512
#: Estimated pairs up to which a region isn't split further.
LEAST = 100_000
#: Bins of the histograms, and rounds that refine heavy ones.
BINS, ROUNDS = 4096, 3

#: Pairs that are listed for an item.
FIRST = 10
#: A price that one item in so many has is dealt to so many tasks.
COMMON, PARTS = 1000, 32


@dataclass
class Cells:
    """Regions by their first left value: the band of each, its grid and the number of its first cell."""

    start: np.ndarray
    low: np.ndarray
    high: np.ndarray
    across: np.ndarray
    down: np.ndarray
    base: np.ndarray
    loads: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def _counts(df: DataFrame, column: str, edges: np.ndarray) -> np.ndarray:
    """Rows by bin, counted in the tasks; values outside the edges are left out."""
    size = len(edges) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = np.zeros(size, np.int64)
        for b in batches:
            v = b.column(0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(edges, v, "right") - 1
            got += np.bincount(at[(at >= 0) & (at < size)], minlength=size)
        hit = np.flatnonzero(got)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(got[hit])], names=["bin", "n"])

    out = np.zeros(size, np.int64)
    for r in df.select(column).mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        out[r["bin"]] = r["n"]
    return out


def _load(n_left, n_right):
    return (n_left + 1.0) * (n_right + 1.0)


def plan_cells(
    left: DataFrame, right: DataFrame, left_value: str, right_value: str, low: Bound, high: Bound, regions: int = REGIONS, least: int = LEAST, bins: int = BINS
) -> Cells | None:
    """Regions of the left values by estimated load; None where a side is empty."""
    ends = left.agg(F.min(left_value).alias("a"), F.max(left_value).alias("b")).first()
    if ends["a"] is None:
        return None
    a, b = (np.array([ends[c]], np.int64) for c in "ab")
    first, last = min(int(a[0]), int(low(a)[0])), max(int(b[0]), int(high(b)[0]))
    edges = np.unique(np.linspace(first, last + 1, bins // 4 + 1).astype(np.int64))
    for turn in range(ROUNDS):
        n_left, n_right = _counts(left, left_value, edges), _counts(right, right_value, edges)
        below = np.r_[0, np.cumsum(n_right)]

        def within(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            """Right rows in bins that touch [lo, hi]."""
            i = np.clip(np.searchsorted(edges, lo, "right") - 1, 0, len(edges) - 1)
            j = np.clip(np.searchsorted(edges, hi, "right"), 0, len(edges) - 1)
            return below[np.maximum(i, j)] - below[i]

        load = _load(n_left, within(low(edges[:-1]), high(edges[1:] - 1)))
        target = max(least, float(load.sum()) / regions)
        wide = np.diff(edges)
        heavy = np.flatnonzero((load > target / 2) & (wide > 1) & (n_left > 0))
        room = bins - (len(edges) - 1)
        if turn == ROUNDS - 1 or not len(heavy) or room < 1:
            break
        heavy = heavy[np.argsort(-load[heavy], kind="stable")][:room]
        parts = np.minimum(wide[heavy], 1 + room // len(heavy))
        edges = np.unique(np.r_[edges, *[np.linspace(edges[i], edges[i + 1], p + 1).astype(np.int64) for i, p in zip(heavy, parts)]])
    above = np.r_[0, np.cumsum(n_left)]

    def weigh(i: int, j: int) -> float:
        n = within(low(edges[i : i + 1]), high(edges[j : j + 1] - 1))[0]
        return float(_load(above[j] - above[i], n))

    heap = [(-weigh(0, len(edges) - 1), 0, len(edges) - 1)]
    done = []
    while heap:
        w, i, j = heapq.heappop(heap)
        if -w <= target or j - i == 1 or len(heap) + len(done) + 1 >= regions:
            done.append((i, j, -w))
            continue
        middle = (above[i] + above[j]) / 2
        k = int(np.clip(np.searchsorted(above, middle), i + 1, j - 1))
        for x, y in ((i, k), (k, j)):
            heapq.heappush(heap, (-weigh(x, y), x, y))
    done.sort()
    start = np.array([edges[i] for i, _, _ in done])
    stop = np.array([edges[j] for _, j, _ in done]) - 1
    loads = np.array([w for _, _, w in done])
    across, down = np.ones(len(done), np.int64), np.ones(len(done), np.int64)
    for r, (i, j, w) in enumerate(done):
        parts = min(int(np.ceil(w / target)), regions)
        if parts > 1:  # a value that can't be split, or no region is left
            n, m = above[j] - above[i] + 1, w / (above[j] - above[i] + 1)
            across[r] = np.clip(round((parts * n / m) ** 0.5), 1, parts)
            down[r] = -(-parts // across[r])
    base = np.r_[0, np.cumsum(across * down)[:-1]]
    return Cells(start, low(start), high(stop), across, down, base, loads / (across * down))


def _deal(column: str, cells: Cells, is_left: bool):
    """Rows with the cells they go to. A row's part of a grid is its place in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for b in batches:
            v = b.column(b.schema.get_field_index(column)).to_numpy(zero_copy_only=False)
            place = np.arange(seen, seen + len(v))
            seen += len(v)
            if is_left:
                first = np.searchsorted(cells.start, v, "right") - 1
                last = first
            else:
                first, last = np.searchsorted(cells.high, v, "left"), np.searchsorted(cells.low, v, "right") - 1
            times = np.maximum(last - first + 1, 0)
            row = np.repeat(np.arange(len(v)), times)
            region = np.repeat(first, times) + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            a, d = cells.across[region], cells.down[region]
            copies = d if is_left else a
            at = np.repeat(np.arange(len(row)), copies)
            j = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
            row, region = row[at], region[at]
            a, d = a[at], d[at]
            own = place[row] % (a if is_left else d)
            cell = cells.base[region] + (own * d + j if is_left else j * d + own)
            rows = b.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *rows.columns], names=["cell", *rows.schema.names])

    return run


_connection = None


def _local() -> duckdb.DuckDBPyConnection:
    global _connection
    if _connection is None:
        _connection = duckdb.connect(config={"threads": 1, "memory_limit": "1GB"})
    return _connection


def band_join(
    left: DataFrame,
    right: DataFrame,
    left_value: str,
    right_value: str,
    low: Bound,
    high: Bound,
    schema: str,
    select: str = "SELECT * FROM pairs",
    regions: int = REGIONS,
    least: int = LEAST,
    bins: int = BINS,
) -> DataFrame:
    """All pairs of rows whose right value lies in [low(v), high(v)] of the left value v.

    Values are whole numbers; ``low`` and ``high`` take and give arrays of them and never fall with
    v. Rows with a null value pair with nothing; repeated rows pair each for itself; an empty side
    gives no rows. ``select`` is what DuckDB runs over each cell's ``pairs``, whose columns are those
    of the left table as ``l_name`` and of the right as ``r_name``, so that no names clash; ``schema`` names its
    columns in their order. An aggregate by left row is whole where no grid is cut, and partial
    otherwise: merge it once more. Both sides are written once, since the histograms read them first;
    what reaches the driver is at most ``bins`` counts for each, and tasks get at most ``regions`` regions.
    """
    spark = left.sparkSession
    left, right = (
        cut(df.select(*[F.col(f"`{c}`").alias(f"{p}_{c}") for c in df.columns]).where(F.col(f"`{p}_{v}`").isNotNull()).withColumn(f"{p}_{v}", F.col(f"`{p}_{v}`").cast("long")))
        for df, p, v in ((left, "l", left_value), (right, "r", right_value))
    )
    lv, rv = f"l_{left_value}", f"r_{right_value}"
    cells = plan_cells(left, right, lv, rv, low, high, regions, least, bins)
    if cells is None:
        return spark.createDataFrame([], schema)
    kinds = {p: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) for p, df in (("l", left), ("r", right))}
    dealt = {p: df.mapInArrow(_deal(v, cells, p == "l"), f"cell int, {kinds[p]}") for p, v, df in (("l", lv, left), ("r", rv, right))}
    target = pa.schema(spark.createDataFrame([], schema).toArrow().schema)

    def join(lt: pa.Table, rt: pa.Table) -> pa.Table:
        if not lt.num_rows or not rt.num_rows:
            return target.empty_table()
        v = lt.column(lv).to_numpy()
        con = _local()
        con.register("l", lt.drop_columns(["cell"]).append_column("lo", pa.array(low(v))).append_column("hi", pa.array(high(v))))
        con.register("r", rt.drop_columns(["cell"]))
        out = con.sql(f'WITH pairs AS (SELECT l.* EXCLUDE (lo, hi), r.* FROM l JOIN r ON r."{rv}" >= l.lo AND r."{rv}" <= l.hi) {select}').to_arrow_table()
        con.unregister("l")
        con.unregister("r")
        return out.rename_columns(target.names).cast(target)

    return dealt["l"].groupBy("cell").cogroup(dealt["r"].groupBy("cell")).applyInArrow(join, schema)


# --- items and the lines near their price ---------------------------------------------------
def price_low(p: np.ndarray) -> np.ndarray:
    """The least u with p - u at most 50, or 1000 (p - u) at most 5 u."""
    return np.minimum(p - 50, -((-200 * p) // 201))


def price_high(p: np.ndarray) -> np.ndarray:
    """The largest u with u - p at most 50, or 1000 (u - p) at most 5 p."""
    return np.maximum(p + 50, p + p // 200)


def _cents(x):
    """floor(100 x + 0.5); null where x is no number or its cents are beyond 2^53."""
    c = F.floor(F.lit(100.0) * x.cast("double") + 0.5)
    return F.when(F.abs(x.cast("double")) < 2.0**53 / 100, c.cast("long"))


def _near(p, u):
    gap = F.abs(u - p)
    return (gap <= 50) | (1000 * gap <= 5 * F.least(u, p))


#: For one price: the sums over all lines near it, and the first 20 lines of which ten at most are of one item.
#: A value of u that has 20 such lines ends the search: no line farther away can be among them.
_BY_PRICE = f"""
, near AS (SELECT *, abs(r_u - l_p) AS gap, min(abs(r_u - l_p)) FILTER (WHERE len(r_top) >= {2 * FIRST}) OVER (PARTITION BY l_p) AS reach FROM pairs),
sums AS (SELECT l_p, sum(r_n)::BIGINT AS n, sum(r_n * gap)::BIGINT AS g, sum(r_crc)::BIGINT AS crc FROM near GROUP BY l_p),
rows_ AS (SELECT l_p, gap, r_u AS u, unnest(r_top) AS t FROM near WHERE reach IS NULL OR gap <= reach),
capped AS (SELECT * FROM rows_ QUALIFY row_number() OVER (PARTITION BY l_p, t.item_id ORDER BY gap, u, t.sale_id, t.line_no NULLS FIRST) <= {FIRST}),
firsts AS (SELECT * FROM capped QUALIFY row_number() OVER (PARTITION BY l_p ORDER BY gap, u, t.sale_id, t.line_no NULLS FIRST, t.item_id) <= {2 * FIRST}),
lists AS (SELECT l_p, list({{'gap': gap, 'u': u, 'sale_id': t.sale_id, 'line_no': t.line_no, 'line_item_id': t.item_id}}) AS top FROM firsts GROUP BY l_p)
SELECT l_p, n, g, crc, top FROM sums JOIN lists USING (l_p)"""
_ROW = "struct<gap: bigint, u: bigint, sale_id: bigint, line_no: bigint, line_item_id: bigint>"


def near_prices(items: DataFrame, lines: DataFrame, regions: int = REGIONS, least: int = LEAST) -> DataFrame:
    """Each item's first ten lines by nearness of the unit price, and counts over all its lines.

    Lines are merged before they are joined: to one row for each unit price u with its count, its
    checksums and its first 20 lines, ten of one item at most, so that ten are left whatever item is asked;
    items to their distinct prices. So the join grows with the number of prices, not with the product of
    the tables, and no price is hot. An item's own lines, found by its id, are taken off the sums.
    Lines without sale_id, item_id, quantity or amount, with quantity zero, or with an amount that is no
    finite number (or beyond 2^53 cents) never pair; nor do items without an id or price. Repeated lines count each.
    A null line_no is empty in the checksum and first in order. Items that are repeated rows give their
    rows each. Columns beyond those named are not read.
    """
    q, twice = F.col("quantity").cast("long"), 2 * _cents(F.col("amount"))
    lines = lines.select(*[F.col(c).cast("long").alias(c) for c in ("sale_id", "line_no", "item_id")], F.when(q < 0, -twice - q).otherwise(twice + q).alias("t"), F.abs(2 * q).alias("b"))
    lines = lines.select("sale_id", "line_no", "item_id", F.expr("CASE WHEN b > 0 THEN (t - pmod(t, b)) div b END").alias("u")).dropna(subset=["sale_id", "item_id", "u"])
    digits = F.concat(F.col("sale_id").cast("string"), F.lit(","), F.coalesce(F.col("line_no").cast("string"), F.lit("")), F.lit(","), F.col("item_id").cast("string"))
    groups = cut(lines.groupBy("item_id", "u").agg(F.count("*").alias("n"), F.sum(F.crc32(digits)).alias("crc")))
    of_item, of_u = Window.partitionBy("u", "item_id").orderBy("sale_id", "line_no"), Window.partitionBy("u").orderBy("sale_id", "line_no", "item_id")
    firsts = lines.withColumn("k", F.row_number().over(of_item)).where(F.col("k") <= FIRST)
    firsts = firsts.withColumn("k", F.row_number().over(of_u)).where(F.col("k") <= 2 * FIRST)
    tops = firsts.groupBy("u").agg(F.sort_array(F.collect_list(F.struct("sale_id", "line_no", "item_id"))).alias("top"))
    right = groups.groupBy("u").agg(F.sum("n").alias("n"), F.sum("crc").alias("crc")).join(tops, "u")

    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.when(F.col("item_id").isNotNull(), _cents(F.col("price"))).alias("p"))
    prices = items.where("p IS NOT NULL").groupBy("p").agg(F.count("*").alias("items"))
    found = band_join(prices.select("p"), right, "p", "u", price_low, price_high, f"p long, n long, g long, crc long, top array<{_ROW}>", _BY_PRICE, regions, least)
    # a price whose right side was cut has several parts
    found = found.groupBy("p").agg(F.sum("n").alias("n"), F.sum("g").alias("g"), F.sum("crc").alias("crc"), F.flatten(F.collect_list("top")).alias("top"))
    own = items.distinct().join(groups, "item_id").where(_near(F.col("p"), F.col("u")))
    own = own.groupBy("item_id", "p").agg(F.sum("n").alias("own_n"), F.sum(F.col("n") * F.abs(F.col("u") - F.col("p"))).alias("own_g"), F.sum("crc").alias("own_crc"))
    # a price with a thousandth of all items, of which there are a thousand at most, is dealt in parts
    many = F.broadcast(prices.where(F.col("items") * COMMON >= items.count()).select("p", F.lit(True).alias("many")))
    part = F.pmod(F.xxhash64("item_id"), F.lit(PARTS)).cast("int")
    items = items.join(many, "p", "left").withColumn("part", F.when(F.col("p").isNull() | F.col("many"), part).otherwise(0)).drop("many")
    found = found.join(many, "p", "left").withColumn("part", F.explode(F.when(F.col("many"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0))))).drop("many")
    out = items.join(own, ["item_id", "p"], "left").join(found, ["p", "part"], "left")
    others = F.filter("top", lambda t: t["line_item_id"] != F.col("item_id"))
    out = out.withColumn("first", F.slice(F.sort_array(others), 1, FIRST))
    sums = [(F.coalesce(F.col(a), F.lit(0)) - F.coalesce(F.col(b), F.lit(0))).alias(c) for a, b, c in (("n", "own_n", "n_pairs"), ("g", "own_g", "gap_sum"), ("crc", "own_crc", "lines_crc"))]
    out = out.select("item_id", *sums, F.posexplode_outer("first").alias("at", "t"))
    return out.select(
        "item_id",
        F.coalesce(F.col("at") + 1, F.lit(0)).alias("rank"),
        *[F.col(f"t.{c}").alias(c) for c in ("gap", "u", "sale_id", "line_no", "line_item_id")],
        "n_pairs",
        "gap_sum",
        "lines_crc",
    )


