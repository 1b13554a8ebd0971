"""Embedding near-duplicates by a pivot-permutation index (operator 1)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut, join_labels, whole_groups

COSINE = 0.9
#: Nearest reference points that describe a vector, at least and at most, and how many of them two
#: vectors must share.
PREFIX, MAX_PREFIX, SHARED = 6, 16, 2
#: Pairs just at the threshold that must become candidates, as measured on so many made ones.
RECALL, PROBES = 0.99, 1000
#: Reference points: one for so many vectors, between the bounds.
VECTORS_PER_PIVOT, PIVOTS = 400, (64, 2048)
#: Members of an inverted list that are compared in one task; longer lists are dealt in blocks.
BLOCK = 4096
#: Candidates whose cosines are computed at once; the share of pairs from which all cosines are cheaper.
VERIFIED_AT_ONCE, DENSE = 20_000, 16


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, without overflow."""
    x = x.astype("f8")
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """For each row the k nearest reference points by angle, nearest first; -1 where there are fewer."""
    near = np.argsort(-(unit_rows(x) @ unit_rows(pivots).T), axis=1, kind="stable")[:, :k].astype("i2")
    return np.pad(near, ((0, 0), (0, k - near.shape[1])), constant_values=-1)


def needed_prefix(some: np.ndarray, pivots: np.ndarray, cosine: float = COSINE, shared: int = SHARED, recall: float = RECALL) -> int:
    """The shortest prefix at which pairs just at ``cosine`` share ``shared`` points with ``recall``.

    Pairs are made from ``some`` vectors of the table: each is turned by the angle of ``cosine``, once
    towards others of the table and once in any direction; the worse of both counts.
    """
    rng = np.random.default_rng(0)
    x = unit_rows(np.resize(some, (PROBES, some.shape[1])))
    points = unit_rows(pivots).T
    out = shared
    for way in (x[rng.permutation(len(x))] * rng.choice([-1.0, 1.0], (len(x), 1)), rng.normal(size=x.shape)):
        way = way - (way * x).sum(1, keepdims=True) * x
        size = np.sqrt((way * way).sum(1, keepdims=True))
        ok = size[:, 0] > 1e-6
        if not ok.any():
            continue
        a = x[ok]
        b = cosine * a + math.sqrt(1 - cosine * cosine) * way[ok] / size[ok]
        need = []
        for k in range(0, len(a), 250):
            ranks = [np.argsort(np.argsort(-(v[k : k + 250] @ points), axis=1, kind="stable"), axis=1) for v in (a, b)]
            need.append(np.sort(np.maximum(*ranks), axis=1)[:, shared - 1] + 1)
        need = np.sort(np.concatenate(need))
        out = max(out, int(need[math.ceil(recall * len(need)) - 1]))
    return out


def reference_points(some: np.ndarray, n: int, cosine: float, prefix: int, shared: int) -> tuple[np.ndarray, int]:
    """(reference points, prefix): ``n`` of the vectors, or half as many until a prefix of
    ``MAX_PREFIX`` at most holds the recall. With ``MAX_PREFIX`` points all vectors share them all.
    """
    while n > MAX_PREFIX:
        k = max(prefix, needed_prefix(some[n:], some[:n], cosine, shared))
        if k <= max(prefix, MAX_PREFIX):
            return some[:n], k
        n //= 2
    return some[:n], n


def links_in_list(pivot: int, x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, same: bool, cosine: float, shared: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i of x, j of y) of one inverted list that link, a few hundred rows at a time.

    Candidates share ``shared`` pivots at least, counted by a product of membership matrices. Where
    they are few, only they are gathered and verified by their cosine; where more than one pair in
    ``DENSE`` is a candidate, one product of the rows is cheaper than gathering. A pair that several lists hold is reported
    in the list of its smallest shared pivot only.
    """
    ids = np.unique(np.r_[px.ravel(), py.ravel()])
    ids = ids[ids >= 0]
    member = lambda p: (p[:, :, None] == ids).any(1).astype("f4")
    x, y = unit_rows(x), unit_rows(y)
    step = max(1, 2_000_000 // max(1, len(y)))
    my = member(py).T
    for at in range(0, len(x), step):
        mx = member(px[at : at + step])
        hit = mx @ my >= shared
        dense = DENSE * int(hit.sum()) > hit.size
        if dense:
            hit &= x[at : at + step] @ y.T >= cosine
        i, j = np.nonzero(hit)
        if same:
            above = i + at < j
            i, j = i[above], j[above]
        for k in range(0, len(i), VERIFIED_AT_ONCE):
            a, b = i[k : k + VERIFIED_AT_ONCE], j[k : k + VERIFIED_AT_ONCE]
            if not dense:
                near = np.einsum("ij,ij->i", x[a + at], y[b]) >= cosine
                a, b = a[near], b[near]
            if len(a):
                own = ids[((mx[a] > 0) & (my.T[b] > 0)).argmax(1)] == pivot
                yield a[own] + at, b[own]


def vector_groups(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    prefix: int = PREFIX,
    shared: int = SHARED,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each input row.

    Equal vectors are collapsed to their smallest id first, so copies cost nothing. The others are
    described by their nearest reference points, a bounded sample of the vectors (2048 at most,
    first in the order of a hash). How many is measured on made pairs, ``prefix`` at least, since
    more points need a longer prefix for the same recall. The inverted list of a point has every vector that
    names it. Vectors of a list that share ``shared`` points are candidates, and every candidate
    is verified in double precision. A list of more than ``block`` vectors is dealt to one task for
    each pair of blocks. Tasks return link counts and a spanning forest, never the pairs.

    Null vectors, and those with null or non-finite components or only zeros, link with nothing.
    Vectors of different lengths are not compared. Rows that repeat an id count as vectors of
    their own. Rows without an id have no component and no links. Extra columns are ignored; an
    empty table gives none.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    f = "f4" if kind == "float" else "f8"
    v = F.col(vector_col).cast("array<float>" if f == "f4" else "array<double>")
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    sound = (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    sound = F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull()
    distinct = cut(base.where(sound).groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    pivots: dict[int, tuple[np.ndarray, int]] = {}
    for r in distinct.groupBy(F.size("v").alias("dim")).count().collect():
        n = int(min(max(r["count"] // VECTORS_PER_PIVOT, PIVOTS[0]), PIVOTS[1]))
        # the vectors behind the points are the probes; where there are few, all share all points
        n = min(n, r["count"] // 2) if r["count"] > PIVOTS[0] else min(r["count"], MAX_PREFIX)
        some = distinct.where(F.size("v") == r["dim"]).orderBy(F.xxhash64("v"), "rep").limit(n + PROBES)
        some = np.array([x["v"] for x in some.select("v").collect()], f)
        pivots[r["dim"]] = reference_points(some, n, cosine, prefix, shared)
    points = spark.sparkContext.broadcast(pivots)
    width = max((k for _, k in pivots.values()), default=0)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("v")
            sizes = np.diff(col.offsets.to_numpy())
            flat, starts = col.values.to_numpy(zero_copy_only=False).astype(f), col.offsets.to_numpy()
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                x = flat[starts[rows][:, None] + np.arange(dim)]
                p = nearest_pivots(x, *points.value[int(dim)])
                p = np.pad(p, ((0, 0), (0, width - p.shape[1])), constant_values=-1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(b.column("rep").to_numpy()[rows]),
                        pa.array(b.column("copies").to_numpy()[rows]),
                        pa.array([r.tobytes() for r in x], pa.binary()),
                        pa.array(p.tolist(), pa.list_(pa.int16())),
                    ],
                    names=["rep", "copies", "x", "pivots"],
                )

    described = distinct.mapInArrow(describe, "rep long, copies long, x binary, pivots array<smallint>")
    lists = described.select("*", F.octet_length("x").alias("dim"), F.explode("pivots").alias("pivot")).where("pivot >= 0")
    # a row for each list: bounded by the number of reference points
    lengths = {(r["dim"], r["pivot"]): r["count"] for r in lists.groupBy("dim", "pivot").count().collect()}
    blocks = [(d, p, -(-n // block)) for (d, p), n in lengths.items()]
    sizes = spark.createDataFrame(blocks or [(0, 0, 1)], "dim int, pivot smallint, blocks int")
    dealt = lists.join(F.broadcast(sizes), ["dim", "pivot"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    key = F.struct("dim", "pivot", lo.alias("lo"), hi.alias("hi"))
    dealt = dealt.select(F.xxhash64(key).alias("key"), "dim", "pivot", lo.alias("lo"), hi.alias("hi"), "own", "rep", "copies", "x", "pivots")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "key", 20_000):
            cols = {c: t.column(c).to_numpy() for c in ("dim", "pivot", "lo", "hi", "own", "rep", "copies")}
            tag = np.stack([cols[c].astype("i8") for c in ("dim", "pivot", "lo", "hi")])
            cuts = np.r_[0, np.flatnonzero((tag[:, 1:] != tag[:, :-1]).any(0)) + 1, t.num_rows]
            xs, ps = t.column("x"), np.array(t.column("pivots").to_pylist(), "i2")
            for s, e in zip(cuts, cuts[1:], strict=False):
                if e - s < 2:
                    continue
                x = np.frombuffer(b"".join(xs.slice(s, e - s).to_pylist()), f).reshape(e - s, -1)
                same = cols["lo"][s] == cols["hi"][s]
                own = cols["own"][s:e]
                left = np.arange(e - s) if same else np.flatnonzero(own == cols["lo"][s])
                right = left if same else np.flatnonzero(own == cols["hi"][s])
                if not len(left) or not len(right):
                    continue
                p, weight = ps[s:e], cols["copies"][s:e]
                n, comp = np.zeros(e - s, "i8"), np.arange(e - s)
                for i, j in links_in_list(int(cols["pivot"][s]), x[left], x[right], p[left], p[right], bool(same), cosine, shared):
                    i, j = left[i], right[j]
                    n += np.bincount(i, weight[j], e - s).astype("i8") + np.bincount(j, weight[i], e - s).astype("i8")
                    join_labels(comp, i, j)
                k = np.flatnonzero(n)
                rep = cols["rep"][s:e]
                yield pa.RecordBatch.from_arrays([pa.array(rep[k]), pa.array(n[k]), pa.array(rep[comp[k]])], names=["rep", "n", "root"])

    order = ["key", "dim", "pivot", "lo", "hi"]
    found = cut(dealt.repartition("key").sortWithinPartitions(*order).mapInArrow(compare, "rep long, n long, root long"))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    roots = connected_components(found.select(F.col("rep").alias("src"), F.col("root").alias("dst")))
    named = distinct.join(counts, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    linked = base.where(sound).join(named, "v").select("vec_id", "n_links", "component_id")
    alone = base.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
