"""SimHash near-duplicates by a binary-trie self-join (operator 9)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import boxed, connected_components, cut, join_labels, named, whole_groups

RADIUS = 3
#: Distinct fingerprints that may share a bucket before it is split by further blocks.
HOT_BUCKET = 50_000
#: Node pairs that the traversal expands at once.
PAIRS_AT_ONCE = 2_000_000
#: One document of so many is sampled; shingles in so many of the sample, these at most, come last.
SAMPLE, COMMON_IN_SAMPLE, TOP_SHINGLES = 16, 4, 50_000
#: Jaccard similarity of five-word shingles at which documents are near-duplicates.
SIMILARITY = 0.8
#: Bits of a parity map at least.
PARITY_BITS = 512
#: Members of a shingle's list that are compared in one task; longer lists are dealt in blocks.
LIST_BLOCK = 4096
#: Lists of at most so many members are compared many at once.
SHORT_LIST = 16
#: A table is broadcast only if it was counted and has no more rows than this.
BROADCAST_ROWS = 300_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a whole text; zero if it has no words."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if not w:
        return 0
    k = min(shingle, len(w))
    grams = map(b" ".join, zip(*(w[i:] for i in range(k)), strict=False))
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), grams), "<u8", len(w) - k + 1)
    ones = np.zeros(64, "i8")
    for i in range(0, len(h), 65_536):
        ones += np.unpackbits(h[i : i + 65_536].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id long, fp long): one row for each input row, nulls as empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in b.column(1).to_pylist()), "u8", b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view("i8"))], names=["doc_id", "fp"])

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))
    return cols.mapInArrow(run, "doc_id long, fp long")


def trie_classes(bucket: np.ndarray, fp: np.ndarray, radius: int = RADIUS, chunk: int = PAIRS_AT_ONCE) -> np.ndarray:
    """Classes of fingerprints linked at ``radius`` or fewer bits inside the same bucket.

    ``bucket`` and ``fp`` are sorted together. Each bucket is a trie with a byte a level; nodes
    are ranges of the sorted rows. Pairs of nodes are traversed together from the roots: the
    differing bits of the two edge labels add up, and a pair over the budget is dropped with all
    below it. Pairs that lie whole in one class already are dropped too, so a dense group costs
    little more than its spanning tree. Chunks are taken depth first: memory stays bounded.
    """
    n = len(fp)
    fp = fp.astype("u8", copy=False)
    comp = np.arange(n)
    new = np.r_[True, bucket[1:] != bucket[:-1]]
    starts = [np.flatnonzero(new)]
    for d in range(1, 9):
        p = fp >> np.uint64(64 - 8 * d)
        new = new | np.r_[True, p[1:] != p[:-1]]
        starts.append(np.flatnonzero(new))
    kids = [np.r_[np.searchsorted(starts[d + 1], starts[d]), len(starts[d + 1])] for d in range(8)]
    root = np.flatnonzero(np.diff(kids[0]) > 0)
    todo = [(0, root, root, np.zeros(len(root), "u1"))]
    merged = False
    while todo:
        d, a, b, err = todo.pop()
        if merged and d:
            lo, hi = np.minimum.reduceat(comp, starts[d]), np.maximum.reduceat(comp, starts[d])
            keep = ~((lo[a] == hi[a]) & (lo[b] == hi[b]) & (lo[a] == lo[b]))
            a, b, err = a[keep], b[keep], err[keep]
            if not len(a):
                continue
        na, nb = kids[d][a + 1] - kids[d][a], kids[d][b + 1] - kids[d][b]
        total = np.cumsum(na * nb)
        if total[-1] > chunk and len(a) > 1:
            at = max(1, int(np.searchsorted(total, chunk)))
            todo.append((d, a[at:], b[at:], err[at:]))
            a, b, err, na, nb = a[:at], b[:at], err[:at], na[:at], nb[:at]
            total = total[:at]
        k = np.arange(total[-1]) - np.repeat(total - na * nb, na * nb)
        w = np.repeat(nb, na * nb)
        ca = np.repeat(kids[d][a], na * nb) + k // w
        cb = np.repeat(kids[d][b], na * nb) + k % w
        up = np.repeat(a == b, na * nb) & (ca > cb)
        e = np.repeat(err, na * nb)
        at = np.uint64(56 - 8 * d)
        e = e + np.bitwise_count((fp[starts[d + 1][ca]] ^ fp[starts[d + 1][cb]]) >> at & np.uint64(255))
        ok = (e <= radius) & ~up
        if d == 7:
            ok &= ca != cb
            before = comp.copy() if not merged else None
            join_labels(comp, starts[8][ca[ok]], starts[8][cb[ok]])
            merged = merged or not (before == comp).all()
        else:
            own = ok & (starts[d + 1][ca] + 1 == np.r_[starts[d + 1], n][ca + 1]) & (ca == cb)
            ok &= ~own  # a leaf against itself links nothing
            if ok.any():
                todo.append((d + 1, ca[ok], cb[ok], e[ok]))
    return comp


def _masks(levels: int) -> list[list[list[int]]]:
    """For each level and each path of blocks taken so far, the four masks of the bits not yet fixed."""
    out, paths = [], [list(range(64))]
    for _ in range(levels):
        here, after = [], []
        for bits in paths:
            q = len(bits) // 4
            blocks = [bits[i * q : (i + 1) * q] for i in range(3)] + [bits[3 * q :]]
            here.append([sum(1 << x for x in blk) for blk in blocks])
            after += [[x for x in bits if x not in set(blk)] for blk in blocks]
        out.append(here)
        paths = after
    return out


def _split(rows: DataFrame, masks: list[list[int]]) -> DataFrame:
    """Send each fingerprint to one bucket for each of the four blocks of its path."""
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    table = F.array(*[F.array(*[F.lit(signed(m)).cast("long") for m in four]) for four in masks])
    cols: list[Column] = [F.col("fp"), F.col("rep"), F.col("path"), F.col("bucket")]
    four = rows.select(*cols, F.posexplode(F.element_at(table, F.col("path") + 1)).alias("blk", "mask"))
    path = (F.col("path") * 4 + F.col("blk")).cast("int")
    return four.select("fp", "rep", path.alias("path"), F.xxhash64("bucket", path, F.col("fp").bitwiseAND(F.col("mask"))).alias("bucket"))


def fingerprint_edges(distinct: DataFrame, radius: int = RADIUS, hot: int = HOT_BUCKET, levels: int = 3) -> DataFrame:
    """(src, dst): edges that span the links among distinct fingerprints, columns fp and rep.

    Fingerprints at ``radius`` (3 at most) or fewer bits agree on one of four blocks, so a bucket
    for each block and value holds every pair. A bucket of more than ``hot`` members is split in
    the same way by four blocks of its other bits, up to ``levels`` times: lossless, and no task
    gets an unbounded group. Inside a bucket the trie self-join finds the links.
    """
    if radius > 3:
        raise ValueError("four blocks guarantee a radius of 3 at most")
    rows = distinct.select("fp", "rep", F.lit(0).alias("path"), F.lit(0).cast("long").alias("bucket"))
    parts = []
    for level, masks in enumerate(_masks(levels)):
        rows = _split(rows, masks)
        if level == levels - 1:
            break
        big = cut(rows.groupBy("bucket").count().where(F.col("count") > hot).select("bucket"))
        if not big.head(1):
            break
        parts.append(rows.join(big, "bucket", "left_anti"))
        rows = rows.join(big, "bucket", "left_semi")
    for p in parts:
        rows = rows.unionByName(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "bucket", 100_000):
            bucket, fp, rep = (t.column(c).to_numpy() for c in ("bucket", "ufp", "rep"))
            comp = trie_classes(bucket, (fp ^ np.int64(-(1 << 63))).view("u8"), radius)
            i = np.flatnonzero(comp != np.arange(len(comp)))
            yield pa.RecordBatch.from_arrays([pa.array(rep[i]), pa.array(rep[comp[i]])], names=["src", "dst"])

    # ufp: the sign bit flipped, so that Spark's signed order is the fingerprints' own
    flat = rows.select("bucket", F.col("fp").bitwiseXOR(F.lit(-(1 << 63)).cast("long")).alias("ufp"), "rep")
    return flat.repartition("bucket").sortWithinPartitions("bucket", "ufp").mapInArrow(run, "src long, dst long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row for each input row.

    Null and empty texts have the fingerprint zero and link like any other. Rows that repeat a
    doc_id each give a row. A null doc_id keeps its row; it takes the component of its
    fingerprint and names none itself. Extra columns are ignored. An empty table gives none.
    """
    fps = cut(fingerprints(docs, id_col, text_col, shingle))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = connected_components(fingerprint_edges(distinct.where("rep is not null"), radius))
    named = distinct.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("fp", F.coalesce("root", "rep").alias("component_id"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return fps.join(named, "fp", "left").select("doc_id", hexed, "component_id")


def shingle_set(text: str | None, shingle: int = 5) -> np.ndarray:
    """The distinct shingles of a whole text as sorted hashes; none if it has no words."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    k = min(shingle, len(w))
    grams = map(b" ".join, zip(*(w[i:] for i in range(k)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams), "<u8", len(w) - k + 1 if w else 0))


def parity_map(x: np.ndarray) -> bytes:
    """For each residue of the hashes whether an odd number of them has it; about a bit a hash.

    Two maps differ in no more bits than the sets have elements of their own, so that the
    differing bits bound the similarity from above. Sizes are powers of two: a larger map folds
    to a smaller one by exclusive or of its halves, under which the bound still holds.
    """
    bits = max(PARITY_BITS, 1 << max(0, len(x) - 1).bit_length())
    odd = np.bincount((x % np.uint64(bits)).astype("i8"), minlength=bits) & 1
    return np.packbits(odd.astype("u1"), bitorder="little").tobytes()


class ParityMaps:
    """Parity maps of a table's rows, by the values and offsets of a binary column."""

    def __init__(self, column: pa.Array):
        self.offsets = np.frombuffer(column.buffers()[1], "i4")[column.offset : column.offset + len(column) + 1].astype("i8")
        self.flat = np.frombuffer(column.buffers()[2] or b"", "u1")
        self.size = np.diff(self.offsets)

    def rows(self, at: np.ndarray, size: int) -> np.ndarray:
        """Maps of these rows as words; those of twice the size are folded."""
        out = np.empty((len(at), size // 8), "u8")
        for times in (1, 2):
            k = np.flatnonzero(self.size[at] == times * size)
            if len(k):
                m = self.flat[self.offsets[at[k]][:, None] + np.arange(times * size)].view("u8").reshape(len(k), times, -1)
                out[k] = m[:, 0] if times == 1 else m[:, 0] ^ m[:, 1]
        return out

    def differ(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Differing bits of each pair of rows; sizes beyond twice each other differ too much anyway."""
        out = np.zeros(len(i), "i8")
        low = np.minimum(self.size[i], self.size[j])
        for size in np.unique(low):
            k = np.flatnonzero(low == size)
            step = max(1, 8_000_000 // int(size))
            for at in range(0, len(k), step):
                some = k[at : at + step]
                out[some] = np.bitwise_count(self.rows(i[some], int(size)) ^ self.rows(j[some], int(size))).sum(1, dtype="i8")
        return out


def enough(n: np.ndarray, m: np.ndarray, differ: np.ndarray | int, similarity: float) -> np.ndarray:
    """Whether sets of these sizes, with at least so many elements of their own, can have the similarity."""
    need = np.ceil(similarity / (1 + similarity) * (n + m) - 1e-9)
    return (n + m - differ >= 2 * need) & (np.minimum(n, m) >= need)


def short_list_pairs(start: np.ndarray, end: np.ndarray, n: np.ndarray, maps: ParityMaps, comp: np.ndarray, similarity: float, spanning: bool) -> tuple[np.ndarray, np.ndarray]:
    """``likely_pairs`` of many short lists (row ranges) at once; with ``spanning`` each row's first partner."""
    k = end - start
    row = np.repeat(start - np.cumsum(k) + k, k) + np.arange(k.sum())
    later = np.repeat(end, k) - row - 1
    i = np.repeat(row, later)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
    ok = (comp[i] != comp[j]) & enough(n[i], n[j], 0, similarity)
    i, j = i[ok], j[ok]
    ok = enough(n[i], n[j], maps.differ(i, j), similarity)
    i, j = i[ok], j[ok]
    if spanning:
        pick = np.unique(j, return_index=True)[1]  # pairs are in the order of i
        i, j = i[pick], j[pick]
    return i, j


def likely_pairs(
    n: np.ndarray, maps: ParityMaps, comp: np.ndarray, left: np.ndarray, right: np.ndarray | None, similarity: float, spanning: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of one list in different classes whose sizes and parity maps allow the similarity.

    Pairs of ``left`` with ``right``, or inside ``left`` where that is None. With ``spanning`` only a
    forest that connects whatever those pairs connect.
    """
    rows_of = np.r_[left, right] if right is not None else left
    cls = np.zeros(len(comp), "i8")
    cls[rows_of], times = np.unique(comp[rows_of], return_inverse=True, return_counts=True)[1:]
    group = np.arange(len(times))
    size = maps.size
    for s in np.unique(size[rows_of]):
        of = lambda at, k, s=s: at[size[at] == k * s]
        if right is None:
            own = of(left, 1)
            own = own[np.lexsort((own, cls[own], times[cls[own]]))]  # the largest class last
            todo = [(own, own, True), (own, of(left, 2), False)]
        else:
            todo = [(of(left, 1), np.r_[of(right, 1), of(right, 2)], False), (of(right, 1), of(left, 2), False)]
        for rows, others, ordered in todo:
            x, y = maps.rows(rows, int(s)), maps.rows(others, int(s))
            step = max(1, 4_000_000 // max(1, y.size))
            for at in range(0, len(rows), step):
                i = rows[at : at + step]
                cols = np.arange(at if ordered else 0, len(others))
                mine = group[cls[i]]
                if (mine == mine[0]).all():
                    cols = cols[group[cls[others[cols]]] != mine[0]]
                j = others[cols]
                differ = np.bitwise_count(x[at : at + step, None] ^ y[cols]).sum(2, dtype="i8") if len(j) else np.zeros((len(i), 0), "i8")
                ok = enough(n[i][:, None], n[j], differ, similarity) & (mine[:, None] != group[cls[j]])
                if ordered:
                    ok &= cols > at + np.arange(len(i))[:, None]
                a, b = np.nonzero(ok)
                a, b = i[a], j[b]
                while spanning and len(a):
                    lo, hi = np.minimum(group[cls[a]], group[cls[b]]), np.maximum(group[cls[a]], group[cls[b]])
                    pick = np.unique(hi, return_index=True)[1]
                    yield a[pick], b[pick]
                    join_labels(group, lo[pick], hi[pick])
                    apart = group[cls[a]] != group[cls[b]]
                    a, b = a[apart], b[apart]
                if len(a):
                    yield a, b


def described(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """doc_id, rid, fp, key, n, prefix, bits of each row: all that the links are found by.

    ``rid`` is a hash of the text, ``key`` one of its shingle set, ``prefix`` the first
    n - ceil(similarity n) + 1 shingles in an order that all rows share: two sets of that similarity
    have one of these in common. The commonest shingles of a sample come last, which makes lists
    short and has no part in the result.
    """
    base = docs.select(named(id_col).cast("long").alias("doc_id"), F.xxhash64(named(text_col).cast("string")).alias("rid"), named(text_col).cast("string").alias("text"))

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t, shingle).view("i8"))], names=["h"])

    some = base.where(F.pmod(F.col("rid"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(shingles, "h long")
    common = some.groupBy("h").count().where(F.col("count") >= COMMON_IN_SAMPLE).orderBy(F.desc("count"), "h").limit(TOP_SHINGLES).select("h").collect()
    top = np.array([r["h"] for r in common], "i8").view("u8")
    order = np.argsort(top)
    hot, late = top[order], (len(top) - order).astype("i4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(2).to_pylist():
                x = shingle_set(t, shingle)
                rank = np.zeros(len(x), "i4")
                if len(hot):
                    k = np.minimum(np.searchsorted(hot, x), len(hot) - 1)
                    rank = np.where(hot[k] == x, late[k], 0)
                first = len(x) - math.ceil(similarity * len(x) - 1e-9) + 1
                prefix = x[np.lexsort((x, rank))[:first]].view("i8")
                fp = np.array([fingerprint(t, shingle)], "u8").view("i8")[0]
                rows.append((int(fp), xxhash.xxh3_128_digest(x.tobytes()), len(x), prefix, parity_map(x)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.binary())
            out = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *out], names=["doc_id", "rid", "fp", "key", "n", "prefix", "bits"])

    return base.mapInArrow(run, "doc_id long, rid long, fp long, key binary, n int, prefix array<long>, bits binary")


def verified(edges: DataFrame, atoms: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """The candidate (src, dst) whose whole shingle sets have the Jaccard similarity."""
    edges = cut(edges.distinct())
    ends = edges.select(F.col("src").alias("atom")).union(edges.select(F.col("dst").alias("atom"))).distinct()
    ends = cut(ends.join(atoms.select("atom", "at"), "atom").select("atom", F.col("at.id").alias("id"), F.col("at.rid").alias("rid")))
    base = docs.select(named(id_col).cast("long").alias("doc_id"), F.xxhash64(named(text_col).cast("string")).alias("rid"), named(text_col).cast("string").alias("text"))
    few = F.broadcast(ends) if ends.count() <= BROADCAST_ROWS else ends
    texts = base.join(few, (base["rid"] == ends["rid"]) & base["doc_id"].eqNullSafe(ends["id"])).select("atom", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([shingle_set(t, shingle).tobytes() for t in b.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), x], names=["atom", "x"])

    whole = cut(texts.mapInArrow(sets, "atom long, x binary").groupBy("atom").agg(F.first("x").alias("x")))  # rows of one atom have one set

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = []
            for a, b in zip(t.column(2), t.column(3), strict=True):
                a, b = (np.frombuffer(v.as_py(), "<u8") for v in (a, b))
                same = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(same >= similarity * (len(a) + len(b) - same) - 1e-9)
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], names=["src", "dst"]).filter(pa.array(ok, pa.bool_()))

    both = edges.join(whole.select(F.col("atom").alias("src"), F.col("x").alias("a")), "src").join(whole.select(F.col("atom").alias("dst"), F.col("x").alias("b")), "dst")
    return cut(both.select("src", "dst", "a", "b").mapInArrow(verify, "src long, dst long"))


def token_lists(atoms: DataFrame, block: int) -> DataFrame:
    """token, lo, hi, own, atom: each list of a shared first shingle, long ones as pairs of blocks."""
    rows = atoms.select("atom", F.explode("prefix").alias("token"))
    rows = rows.join(rows.groupBy("token").agg(F.count("*").alias("members")).where("members > 1"), "token")
    blocks = F.ceil(F.col("members") / block).cast("int")
    rows = rows.select("atom", "token", F.pmod(F.xxhash64("atom"), blocks).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    return cut(rows.select("token", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "atom"))


def list_edges(lists: DataFrame, atoms: DataFrame, comps: DataFrame | None, similarity: float, spanning: bool) -> DataFrame:
    """(src, dst): candidates inside the lists, of different classes of ``comps`` (atom, comp)."""
    some = atoms.select("atom", "n", "bits")
    some = some.withColumn("comp", F.col("atom")) if comps is None else some.join(comps, "atom", "left").withColumn("comp", F.coalesce("comp", "atom"))
    rows = lists.join(some, "atom").withColumn("key", F.xxhash64("token", "lo", "hi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "key", 20_000):
            token, lo, hi, own, atom, n, comp = (t.column(c).to_numpy() for c in ("token", "lo", "hi", "own", "atom", "n", "comp"))
            n, maps = n.astype("i8"), ParityMaps(t.column("bits").combine_chunks())
            cuts = np.r_[0, np.flatnonzero((token[1:] != token[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1, t.num_rows]
            start, end = cuts[:-1], cuts[1:]
            open_ = np.minimum.reduceat(comp, start) != np.maximum.reduceat(comp, start)
            short = open_ & (end - start <= SHORT_LIST) & (lo[start] == hi[start])
            pairs = [iter([short_list_pairs(start[short], end[short], n, maps, comp, similarity, spanning)])]
            for s, e in zip(start[open_ & ~short], end[open_ & ~short], strict=True):
                at = np.arange(s, e)
                left, right = (at, None) if lo[s] == hi[s] else (at[own[s:e] == lo[s]], at[own[s:e] == hi[s]])
                pairs.append(likely_pairs(n, maps, comp, left, right, similarity, spanning))
            for i, j in chain(*pairs):
                a, b = atom[i], atom[j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["src", "dst"])

    order = ["key", "token", "lo", "hi", "atom"]
    return rows.repartition("key").sortWithinPartitions(*order).mapInArrow(run, "src long, dst long")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = SIMILARITY, radius: int = RADIUS, block: int = LIST_BLOCK
) -> DataFrame:
    """doc_id, rid, root: rows of one root are linked by pairs of at least that Jaccard similarity.

    1. The trie self-join links fingerprints within ``radius`` bits. SimHash alone misses most pairs
       just at the similarity, so lists of shared first shingles, which every such pair is in, add
       a spanning forest of what the pairs' parity maps allow. All are verified on whole sets.
    2. What lists still hold of pairs of different classes is verified in full. So the classes
       are exactly those of all pairs, and a group of copies costs little more than its forest.

    Texts of equal shingle sets are one node from the start; texts without words are alike.
    """
    rows = cut(described(docs, id_col, text_col, shingle, similarity))
    at = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "rid")).alias("at")
    atoms = rows.groupBy("key").agg(at, F.min("fp").alias("fp"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
    atoms = cut(atoms.withColumn("atom", F.monotonically_increasing_id()))
    prints = cut(atoms.where("n > 0").groupBy("fp").agg(F.min("atom").alias("rep")))
    alike = atoms.join(prints, "fp").where("atom <> rep").select(F.col("rep").alias("src"), F.col("atom").alias("dst"))
    lists = token_lists(atoms.where("n > 0"), block)
    verify = lambda e: verified(e, atoms, docs, id_col, text_col, shingle, similarity)
    links = verify(fingerprint_edges(prints, radius).unionByName(alike).unionByName(list_edges(lists, atoms, None, similarity, True)))
    comps = cut(connected_components(links).withColumnsRenamed({"node": "atom", "root": "comp"}))
    more = verify(list_edges(lists, atoms, comps, similarity, False))
    roots = connected_components(links.unionByName(more)).withColumnsRenamed({"node": "atom"})
    named = atoms.select("key", "atom").join(roots, "atom", "left").select("key", F.coalesce("root", "atom").alias("root"))
    return rows.select("doc_id", "rid", "key").join(named, "key").select("doc_id", "rid", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The documents without near-duplicates by ``near_groups``, columns unchanged.

    Of each group the row with the smallest id stays, once; among rows of that id the smallest
    hash of the text, then of the whole row, decides. Rows without an id rank last. Rows of one id
    and different texts are documents of their own. An empty table stays empty.
    """
    groups = near_groups(docs, id_col, text_col, shingle, similarity, radius)
    best = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "rid")).alias("x"))
    keys = ["none", "id", "rid"]
    own = named(id_col).cast("long")
    d = docs.select(boxed(docs), own.isNull().alias("none"), F.coalesce(own, F.lit(0)).alias("id"), F.xxhash64(named(text_col).cast("string")).alias("rid"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("row")))
    return d.join(best.select("x.*"), keys).withColumn("place", place).where("place = 1").select("row.*")
