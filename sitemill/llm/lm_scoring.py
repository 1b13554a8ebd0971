"""Stupid-backoff scores of documents by counts over the whole corpus (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, whole_groups

ORDER = 3
BACKOFF = 0.4
#: Tokens of consecutive documents, at five characters each, that make a chunk: a worker holds one
#: chunk at a time. Larger chunks send fewer n-grams twice.
CHUNK_TOKENS = 3_000_000
#: Tokens, of all orders' n-grams, whose counts one partition of the tables holds.
PARTITION_TOKENS = 2_000_000
#: Bits of an n-gram's key and of a word's: two share one by chance once in so many powers of two.
KEY_BITS, WORD_BITS = 54, 48
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def _planes(a: np.ndarray) -> bytes:
    """Bytes of an array plane by plane, which compresses where high bytes repeat."""
    return np.ascontiguousarray(a.view("u1").reshape(len(a), a.itemsize).T).tobytes()


def _unplanes(b: bytes, kind: str) -> np.ndarray:
    k = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(b, "u1").reshape(k.itemsize, -1).T).view(k).ravel()


def _pack(*arrays: np.ndarray) -> bytes:
    parts = [_planes(a) for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = len(raw) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for k in kinds:
        w = np.dtype(k).itemsize * n
        out.append(_unplanes(raw[at : at + w], k))
        at += w
    return out


class Chunk:
    """Consecutive documents as one stream of word numbers, and their n-grams as 64-bit keys."""

    def __init__(self, ids: list[int | None], sizes: np.ndarray, words: np.ndarray, vocabulary: np.ndarray):
        self.ids, self.sizes, self.words, self.vocabulary = ids, sizes, words, vocabulary

    @classmethod
    def read(cls, ids: list[int | None], texts: list[str | None]) -> Chunk:
        number: dict[bytes, int] = {}
        streams, sizes = [], []
        for t in texts:
            w = tokens(t)
            sizes.append(len(w))
            streams.append(np.fromiter((number.setdefault(x, len(number)) for x in w), "u4", len(w)))
        vocabulary = np.fromiter(map(xxhash.xxh64_intdigest, number), "u8", len(number)) >> np.uint64(64 - WORD_BITS)
        return cls(ids, np.array(sizes, "i8"), np.concatenate(streams) if streams else np.zeros(0, "u4"), vocabulary)

    @classmethod
    def unpack(cls, ids: list[int | None], words: bytes, sizes: bytes, vocabulary: bytes) -> Chunk:
        return cls(ids, *(_unpack(b, k)[0] for b, k in ((sizes, "i8"), (words, "u4"), (vocabulary, "u8"))))

    def keys(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the n-grams, and where each ends in the stream; none crosses documents."""
        h = self.vocabulary[self.words] if len(self.words) else np.zeros(0, "u8")
        ends = np.arange(len(h))
        place = ends - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        ends = ends[place >= n - 1]
        k = np.full(len(ends), n, "u8") * _ODD[0]
        for j in range(n - 1, -1, -1):
            k = _mix(k * np.uint64(3) + h[ends - j])
        return k >> np.uint64(64 - KEY_BITS), ends

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_TOKENS) -> Iterator[tuple[int, Chunk]]:
    """Chunks of consecutive rows (id, text, partition), numbered by partition and place."""
    task = seq = size = 0
    ids, texts = [], []
    for b in batches:
        task = b.column(2)[0].as_py() if b.num_rows else task
        for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ids.append(d)
            texts.append(t)
            size += len(t or "") // 5 + 1
            if size >= limit:
                yield task << 24 | seq, Chunk.read(ids, texts)
                ids, texts, size, seq = [], [], 0, seq + 1
    if ids:
        yield task << 24 | seq, Chunk.read(ids, texts)


def backoff_scores(chunk: Chunk, counts: dict[int, np.ndarray], total: int, order: int, exclude_own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Log10 scores summed per document, and token counts; ``counts[n]`` by sorted distinct n-gram.

    Each token takes the longest n-gram that ends in it and has a count: its count over that of its
    context, times 0.4 for each order given up. Down to nothing, a word that no other document has
    takes one over the corpus size. With ``exclude_own`` a document's own n-grams do not count.
    """
    n_words = len(chunk.words)
    doc = chunk.owners()

    def of_others(n: int) -> np.ndarray:
        """Corpus count of the n-gram that ends at each token, -1 where the document is too short."""
        k, ends = chunk.keys(n)
        _, inverse = np.unique(k, return_inverse=True)
        del k
        c = counts[n][inverse].astype("f8")
        if exclude_own:
            _, own, mine = np.unique(inverse * (len(chunk.sizes) + 1) + doc[ends], return_inverse=True, return_counts=True)
            c -= mine[own]
        out = np.full(n_words, -1.0)
        out[ends] = c
        return out

    shorter = of_others(1)
    size = np.maximum(total - (chunk.sizes[doc] if exclude_own else 0), 1).astype("f8")
    score = np.log10(np.maximum(shorter, 1) / size) + np.where(shorter > 0, 0, np.log10(BACKOFF))
    for n in range(2, order + 1):
        here = of_others(n)
        context = np.r_[-1.0, shorter[:-1]][:n_words]
        full = (here > 0) & (context > 0)
        # a token with a long enough past that is not found there pays for the backoff
        score += np.where(here >= 0, np.log10(BACKOFF), 0)
        score[full] = np.log10(here[full]) - np.log10(context[full])
        shorter = here
    return np.bincount(doc, score, len(chunk.sizes)), chunk.sizes


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, exclude_own: bool = True, chunk_tokens: int = CHUNK_TOKENS
) -> DataFrame:
    """doc_id, n_tokens, log10_score, mean_log10: one row for each input row.

    N-gram counts of order 1 to ``order`` are gathered over all documents, in tables partitioned by
    the n-gram's hash. The documents' exploded n-grams are joined to them in chunks of consecutive
    documents: a chunk sends each distinct n-gram once to its hash partition, with its count there,
    and gets the corpus counts back in the same order. So however frequent an n-gram is, it is one
    entry for each chunk, a partition's load is even, and no list of documents moves. Then scores
    are summed by document.

    Chunks are materialised before their n-grams are taken, so it doesn't matter whether the rows of
    ``docs`` come in the same order twice, as after a lost executor they may not. Partitions are as
    many as the chunks' tokens need, at ``PARTITION_TOKENS`` each.

    Null and empty texts have no tokens, score 0 and a null mean. Rows of one or no id each give a
    row and count as documents of their own. Extra columns are ignored; an empty table gives none.
    """
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.spark_partition_id().alias("task"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "part", 1):
            part, n = t.column("part").to_numpy(), t.column("n").to_numpy()
            for p in np.unique(part):
                for k in np.unique(n[part == p]):
                    rows = t.take(np.flatnonzero((part == p) & (n == k)))
                    held = [_unpack(b, "u8", "u4") for b in rows.column("blob").to_pylist()]
                    keys = [np.cumsum(d, dtype="u8") for d, _ in held]
                    flat, own = np.concatenate(keys), np.concatenate([m for _, m in held])
                    order_ = np.argsort(flat, kind="stable")
                    s = flat[order_]
                    first = np.r_[True, s[1:] != s[:-1]]
                    sums = np.add.reduceat(own[order_].astype("u8"), np.flatnonzero(first))
                    back = np.empty(len(flat), "u8")
                    back[order_] = sums[np.cumsum(first) - 1]
                    cuts = np.cumsum([0, *map(len, keys)])
                    blobs = [_pack(back[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("chunk").combine_chunks(), pa.array([int(k)] * len(blobs), pa.int32()), pa.array([int(p)] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())],
                        names=["chunk", "n", "part", "blob"],
                    )

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, c in chunks(batches, chunk_tokens):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name], pa.int64()),
                    pa.array([len(c.words)], pa.int64()),
                    pa.array([_pack(c.words)], pa.binary()),
                    pa.array([c.ids], pa.list_(pa.int64())),
                    pa.array([_pack(c.sizes)], pa.binary()),
                    pa.array([_pack(c.vocabulary)], pa.binary()),
                ],
                names=["chunk", "tokens", "blob", "ids", "sizes", "vocabulary"],
            )

    body = cut(cols.mapInArrow(bodies, "chunk long, tokens long, blob binary, ids array<bigint>, sizes binary, vocabulary binary"))
    total = body.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    parts = 1 << max(3, (total // PARTITION_TOKENS).bit_length())
    shift = np.uint64(KEY_BITS - parts.bit_length() + 1)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, *blobs in zip(*(b.column(k).to_pylist() for k in ("chunk", "blob", "sizes", "vocabulary")), strict=True):
                c = Chunk.unpack([], *blobs)
                for n in range(1, order + 1):
                    u, m = np.unique(c.keys(n)[0], return_counts=True)
                    cuts = np.searchsorted(u >> shift, np.arange(parts + 1))
                    rows = [(p, x, y) for p, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if x < y]
                    out = [_pack(np.diff(u[x:y], prepend=np.uint64(0)), m[x:y].astype("u4")) for _, x, y in rows]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p for p, _, _ in rows], pa.int32()), pa.array([name] * len(rows), pa.int64()), pa.array([n] * len(rows), pa.int32()), pa.array(out, pa.binary())],
                        names=["part", "chunk", "n", "blob"],
                    )

    grams = body.mapInArrow(explode, "part int, chunk long, n int, blob binary")
    tables = grams.repartition(parts, "part").sortWithinPartitions("part", "n", "chunk").mapInArrow(count, "chunk long, n int, part int, blob binary")
    none, zero = F.lit(None), F.lit(0).alias("n")
    tables = tables.withColumns({"ids": none.cast("array<bigint>"), "sizes": none.cast("binary"), "vocabulary": none.cast("binary")})
    body = body.select("chunk", zero, F.lit(0).alias("part"), "blob", "ids", "sizes", "vocabulary")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "chunk", 1):
            names = t.column("chunk").to_numpy()
            for name in np.unique(names):
                rows = t.filter(pa.array(names == name)).to_pylist()
                top = next(r for r in rows if r["n"] == 0)
                c = Chunk.unpack(top["ids"], top["blob"], top["sizes"], top["vocabulary"])
                found = {n: [_unpack(r["blob"], "u8")[0] for r in sorted((r for r in rows if r["n"] == n), key=lambda r: r["part"])] for n in range(1, order + 1)}
                counts = {n: np.concatenate(x) if x else np.zeros(0, "u8") for n, x in found.items()}
                s, sizes = backoff_scores(c, counts, total, order, exclude_own)
                mean = [x / n if n else None for x, n in zip(s.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.ids, pa.int64()), pa.array(sizes), pa.array(s), pa.array(mean, pa.float64())], names=["doc_id", "n_tokens", "log10_score", "mean_log10"]
                )

    both = tables.unionByName(body).repartition("chunk").sortWithinPartitions("chunk", "n", "part")
    return both.mapInArrow(score, "doc_id long, n_tokens long, log10_score double, mean_log10 double")
