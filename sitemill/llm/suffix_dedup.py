"""Removal of every long byte string that also starts somewhere else, by a collection's suffix array.

Windows of ``length`` bytes meet where their content sends them. A window's anchor is the leftmost
least hash among its 64-byte strings, so equal windows have equal anchors at equal places. The windows
of one anchor lie side by side; with the bytes that they cover they are one *piece*. Pieces whose
anchor string occurs once in the whole collection are never sent.

Pieces of the same anchor string meet in one task, which sorts their suffixes column by column: each
round puts one more symbol in front of every piece, from its end to its start, and inserts the new
suffixes into the collection's Burrows-Wheeler transform and its common prefixes. Both are files that a
round reads and writes in order. A symbol is a block of 16 bytes counted from the anchor: equal windows have
equal blocks, and a round for each byte of a piece would cost 256 times as much. Windows start at any byte,
so suffixes that share the 24 blocks inside a window are then told apart by the bytes on both sides.
"""

from __future__ import annotations

import hashlib
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

LENGTH, BLOCK = 400, 16
#: Bytes of the string that an anchor stands on.
GRAM = 64
#: Texts are searched in stretches of so many windows, so that places fit into the low bits of a hash.
STRETCH, PLACE = 1 << 19, np.uint64((1 << 20) - 1)
#: Bytes of pieces that a task sorts, about; and pieces of one anchor beyond which its windows meet by digest.
TASK_BYTES, HOT = 16_000_000, 20_000
#: Numbers that a round reads from a file at once.
READ = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_power = None


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd base, of its inverse, and a number for each byte; all modulo 2^64."""
    global _power
    if _power is None:
        size = STRETCH + 2 * LENGTH + 1024
        up, down = (np.full(size, b, np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        bytes_ = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
        _power = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64), bytes_
    return _power


def anchors(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, anchor, first window, last window) of each run of windows with one anchor, in order."""
    gram = min(GRAM, length // 2)
    wide = length - gram + 1
    n = len(text) - length + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 4
    up, down, of = _powers()
    out = []
    for at in range(0, n, STRETCH):
        m = min(STRETCH, n - at)
        b = np.frombuffer(text, np.uint8, m + length - 1, at)
        s = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(of[b] * up[: len(b)], out=s[1:])
        h = (s[gram:] - s[:-gram]) * down[: len(b) - gram + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        k = len(h)
        low = np.full(-(-k // wide) * wide, np.iinfo(np.uint64).max, np.uint64)
        low[:k] = (h & ~PLACE) | np.arange(k, dtype=np.uint64)
        rows = low.reshape(-1, wide)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = (np.minimum(back[:m], ahead[wide - 1 : wide - 1 + m]) & PLACE).astype(np.int64)
        first = np.r_[0, np.flatnonzero(least[1:] != least[:-1]) + 1]
        last = np.r_[first[1:] - 1, m - 1]
        out.append((h[least[first]].view(np.int64), least[first] + at, first + at, last + at))
    return tuple(np.concatenate(x) for x in zip(*out))


# --- the collection's suffix array ----------------------------------------------------------
def _merge(old: Path, new: Path, kind, at: np.ndarray, values: np.ndarray, shift=None) -> None:
    """Write ``old`` anew with ``values`` put before its entries ``at``, read and written in order."""
    with old.open("rb") as src, new.open("wb") as out:
        a, done = 0, 0
        while True:
            part = np.fromfile(src, kind, READ)
            if shift is not None:
                part = shift(part)
            end = np.searchsorted(at, a + len(part), "left") if len(part) == READ else len(at)
            np.insert(part, at[done:end] - a, values[done:end]).tofile(out)
            a, done = a + len(part), end
            if len(part) < READ:
                return


class _Least:
    """Least entry of any stretch of a short-integer array, by blocks."""

    def __init__(self, values: np.ndarray, size: int = 64):
        self.size = size
        pad = np.full(-(-max(len(values), 1) // size) * size, 255, np.uint8)
        pad[: len(values)] = values
        rows = pad.reshape(-1, size)
        self.values = pad
        self.ahead = np.minimum.accumulate(rows, axis=1).ravel()
        self.back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [self.ahead[size - 1 :: size].copy()]
        while 2 ** len(self.levels) <= len(rows):
            x, w = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(x[:-w], x[w:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair the least of [a, b]; a <= b."""
        i, j = a // self.size, b // self.size
        out = np.minimum(self.back[a], self.ahead[b])
        near = i == j
        if near.any():
            x, y = a[near], b[near]
            ends = np.c_[x, y + 1].ravel()
            padded = np.r_[self.values, 255]
            out[near] = np.minimum.reduceat(padded, ends)[::2]
        far = j - i > 1
        if far.any():
            x, y = i[far] + 1, j[far]
            level = np.frexp((y - x).astype(float))[1] - 1
            got = np.empty(len(x), np.uint8)
            for k in np.unique(level):
                s = level == k
                v = self.levels[k]
                got[s] = np.minimum(v[x[s]], v[y[s] - 2**k])
            out[far] = np.minimum(out[far], got)
        return out


def collection_suffixes(symbols: np.ndarray, start: np.ndarray, cap: int, folder: Path) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all strings in order, as places in ``symbols``, and the common prefix with the one before.

    String i is symbols[start[i]:start[i + 1]]; symbols are whole numbers from 0, prefixes are counted
    up to ``cap``. Round j inserts the suffixes of j symbols. The transform is kept as the sorted list of (symbol,
    position): entry t is the t-th suffix that is not empty, its symbol, and where its tail stands, so a new
    suffix stands where (symbol in front, position of its tail) sorts. Its common prefix is one more than
    the least one between the two tails. Memory holds one byte for each suffix, files the rest.
    """
    m, size = len(start) - 1, np.diff(start)
    files = {n: (folder / f"{n}0", folder / f"{n}1") for n in ("places", "prefix", "suffix")}
    np.zeros(0, np.int64).tofile(files["places"][0])
    np.zeros(m, np.uint8).tofile(files["prefix"][0])
    np.zeros(0, np.int64).tofile(files["suffix"][0])
    tail = np.arange(m)  # where the last suffix of each string stands; the empty ones are the first m
    for j in range(1, int(size.max(initial=0)) + 1):
        old, new = {n: f[(j - 1) % 2] for n, f in files.items()}, {n: f[j % 2] for n, f in files.items()}
        live = np.flatnonzero(size >= j)
        key = (symbols[start[live + 1] - j].astype(np.int64) << 32) | tail[live]
        order = np.argsort(key)
        live, key = live[order], key[order]
        places = np.memmap(old["places"], np.int64, "r") if old["places"].stat().st_size else np.zeros(0, np.int64)
        at = np.searchsorted(places, key)
        to = at + np.arange(len(at))
        prefix = np.fromfile(old["prefix"], np.uint8)
        least = _Least(prefix)

        def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Common prefixes of suffixes with entries a and the later b."""
            out = np.zeros(len(a), np.uint8)
            same = a >> 32 == b >> 32
            p, q = a[same] & 0xFFFFFFFF, b[same] & 0xFFFFFFFF
            out[same] = np.minimum(least(p + 1, q) + 1, cap)
            return out

        before = np.full(len(at), -1, np.int64)
        before[at > 0] = places[at[at > 0] - 1]
        twin = np.r_[False, at[1:] == at[:-1]]
        before[twin] = key[:-1][twin[1:]]
        fresh = common(before, key)
        last = np.r_[at[1:] != at[:-1], True] & (at < len(places))  # the old entry that follows a new one
        prefix[m + at[last]] = common(key[last], np.asarray(places[at[last]]))
        prefix.tofile(old["prefix"])
        # entries point at tails: those behind an insertion move on
        moved = np.searchsorted(m + at, key & 0xFFFFFFFF, "right")
        _merge(old["places"], new["places"], np.int64, at, key + moved, lambda x: x + np.searchsorted(m + at, x & 0xFFFFFFFF, "right"))
        _merge(old["prefix"], new["prefix"], np.uint8, m + at, fresh)
        _merge(old["suffix"], new["suffix"], np.int64, at, start[live + 1] - j)
        tail[live] = m + to
    turn = int(size.max(initial=0)) % 2
    return np.fromfile(files["suffix"][turn], np.int64), np.fromfile(files["prefix"][turn], np.uint8)[m:]


def _words(rows: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as columns of 8-byte words."""
    wide = -(-rows.shape[1] // 8) * 8
    out = np.zeros((len(rows), wide), np.uint8)
    out[:, : rows.shape[1]] = rows
    return list(out.view(np.uint64).T)


def _classes(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(class of each row, size of its class) by equal columns."""
    order = np.lexsort(columns)
    step = np.ones(len(order), bool)
    if len(order):
        step[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(step) - 1
    return of, np.bincount(of, minlength=1)[of] if len(of) else of


def repeated_windows(bodies: list[bytes], skip: np.ndarray, n: np.ndarray, length: int, block: int, folder: Path) -> np.ndarray:
    """For every window of distinct pieces whether it also starts in another one; windows of piece i follow those of i - 1.

    A body is whole blocks; its first window starts after ``skip`` bytes, and it has ``n`` windows.
    """
    inner = (length - block + 1) // block
    rest = length - inner * block
    data = np.frombuffer(b"".join(bodies), np.uint8).reshape(-1, block)
    start = np.r_[0, np.cumsum([len(b) // block for b in bodies])].astype(np.int64)
    symbols = _classes(_words(data))[0]
    suffix, prefix = collection_suffixes(symbols, start, inner, folder)
    first = np.r_[0, np.cumsum(n)].astype(np.int64)
    out = np.zeros(first[-1], bool)
    joined = prefix >= inner
    group = np.cumsum(~joined)
    many = np.bincount(group, minlength=1)[group] > 1 if len(group) else joined
    at, group = suffix[many], group[many]
    piece = np.searchsorted(start, at, "right") - 1
    offset = (at - start[piece]) * block - skip[piece]  # of the window that starts with the suffix
    low, high = np.maximum(offset - n[piece] + 1, 0), np.minimum(offset, block - 1)  # bytes that may stand before it
    good = low <= high
    at, group, piece, offset, low, high = (x[good] for x in (at, group, piece, offset, low, high))
    if not len(at):
        return out
    pad = np.vstack([data, np.zeros((2 + -(-rest // block), block), np.uint8)])
    left = np.where((at > start[piece])[:, None], pad[at - 1], 0)
    right = np.hstack([pad[np.minimum(at + inner + i, len(data))] for i in range(-(-rest // block))])[:, :rest]
    beside = np.hstack([left, right]).astype(np.uint8)
    kind, size = _classes([*_words(beside), low, high, group])
    alone = np.zeros(len(at), bool)
    for x in range(block):
        valid = (low <= x) & (x <= high)
        hit = valid & (size > 1)
        out[(first[piece] + offset - x)[hit]] = True
        # one row stands for each class; what is left to compare are groups of several classes
        rows = np.flatnonzero(valid)
        rows = rows[np.unique(kind[rows], return_index=True)[1]]
        rows = rows[np.bincount(group[rows], minlength=1)[group[rows]] > 1] if len(rows) else rows
        if not len(rows):
            continue
        _, twins = _classes([*_words(beside[rows, block - x : block - x + rest]), group[rows]])
        alone[:] = False
        alone[rows[twins > 1]] = True
        alone &= size == 1
        out[(first[piece] + offset - x)[alone]] = True
    return out


# --- pieces from texts, and spans back to them ------------------------------------------------
def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for b in batches:
        for v in b.column(0):
            yield v.as_buffer().to_pybytes() if v.is_valid else b""


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _keys(length: int):
    """Digest, rows and anchor keys, with how often each, of a text; a text that the task has met is a count alone."""
    schema = pa.schema([("digest", pa.binary()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        more: dict[bytes, int] = {}
        for text in _texts(batches):
            d = hashlib.sha256(text).digest()
            if d in more:
                more[d] += 1
            else:
                more[d] = 0
                yield d, 1, *np.unique(anchors(text, length)[0], return_counts=True)
        yield from ((d, n, None, None) for d, n in more.items() if n)

    return lambda batches: _batches(rows(batches), schema)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text once in a task, compressed."""
    schema = pa.schema([("digest", pa.binary()), ("z", pa.binary())])
    seen: set[bytes] = set()
    zip_ = zstandard.ZstdCompressor(level=3)

    def rows() -> Iterator[tuple]:
        for text in _texts(batches):
            d = hashlib.sha256(text).digest()
            if d not in seen:
                seen.add(d)
                yield d, zip_.compress(text)

    return _batches(rows(), schema)


def _pieces(row: dict, length: int, block: int) -> Iterator[tuple[int, bytes, bytes, int, int, int]]:
    """(key, id, body, skip, windows, first window) of the wanted pieces of a text."""
    text = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["z"]), np.uint8)
    key, anchor, first, last = anchors(text.tobytes(), length)
    for r in np.flatnonzero(np.isin(key, row["keys"])):
        a, f, e = int(anchor[r]), int(first[r]), int(last[r])
        skip = (f - a) % block
        body = np.zeros(-(-(skip + e - f + length) // block) * block, np.uint8)
        body[skip : skip + e - f + length] = text[f : e + length]
        raw = body.tobytes()
        n = e - f + 1
        yield int(key[r]), hashlib.blake2b(raw + skip.to_bytes(4, "little") + n.to_bytes(4, "little"), digest_size=16).digest(), raw, skip, n, f


def _bodies(length: int, block: int):
    """Distinct pieces of a task; equal ones follow as a count without a body."""
    schema = pa.schema([("key", pa.int64()), ("piece", pa.binary()), ("body", pa.binary()), ("skip", pa.int32()), ("windows", pa.int32()), ("copies", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        more: dict[bytes, list[int]] = {}
        for b in batches:
            for row in b.to_pylist():
                for key, piece, body, skip, n, _ in _pieces(row, length, block):
                    if piece in more:
                        more[piece][1] += 1
                    else:
                        more[piece] = [key, 0]
                        yield key, piece, body, skip, n, 1
        yield from ((k, p, None, None, None, c) for p, (k, c) in more.items() if c)

    return lambda batches: _batches(rows(batches), schema)


def _places(length: int, block: int):
    """Each distinct piece of a text once, with the first window of all its places."""
    schema = pa.schema([("piece", pa.binary()), ("num", pa.int64()), ("firsts", pa.list_(pa.int64()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for row in b.to_pylist():
                firsts: dict[bytes, list[int]] = {}
                for _, piece, _, _, _, f in _pieces(row, length, block):
                    firsts.setdefault(piece, []).append(f)
                yield from ((piece, row["num"], f) for piece, f in firsts.items())

    return lambda batches: _batches(rows(batches), schema, 20_000)


def _runs_of(flags: np.ndarray) -> list[dict]:
    """Maximal runs of true entries as first and last."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return [{"a": int(a), "b": int(b) - 1} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


_MARKS = pa.schema([("piece", pa.binary()), ("windows", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))])
_MARKS_SQL = "piece binary, windows array<struct<a: int, b: int>>"


def _sorted(length: int, block: int):
    """All pieces of a partition -> the windows of each that also start elsewhere."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        copies: dict[bytes, int] = {}
        whole: dict[bytes, tuple[bytes, int, int]] = {}
        for b in batches:
            for key, piece, body, skip, n, c in zip(*(x.to_pylist() for x in b.columns)):
                copies[piece] = copies.get(piece, 0) + c
                if body is not None and piece not in whole:
                    whole[piece] = (body, skip, n)
        if not whole:
            return
        folder = Path(tempfile.mkdtemp(prefix="suffixes"))  # files of this task alone, gone when it ends
        try:
            n = np.array([w[2] for w in whole.values()], np.int64)
            found = repeated_windows([w[0] for w in whole.values()], np.array([w[1] for w in whole.values()], np.int64), n, length, block, folder)
        finally:
            shutil.rmtree(folder, ignore_errors=True)
        for piece, a, k in zip(whole, np.r_[0, np.cumsum(n)], n):
            if copies[piece] > 1:
                yield piece, [{"a": 0, "b": int(k) - 1}]
            elif found[a : a + k].any():
                yield piece, _runs_of(found[a : a + k])

    return lambda batches: _batches(rows(batches), _MARKS)


def _digested(length: int):
    """The windows of pieces as digests: for anchors that very many distinct pieces share."""
    schema = pa.schema([("window", pa.binary()), ("piece", pa.binary()), ("at", pa.int32()), ("copies", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for row in b.to_pylist():
                text = row["body"]
                for w in range(row["windows"]):
                    x = text[row["skip"] + w : row["skip"] + w + length]
                    yield hashlib.blake2b(x, digest_size=16).digest(), row["piece"], w, row["copies"]

    return lambda batches: _batches(rows(batches), schema, 20_000)


def _cut_text(length: int):
    """num, spans and what is left of a text, from its repeated windows."""
    schema = pa.schema([("num", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for row in b.to_pylist():
                text = zstandard.ZstdDecompressor().decompress(row["z"])
                found = [np.add.outer([(w["a"], w["b"] + length) for w in p["windows"]], p["firsts"]).transpose(0, 2, 1).reshape(-1, 2) for p in row["pieces"]]
                found = np.concatenate(found)
                found = found[np.argsort(found[:, 0])]
                reach = np.maximum.accumulate(found[:, 1])
                opens = np.flatnonzero(np.r_[True, found[1:, 0] > reach[:-1]])
                spans = list(zip(found[opens, 0].tolist(), reach[np.r_[opens[1:] - 1, len(reach) - 1]].tolist()))
                left = hashlib.sha256()
                at = 0
                for a, e in spans:
                    left.update(text[at:a])
                    at = e
                left.update(text[at:])
                yield row["num"], [{"start": a, "end": e} for a, e in spans], left.hexdigest()

    return lambda batches: _batches(rows(batches), schema)


def _hot_marks(bodies: DataFrame, length: int) -> DataFrame:
    """Marks of pieces whose anchors are too common for one task: windows are counted by digest."""
    whole = bodies.groupBy("piece").agg(F.max("body").alias("body"), F.max("skip").alias("skip"), F.max("windows").alias("windows"), F.sum("copies").alias("copies"))
    windows = cut(whole.mapInArrow(_digested(length), "window binary, piece binary, at int, copies long"))
    again = windows.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window")
    hits = windows.join(again, "window").groupBy("piece").agg(F.collect_set("at").alias("at"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flags = [np.bincount(x.values.to_numpy()) > 0 for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_runs_of(f) for f in flags], _MARKS.types[1])], schema=_MARKS)

    return hits.mapInArrow(runs, _MARKS_SQL)


def repeated_spans(df: DataFrame, text: str = "text", length: int = LENGTH, block: int = BLOCK, task_bytes: int = TASK_BYTES, hot: int = HOT) -> DataFrame:
    """The distinct texts from which something goes: digest (SHA-256), removed spans of bytes, kept_sha256.

    Goes whatever is covered by a string of ``length`` bytes that also starts anywhere else, in the
    same text or another row, matches lying within one row each; strings are judged on the input. A null
    text is empty. Texts of fewer bytes have nothing to remove, but one that stands in several rows and has
    as many goes whole. The answer is a function of the texts, so order, ids and other columns don't
    matter; an empty table gives no rows.

    What is shuffled: a digest and the anchor keys (8 bytes for about 170 bytes of text) of each distinct
    text; texts with a repeated anchor, compressed, once to be cut to pieces and once to be cut; and the
    pieces of repeated anchors (about 570 bytes for 170 windows). Equal texts and equal pieces are merged
    in each task before. Pieces are dealt by anchor to as many tasks as their bytes need. Anchors with
    over ``hot`` pieces would fill a task: their windows meet by 128-bit digest instead, so that no task holds a group.
    """
    if not 2 * block <= length <= 250 * block:
        raise ValueError("length has to be 2 to 250 blocks")
    docs = df.select(F.col(f"`{text}`").cast("binary").alias("t")).where(F.octet_length("t") >= length)
    texts = docs.mapInArrow(_keys(length), "digest binary, n long, keys array<long>, times array<long>")
    texts = texts.groupBy("digest").agg(F.sum("n").alias("n"), F.first(F.when(F.col("keys").isNotNull(), F.arrays_zip("keys", "times")), ignorenulls=True).alias("keys"))
    texts = cut(texts).withColumn("num", F.monotonically_increasing_id())  # stands for the digest while keys are counted
    keys = texts.select("num", F.explode("keys").alias("k")).select("num", F.col("k.keys").alias("key"), F.col("k.times").alias("times"))
    again = keys.groupBy("key").agg(F.sum("times").alias("pieces")).where("pieces > 1")
    wanted = keys.join(again, "key").groupBy("num").agg(F.collect_list(F.struct("key", "pieces", "times")).alias("keys"))
    wanted = texts.select("num", "digest", "n").join(wanted, "num")
    sent = docs.mapInArrow(_packed, "digest binary, z binary").groupBy("digest").agg(F.first("z").alias("z"))
    held = cut(sent.join(wanted, "digest").select("num", "digest", "n", "z", "keys"))
    every = F.transform("keys", lambda k: k["key"]).alias("keys")
    times = F.aggregate("keys", F.lit(0).cast("long"), lambda n, k: n + k["times"])
    size = held.agg(F.sum(times).alias("n"), F.max(F.array_max(F.transform("keys", lambda k: k["pieces"]))).alias("most")).first()
    some_keys = lambda few: F.transform(F.filter("keys", lambda k: (k["pieces"] <= hot) if few else (k["pieces"] > hot)), lambda k: k["key"]).alias("keys")
    body_schema = "key long, piece binary, body binary, skip int, windows int, copies long"
    parts = max(1, -(-(size["n"] or 0) * (length + length // 2) // task_bytes))
    marks = held.select("z", some_keys(True)).mapInArrow(_bodies(length, block), body_schema).repartition(parts, "key").mapInArrow(_sorted(length, block), _MARKS_SQL)
    if (size["most"] or 0) > hot:
        marks = marks.unionByName(_hot_marks(held.select("z", some_keys(False)).mapInArrow(_bodies(length, block), body_schema), length))
    places = held.where("n = 1").select("num", "z", every).mapInArrow(_places(length, block), "piece binary, num long, firsts array<long>")
    hits = places.join(marks, "piece").groupBy("num").agg(F.collect_list(F.struct("firsts", "windows")).alias("pieces"))
    some = held.where("n = 1").select("num", "digest", "z").join(hits, "num")
    some = some.select("num", "z", "pieces").mapInArrow(_cut_text(length), "num long, removed array<struct<start: long, end: long>>, kept_sha256 string")
    whole = docs.select(F.unhex(F.sha2("t", 256)).alias("digest"), F.octet_length("t").cast("long").alias("size"))
    whole = whole.groupBy("digest", "size").agg(F.count("*").alias("n")).where("n > 1")
    span = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("end")))
    nothing = hashlib.sha256().hexdigest()
    return texts.select("num", "digest").join(some, "num").select("digest", "removed", "kept_sha256").unionByName(whole.select("digest", span.alias("removed"), F.lit(nothing).alias("kept_sha256")))


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row for each row of ``df``: its id, n_bytes, the removed spans of its UTF-8 bytes, kept_sha256.

    Spans are maximal and in order, an empty list where nothing goes. Null texts are empty. Repeated
    rows and null ids give their rows each; other columns may have any names.
    """
    found = repeated_spans(df, text, **options).withColumnRenamed("kept_sha256", "left_sha256")
    t = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.octet_length(t).cast("long").alias("n_bytes"), F.sha2(t, 256).alias("sha256"))
    out = rows.withColumn("digest", F.unhex("sha256")).join(found, "digest", "left")
    spans = F.coalesce("removed", F.array().cast("array<struct<start: long, end: long>>"))
    return out.select(F.col("id").alias(id_col), "n_bytes", spans.alias("removed"), F.coalesce("left_sha256", "sha256").alias("kept_sha256"))
