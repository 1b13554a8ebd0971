"""Packing of tokenized documents into sequences by bin completion (operator 5)."""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

CAPACITY = 1024
END = 2
#: The pattern by which byte-level BPE cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What the quick encoder leaves to the tokenizer itself: special strings, scripts whose classes
#: differ between Unicode versions, and runs that it would take quadratic time for.
CAREFUL = re.compile(r"<\||[^\x00-ԯ -⁯₠-₿]|\S{3000}|\s{3000}")


def _bytes_of(token: str, table: dict[str, int]) -> bytes:
    return bytes(table[c] for c in token)


@cache
def encoder(path: str):
    """text -> ids (numpy) for a byte-level BPE file of the tokenizers library.

    Ordinary texts go through a second implementation of the same merges that is several times
    faster; it is used only if the file's ids are in the order of its merges, and gives the same
    ids (tested). The rest go through ``tokenizers``.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def slow(text: str) -> np.ndarray:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    plain = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"].get("merges", [])]
    vocab = spec["model"]["vocab"]
    if not plain or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return slow
    import tiktoken

    # byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ...
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    table = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {_bytes_of(t, table): i for t, i in vocab.items() if t not in special}
    quick = tiktoken.Encoding("quick", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if CAREFUL.search(text):
            return slow(text)
        return np.array(quick.encode_ordinary(text), "<u4")

    return encode


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and the task and the rank among its pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = encode(t or "").astype("<u4").tobytes() + END.to_bytes(4, "little")
                n = len(raw) // 4
                at = n if n <= capacity else n % capacity or capacity
                cuts = [0, *range(at, n + 1, capacity)]
                for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    row = (d, k, x, y - x, zlib.crc32(raw[4 * x : 4 * y]), task, seen[y - x])
                    seen[y - x] += 1
                    for col, v in zip(out, row, strict=True):
                        col.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
    cols = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return cols.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long")


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs: total size, and items too large to share (Martello and Toth)."""
    size = np.arange(capacity + 1)
    n, s = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(counts * size)]  # of sizes below the index
    best, half = math.ceil(s[-1] / capacity), capacity // 2
    for k in range(half + 1):
        alone = n[-1] - n[capacity - k + 1]
        large = n[capacity - k + 1] - n[half + 1]
        room = large * capacity - (s[capacity - k + 1] - s[half + 1])
        small = s[half + 1] - s[k]
        best = max(best, alone + large + max(0, math.ceil((small - room) / capacity)))
    return int(best)


def covers(a: tuple[int, ...], b: tuple[int, ...], most: int = 10_000) -> bool:
    """Whether the set a dominates b: the items of b can be dealt to those of a, none overfull.

    Then a packing with b has one with a that is no worse. Equal items may be matched first. Gives
    up after ``most`` tries with False, which keeps b and so loses nothing.
    """
    left, spare = Counter(b), Counter(a)
    common = left & spare
    todo = sorted((left - common).elements(), reverse=True)
    room = sorted((spare - common).elements())
    if sum(todo) > sum(room):
        return False
    tries = 0

    def deal(i: int) -> bool:
        nonlocal tries
        if i == len(todo):
            return True
        seen = set()
        for j, free in enumerate(room):
            if free < todo[i] or free in seen:
                continue
            tries += 1
            if tries > most:
                return False
            seen.add(free)
            room[j] = free - todo[i]
            if deal(i + 1):
                return True
            room[j] = free
        return False

    return deal(0)


def undominated(sets: list[tuple[int, ...]], width: int | None = None) -> list[tuple[int, ...]]:
    """The sets that none before them covers, in their order; the first ``width`` if given."""
    out: list[tuple[int, ...]] = []
    for items in sets:
        if len(out) == width:
            break
        if not any(covers(o, items) for o in out):
            out.append(items)
    return out


def all_fillings(counts: np.ndarray, room: int) -> list[tuple[int, ...]]:
    """Every undominated set of items for ``room``, tightest first. Exponential: for the exact search."""
    sizes = [int(x) for x in np.flatnonzero(counts[: room + 1])[::-1] if x]
    found: list[tuple[int, ...]] = []

    def grow(at: int, left: int, items: tuple[int, ...]) -> None:
        if at == len(sizes):
            found.append(items)
            return
        for n in range(min(int(counts[sizes[at]]), left // sizes[at]), -1, -1):
            grow(at + 1, left - n * sizes[at], items + (sizes[at],) * n)

    grow(0, room, ())
    # larger sums first, then larger items: no set is covered by one after it, but for equals
    found.sort(key=lambda f: (-sum(f), [-x for x in f]))
    return undominated(found)


def fillings(counts: np.ndarray, room: int, width: int) -> list[tuple[int, ...]]:
    """Tight sets of items for ``room`` that don't dominate each other: tightest first, unlike ones before the rest.

    One item that fills the room exactly dominates every other set. Otherwise sets of one, two and
    three items, each made maximal by further best fits: a choice, not every undominated set, which
    ``all_fillings`` enumerates.
    """
    have = counts[: room + 1].copy()
    if room <= 0 or not have[1:].any():
        return [()]
    if have[room]:
        return [(room,)]
    under = np.maximum.accumulate(np.where(have > 0, np.arange(room + 1), 0))  # largest item that fits
    sizes = np.flatnonzero(have)[::-1]
    sizes = sizes[sizes > 0]

    def rest(x: np.ndarray, left: np.ndarray) -> np.ndarray:
        y = under[np.minimum(left, x)]
        # the same size twice needs two of it
        return np.where((y == x) & (have[x] < 2), under[np.maximum(y - 1, 0)], y)

    second = rest(sizes, room - sizes)
    third = rest(np.where(second > 0, second, 1), room - sizes - second) * (second > 0)
    found: dict[tuple[int, ...], int] = {}

    def add(items: list[int]) -> None:
        left, used = room - sum(items), {}
        for x in items:
            used[x] = used.get(x, 0) + 1
        if any(have[x] < c for x, c in used.items()):
            return
        while left > 0:
            y = int(under[left])
            while y and have[y] <= used.get(y, 0):
                y = int(under[y - 1])
            if not y:
                break
            c = min(left // y, int(have[y]) - used.get(y, 0))
            items += [y] * c
            used[y] = used.get(y, 0) + c
            left -= y * c
        found[tuple(sorted(items, reverse=True))] = left

    add([int(sizes[0])])
    total = sizes + second
    for i in np.argsort(-total, kind="stable")[: 2 * width]:
        add([int(sizes[i])] + [int(second[i])] * bool(second[i]))
    if min(found.values()):
        for i in np.argsort(-(total + third), kind="stable")[: 2 * width]:
            add([int(x) for x in (sizes[i], second[i], third[i]) if x])
        # an exact fill by more items: which totals can be reached at all
        best = exact_fill(have, room)
        if best:
            add(best)
    kept = undominated([items for items, _ in sorted(found.items(), key=lambda f: (f[1], [-x for x in f[0]]))])
    # unlike ones first: those whose largest item is larger than in any tighter one
    tops = np.maximum.accumulate([0, *(f[0] for f in kept)])
    return sorted(kept, key=lambda f: f[0] <= tops[kept.index(f)])[:width]


def exact_fill(have: np.ndarray, room: int, most: int = 4) -> list[int]:
    """Up to ``most`` items that fill the room exactly, large ones first; empty if there are none."""
    sizes = [int(x) for x in np.flatnonzero(have)[::-1] if x]
    reach = [0, sum(1 << x for x in sizes)]  # bit t: t is a sum of so many items (counts apart)
    mask = (1 << (room + 1)) - 1
    for _ in range(most - 1):
        r, prev = 0, reach[-1]
        for x in sizes:
            r |= (prev << x) & mask
        reach.append(r)
        if r >> room & 1:
            break
    for k in range(1, len(reach)):
        if not reach[k] >> room & 1:
            continue
        items, left, top, used = [], room, room, {}
        for j in range(k, 0, -1):
            for x in sizes:
                if x <= min(top, left) and used.get(x, 0) < have[x] and (left - x == 0 if j == 1 else reach[j - 1] >> (left - x) & 1):
                    items.append(x)
                    used[x] = used.get(x, 0) + 1
                    left, top = left - x, x
                    break
            else:
                break
        if left == 0:
            return items
    return []


Plan = list[tuple[tuple[int, ...], int]]


def best_fit(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Best-fit decreasing, with equal bins held as one group: the number of groups is bounded."""
    free: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for s in np.flatnonzero(counts)[::-1]:
        s, left = int(s), int(counts[s])
        while left:
            fits = [f for f in free if f >= s]
            if fits:
                f = min(fits)
                items, bins = free[f].pop()
                if not free[f]:
                    del free[f]
            else:
                f, items, bins = capacity, (), left  # as many new bins as could be needed
            each = f // s
            full = min(bins, left // each)
            new = [(each, full), (left - full * each, 1)] if full < bins and left > full * each else [(each, full)]
            for n, times in new:
                if n and times:
                    free.setdefault(f - n * s, []).append(((*items, *[s] * n), times))
                    left -= n * times
            rest = bins - sum(times for n, times in new if n)
            if items and rest:
                free.setdefault(f, []).append((items, rest))
    return [g for groups in free.values() for g in groups]


def bin_completion(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = 2_000, width: int = 3, exact: bool = False) -> Plan:
    """Fillings and how often each is used, for ``counts[size]`` items; all items are placed.

    Branch and bound: each step completes the bin of the largest item left by an undominated
    filling, as often as the counts allow (equal bins are one step, so the work does not grow with
    the number of documents). The best-fit solution is the first incumbent; fillings are tried
    in the order of ``fillings``, deepest first. A branch is left when its waste exceeds what a better solution may waste; the
    search ends at the lower bound or after ``nodes`` steps, with the best found.

    With ``exact`` a step is one bin, every undominated filling is tried, and only the bound ends the
    search: no packing has fewer bins. Its time is exponential in the bins, so it is for small tables.
    """
    counts = counts.astype("i8").copy()
    counts[0] = 0
    total = int((counts * np.arange(capacity + 1)).sum())
    least = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    bins_best = sum(times for _, times in best)
    todo: list[tuple[np.ndarray, int, int, tuple | None]] = [(counts, 0, 0, None)]
    steps = 0
    while todo and bins_best > least and (exact or steps < nodes):
        have, bins, waste, trail = todo.pop()
        if waste > (bins_best - 1) * capacity - total or bins + lower_bound(have, capacity) >= bins_best:
            continue
        steps += 1
        left = np.flatnonzero(have)
        if not len(left):
            if bins < bins_best:
                bins_best, best = bins, []
                while trail:
                    trail, step = trail
                    best.append(step)
                best.reverse()
            continue
        big = int(left[-1])
        have = have.copy()
        have[big] -= 1
        children = []
        for items in all_fillings(have, capacity - big) if exact else fillings(have, capacity - big, width):
            need = np.bincount([big, *items], minlength=capacity + 1)
            used = np.flatnonzero(need)
            whole = have.copy()
            whole[big] += 1
            times = 1 if exact else int((whole[used] // need[used]).min())
            whole[used] -= need[used] * times
            over = capacity - big - sum(items)
            children.append((whole, bins + times, waste + over * times, (trail, ((big, *items), times))))
        todo += reversed(children)
    return best


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, nodes: int = 2_000, exact: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row for each piece.

    Every row of ``docs`` gives its pieces: null and empty texts one of a single end token; rows of
    one id each their own. Documents of at most ``capacity`` tokens stay whole; longer ones are cut
    from the end into full pieces, so that only the first may be shorter. Extra columns are ignored.

    Only the counts of the ``capacity`` possible lengths reach the driver, however many documents
    there are (``nodes`` and ``exact`` are those of ``bin_completion``); the plan made from them is of bounded size too. A piece finds its place by its rank
    among the pieces of its length: tasks rank their own, and counts of (task, length) shift them.
    """
    all_pieces = cut(pieces(docs, tokenizer, id_col, text_col, capacity))
    by_task = all_pieces.groupBy("length", "task").count()
    counts = np.zeros(capacity + 1, "i8")
    for r in by_task.groupBy("length").agg(F.sum("count").alias("n")).collect():
        counts[r["length"]] = r["n"]
    runs: dict[int, list[tuple[int, int, int]]] = {}
    first_free, taken = 0, np.zeros(capacity + 1, "i8")
    for items, times in bin_completion(counts, capacity, nodes, exact=exact):
        at = 0
        for x in items:
            runs.setdefault(x, []).append((int(taken[x]), first_free, at))
            taken[x] += times
            at += x
        first_free += times
    table = {x: tuple(np.array(c, "i8") for c in zip(*r, strict=True)) for x, r in runs.items()}
    shared = docs.sparkSession.sparkContext.broadcast(table)
    shift = by_task.withColumn("base", F.sum("count").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = all_pieces.join(shift.select("length", "task", F.coalesce("base", F.lit(0)).alias("base")), ["length", "task"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("global").to_numpy()
            seq, off = np.zeros(len(rank), "i8"), np.zeros(len(rank), "i8")
            for x in np.unique(length):
                lo, base, at = shared.value[int(x)]
                own = np.flatnonzero(length == x)
                k = np.searchsorted(lo, rank[own], "right") - 1
                seq[own], off[own] = base[k] + rank[own] - lo[k], at[k]
            cols = [c for n, c in zip(b.schema.names, b.columns, strict=True) if n != "global"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(off)], names=[n for n in b.schema.names if n != "global"] + ["sequence_id", "offset"])

    cols = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("global"))
    return cols.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
