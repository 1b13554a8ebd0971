"""Search of barcodes and adapters in reads, with mismatches and partial overlaps, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

#: Padded bytes that one step compares at once, so that long reads take no more memory than short ones.
STEP_BYTES = 1 << 23


def _steps(lengths: np.ndarray, width: int) -> Iterator[slice]:
    """Consecutive rows whose matrix, as wide as their longest, stays within the step (one row at least)."""
    at, most = 0, 0
    for i, n in enumerate(lengths):
        wide = max(most, int(n) + width)
        if i > at and wide * (i + 1 - at) > STEP_BYTES:
            yield slice(at, i)
            at, wide = i, int(n) + width
        most = wide
    if at < len(lengths):
        yield slice(at, len(lengths))


def best_places(reads: list[bytes], adapter: bytes, rate: float, least: int, front: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, place, errors) of the best place of an adapter in each read; the score is -1 where there is none.

    No indels. ``N`` in the adapter is any base. A front adapter may lack its first bases where the
    read starts, a back adapter its last ones where the read ends; ``least`` bases must overlap, and
    the errors be within ``rate`` times the overlapping bases other than N. The score is matches less
    errors; the highest wins, then the leftmost place. Places before the read are negative.
    """
    k = len(adapter)
    letters = np.frombuffer(adapter, "u1")
    lengths = np.array([len(r) for r in reads], "i8")
    score, place, errors = np.full(len(reads), -1, "i8"), np.zeros(len(reads), "i8"), np.zeros(len(reads), "i8")
    for rows in _steps(lengths, 2 * k):
        n = lengths[rows]
        width = int(n.max())
        padded = np.zeros((len(n), width + 2 * k), "u1")
        padded[:, k : k + width] = np.array(reads[rows], f"S{max(width, 1)}").view("u1").reshape(len(n), -1)[:, :width]
        places = width + k
        wrong, over, firm = (np.zeros((len(n), places), "i4") for _ in range(3))
        for j, base in enumerate(letters):
            column = padded[:, j : j + places]
            inside = column != 0
            over += inside
            if base != ord("N"):
                firm += inside
                wrong += inside & (column != base)
        at = np.arange(places) - k
        fits = (at[None, :] + k <= n[:, None]) if front else (at[None, :] >= 0) & (at[None, :] < n[:, None])
        good = fits & (over >= min(least, k)) & (wrong <= np.floor(rate * firm + 1e-9))
        points = np.where(good, over - 2 * wrong, -1)
        top = points.argmax(axis=1)
        row = np.arange(len(n))
        score[rows], place[rows], errors[rows] = points[row, top], at[top], wrong[row, top]
    return score, place, errors


def _bytes(seqs: pd.Series) -> list[bytes]:
    return [(s or "").encode("ascii", "replace") for s in seqs]


def claim(seq: Column, barcodes: list[tuple[str, str]], rate: float, least: int = 3) -> Column:
    """struct(sample, barcode_start, errors) of the barcode with the best place, null sample if none has one.

    Ties go to the leftmost place, then to the first of the table. The start is zero for a partial one.
    """

    @pandas_udf("sample string, barcode_start int, errors int")
    def found(seqs: pd.Series) -> pd.DataFrame:
        reads = _bytes(seqs)
        score, start, errors = np.full(len(reads), -1, "i8"), np.zeros(len(reads), "i8"), np.zeros(len(reads), "i8")
        owner = np.full(len(reads), -1)
        for i, (_, barcode) in enumerate(barcodes):
            s, p, e = best_places(reads, barcode.encode(), rate, least, front=True)
            better = (s > score) | ((s == score) & (s >= 0) & (p < start))
            score, start, errors, owner = np.where(better, s, score), np.where(better, p, start), np.where(better, e, errors), np.where(better, i, owner)
        hit = owner >= 0
        names = np.array([*(name for name, _ in barcodes), None], object)
        value = lambda x: pd.array(np.where(hit, x, 0), "Int32").copy()
        begin, wrong = value(np.maximum(start, 0)), value(errors)
        begin[~hit], wrong[~hit] = pd.NA, pd.NA
        return pd.DataFrame({"sample": names[owner], "barcode_start": begin, "errors": wrong})

    return found(seq)


def cut_near(seq: Column, adapters: list[str], rate: float = 0.1, least: int = 3) -> Column:
    """Length of a read before the best place of any 3' adapter, whole or cut by the read's end; else its length."""

    @pandas_udf("int")
    def cut(seqs: pd.Series) -> pd.Series:
        reads = _bytes(seqs)
        score, keep = np.full(len(reads), -1, "i8"), np.array([len(r) for r in reads], "i8")
        for adapter in adapters:
            s, p, _ = best_places(reads, adapter.encode(), rate, least, front=False)
            better = (s > score) | ((s == score) & (s >= 0) & (p < keep))
            score, keep = np.where(better, s, score), np.where(better, p, keep)
        return pd.Series(keep.astype("i4"))

    return cut(seq)
