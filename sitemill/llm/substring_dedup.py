"""Repeated passages across documents by hashing lines and the sentences in them (operator 6)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import boxed, cut, named

#: A unit ends after a line break, or after a sentence mark and the space behind it.
BOUNDARY = re.compile(r"\n+|[.!?…][\"'»”)\]]*[ \t]+")
#: Shorter units repeat by chance: they go only with a longer one beside them.
MIN_UNIT_WORDS = 4
#: Repeated units in a row are removed if they have so many words together.
MIN_RUN_WORDS = 8
#: Fewer than so many of the commonest repeated digests are broadcast, 3 MB at most.
TOP_DIGESTS = 50_000


def units(text: str) -> list[tuple[int, int]]:
    """(start, end) of the units; they cover the whole text without gaps."""
    out, at = [], 0
    for m in BOUNDARY.finditer(text):
        out.append((at, m.end()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def passages(text: str, min_words: int = MIN_UNIT_WORDS) -> list[tuple[int, int, list[str]]]:
    """(start, end, lower-case words): units, where short ones of a line are joined to those behind them.

    At the end of a line a short one joins the unit before it. What is joined depends on the line
    since its last long unit only, so a repeated passage gives the same units wherever it stands.
    """
    out: list[tuple[int, int, list[str]]] = []
    start, words, fresh = 0, [], True  # fresh: no unit of this line yet
    for a, b in units(text):
        words += text[a:b].lower().split()
        last = text[b - 1] == "\n" or b == len(text)
        if len(words) < min_words and last and not fresh:
            x, _, w = out.pop()
            out.append((x, b, w + words))
            start, words = b, []
        elif len(words) >= min_words or last:
            out.append((start, b, words))
            start, words = b, []
        fresh = last or fresh and start != b
    return out


def _digests(text: str, min_words: int) -> Iterator[tuple[int, bytes]]:
    for i, (_, _, w) in enumerate(passages(text, min_words)):
        if w:
            yield i, xxhash.xxh3_128_digest(" ".join(w).encode("utf-8", "surrogatepass"))


def removed_spans(text: str, repeated: set[int], min_run_words: int = MIN_RUN_WORDS, min_words: int = MIN_UNIT_WORDS) -> list[tuple[int, int]]:
    """Spans to remove: runs of repeated units that have enough words and not only short ones."""
    spans: list[tuple[int, int]] = []
    start = end = None
    words = longest = 0
    for i, (a, b, w) in enumerate([*passages(text, min_words), (len(text), len(text), [])]):
        if i in repeated:
            if start is None:
                start, words, longest = a, 0, 0
            end, words, longest = b, words + len(w), max(longest, len(w))
        elif start is not None:
            if words >= min_run_words and longest >= min_words:
                spans.append((start, end))
            start = None
    return spans


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_UNIT_WORDS,
    min_run_words: int = MIN_RUN_WORDS,
    removed_col: str = "removed",
) -> DataFrame:
    """``docs`` with repeated passages removed from ``text_col``; adds ``removed_col`` array<struct<start,end>>.

    Units (lines, and sentences within lines, so that a passage pasted into a line is found too)
    are normalised by case and white space and grouped by a 128-bit digest over the whole table.
    The occurrence that ranks first by (id, hash of the text, copy, place) stays; the others go.
    ``copy`` numbers rows of one id and text, so of equal rows only one keeps a passage. ``removed``
    holds code point offsets into the original text, which reading the original at the kept offsets
    reproduces; a column of that name is replaced. Null text stays null; empty text stays empty; null
    ids rank last. Other columns pass through.

    Digests that occur twice are joined back to the units. Those with more than one part in
    TOP_DIGESTS of all repeats, so fewer than that many, are broadcast and their units dealt by row:
    a unit that a third of all rows share makes no large task.
    """
    names = [c for c in docs.columns if c != removed_col]
    docs = docs.select(*[named(c) for c in names])
    text = named(text_col).cast("string")
    base = docs.select(boxed(docs), F.coalesce(named(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("__id"), F.xxhash64(text).alias("__rid"), (F.length(text) > 0).alias("filled"))
    some = docs.select(F.coalesce(named(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("__id"), F.xxhash64(text).alias("__rid"), text.alias("text")).where(F.length("text") > 0)
    # rows of one id and text, if any, are told apart by their number among equals
    again = cut(some.groupBy("__id", "__rid").agg(F.count("*").alias("__n")).where("__n > 1"))
    rows = some

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], []]
            for d, r, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for i, h in _digests(t, min_words):
                    for col, v in zip(cols, (h, d, r, i), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32())],
                names=["digest", "__id", "__rid", "unit"],
            )

    found = rows.mapInArrow(explode, "digest binary, __id long, __rid long, unit int")
    place = F.struct("__id", "__rid", "unit")
    first = found.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    first = cut(first)
    total = first.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = first.where(F.col("n") > total / TOP_DIGESTS).select("digest", F.col("first").alias("__top"))  # fewer than TOP_DIGESTS
    # units of the commonest digests need no partner and are dealt by row, the others by digest
    own = F.encode(F.concat_ws(":", F.hex("digest"), F.col("__id").cast("string"), F.col("unit").cast("string")), "utf-8")
    dealt = found.join(F.broadcast(top), "digest", "left").withColumn("__at", F.when(F.col("__top").isNull(), F.col("digest")).otherwise(own))
    dealt = dealt.join(first.select(F.col("digest").alias("__at"), "first"), "__at", "left").withColumn("first", F.coalesce("__top", "first"))
    repeated = dealt.where(F.col("first").isNotNull()).select("__id", "__rid", "unit", (place != F.col("first")).alias("later"))
    marks = repeated.groupBy("__id", "__rid").agg(F.collect_set(F.when(F.col("later"), F.col("unit"))).alias("__units"))
    # of equal rows all but one lose every unit that repeats, and equal rows repeat all their units
    joined = base.join(marks, ["__id", "__rid"], "left")
    if again.head(1):
        copy = F.row_number().over(Window.partitionBy("__id", "__rid").orderBy(F.xxhash64("row")))
        joined = joined.withColumn("__copy", F.when(F.col("filled"), copy).otherwise(1))
    else:
        joined = joined.withColumn("__copy", F.lit(1))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, gone = [], []
            cols = b.column("row").flatten()
            for t, u, copy in zip(cols[at].to_pylist(), b.column("__units").to_pylist(), b.column("__copy").to_pylist(), strict=True):
                if copy > 1:
                    u = range(len(passages(t, min_words)))
                spans = removed_spans(t, set(u), min_run_words, min_words) if u else []
                for x, y in reversed(spans):
                    t = t[:x] + t[y:]
                texts.append(t)
                gone.append([{"start": x, "end": y} for x, y in spans])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(gone, kind)], names=[*names, removed_col])

    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    at = names.index(text_col)
    schema = docs.select(*[named(c) for c in names], F.lit(None).cast("array<struct<start:int,end:int>>").alias(removed_col)).schema
    return joined.select("row", "__units", "__copy").mapInArrow(cut_out, schema)
