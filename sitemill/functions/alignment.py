"""Column functions for alignments: flags, strands, CIGAR blocks, truncation sites, mismatches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: SAM flag bits.
UNMAPPED, REVERSE, SECONDARY, SUPPLEMENTARY = 4, 16, 256, 2048

_OPS = re.compile(r"(\d+)([MIDNSHP=X])")
_INTRONS = re.compile(r"\d+N")
_MD = re.compile(r"(\d+)|\^([A-Za-z]+)|([A-Za-z])")
_COMPLEMENT = {"A": "T", "C": "G", "G": "C", "T": "A"}


def strand_of(flag: Column) -> Column:
    return F.when(flag.bitwiseAND(REVERSE) != 0, "-").otherwise("+")


def has_deletion(cigar: Column) -> Column:
    """Whether any operation is D, of whatever length."""
    return cigar.contains("D")


def has_junction(cigar: Column) -> Column:
    return cigar.contains("N")


def cigar_blocks(cigar: Column, start0: Column) -> Column:
    """array<struct<kind, s, e>>: aligned (M) and deleted (D) reference blocks of a read.

    M, = and X align, D deletes, N only advances; I, S, H and P touch no reference base.
    """
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), 1)

    def step(acc: Column, op: Column) -> Column:
        n, kind = F.expr("0L") + op.substr(F.lit(1), F.length(op) - 1).cast("long"), F.right(op, F.lit(1))
        moves, after = kind.isin("M", "=", "X", "D", "N"), acc["at"] + n
        block = F.struct(F.when(kind == "D", "D").otherwise("M").alias("kind"), acc["at"].alias("s"), after.alias("e"))
        kept = F.when(kind.isin("M", "=", "X", "D"), F.concat(acc["out"], F.array(block))).otherwise(acc["out"])
        return F.struct(F.when(moves, after).otherwise(acc["at"]).alias("at"), kept.alias("out"))

    empty = F.array().cast("array<struct<kind:string,s:bigint,e:bigint>>")
    return F.aggregate(ops, F.struct(start0.cast("long").alias("at"), empty.alias("out")), step, lambda acc: acc["out"])


def cigar_insertions(cigar: Column, start0: Column) -> Column:
    """array<struct<pos, q, n>>: inserted bases of a read: the reference base behind them, their place in the read, their number."""
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), 1)

    def step(acc: Column, op: Column) -> Column:
        n, kind = op.substr(F.lit(1), F.length(op) - 1).cast("long"), F.right(op, F.lit(1))
        found = F.array(F.struct(acc["at"].alias("pos"), acc["q"].alias("q"), n.alias("n")))
        return F.struct(
            F.when(kind.isin("M", "=", "X", "D", "N"), acc["at"] + n).otherwise(acc["at"]).alias("at"),
            F.when(kind.isin("M", "=", "X", "I", "S"), acc["q"] + n).otherwise(acc["q"]).alias("q"),
            F.when(kind == "I", F.concat(acc["out"], found)).otherwise(acc["out"]).alias("out"),
        )

    empty = F.array().cast("array<struct<pos:bigint,q:bigint,n:bigint>>")
    zero = F.lit(0).cast("long")
    return F.aggregate(ops, F.struct(start0.cast("long").alias("at"), zero.alias("q"), empty.alias("out")), step, lambda acc: acc["out"])


def reference_length(cigar: Column) -> Column:
    """Reference bases that a CIGAR spans."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), 1), F.lit(0).cast("long"), lambda n, x: n + x.cast("long"))


def truncation_site(strand: Column, start0: Column, end0: Column) -> Column:
    """The base just upstream of a read: one before its start, or its exclusive end on the reverse strand."""
    return F.when(strand == "-", end0).otherwise(start0 - 1)


def crosslink_base(strand: Column, start: Column, end: Column) -> Column:
    """The first base of a read itself, another convention than the truncation site."""
    return F.when(strand == "-", end - 1).otherwise(start)


def may_mismatch(md: Column) -> Column:
    """A cheap screen: an MD tag with a base that does not follow ``^``. Over-inclusive, so harmless."""
    return md.rlike(r"(?<!\^)[ACGT]")


def complement(base: Column) -> Column:
    return F.translate(base, "ACGT", "TGCA")


def mismatches(md: str, cigar: str, seq: str, start0: int) -> Iterator[tuple[int, str, str]]:
    """(position, reference base, read base) of the substitutions in one read."""
    at_query: dict[int, int] = {}  # aligned bases in order: reference position -> query position
    ref, query = start0, 0
    order: list[int] = []
    for n, op in _OPS.findall(cigar):
        n = int(n)
        if op in "M=X":
            for i in range(n):
                at_query[ref + i] = query + i
            order.extend(range(ref, ref + n))
            ref, query = ref + n, query + n
        elif op in "DN":
            ref += n
        elif op in "IS":
            query += n
    k = 0
    for run, deleted, base in _MD.findall(md):
        if run:
            k += int(run)
        elif base:
            if k >= len(order):
                return
            p, r = order[k], base.upper()
            q = seq[at_query[p]].upper() if at_query[p] < len(seq) else "N"
            if r in _COMPLEMENT and q in _COMPLEMENT and r != q:
                yield p, r, q
            k += 1


def substitutions(reads: DataFrame, keys: tuple[str, ...] = ("sample", "chrom", "strand")) -> DataFrame:
    """(keys, pos, ref, alt) for each substituted base; both bases are complemented on the reverse strand.

    Reads need cigar, md, seq, start0 and strand. The MD screen runs first, in the JVM, so only the
    few reads with a mismatch reach the walk, which is Arrow-batched.
    """
    at = list(keys).index("strand")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[] for _ in range(len(keys) + 3)]
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                *own, cigar, md, seq, start0 = row
                for p, r, q in mismatches(md, cigar, seq, start0):
                    if own[at] == "-":
                        r, q = _COMPLEMENT[r], _COMPLEMENT[q]
                    for col, v in zip(rows, (*own, p, r, q), strict=True):
                        col.append(v)
            kinds = [*(f.type for f in list(b.schema)[: len(keys)]), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names=[*keys, "pos", "ref", "alt"])

    some = reads.where(may_mismatch(F.col("md")) & F.col("seq").isNotNull()).select(*keys, "cigar", "md", "seq", F.col("start0").cast("long"))
    kinds = ", ".join(f"{k} {reads.schema[k].dataType.simpleString()}" for k in keys)
    return some.mapInArrow(walk, f"{kinds}, pos long, ref string, alt string")


def md_tag(cigar: str, seq: str, reference: str) -> tuple[str, int]:
    """(MD, NM) of a read, from the reference bases that its CIGAR spans."""
    out, run, edits, r, q = "", 0, 0, 0, 0
    for n, op in _OPS.findall(cigar):
        n = int(n)
        if op in "M=X":
            for a, b in zip(reference[r : r + n].upper(), seq[q : q + n].upper(), strict=False):
                if a == b:
                    run += 1
                else:
                    out, run, edits = f"{out}{run}{a}", 0, edits + 1
            r, q = r + n, q + n
        elif op == "D":
            out, run, edits = f"{out}{run}^{reference[r : r + n].upper()}", 0, edits + n
            r += n
        elif op == "N":
            r += n
        elif op in "IS":
            q, edits = q + n, edits + (n if op == "I" else 0)
    return f"{out}{run}", edits


def with_md(reads: DataFrame, reference: DataFrame, slice_size: int = 100_000) -> DataFrame:
    """Adds md and nm to reads, from a reference in slices (name, slice, bases) or of whole sequences (name, seq).

    Whole sequences are cut to slices of ``slice_size`` first. A read joins the slices that its aligned and
    deleted blocks touch, so introns fetch nothing, no task holds a chromosome, and nothing is broadcast.
    Tags depend on chrom, start0, cigar and seq alone: equal ones are tagged once, and rows need no number.
    Reads beyond the reference, or without an alignment, get nulls.
    """
    if "slice" in reference.columns:
        slices = reference.select(F.col("name").alias("chrom"), "slice", "bases")
    else:
        # cut in one pass: a slice taken from the whole sequence would read it from its start
        cuts = F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{slice_size}}}"), F.lit(0))
        slices = reference.where(F.length("seq") > 0).select(F.col("name").alias("chrom"), F.posexplode(cuts).alias("slice", "bases")).withColumn("slice", F.col("slice").cast("long"))
    keys = ["chrom", "start0", "cigar", "seq"]
    alike = reads.where(F.col("cigar").isNotNull() & (F.col("cigar") != "*") & F.col("chrom").isNotNull() & (F.col("start0") >= 0)).select(*keys).distinct()
    wide = alike.select(*keys, F.posexplode(cigar_blocks(F.col("cigar"), F.col("start0"))).alias("block", "b")).select(*keys, "block", "b.s", "b.e")
    wide = wide.select("*", F.explode(F.sequence(F.floor(F.col("s") / slice_size), F.floor((F.col("e") - 1) / slice_size))).alias("slice"))
    low, high = F.greatest(F.col("s"), F.col("slice") * slice_size), F.least(F.col("e"), (F.col("slice") + 1) * slice_size)
    part = wide.join(slices, ["chrom", "slice"]).select(*keys, "block", "slice", F.substring("bases", (low - F.col("slice") * slice_size + 1).cast("int"), (high - low).cast("int")).alias("part"))
    parts = part.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("block", "slice", "part"))).alias("parts"))
    ref = parts.select(*keys, F.array_join(F.transform("parts", lambda x: x["part"]), "").alias("ref"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)
            tags = [md_tag(_INTRONS.sub("", c), q or "", r) for c, q, r in rows]  # the blocks' bases, one after another
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([t[0] for t in tags], pa.string()), pa.array([t[1] for t in tags], pa.int32())], names=[*keys, "md", "nm"])

    kinds = ", ".join(f"{k} {reads.schema[k].dataType.simpleString()}" for k in keys)
    tags = ref.mapInArrow(run, f"{kinds}, md string, nm int")
    right = tags.select(*[F.col(k).alias(f"__{k}") for k in keys], "md", "nm")
    old = reads.drop("md", "nm")
    on = [old[k].eqNullSafe(F.col(f"__{k}")) for k in keys]
    return old.join(right, on, "left").drop(*[f"__{k}" for k in keys])
