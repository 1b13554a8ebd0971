"""Column functions for read names, sequences, qualities and sample names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_umi(name: Column) -> Column:
    """The last ``#`` token if it is three or more of ACGTN; else null."""
    last = F.element_at(F.split(name, "#"), -1)
    return F.when(name.contains("#") & last.rlike("^[ACGTN]{3,}$"), last)


def name_count(name: Column) -> Column:
    """The copy count packed into ``ID#COUNT`` or ``ID#COUNT#UMI``; one if there is none."""
    n = F.try_element_at(F.split(name, "#"), F.lit(2))
    return F.when(n.rlike("^[0-9]+$"), n.cast("long")).otherwise(F.lit(1).cast("long"))


def name_id(name: Column) -> Column:
    return F.substring_index(name, "#", 1)


def pack_name(header: Column, count: Column) -> Column:
    """First field of a header with its count: ``ID#COUNT``."""
    return F.concat(F.split(header, r"\s+")[0], F.lit("#"), count.cast("string"))


def strip_mate(name: Column) -> Column:
    """Without the ``/1`` or ``/2`` of an archive's read name."""
    return F.regexp_replace(name, r"/[12](?=[\s#]|$)", "")


def sample_name(path: Column) -> Column:
    """File name without FASTQ extensions and the mark of collapsed files."""
    base = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.(fastq\.gz|fq\.gz|fastq|fq)$", "")
    return F.regexp_replace(base, "_collapsed", "")


def umi_to_sequence(header: Column, seq: Column, qual: Column, umi_length: int) -> tuple[Column, Column, Column]:
    """``@UMI:ID rest`` becomes ``@ID rest`` with the UMI before the sequence at quality I.

    A header without a colon in its first field is left as it is, quality too, so that sequence
    and quality keep one length.
    """
    first = F.split(header, " ")[0]
    has = first.contains(":")
    umi = F.regexp_extract(first, r"^@?([^:]*):", 1)
    moved = F.regexp_replace(header, r"^(@?)[^: ]*:", "$1")
    return (
        F.when(has, moved).otherwise(header),
        F.when(has, F.concat(umi, seq)).otherwise(seq),
        F.when(has, F.concat(F.lit("I" * umi_length), qual)).otherwise(qual),
    )


def strip_prefix_to_name(name: Column, seq: Column, qual: Column, length: int) -> tuple[Column, Column, Column]:
    """The first bases go to the name as ``name#UMI``; sequence and quality lose them."""
    rest = lambda c: F.substring(c, length + 1, 1 << 30)
    return F.concat(name, F.lit("#"), F.substring(seq, 1, length)), rest(seq), rest(qual)


def trim_layout(name: Column, seq: Column, qual: Column, umi: int, barcode: int = 0, spacer: int = 0, barcode_first: bool = False) -> tuple[Column, Column, Column]:
    """UMI, barcode and spacer off the 5' end in one projection; the UMI goes to the name.

    The layout is UMI, barcode, spacer, or barcode, UMI, spacer.
    """
    at = barcode + 1 if barcode_first else 1
    total = umi + barcode + spacer
    return F.concat(name, F.lit("#"), F.substring(seq, at, umi)), F.substring(seq, total + 1, 1 << 30), F.substring(qual, total + 1, 1 << 30)


def mean_quality(qual: Column) -> Column:
    """Mean Phred score at offset 33; null for an empty string."""
    n = F.length(qual)
    total = F.aggregate(F.split(qual, ""), F.lit(0).cast("long"), lambda s, c: s + F.when(c == "", 0).otherwise(F.ascii(c) - 33))
    return F.when(n > 0, total / n)


def cut_tail(qual: Column, window: int = 4, mean: float = 5.0) -> Column:
    """Length to keep: bases go from the 3' end while the last ``window`` have a low mean quality."""
    scores = F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)
    sound = lambda i: F.aggregate(F.slice(scores, F.greatest(i - window + 1, F.lit(1)), F.least(i, F.lit(window))), F.lit(0), lambda s, x: s + x) >= mean * F.least(i, F.lit(window))
    ends = F.when(F.length(qual) > 0, F.sequence(F.lit(1), F.length(qual))).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.array_max(F.filter(ends, sound)), F.lit(0))


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two strings; null unless they have one length."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int"))
    return F.when(F.length(a) == F.length(b), F.aggregate(pairs, F.lit(0), lambda s, x: s + x))


def adapter_cut(seq: Column, adapter: str, least: int = 5) -> Column:
    """Length of the sequence before an adapter: its leftmost exact place, or a prefix of it at the end.

    ``N`` in the adapter is any base. Sequences without it keep their length.
    """
    pattern = "".join("." if c == "N" else c for c in adapter)
    whole = F.length(F.regexp_extract(seq, f"^(.*?){pattern}", 1))
    found = F.when(seq.rlike(pattern), whole)
    for n in range(min(len(adapter) - 1, 60), least - 1, -1):
        found = F.coalesce(found, F.when(seq.rlike(f"{pattern[:n]}$"), F.length(seq) - n))
    return F.coalesce(found, F.length(seq))


def repeat_parts(name: Column) -> tuple[Column, Column, Column]:
    """(element, class, family) of a repeat reference: ``A#C/F``, ``A#C``, transfer RNA, else ribosomal."""
    tail = F.substring_index(name, "#", -1)
    has, trna = name.contains("#"), name.contains("tRNA")
    return (
        F.when(has, F.substring_index(name, "#", 1)).otherwise(name),
        F.when(has, F.substring_index(tail, "/", 1)).when(trna, "tRNA").otherwise("rRNA"),
        F.when(has, tail).when(trna, "tRNA").otherwise("rRNA/rDNA"),
    )
