"""Row filters on alignments and chromosomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alignment import SECONDARY, SUPPLEMENTARY, UNMAPPED


def valid_read(flag: Column, cigar: Column) -> Column:
    """Mapped, primary, not supplementary, with a CIGAR."""
    return (flag.bitwiseAND(UNMAPPED | SECONDARY | SUPPLEMENTARY) == 0) & cigar.isNotNull() & (cigar != "*")


def pileup_reads(reads: DataFrame, min_mapq: int = 255, max_nh: int = 1) -> DataFrame:
    """Reads that a pileup takes. NH is looked at only below mapping quality 255; a missing NH passes."""
    out = reads.where(valid_read(F.col("flag"), F.col("cigar")) & (F.col("mapq") >= min_mapq))
    return out if min_mapq >= 255 else out.where(F.coalesce(F.col("nh") <= max_nh, F.lit(True)))


def unique_reads(reads: DataFrame, max_nh: int = 1) -> DataFrame:
    """Mapped reads with few hits; a missing NH counts as unique."""
    return reads.where((F.col("flag").bitwiseAND(UNMAPPED) == 0) & F.coalesce(F.col("nh") <= max_nh, F.lit(True)))


def multimapped_reads(reads: DataFrame) -> DataFrame:
    return reads.where(F.col("nh") > 1)


def is_human_standard(chrom: Column) -> Column:
    """1 to 22, leading zeros allowed, X, Y and MT, with or without chr; M only with it."""
    return chrom.rlike("^(chr)?(0*([1-9]|1[0-9]|2[0-2])|X|Y|MT)$|^chrM$")


def is_numbered_or_named(chrom: Column) -> Column:
    """Human chromosomes of the site callers on tags: chr1 to chr22, chrX, chrY, chrM, with or without chr."""
    return chrom.rlike("^(chr)?([1-9]|1[0-9]|2[0-2]|X|Y|M)$")


def canonical_chromosomes(reads: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Numbered, X, Y and mitochondrial chromosomes of any organism, in the naming style at hand.

    The style is chr* if any name is. If nothing matches, everything passes, as unfiltered. The two
    facts come from one aggregate of a single row.
    """
    plain, named = F.col(chrom).rlike("^([0-9]+|X|Y|MT)$"), F.col(chrom).rlike("^chr([0-9]+|X|Y|M)$")
    facts = reads.agg(
        F.coalesce(F.bool_or(F.col(chrom).startswith("chr")), F.lit(False)).alias("__style"),
        F.coalesce(F.bool_or(named), F.lit(False)).alias("__any_named"),
        F.coalesce(F.bool_or(plain), F.lit(False)).alias("__any_plain"),
    )
    both = reads.crossJoin(F.broadcast(facts))
    keep = F.when(F.col("__style"), named | ~F.col("__any_named")).otherwise(plain | ~F.col("__any_plain"))
    return both.where(keep).drop("__style", "__any_named", "__any_plain")


def testable(coverage: Column, signal: Column, min_coverage: int = 5, min_signal: int = 1, min_fraction: float = 0.05) -> Column:
    return (coverage >= min_coverage) & (signal >= max(1, min_signal)) & (signal / coverage >= min_fraction)


def significant(q: Column, fdr: float = 0.05) -> Column:
    """Inclusive threshold."""
    return q <= fdr


def cims_postfilter(df: DataFrame, fdr: float = 1.0) -> DataFrame:
    """Strict threshold, off at 1; by FDR, then most mutated, then fewest tags."""
    out = df.where(F.col("fdr") < fdr) if fdr < 1 else df
    return out.orderBy("fdr", F.col("m").desc(), "k")


def singletons(df: DataFrame) -> DataFrame:
    """Sites of one base."""
    return df.where(F.col("end") - F.col("start") == 1)


def long_enough(reads: DataFrame, min_length: int = 16, min_quality: float | None = 30.0) -> DataFrame:
    from ..functions.names import mean_quality

    out = reads.where(F.length("seq") >= min_length)
    return out if min_quality is None else out.where(mean_quality(F.col("qual")) >= min_quality)
