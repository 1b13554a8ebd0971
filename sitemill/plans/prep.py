"""Read preprocessing by layout, one projection each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.adapters import cut_near
from ..functions.names import adapter_cut, cut_tail, mean_quality, strip_mate, trim_layout, umi_to_sequence
from ..operators.dedup import collapse_exact


def trim_adapters(reads: DataFrame, adapters: list[str], error_rate: float = 0.0, least: int = 5) -> DataFrame:
    """Sequence and quality up to the adapter: the earliest exact one, or with an error rate the best one."""
    if not adapters:
        return reads
    if error_rate > 0:
        keep = cut_near(F.col("seq"), adapters, error_rate, least)
    else:
        cuts = [adapter_cut(F.col("seq"), a, least) for a in adapters]
        keep = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return reads.withColumn("__k", keep).withColumn("qual", F.expr("left(qual, __k)")).withColumn("seq", F.expr("left(seq, __k)")).drop("__k")


def standard(reads: DataFrame, umi: int = 7, barcode: int = 0, spacer: int = 0, barcode_first: bool = False, min_length: int = 16, min_quality: float = 30.0, adapters: list[str] | None = None) -> DataFrame:
    """UMI to the name, barcode and spacer off, adapters off, then length and mean quality.

    With the barcode first, reads are filtered before trimming too.
    """
    r = reads.withColumn("name", strip_mate(F.col("name")))
    sound = (F.length("seq") >= min_length) & (mean_quality(F.col("qual")) >= min_quality)
    if barcode_first:
        r = r.where(sound)
    name, seq, qual = trim_layout(F.col("name"), F.col("seq"), F.col("qual"), umi, barcode, spacer, barcode_first)
    r = r.select(*[c for c in r.columns if c not in ("name", "seq", "qual")], name.alias("name"), seq.alias("seq"), qual.alias("qual"))
    return trim_adapters(r, adapters or []).where(sound)


def eclip_single(reads: DataFrame, umi: int, adapters: list[str] | None = None, min_length: int = 20) -> DataFrame:
    """UMI from the header to the sequence, exact collapse, UMI to the name, adapters and tails off."""
    h, s, q = umi_to_sequence(F.col("header"), F.col("seq"), F.col("qual"), umi)
    moved = reads.select(h.alias("header"), s.alias("seq"), q.alias("qual"), "ord")
    one = collapse_exact(moved)
    name, seq, qual = trim_layout(F.col("name"), F.col("seq"), F.col("qual"), umi)
    r = trim_adapters(one.select(name.alias("name"), seq.alias("seq"), qual.alias("qual"), "count", "ord"), adapters or [])
    r = r.withColumn("__k", cut_tail(F.col("qual"))).withColumn("seq", F.expr("left(seq, __k)")).withColumn("qual", F.expr("left(qual, __k)")).drop("__k")
    return r.where(F.length("seq") >= min_length)


def eclip_paired(reads: DataFrame, umi: int, adapters: list[str] | None = None, min_length: int = 20) -> DataFrame:
    """Read 2 starts at the crosslink side with the UMI first in its sequence: no header move."""
    one = collapse_exact(reads)
    name, seq, qual = trim_layout(F.col("name"), F.col("seq"), F.col("qual"), umi)
    r = trim_adapters(one.select(name.alias("name"), seq.alias("seq"), qual.alias("qual"), "count", "ord"), adapters or [])
    return r.where(F.length("seq") >= min_length)


def parclip(reads: DataFrame, umi: int = 0, spacer: int = 2, adapters: list[str] | None = None, min_length: int = 16) -> DataFrame:
    """Collapse, UMI to the name, adapters off, then the spacer off the 5' end."""
    one = collapse_exact(reads)
    name = F.concat("name", F.lit("#"), F.substring("seq", 1, umi)) if umi else F.col("name")
    r = one.select(name.alias("name"), F.substring(F.col("seq"), umi + 1, 1 << 30).alias("seq"), F.substring(F.col("qual"), umi + 1, 1 << 30).alias("qual"), "count", "ord")
    r = trim_adapters(r, adapters or [])
    r = r.withColumn("seq", F.substring("seq", spacer + 1, 1 << 30)).withColumn("qual", F.substring("qual", spacer + 1, 1 << 30))
    return r.where(F.length("seq") >= min_length)
