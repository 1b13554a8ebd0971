"""Strand-aware pileups, backgrounds and site tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.alignment import cigar_blocks, has_deletion, reference_length, substitutions, truncation_site
from ..functions.lineage import settled
from ..functions.stats import bh_adjust, binom_sf, binom_sf_deep, weighted_quantile
from .filters import testable
from .intervals import CHUNK, gap_cluster_chunked, interval_bins

KEYS = ["sample", "chrom", "strand"]
#: Substitution counts saturate here.
SUB_CAP = 65_535


def read_events(reads: DataFrame, chrom_sizes: DataFrame | None = None) -> DataFrame:
    """(sample, chrom, strand, kind, s, e): aligned M and deleted D blocks, and one site T a read.

    The site's kind is C for a read without a deletion. A site before the chromosome's start, or
    past its end where ``chrom_sizes`` says it, belongs to no position and is left out.
    """
    end0 = F.col("start0") + reference_length(F.col("cigar"))
    t = truncation_site(F.col("strand"), F.col("start0"), end0)
    site = F.struct(F.when(has_deletion(F.col("cigar")), "T").otherwise("C").alias("kind"), t.cast("long").alias("s"), (t + 1).cast("long").alias("e"))
    ok = t >= 0
    if chrom_sizes is not None:
        reads = reads.join(chrom_sizes.select("chrom", F.col("length").alias("__len")), "chrom", "left")
        ok = ok & F.coalesce(t < F.col("__len"), F.lit(True))
    none = F.array().cast("array<struct<kind:string,s:bigint,e:bigint>>")
    every = F.concat(cigar_blocks(F.col("cigar"), F.col("start0")), F.when(ok, F.array(site)).otherwise(none))
    return reads.select(*KEYS, F.inline(every))


def pileup(reads: DataFrame, chrom_sizes: DataFrame | None = None, chunks: bool = False) -> DataFrame:
    """Counts by (sample, chrom, strand, pos): coverage, truncations, clean_truncations, deletions.

    Coverage counts aligned bases plus one at each truncation base. Blocks are cut at chunk ends and
    swept there: what begins, ends and truncates is summed by position, running sums are the counts, and a
    step becomes its positions last. So a base is shuffled by no read, deep places cost one row,
    and no chromosome is held by one task. Positions without any signal have no row. With ``chunks`` rows keep
    __chunk, by which they lie together.
    """
    kind, s, e, hi = F.col("kind"), F.col("s"), F.col("e"), (F.col("__chunk") + 1) * CHUNK
    cut = read_events(reads, chrom_sizes).where(s < e).select(*KEYS, "kind", "s", "e", F.explode(interval_bins(s, e, CHUNK)).alias("__chunk"))

    def event(pos: Column, **counts: Column) -> Column:
        zero = F.lit(0)
        return F.struct(pos.alias("pos"), *[counts.get(n, zero).cast("int").alias(n) for n in ("m", "d", "t", "c")])

    m, d, c = (F.when(kind == k, 1).otherwise(0) for k in "MDC")
    block = F.array(event(F.greatest(s, F.col("__chunk") * CHUNK), m=m, d=d), event(F.least(e, hi), m=-m, d=-d))
    every = F.when(kind.isin("T", "C"), F.array(event(s, t=F.lit(1), c=c))).otherwise(block)
    events = cut.select(*KEYS, "__chunk", F.inline(every)).groupBy(*KEYS, "__chunk", "pos").agg(*[F.sum(n).alias(n) for n in ("m", "d", "t", "c")])
    w = Window.partitionBy(*KEYS, "__chunk").orderBy("pos")
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    swept = events.select(*KEYS, "__chunk", "pos", F.sum("m").over(running).alias("m"), F.sum("d").over(running).alias("d"), "t", "c", F.lead("pos").over(w).alias("next"))
    goes_on = (F.col("m") > 0) | (F.col("d") > 0)
    steps = swept.where(goes_on | (F.col("t") > 0)).withColumn("last", F.when(goes_on, F.col("next") - 1).otherwise(F.col("pos")))
    each = steps.select(*KEYS, "__chunk", F.posexplode(F.sequence("pos", "last")).alias("i", "pos"), "m", "d", "t", "c")
    at = lambda n: F.when(F.col("i") == 0, F.col(n)).otherwise(0).cast("long")
    return each.select(*KEYS, *(["__chunk"] if chunks else []), "pos", (F.col("m") + at("t")).alias("coverage"), at("t").alias("truncations"), at("c").alias("clean_truncations"), F.col("d").alias("deletions"))


def substitution_counts(reads: DataFrame) -> DataFrame:
    """(sample, chrom, strand, pos, sub_type, n) with sub_type like TC; reads without a site count nothing."""
    end0 = F.col("start0") + reference_length(F.col("cigar"))
    subs = substitutions(reads.where(truncation_site(F.col("strand"), F.col("start0"), end0) >= 0))
    n = F.least(F.count("*"), F.lit(SUB_CAP)).cast("long").alias("n")
    return subs.groupBy(*KEYS, "pos", F.concat("ref", "alt").alias("sub_type")).agg(n)


def with_substitutions(piles: DataFrame, subs: DataFrame) -> DataFrame:
    """Substitutions at pileup positions with their coverage; others are dropped."""
    return subs.join(piles, [*KEYS, "pos"])


def background(df: DataFrame, signal: str, by: list[str] | None = None, min_coverage: int = 5, exclude_top: float = 0.01) -> DataFrame:
    """Background rate ``lambda`` by ``by`` (one row without it): signal over coverage.

    Positions of the top fractions are left out: those above the exact quantile, interpolated
    linearly. Where the quantile is not above zero, or nothing is left, all positions count. The pileup
    is read once, to a histogram of (signal, coverage), on which quantile and sums are exact.
    """
    by = by or []
    h = df.where(F.col("coverage") >= min_coverage).groupBy(*by, F.col(signal).alias("s"), F.col("coverage").alias("c")).agg(F.count("*").alias("n"))
    h = settled(h.withColumn("f", F.col("s") / F.col("c")))
    top = weighted_quantile(h, "f", "n", by, 1 - exclude_top).withColumnRenamed("quantile", "t")
    low = F.col("f") <= F.col("t")
    s, c = F.col("s") * F.col("n"), F.col("c") * F.col("n")
    sums = (h.join(top, by) if by else h.crossJoin(top)).groupBy(*by).agg(
        F.max("t").alias("t"), F.sum(s).alias("s_all"), F.sum(c).alias("c_all"), F.sum(F.when(low, s)).alias("s_low"), F.sum(F.when(low, c)).alias("c_low")
    )
    kept = (F.col("t") > 0) & (F.coalesce("c_low", F.lit(0)) > 0)
    rate = F.when(kept, F.col("s_low") / F.col("c_low")).otherwise(F.col("s_all") / F.col("c_all"))
    return sums.select(*by, F.coalesce(rate, F.lit(0.0)).alias("lambda"))


def cluster_rates(piles: DataFrame, max_gap: int = 25) -> DataFrame:
    """Adds cluster (its first position) and local_rate: clean truncations over coverage in runs of near positions.

    Runs are found and summed in pieces of a chromosome, so no task sorts a whole one or holds a whole run.
    """
    c = gap_cluster_chunked(piles, KEYS, "pos", max_gap, carry=["coverage", "clean_truncations"], sums=["coverage", "clean_truncations"])
    rate = F.when(F.col("sum_coverage") > 0, F.col("sum_clean_truncations") / F.col("sum_coverage")).otherwise(0.0)
    return c.withColumn("local_rate", rate).drop("sum_coverage", "sum_clean_truncations")


def site_pvalues(df: DataFrame, signal: str, rate: str, min_coverage: int = 5, min_signal: int = 1, min_fraction: float = 0.05, deep: bool = False) -> DataFrame:
    """The testable positions with signal, fraction and pvalue; a rate of zero gives p = 1.

    ``deep`` takes a tail whose time does not grow with the coverage.
    """
    tail = binom_sf_deep if deep else binom_sf
    out = df.where(testable(F.col("coverage"), F.col(signal), min_coverage, min_signal, min_fraction))
    out = out.withColumn("signal", F.col(signal)).withColumn("fraction", F.col(signal) / F.col("coverage"))
    p = F.when(F.col(rate) > 0, tail(F.col(signal).cast("long"), F.col("coverage").cast("long"), F.col(rate).cast("double"))).otherwise(1.0)
    return out.withColumn("pvalue", p)


def test_sites(
    df: DataFrame, signal: str, rate: str, family: list[str] | None = None, min_coverage: int = 5, min_signal: int = 1, min_fraction: float = 0.05, deep: bool = False
) -> DataFrame:
    """Adds fraction, pvalue and qvalue to the testable positions.

    The filter comes before the adjustment, whose family is by default one (sample, chrom, strand).
    Positions whose rate is zero get p = 1 and stay in the family. The testable positions, a small
    part of a pileup, are read twice and so written first.
    """
    return bh_adjust(settled(site_pvalues(df, signal, rate, min_coverage, min_signal, min_fraction, deep)), family or KEYS)


def bed_sites(sites: DataFrame, label: str | None) -> DataFrame:
    """The site columns of a BED-like table, in its order: q ascending, then fraction descending.

    Names are ``label:chrom:pos:strand``. Without a label, for substitutions, it is the type as in
    ``TtoC``, and sub_type stays as a column.
    """
    from ..functions.stats import site_score

    kind = [] if label else ["sub_type"]
    first = F.lit(label) if label else F.concat(F.substring("sub_type", 1, 1), F.lit("to"), F.substring("sub_type", 2, 1))
    out = sites.select(
        *kind,
        "sample",
        "chrom",
        F.col("pos").alias("start"),
        (F.col("pos") + 1).alias("end"),
        F.concat_ws(":", first, "chrom", F.col("pos").cast("string"), "strand").alias("name"),
        site_score(F.col("qvalue")).alias("score"),
        "strand",
        "signal",
        "coverage",
        "fraction",
        "pvalue",
        "qvalue",
    )
    return out.orderBy("sample", *kind, "chrom", F.when(F.col("strand") == "+", 0).otherwise(1), "qvalue", F.col("fraction").desc(), "start")
