"""Mutation tables of reads: joins with tags, permutation rates, read-through removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.alignment import cigar_blocks, cigar_insertions, complement, has_deletion, substitutions, truncation_site
from ..functions.lineage import counted, stored
from .intervals import depth_at, gap_cluster_chunked
from .pileup import site_pvalues

STRANDED = ["chrom", "strand"]


def of_kept_tags(mutations: DataFrame, tags: DataFrame, name: str = "qname") -> DataFrame:
    """Mutations of reads that deduplication kept."""
    return mutations.join(tags.select(name).distinct(), name, "left_semi")


def without_read_through(tags: DataFrame, deletions: DataFrame, name: str = "qname") -> DataFrame:
    """Tags without a deletion: the polymerase of the others read through the site."""
    return tags.join(deletions.select(name).distinct(), name, "left_anti")


def of_type(mutations: DataFrame, kind: str) -> DataFrame:
    return mutations.where(F.col("mut_type") == kind)


def parse_alignments(reads: DataFrame, min_mapq: int = 1, min_length: int = 16) -> DataFrame:
    """Reads as BED rows, of a least quality and length."""
    return reads.where((F.col("mapq") >= min_mapq) & (F.length("seq") >= min_length)).select(
        "sample", "chrom", F.col("start0").alias("start"), F.col("end0").alias("end"), F.col("qname").alias("name"), F.col("mapq").cast("double").alias("score"), "strand"
    )


def mutation_list(reads: DataFrame, min_mapq: int = 1, min_length: int = 16) -> DataFrame:
    """(sample, qname, chrom, strand, pos, mut_type, ref, alt): what differs in the reads that parse_alignments takes.

    Bases are those of the read's strand: substitutions (``sub``) have both, deletions (``del``) a row a base
    and none, insertions (``ins``) one row with the inserted bases, at the reference base that follows them
    on the forward strand.
    """
    keys = ("sample", "qname", "chrom", "strand")
    kept = reads.where((F.col("mapq") >= min_mapq) & (F.length("seq") >= min_length))
    subs = substitutions(kept, keys).select(*keys, "pos", F.lit("sub").alias("mut_type"), "ref", "alt")
    gone = kept.where(has_deletion(F.col("cigar"))).select(*keys, F.inline(cigar_blocks(F.col("cigar"), F.col("start0")))).where("kind = 'D'")
    dels = gone.select(*keys, F.explode(F.sequence("s", F.col("e") - 1)).alias("pos"), F.lit("del").alias("mut_type"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("string").alias("alt"))
    more = kept.where(F.col("cigar").contains("I")).select(*keys, "seq", F.inline(cigar_insertions(F.col("cigar"), F.col("start0"))))
    bases = F.substring(F.col("seq"), (F.col("q") + 1).cast("int"), F.col("n").cast("int"))
    bases = F.when(F.col("strand") == "-", complement(F.reverse(bases))).otherwise(bases)
    extra = more.select(*keys, "pos", F.lit("ins").alias("mut_type"), F.lit(None).cast("string").alias("ref"), bases.alias("alt"))
    return subs.unionByName(dels).unionByName(extra)


def permuted_mutations(tags: DataFrame, mutations: DataFrame, iterations: int = 5, seed: int = 1, by: list[str] | None = None) -> DataFrame:
    """(chrom, strand, pos, k, m, fdr): mutated tags m of k overlapping ones, against random places.

    Own estimate: each mutation is thrown ``iterations`` times to a place of its tag chosen by a
    digest (repeatable on any partitioning and engine). The rate at (m, k) is the expected number of positions
    with so many mutations or more, over the observed number, at most one. With ``by`` (columns of the mutations),
    each of its values has rates of its own. Tags are counted at the mutations' places only, in one sweep for all.
    """
    by = by or []
    placed = mutations.select("qname", *by).join(tags.select("qname", *STRANDED, "start", "end"), "qname")
    numbered = placed.withColumn("i", F.row_number().over(Window.partitionBy("qname", *by).orderBy("start")))
    thrown = numbered.select("*", F.explode(F.sequence(F.lit(1), F.lit(iterations))).alias("it"))
    digits = F.substring(F.md5(F.concat_ws("|", "qname", "i", "it", F.lit(seed))), 1, 8)
    at = F.col("start") + F.conv(digits, 16, 10).cast("long") % (F.col("end") - F.col("start"))
    # throw zero is where the mutations are
    every = mutations.select(*by, F.lit(0).alias("it"), *STRANDED, F.col("pos").cast("long").alias("pos")).unionByName(thrown.select(*by, "it", *STRANDED, at.cast("long").alias("pos")))
    m = every.dropna(subset=[*STRANDED, "pos"]).groupBy(*by, "it", *STRANDED, "pos").agg(F.count("*").alias("m"))
    counted_at = stored(depth_at(m, tags, STRANDED, name="k").where("k > 0"))
    n = counted_at.groupBy(*by, "k", "m").agg(F.count_if(F.col("it") == 0).alias("n_real"), (F.count_if(F.col("it") > 0) / F.lit(iterations)).alias("n_null"))
    more = Window.partitionBy(*by, "k").orderBy(F.col("m").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rates = n.withColumn("a", F.sum("n_real").over(more)).withColumn("b", F.sum("n_null").over(more)).where("n_real > 0")
    rates = counted(rates.select(*by, "k", "m", F.least(F.col("b") / F.col("a"), F.lit(1.0)).alias("fdr")))
    return counted_at.where("it = 0").join(rates, [*by, "k", "m"]).select(*by, *STRANDED, "pos", "k", "m", "fdr")


def truncation_clusters(tags: DataFrame, deletions: DataFrame, pvalue: float = 0.001, gap: int = 25, min_depth: int = 1) -> DataFrame:
    """Own truncation caller on tags: read-through removed, sites clustered by gap, tested in the cluster.

    A position's truncations are tested against the even share of its cluster by a binomial tail.
    """
    kept = without_read_through(tags, deletions)
    site = truncation_site(F.col("strand"), F.col("start"), F.col("end"))
    n = kept.groupBy(*STRANDED, site.alias("pos")).agg(F.count("*").alias("truncations")).where((F.col("pos") >= 0) & (F.col("truncations") >= min_depth))
    c = gap_cluster_chunked(n, STRANDED, "pos", gap, carry=["truncations"], sums=["truncations"], last="last")
    c = c.withColumn("coverage", F.col("sum_truncations")).withColumn("rate", F.lit(1.0) / (F.col("last") - F.col("cluster") + 1))
    tested = site_pvalues(c, "truncations", "rate", 1, 1, 0.0)
    return tested.where(F.col("pvalue") < pvalue).select("chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), "truncations", "strand", "pvalue")
