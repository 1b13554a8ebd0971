"""A whole run of aligned samples: every table of an analysis in numbered folders, and a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import settled
from ..operators import filters, matrix, mutations, tracks
from ..operators import pileup as P
from ..operators.demux import assign_groups
from ..sources import writers as W
from . import sites
from .config import Settings, layout
from .tags import tag_sites


def chromosome_log(reads: DataFrame, piles: DataFrame, min_mapq: int = 255, max_nh: int = 1) -> DataFrame:
    """(sample, chrom, n_reads, n_pos, truncations, deletions, n_skipped): reads that the pileup took, and those that it passed over."""
    every = reads.where(F.col("chrom").isNotNull() & (F.col("chrom") != "*")).groupBy("sample", "chrom").agg(F.count("*").alias("all"))
    kept = filters.pileup_reads(reads, min_mapq, max_nh).groupBy("sample", "chrom").agg(F.count("*").alias("n_reads"))
    sums = piles.groupBy("sample", "chrom").agg(F.count("*").alias("n_pos"), F.sum("truncations").alias("truncations"), F.sum("deletions").alias("deletions"))
    out = every.join(kept, ["sample", "chrom"], "left").join(sums, ["sample", "chrom"], "left").na.fill(0, ["n_reads", "n_pos", "truncations", "deletions"])
    return out.select("sample", "chrom", "n_reads", "n_pos", "truncations", "deletions", (F.col("all") - F.col("n_reads")).alias("n_skipped"))


def sample_log(reads: DataFrame, kept: DataFrame, out: dict[str, DataFrame]) -> DataFrame:
    """(sample, alignments, kept, and the sites of each kind): the counts that a run reports."""
    log = reads.groupBy("sample").agg(F.count("*").alias("alignments")).join(kept.groupBy("sample").agg(F.count("*").alias("kept")), "sample", "left")
    for kind in [k for k in ("truncations", "deletions", "substitutions", "crosslinks") if k in out]:
        log = log.join(out[kind].groupBy("sample").agg(F.count("*").alias(kind)), "sample", "left")
    return log.na.fill(0)


def report(log: DataFrame) -> str:
    """A table of text with a row for each sample."""
    rows = [log.columns, *[[str(v) for v in r] for r in log.orderBy("sample").collect()]]  # as many as there are samples
    wide = [max(len(r[i]) for r in rows) for i in range(len(rows[0]))]
    return "\n".join("  ".join(c.ljust(w) if i == 0 else c.rjust(w) for i, (c, w) in enumerate(zip(r, wide))) for r in rows)


def deduplicated(reads: DataFrame, s: Settings) -> DataFrame:
    """The rows of ``reads`` that deduplication keeps, with all their columns; rescued ones become unique."""
    one = sites.dedup_reads(reads, s.umi_length, s.max_nh, s.multi_map, s.rescue_window)
    keys = ["sample", "qname", "chrom", "strand", "start0", "cigar"]
    kept = reads.join(one.select(*keys).distinct(), keys, "left_semi")
    if s.multi_map:
        clear = ~(filters.SECONDARY | filters.SUPPLEMENTARY)
        kept = kept.withColumn("nh", F.lit(1)).withColumn("flag", F.col("flag").bitwiseAND(clear)).withColumn("mapq", F.greatest("mapq", F.lit(s.min_mapq)))
    return kept


def run_samples(spark: SparkSession, reads: DataFrame, root: str, settings: Settings | None = None, groups: DataFrame | None = None) -> DataFrame:
    """Deduplicates, analyses and writes a batch of samples below ``root``; the counts of each sample.

    Folders are numbered in the order of the work: alignments (BAM with index), tags (BED), tracks (scaled
    bedGraph and the scale table), pileups, sites, tag_sites, peaks (of each sample and of all), matrix, reports. Reads carry the columns of
    ``read_bam`` and umi. With ``groups`` sites are called for the pooled samples of a group.
    """
    s, at = settings or Settings(), layout(root)
    if s.filter_chromosomes:
        reads = filters.canonical_chromosomes(reads)
    reads = settled(reads)
    kept = settled(deduplicated(reads, s))
    sizes = kept.where(F.col("chrom") != "*").groupBy("chrom").agg(F.max("end0").alias("length"))
    W.write_bam(kept.select("sample", "qname", "flag", "chrom", "start0", "mapq", "cigar", "seq", "nh", "md"), sizes, at["alignments"])
    tags = kept.withColumnRenamed("start0", "start").withColumnRenamed("end0", "end")
    beds = tags.select("sample", F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "qname", F.lit("1"), "strand").alias("value"))
    W.write_by_sample(beds, at["tags"])
    scales = tracks.scale_factors(kept)
    track = tracks.rpm_track(kept, scales)
    line = F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), F.col("value").cast("string")).alias("value")
    W.write_by_sample(track.withColumn("strand", F.when(F.col("strand") == "-", "rev").otherwise("fwd")).select("sample", "strand", line), f"{at['tracks']}/bedgraph", "strand")
    W.write_tsv(scales.select("sample", "mapped", "scale").orderBy("sample"), f"{at['tracks']}/scale_factors")
    limits = {"min_coverage": s.min_coverage, "min_fraction": s.min_fraction, "min_signal": s.min_signal, "fdr": s.fdr, "cluster_gap": s.cluster_gap}
    kinds = sites.parse_sub_types(s.sub_types.split(",")) if s.sub_types else None
    out = sites.analyse(kept, groups, s.min_mapq, s.max_nh, kinds, s.no_subs, **limits)
    W.write_pileup(out["pileup"], at["pileups"])
    for name, table in out.items():
        if name == "crosslinks":
            W.write_text(W.bed_text(table), f"{at['sites']}/{name}")
        elif name != "pileup":
            W.write_sites(table, f"{at['sites']}/{name}")
    changes = mutations.mutation_list(kept).drop("start", "end")
    for r in tags.select("sample").distinct().orderBy("sample").collect():  # as many as there are samples
        own = F.col("sample") == r["sample"]
        for kind, table in tag_sites(tags.where(own), changes.where(own), s).items():
            write = W.write_flanked if kind.endswith("_flanked") else W.write_truncation_table if kind == "trunc" else W.write_mutation_table
            write(table, f"{at['tag_sites']}/{r['sample']}/{kind}")
    single = matrix.call_peaks(tags, s.peak_size, s.peak_distance, by=["sample"])
    W.write_by_sample(single.select("sample", F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "name", F.col("score").cast("string"), "strand").alias("value")), f"{at['peaks']}/samples")
    every = settled(matrix.call_peaks(tags, s.peak_size, s.peak_distance))
    W.write_text(W.bed_text(every.orderBy("chrom", "start", "strand")), f"{at['peaks']}/all")
    peaks = every.drop("pvalue").withColumn("peak_id", F.xxhash64("chrom", "start", "end", "strand"))
    names = [r["sample"] for r in scales.select("sample").orderBy("sample").collect()]
    pooled = tags.select("sample").distinct()
    pooled = assign_groups(pooled, groups) if groups is not None else pooled.withColumn("grp", F.col("sample"))
    labels = [r["grp"] for r in pooled.select("grp").distinct().orderBy("grp").collect()]
    W.write_tsv(matrix.wide_matrix(peaks, matrix.peak_counts(peaks, tags), pooled, scales, names, labels, s.raw_counts), at["matrix"])
    log = settled(sample_log(reads, kept, out))
    W.write_tsv(log.orderBy("sample"), f"{at['reports']}/samples")
    piles = out["pileup"] if groups is None else P.pileup(filters.pileup_reads(kept, s.min_mapq, s.max_nh))
    W.write_tsv(chromosome_log(kept, piles, s.min_mapq, s.max_nh).orderBy("sample", "chrom"), f"{at['reports']}/chromosomes")
    given = spark.createDataFrame([(k, str(v)) for k, v in sorted(s.as_dict().items())], "setting string, value string")
    W.write_tsv(given, f"{at['reports']}/settings")
    return log
