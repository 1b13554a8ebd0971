"""Command line: one subcommand for each step, with files in and files out."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.names import name_umi
from .operators import dedup, demux, filters, matrix, mutations, tracks
from .operators import pileup as P
from .plans import prep, sites
from .plans.config import Settings
from .plans.run import report, run_samples
from .plans.tags import tag_sites
from .sources import readers as R
from .sources import writers as W


def alignments(spark: SparkSession, path: str) -> DataFrame:
    """Alignment rows of SAM, BAM or Parquet, with the UMI of the name."""
    if path.endswith(".bam"):
        r = R.read_bam(spark, path)
    elif path.endswith((".sam", ".sam.gz")):
        r = R.read_sam(spark, path)
    else:
        r = spark.read.parquet(path)
    return r if "umi" in r.columns else r.withColumn("umi", name_umi(F.col("qname")))


LAYOUTS = ("standard", "eclip-single", "eclip-paired", "parclip")


def prepared(reads: DataFrame, layout: str, s: Settings, adapters: list[str] | None) -> DataFrame:
    """Trimmed reads by the layout of a library."""
    if layout == "eclip-single":
        return prep.eclip_single(reads, s.umi_length, adapters)
    if layout == "eclip-paired":
        return prep.eclip_paired(reads, s.umi_length, adapters)
    if layout == "parclip":
        return prep.parclip(reads, s.umi_length, s.spacer_length or 2, adapters, s.min_length)
    named = reads.withColumnRenamed("header", "name")
    return prep.standard(named, s.umi_length, s.barcode_length, s.spacer_length, s.barcode_first, s.min_length, s.min_quality, adapters)


def settings_of(args: argparse.Namespace) -> Settings:
    given = {f.name: getattr(args, f.name) for f in fields(Settings) if getattr(args, f.name, None) is not None}
    return Settings.from_strings({k: str(v) for k, v in given.items()})


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sitemill", description="Crosslink sites, coverage and peaks on Spark.")
    sub = p.add_subparsers(dest="command", required=True)
    about = {
        "collapse": "exact collapse of a FASTQ file or folder",
        "demux": "deal reads to samples by barcode",
        "barcodes": "report barcodes that collide",
        "dedup": "UMI deduplication of alignments",
        "pileup": "per-position counts to Parquet",
        "sites": "truncation, deletion and substitution sites",
        "crosslinks": "every position with truncations",
        "coverage": "scaled coverage tracks",
        "peaks": "peak calls",
        "matrix": "peak by sample matrix",
        "prep": "trim reads by --layout (standard, eclip-single, eclip-paired, parclip)",
        "tag-sites": "mutation and truncation sites of collapsed tags",
        "repeats": "repeat elements and families from alignments to repeats",
        "run": "a whole run of samples, in numbered folders",
    }
    for name, text in about.items():
        s = sub.add_parser(name, help=text)
        s.add_argument("input")
        s.add_argument("output")
        for extra in ("--barcodes", "--groups", "--peaks", "--adapters"):
            s.add_argument(extra)
        s.add_argument("--layout", choices=LAYOUTS, default="standard")
        for f in fields(Settings):
            flag = "--" + f.name.replace("_", "-")
            s.add_argument(flag, **({"action": argparse.BooleanOptionalAction, "default": None} if isinstance(f.default, bool) else {"type": type(f.default), "default": None}))
    return p


def run(spark: SparkSession, argv: Sequence[str]) -> None:
    a = parser().parse_args(argv)
    s = settings_of(a)
    if a.command == "collapse":
        return W.write_fastq(dedup.collapse_exact(R.read_fastq(spark, a.input)), a.output)
    if a.command == "demux":
        reads = demux.demultiplex(R.read_fastq(spark, a.input).withColumnRenamed("header", "name"), R.read_barcodes(spark, a.barcodes), s.max_mismatches)
        return W.write_fastq(reads, a.output, by_sample=True)
    if a.command == "barcodes":
        return W.write_tsv(demux.barcode_collisions(R.read_barcodes(spark, a.input), s.max_mismatches), a.output)
    if a.command == "prep":
        adapters = [r["seq"] for r in R.read_fasta(spark, a.adapters).collect()] if a.adapters else None  # some dozens
        return W.write_fastq(prepared(R.read_fastq(spark, a.input), a.layout, s, adapters), a.output, gzip=True)
    reads = alignments(spark, a.input)
    if a.command == "repeats":
        hits = reads.where(F.col("flag").bitwiseAND(4) == 0).withColumnRenamed("chrom", "ref")
        totals = reads.groupBy("sample").agg(F.countDistinct("qname").alias("total"))
        elements = demux.repeat_elements(hits, totals)
        return W.write_repeat_tables(elements, demux.repeat_families(elements), a.output)
    if a.command == "run":
        log = run_samples(spark, reads, a.output, s, R.read_groups(spark, a.groups) if a.groups else None)
        return print(report(log))
    if s.filter_chromosomes:
        reads = filters.canonical_chromosomes(reads)
    if a.command == "dedup":
        return W.write_alignments(sites.dedup_reads(reads, s.umi_length, s.max_nh, s.multi_map, s.rescue_window), a.output)
    if a.command == "coverage":
        return tracks.rpm_track(reads, tracks.scale_factors(reads)).write.partitionBy("sample", "strand").parquet(a.output)
    tags = filters.unique_reads(reads, s.max_nh).withColumnRenamed("start0", "start").withColumnRenamed("end0", "end")
    if a.command == "peaks":
        return W.write_text(W.bed_text(matrix.call_peaks(tags, s.peak_size, s.peak_distance)), a.output)
    if a.command == "matrix":
        peaks = R.read_bed(spark, a.peaks).drop("sample").withColumn("peak_id", F.xxhash64("chrom", "start", "end", "strand", "name"))
        names = [r["sample"] for r in tags.select("sample").distinct().orderBy("sample").collect()]
        groups = R.read_groups(spark, a.groups) if a.groups else tags.select("sample", F.col("sample").alias("grp")).distinct()
        labels = [r["grp"] for r in groups.select("grp").distinct().orderBy("grp").collect()]
        wide = matrix.wide_matrix(peaks, matrix.peak_counts(peaks, tags), groups, tracks.scale_factors(reads), names, labels, s.raw_counts)
        return W.write_tsv(wide, a.output)
    if a.command == "tag-sites":
        for kind, table in tag_sites(tags, mutations.mutation_list(reads).drop("start", "end"), s).items():
            write = W.write_flanked if kind.endswith("_flanked") else W.write_truncation_table if kind == "trunc" else W.write_mutation_table
            write(table, f"{a.output}/{kind}")
        return None
    kept = filters.pileup_reads(reads, s.min_mapq, s.max_nh)
    if a.command == "pileup":
        return W.write_pileup(P.pileup(kept), a.output)
    if a.command == "crosslinks":
        return W.write_text(W.bed_text(sites.all_crosslinks(P.pileup(kept))), a.output)
    limits = {"min_coverage": s.min_coverage, "min_fraction": s.min_fraction, "min_signal": s.min_signal, "fdr": s.fdr, "cluster_gap": s.cluster_gap}
    groups = R.read_groups(spark, a.groups) if a.groups else None
    out = sites.analyse(reads, groups, s.min_mapq, s.max_nh, sites.parse_sub_types(s.sub_types.split(",")) if s.sub_types else None, s.no_subs, **limits)
    for name, table in out.items():
        if name == "pileup":
            W.write_pileup(table, f"{a.output}/pileup")
        elif name == "crosslinks":
            W.write_text(W.bed_text(table), f"{a.output}/{name}")
        else:
            W.write_sites(table, f"{a.output}/{name}")
    return None


def main() -> None:
    import sys

    spark = SparkSession.builder.appName("sitemill").getOrCreate()
    run(spark, sys.argv[1:])


if __name__ == "__main__":
    main()
