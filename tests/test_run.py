"""A whole run: every folder has its tables, and they agree with the operators; named sinks."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from sitemill import cli
from sitemill.operators import filters
from sitemill.plans import run
from sitemill.plans.config import Settings, layout
from sitemill.sources import readers as R
from sitemill.sources import writers as W


def sam(path, seed):
    """Reads over two chromosomes, many of them starting at one site, some with a deletion, some unusable."""
    r = random.Random(seed)
    lines = ["@SQ\tSN:chr1\tLN:9000", "@SQ\tSN:chr2\tLN:9000"]
    for i in range(400):
        umi = "".join(r.choice("ACGT") for _ in range(7))
        chrom, pos = (("chr1", 1001) if i % 4 == 0 else (r.choice(["chr1", "chr2"]), r.randrange(900, 1600)))
        cigar, md = ("10M1D19M", "10^A19") if i % 5 == 0 else ("30M", "30" if i % 7 else "5T24")
        seq = "A" * 5 + ("C" if md == "5T24" else "A") + "A" * (24 if cigar == "30M" else 23)
        lines.append(f"r{i}#{umi}\t{16 if i % 11 == 0 else 0}\t{chrom}\t{pos}\t{255 if i % 13 else 3}\t{cigar}\t*\t0\t0\t{seq}\t*\tNH:i:{1 if i % 13 else 2}\tMD:Z:{md}")
    path.write_text("\n".join(lines) + "\n")


def tsv(spark, path):
    return spark.read.option("sep", "\t").option("header", "true").csv(str(path))


def test_run(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    for i, s in enumerate("ab"):
        sam(tmp_path / f"in/{s}.sam", i)
    reads = R.read_sam(spark, str(tmp_path / "in")).withColumn("umi", F.regexp_extract("qname", "#(.*)", 1))
    reads.write.parquet(str(tmp_path / "reads"))
    cli.run(spark, ["run", str(tmp_path / "reads"), str(tmp_path / "out"), "--cims-fdr", "1.0", "--cits-pvalue", "0.9"])
    at = layout(str(tmp_path / "out"))
    shown = capsys.readouterr().out.splitlines()
    assert shown[0].split()[:3] == ["sample", "alignments", "kept"] and [x.split()[0] for x in shown[1:]] == ["a", "b"]
    kept = run.deduplicated(reads, Settings())
    n = {r["sample"]: r["n"] for r in kept.groupBy("sample").agg(F.count("*").alias("n")).collect()}
    bams = R.read_bam(spark, at["alignments"])
    assert {r["sample"]: r["n"] for r in bams.groupBy("sample").agg(F.count("*").alias("n")).collect()} == n
    assert R.read_bam(spark, at["alignments"], "chr2", 900, 1000).count() == kept.where("chrom = 'chr2' and start0 < 1000 and end0 > 900").count()
    tags = spark.read.text(at["tags"])
    assert tags.count() == sum(n.values()) and set(tags.columns) == {"value", "sample"}
    tracks = spark.read.text(f"{at['tracks']}/bedgraph")
    assert {(r["sample"], r["strand"]) for r in tracks.select("sample", "strand").distinct().collect()} == {(s, d) for s in "ab" for d in ("fwd", "rev")}
    assert {r["sample"]: int(r["mapped"]) for r in tsv(spark, f"{at['tracks']}/scale_factors").collect()} == n
    piles = spark.read.parquet(at["pileups"])
    sites = [r["value"].split("\t") for r in spark.read.text(f"{at['sites']}/truncations").collect()]
    assert sites[0][0] == "#chrom" and any(x[0] == "chr1" and x[1] == "999" for x in sites[1:])
    peaks = R.read_bed(spark, f"{at['peaks']}/all")
    assert peaks.count() == tsv(spark, at["matrix"]).count() > 0
    assert {r["sample"] for r in spark.read.text(f"{at['peaks']}/samples").select("sample").distinct().collect()} <= {"a", "b"}
    for s in "ab":
        cims = [r["value"].split("\t") for r in spark.read.text(f"{at['tag_sites']}/{s}/del").collect()]
        assert cims[0] == W.CIMS_HEADER.split("\t") and all(len(x) == 9 for x in cims) and len(cims) > 1
        rates = [float(x[8]) for x in cims[1:]]
        assert rates == sorted(rates)
        cits = [r["value"].split("\t") for r in spark.read.text(f"{at['tag_sites']}/{s}/trunc").collect()]
        assert cits[0] == W.CITS_HEADER.split("\t") and all(int(x[2]) - int(x[1]) == 1 for x in cits[1:])
        flanked = [r["value"].split("\t") for r in spark.read.text(f"{at['tag_sites']}/{s}/del_flanked").collect()]
        assert len(flanked) == len(cims) - 1 and all(int(x[2]) - int(x[1]) == 21 for x in flanked)
    log = {(r["sample"], r["chrom"]): r for r in tsv(spark, f"{at['reports']}/chromosomes").collect()}
    for (s, c), r in log.items():
        own = kept.where((F.col("sample") == s) & (F.col("chrom") == c))
        taken = filters.pileup_reads(own).count()
        assert (int(r["n_reads"]), int(r["n_skipped"])) == (taken, own.count() - taken)
        assert int(r["n_pos"]) == piles.where((F.col("sample") == s) & (F.col("chrom") == c)).count()
    assert {r["setting"]: r["value"] for r in tsv(spark, f"{at['reports']}/settings").collect()}["cits_pvalue"] == "0.9"


def test_skipped_reads(spark):
    rows = [("s", "chr1", f, q, "5M", 1, 10, 15, "+") for f, q in ((0, 255), (4, 255), (256, 255), (0, 3), (16, 255))]
    df = spark.createDataFrame(rows, "sample string, chrom string, flag int, mapq int, cigar string, nh int, start0 long, end0 long, strand string")
    piles = spark.createDataFrame([("s", "chr1", 3, 1)], "sample string, chrom string, truncations int, deletions int")
    assert tuple(run.chromosome_log(df, piles).first()) == ("s", "chr1", 2, 1, 3, 1, 3)


def test_prep_and_repeats(spark, tmp_path):
    (tmp_path / "r.fastq").write_text("".join(f"@r{i}\n{'ACGTACG' + 'TTGCA' * 6}\n+\n{'I' * 37}\n" for i in range(3)))
    (tmp_path / "a.fa").write_text(">x\nGCATTGCATTGCA\n")
    for way, count in (("standard", 3), ("parclip", 1), ("eclip-paired", 1)):
        cli.run(spark, ["prep", str(tmp_path / "r.fastq"), str(tmp_path / way), "--layout", way])
        got = [r["value"] for r in spark.read.text(str(tmp_path / way)).collect()]
        assert len(got) == 4 * count and any("#ACGTACG" in x for x in got), way
    cli.run(spark, ["prep", str(tmp_path / "r.fastq"), str(tmp_path / "cut"), "--adapters", str(tmp_path / "a.fa"), "--min-length", "1"])
    assert max(len(r["value"]) for r in spark.read.text(str(tmp_path / "cut")).collect()) < 30
    hits = "".join(f"q{i}\t{f}\t{c}\t1\t255\t5M\t*\t0\t0\tACGTA\t*\n" for i, (f, c) in enumerate([(0, "AluSx#SINE/Alu"), (0, "AluSx#SINE/Alu"), (0, "MER#DNA"), (4, "*")]))
    (tmp_path / "s.sam").write_text(hits)
    cli.run(spark, ["repeats", str(tmp_path / "s.sam"), str(tmp_path / "rep")])
    elements = [tuple(r) for r in tsv(spark, tmp_path / "rep/s/repeat_elements").collect()]
    assert elements == [("AluSx", "SINE", "SINE/Alu", "2", "500000.00"), ("MER", "DNA", "DNA", "1", "250000.00")]
    assert [tuple(r) for r in tsv(spark, tmp_path / "rep/s/repeat_families").collect()] == [("SINE", "SINE/Alu", "2", "500000.00"), ("DNA", "DNA", "1", "250000.00")]


def test_tag_sites_command(spark, tmp_path):
    sam(tmp_path / "a.sam", 5)
    cli.run(spark, ["tag-sites", str(tmp_path / "a.sam"), str(tmp_path / "t"), "--cits-pvalue", "0.9"])
    assert spark.read.text(str(tmp_path / "t/del")).first()[0] == W.CIMS_HEADER
    assert spark.read.text(str(tmp_path / "t/trunc")).first()[0] == W.CITS_HEADER
