"""The command line from files to files."""

from __future__ import annotations

import random

from sitemill import cli
from sitemill.functions.alignment import md_tag, with_md
from sitemill.operators import dedup
from tests.test_operators import READ, read

HEAD = "@SQ\tSN:chr1\tLN:5000\n"


def sam(path, n=60):
    rows = [f"q{i}#1#ACG\t0\tchr1\t{1001 if i % 2 else 960 + i}\t255\t30M\t*\t0\t0\t{'A' * 30}\t{'I' * 30}\tNH:i:1\tMD:Z:30\n" for i in range(n)]
    path.write_text(HEAD + "".join(rows))
    return str(path)


def test_steps(spark, tmp_path):
    s = sam(tmp_path / "s.sam")
    run = lambda *a: cli.run(spark, [str(x) for x in a])
    run("dedup", s, tmp_path / "d")
    assert spark.read.parquet(str(tmp_path / "d")).count() > 5
    run("pileup", s, tmp_path / "p")
    assert spark.read.parquet(str(tmp_path / "p")).agg({"truncations": "sum"}).first()[0] == 60
    run("sites", s, tmp_path / "x", "--no-subs", "--fdr", "0.1")
    lines = [r[0] for r in spark.read.text(str(tmp_path / "x/truncations")).collect()]
    assert lines[0].startswith("#chrom") and any(x.startswith("chr1\t999\t1000\ttruncation:chr1:999:+") for x in lines)
    run("crosslinks", s, tmp_path / "c")
    run("coverage", s, tmp_path / "t")
    (tmp_path / "k.bed").write_text("chr1\t990\t1040\tp1\t5\t+\n")
    run("matrix", s, tmp_path / "m", "--peaks", tmp_path / "k.bed", "--raw-counts")
    m = spark.read.option("sep", "\t").option("header", "true").csv(str(tmp_path / "m")).first()
    assert m["TC_s"] == "59" and m["BC_grp_s"] == "1"
    run("peaks", s, tmp_path / "k")
    (tmp_path / "b.txt").write_text("x\tAAAA\ny\tAAAT\n")
    run("barcodes", tmp_path / "b.txt", tmp_path / "bc")
    assert spark.read.option("sep", "\t").option("header", "true").csv(str(tmp_path / "bc")).first()["variant"] == "AAAN"
    (tmp_path / "r.fastq").write_text("@a x\nAAAAGG\n+\nIIIIII\n@b\nAAAAGG\n+\nIIIIII\n@c\nCCCCCC\n+\nIIIIII\n")
    run("collapse", tmp_path / "r.fastq", tmp_path / "f")
    assert "@a#2" in {r[0] for r in spark.read.text(str(tmp_path / "f")).collect()}
    run("demux", tmp_path / "r.fastq", tmp_path / "g", "--barcodes", tmp_path / "b.txt")
    assert {r["sample"] for r in spark.read.option("basePath", str(tmp_path / "g")).text(str(tmp_path / "g")).select("sample").distinct().collect()} == {"x", "unknown"}


def test_md_tags(spark):
    assert md_tag("5M1D4M", "AAAAACCCC", "AAAAAGCCCC") == ("5^G4", 1)
    assert md_tag("2S4M10N3M", "NNACGTAAA", "ACCT" + "N" * 10 + "AAA") == ("2C4", 1)
    assert md_tag("2M1I2M", "AAGTT", "AATT") == ("4", 1)
    ref = spark.createDataFrame([("chr1", "ACGT" * 100)], "name string, seq string")
    reads = spark.createDataFrame([read(2, "10M", seq="GTACGTACGT", order=0), read(96, "8M", seq="ACGAACGT", order=1), read(395, "10M", seq="TACGTACGTA", order=2), read(5000, "4M", seq="ACGT", order=3)], READ)
    got = {r["ord"]: (r["md"], r["nm"]) for r in with_md(reads, ref, 50).collect()}
    assert got[0] == ("10", 0) and got[1] == ("3T4", 1) and got[3] == (None, None)


def test_md_tags_from_slices_of_any_size(spark):
    """Slices of any size give the tags of the whole reference; introns and repeated orders don't matter."""
    r = random.Random(9)
    seq = "".join(r.choice("ACGT") for _ in range(3000))
    rows, want = [], {}
    for i in range(60):
        start, gap = r.randrange(2000), r.choice([0, 5, 700])
        cigar = f"3S12M{gap}N10M2D4M" if gap else "20M1I5M"
        spanned = seq[start : start + (28 + gap if gap else 25)]
        read_seq = "".join(r.choice("ACGT") for _ in range(29)) if i % 3 else "TTT" + seq[start : start + 12] + seq[start + 12 + gap : start + 22 + gap] + seq[start + 24 + gap : start + 28 + gap]
        rows.append(read(start, cigar, seq=read_seq, order=i % 7, name=f"r{i}"))
        want[f"r{i}"] = md_tag(cigar, read_seq, spanned)
    reads = spark.createDataFrame([*rows, read(10, "*", seq="ACG", order=0, name="none")], READ)
    for size in (11, 64, 5000):
        cuts = [("chr1", k, seq[k * size : (k + 1) * size]) for k in range(-(-len(seq) // size))]
        slices = spark.createDataFrame(cuts, "name string, slice long, bases string")
        got = {x["qname"]: (x["md"], x["nm"]) for x in with_md(reads, slices, size).collect()}
        assert got == want | {"none": (None, None)}


def test_weighted_collapse(spark):
    reads = [read(100, "30M", end=130, umi="AAA", name=f"r{i}#3#AAA", order=i) for i in range(2)]
    got = dedup.collapse_weighted(spark.createDataFrame(reads, READ)).collect()
    assert len(got) == 1 and got[0]["score"] == 6 and got[0]["reads"] == 2
    # AAT (2 reads of 5 copies) is a neighbour of AAA (6 of 3): one network of 28 copies, and CCC apart
    names = [("AAA", 3)] * 6 + [("AAT", 5)] * 2 + [("CCC", 1)]
    reads = [read(100, "30M", end=130, umi=u, name=f"r{i}#{c}#{u}", order=i) for i, (u, c) in enumerate(names)]
    got = dedup.collapse_weighted(spark.createDataFrame(reads, READ)).collect()
    assert sorted((r["umi"], r["reads"], r["score"]) for r in got) == [("AAA", 6, 18), ("AAT", 2, 10), ("CCC", 1, 1)]
    names[0] = ("AAA", 20)
    reads = [read(100, "30M", end=130, umi=u, name=f"r{i}#{c}#{u}", order=i) for i, (u, c) in enumerate(names)]
    got = dedup.collapse_weighted(spark.createDataFrame(reads, READ)).collect()
    assert sorted((r["umi"], r["reads"], r["score"]) for r in got) == [("AAA", 8, 45), ("CCC", 1, 1)]
