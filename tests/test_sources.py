"""Files in and out."""

from __future__ import annotations

import gzip
import hashlib
import io
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitemill.sources import readers as R
from sitemill.sources import writers as W
from sitemill.streaming import batches as B


def put(path, text):
    path.write_text(text)
    return str(path)


def test_fastq(spark, tmp_path):
    text = "".join(f"@r{i} x\nACGT{'A' * (i % 9)}\n+\nIIII{'@' * (i % 9)}\n" for i in range(500))
    put(tmp_path / "S1.fastq", text)
    with gzip.open(tmp_path / "S2.fq.gz", "wt") as f:
        f.write(text)
    put(tmp_path / "notes.txt", "no")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = R.read_fastq(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 1000 and {r["sample"] for r in got} == {"S1", "S2"}
    for s in ("S1", "S2"):
        own = sorted((r["ord"], r["header"], r["seq"], r["qual"]) for r in got if r["sample"] == s)
        assert own == [(i, f"r{i} x", "ACGT" + "A" * (i % 9), "IIII" + "@" * (i % 9)) for i in range(500)]
    assert [r["ord"] for r in R.first_reads(R.read_fastq(spark, str(tmp_path / "S1.fastq")), 3).collect()] == [0, 1, 2]


def test_truncated_fastq(spark, tmp_path):
    p = put(tmp_path / "x.fastq", "@a\nAC\n+\nII\n@b\nAC\n+\n")
    with pytest.raises(Exception, match="truncated record"):
        R.read_fastq(spark, p).collect()
    assert R.read_fastq(spark, p, strict=False).count() == 1


SAM = "@HD\tVN:1\n@SQ\tSN:chr1\tLN:1000\nq1\t16\tchr1\t101\t255\t8M1D21M\t*\t0\t0\tACGT\tIIII\tNH:i:1\tMD:Z:8^A21\nq2\t4\t*\t0\t0\t*\t*\t0\t0\tACGT\tIIII\n"


def test_sam(spark, tmp_path):
    p = put(tmp_path / "s.sam", SAM)
    got = {r["qname"]: r for r in R.read_sam(spark, p).collect()}
    q = got["q1"]
    assert (q["sample"], q["start0"], q["end0"], q["strand"], q["nh"], q["md"]) == ("s", 100, 130, "-", 1, "8^A21")
    assert got["q2"]["nh"] is None and got["q2"]["md"] is None
    assert [tuple(r) for r in R.read_sam_header(spark, p).collect()] == [("chr1", 1000)]


def bgzf(data: bytes) -> bytes:
    out = b""
    for i in [*range(0, len(data), 40), None]:
        part = b"" if i is None else data[i : i + 40]
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(part) + c.flush()
        head = struct.pack("<4BIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25)
        out += head + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


def bam(refs, rows, text=b""):
    b = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(refs))
    for n, k in refs:
        b += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", k)
    for name, flag, ref, pos, mapq, ops, seq, qual, tags in rows:
        codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0] * (len(seq) % 2)
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, 0, len(ops), flag, len(seq), -1, -1, 0) + name.encode() + b"\0"
        body += struct.pack(f"<{len(ops)}I", *[n << 4 | "MIDNSHP=X".index(o) for n, o in ops])
        body += bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2)) + bytes(ord(q) - 33 for q in qual) + tags
        b += struct.pack("<i", len(body)) + body
    return bgzf(b)


def test_bam(spark, tmp_path):
    tags = b"NHC\x02" + b"MDZ5T4\0" + b"XBBc" + struct.pack("<i", 2) + b"\1\2" + b"XFf" + struct.pack("<f", 1.5) + b"XAAz"
    rows = [("q1", 16, 0, 100, 255, [(10, "M")], "ACGTNACGTA", "I" * 10, tags), ("q2", 0, 1, 5, 3, [(2, "S"), (3, "M")], "ACGTA", "I" * 5, b"")]
    (tmp_path / "t.bam").write_bytes(bam([("chr1", 1000), ("chr2", 500)], rows))
    got = {r["qname"]: r for r in R.read_bam(spark, str(tmp_path / "t.bam")).collect()}
    q = got["q1"]
    assert (q["sample"], q["chrom"], q["start0"], q["end0"], q["strand"], q["mapq"], q["cigar"], q["seq"], q["nh"], q["md"]) == ("t", "chr1", 100, 110, "-", 255, "10M", "ACGTNACGTA", 2, "5T4")
    assert got["q2"]["end0"] == 8 and got["q2"]["nh"] is None
    assert R.read_bam(spark, str(tmp_path / "t.bam"), "chr2").count() == 1
    assert sorted(tuple(r) for r in R.read_bam_header(spark, str(tmp_path / "t.bam")).collect()) == [("chr1", 1000), ("chr2", 500)]


def test_intervals(spark, tmp_path):
    b = R.read_bed(spark, put(tmp_path / "S_collapsed.bed", "#c\ntrack x\nchr1\t5\t10\tn\t3.5\t+\nchr1\t1\t2\n")).collect()
    assert sorted((r["sample"], r["start"], r["end"], r["name"], r["score"], r["strand"]) for r in b if r["name"]) == [("S", 5, 10, "n", 3.5, "+")] and len(b) == 2
    g = R.read_bedgraph(spark, put(tmp_path / "S.bedgraph", "track type=bedGraph\nchr1 0 10 1.5\nchr1\t10\t20\t2\n"), "+").collect()
    assert sorted((r["start"], r["end"], r["value"]) for r in g) == [(0, 10, 1.5), (10, 20, 2.0)]


def test_tables(spark, tmp_path):
    assert [tuple(r) for r in R.read_groups(spark, put(tmp_path / "g", "# c\r\nS1.fastq.gz\tA\r\n\r\nS2\tB\n")).collect()] == [("S1", "A"), ("S2", "B")]
    with pytest.raises(Exception, match="no tab"):
        R.read_groups(spark, put(tmp_path / "g2", "S1 A\n")).collect()
    assert [r["barcode"] for r in R.read_barcodes(spark, put(tmp_path / "b", "#x\ns1\tACGT\ns2\tGGGG\n")).collect()] == ["ACGT", "GGGG"]
    assert R.read_chrom_sizes(spark, put(tmp_path / "c", "chr1\t10\n")).first()["length"] == 10
    assert R.read_scale_factors(spark, put(tmp_path / "f", "s\t5\t200000.000000\n")).first()["scale"] == 200000.0
    p = R.read_called_peaks(spark, put(tmp_path / "p", "#h\nid1\tchr1\t5\t9\t+\t7\n")).first()
    assert (p["chrom"], p["start"], p["end"], p["name"], p["score"], p["strand"]) == ("chr1", 5, 9, "id1", 7.0, "+")
    assert [r["ref"] for r in R.read_index_stats(spark, put(tmp_path / "i", "a\t9\t3\t0\nb\t9\t0\t1\n*\t0\t0\t4\n")).collect()] == ["a"]
    s = R.read_aligner_stats(spark, put(tmp_path / "a", "100 reads; of these:\n  60 (60.00%) aligned 0 times\n  30 (30.00%) aligned exactly 1 time\n  10 (10.00%) aligned >1 times\n40.00% overall alignment rate\n")).first()
    assert (s["total"], s["once"], s["many"], s["rate"]) == (100, 30, 10, 40.0)
    fa = R.read_fasta(spark, put(tmp_path / "x.fa", ">a\nAC\nGT\n>b\nNN\n")).collect()
    assert sorted(tuple(r) for r in fa) == [("a", "ACGT"), ("b", "NN")]


def test_stored_substitutions(spark, tmp_path):
    buf = io.BytesIO()
    pos = np.array([3, 9], "i4")
    np.savez_compressed(buf, chr1__rev__positions=pos, chr1__rev__coverage=pos, chr1__rev__sub__TC=np.array([0, 2], "u2"), chr1__rev__sub__AG=np.array([1, 0], "u2"))
    (tmp_path / "p.npz").write_bytes(buf.getvalue())
    got = sorted(tuple(r) for r in R.import_substitution_arrays(spark, str(tmp_path / "p.npz"), "s").collect())
    assert got == [("s", "chr1", "-", 3, "AG", 1), ("s", "chr1", "-", 9, "TC", 2)]


def test_stored_pileups(spark, tmp_path):
    buf = io.BytesIO()
    a = np.array([1, 2], "i4")
    np.savez_compressed(buf, chr1__fwd__positions=a, chr1__fwd__coverage=a, chr1__fwd__truncations=a, chr2__positions=a, chr2__coverage=a)
    (tmp_path / "p.npz").write_bytes(buf.getvalue())
    got = sorted(tuple(r) for r in R.import_pileup_arrays(spark, str(tmp_path / "p.npz"), "s").collect())
    assert got == [("s", "chr1", "+", 1, 1, 1, 1, 0), ("s", "chr1", "+", 2, 2, 2, 2, 0), ("s", "chr2", "+", 1, 1, 0, 0, 0), ("s", "chr2", "+", 2, 2, 0, 0, 0)]
    old = spark.createDataFrame([("s", "chr1", 5, 3, 2, 0)], "sample string, chrom string, pos long, coverage long, truncations long, deletions long")
    old.write.parquet(str(tmp_path / "old"))
    r = R.read_pileup(spark, str(tmp_path / "old")).first()
    assert r["clean_truncations"] == 2 and r["strand"] == "+"
    W.write_pileup(R.import_pileup_arrays(spark, str(tmp_path / "p.npz"), "s"), str(tmp_path / "new"))
    assert R.read_pileup(spark, str(tmp_path / "new")).where("chrom = 'chr1'").count() == 2


def test_writers(spark, tmp_path):
    reads = spark.createDataFrame([("a", "r1#2", "ACGT", "IIII"), ("b", "r2#1", "GG", "II")], "sample string, name string, seq string, qual string")
    W.write_fastq(reads, str(tmp_path / "f"), by_sample=True)
    back = R.read_fastq(spark, str(tmp_path / "f/sample=a/*.txt"))
    assert [(r["header"], r["seq"], r["qual"]) for r in back.collect()] == [("r1#2", "ACGT", "IIII")]
    sums = W.deposit(reads, str(tmp_path / "g")).collect()
    assert len(sums) == 2 and all(len(r["md5"]) == 32 for r in sums)
    site = spark.createDataFrame([("chr1", 5, 6, "n", 139, "+", 3, 9, 1 / 3, 0.0123456, 4e-12)], "chrom string, start long, end long, name string, score long, strand string, signal long, coverage long, fraction double, pvalue double, qvalue double")
    W.write_text(W.site_bed_text(site), str(tmp_path / "s"), W.SITE_HEADER)
    assert [r["value"] for r in spark.read.text(str(tmp_path / "s")).collect()] == [W.SITE_HEADER, "chr1\t5\t6\tn\t139\t+\t3\t9\t0.3333\t1.235e-02\t4.000e-12"]
    assert W.bed_text(site).first()[0] == "chr1\t5\t6\tn\t139\t+"


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in/a.sam", SAM)
    put(tmp_path / "in/b.sam", SAM)
    seen = []
    B.run_batches(B.stream_sam(spark, str(tmp_path / "in"), 1), lambda df, i: seen.append(sorted((r["sample"], r["qname"]) for r in df.collect())), str(tmp_path / "ck")).awaitTermination(120)
    assert sorted(x for s in seen for x in s) == [("a", "q1"), ("a", "q2"), ("b", "q1"), ("b", "q2")]


def test_event_windows_of_a_stream(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.write.parquet(str(tmp_path / "e"))
    s = B.windowed_counts(spark.readStream.schema(e.schema).parquet(str(tmp_path / "e")))
    q = s.writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    assert spark.table("w").agg(F.sum("n")).first()[0] == e.count()


@pytest.mark.parametrize("split", [40, 97, 1 << 20])
def test_fasta_slices(spark, tmp_path, split):
    """Slices of any size, however the files are split, over headers at the borders."""
    r = random.Random(split)
    want = {f"s{i}": "".join(r.choice("ACGTN") for _ in range(r.choice([0, 1, 9, 60, 333]))) for i in range(12)}
    names = sorted(want)
    for f, own in (("a.fa", names[:7]), ("b.fa", names[7:])):
        text = "".join(f">{n} about it\n" + "".join(want[n][k : k + 10] + "\n" for k in range(0, len(want[n]), 10)) + ("\n" if n == "s3" else "") for n in own)
        put(tmp_path / f, text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        for size in (1, 7, 100_000):
            got = {}
            for x in R.read_fasta_slices(spark, str(tmp_path / "*.fa"), size).collect():
                got.setdefault(x["name"], {})[x["slice"]] = x["bases"]
            assert {n: "".join(s[k] for k in sorted(s)) for n, s in got.items()} == {n: s for n, s in want.items() if s}
            assert all(sorted(s) == list(range(len(s))) and all(len(b) == size for k, b in s.items() if k < len(s) - 1) for s in got.values())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_digests_of_large_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    put(tmp_path / "d/small.gz", "abc")
    put(tmp_path / "d/other.txt", "abc")
    with open(tmp_path / "d/large.gz", "wb") as f:  # sparse: more than Spark reads as one value
        f.truncate((1 << 31) + 5)
    md5 = hashlib.md5()
    for _ in range(1 << 11):
        md5.update(bytes(1 << 20))
    md5.update(bytes(5))
    got = {r["path"].split("/")[-1]: (r["bytes"], r["md5"]) for r in W.file_digests(spark, str(tmp_path / "d"), ".gz").collect()}
    assert got == {"small.gz": (3, hashlib.md5(b"abc").hexdigest()), "large.gz": ((1 << 31) + 5, md5.hexdigest())}
    assert W.file_digests(spark, str(tmp_path / "d"), ".none").count() == 0
