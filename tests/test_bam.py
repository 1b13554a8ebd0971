"""BAM files: any split gives the rows of a whole read, regions by index, what is written is read back."""

from __future__ import annotations

import random
import struct
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitemill.sources import bam
from sitemill.sources import readers as R
from sitemill.sources import writers as W

REFS = [("chr1", 100_000), ("chr2", 3_000_000), ("chrM", 900)]
ROW = "qname string, flag int, chrom string, start0 long, mapq int, cigar string, mate_chrom string, mate_start0 long, insert_size int, seq string, qual string, tags array<string>"
FIELDS = [f.split()[0] for f in ROW.split(", ")]


def rows_of(n, seed=1, long_every=0):
    r, out = random.Random(seed), []
    for i in range(n):
        name, size = r.choice(REFS)
        start, k = r.randrange(size - 500), r.randint(1, 90)
        if long_every and i % long_every == 0:
            k = 150_000
        m, gap = max(k // 2, 1), r.choice([0, 0, 3, 40_000 if name == "chr2" else 2])
        cigar = f"{m}M{gap}N{k - m}M" if gap and k > m else f"{k}M"
        tags = ["NH:i:1", f"MD:Z:{k}", "XA:A:z", "XF:f:1.5", "XB:B:c,1,-2", "XI:B:I,70000", "XN:i:-5", "XE:H:1AE3"][: r.randint(0, 8)]
        seq = "".join(r.choice("ACGTN") for _ in range(k))
        mate = r.choice([("*", -1, 0), (name, start + 50, 120)])
        out.append((f"r{i}", r.choice([0, 16, 163]), name, start, r.choice([0, 60, 255]), cigar, *mate, seq, r.choice(["*", "I" * k, "#" * k]), tags))
    out += [(f"u{i}", 4, "*", -1, 0, "*", "*", -1, 0, "ACG", "III", []) for i in range(5)]
    return out


def order(row):
    refs = [n for n, _ in REFS]
    return (refs.index(row[2]) if row[2] in refs else 99, row[3])


def plain(rows):
    return Counter((*r[:-1], tuple(r[-1])) for r in rows)


def file_of(rows, block=700, text="@HD\tVN:1.6\tSO:coordinate\n"):
    """A BAM file's bytes with blocks of so many bytes, which records cross."""
    data = b"BAM\1" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(REFS))
    data += b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in REFS)
    number = {n: i for i, (n, _) in enumerate(REFS)}
    data += b"".join(bam.pack(dict(zip(FIELDS, r)), number.get(r[2], -1), number)[0] for r in rows)
    return b"".join(bam.pack_block(data[i : i + block]) for i in range(0, len(data), block)) + bam.EMPTY_BLOCK


def overlapping(rows, chrom, start, end):
    span = lambda c: sum(int(n) for n, o in bam_ops(c) if o in "MDN=X")
    return plain(r for r in rows if r[2] == chrom and r[3] < end and max(r[3] + span(r[5]), r[3] + 1) > start)


def bam_ops(cigar):
    n = ""
    for c in cigar:
        if c.isdigit():
            n += c
        elif n:
            yield n, c
            n = ""


def direct(path, split, **region):
    """All parts of a file, read without Spark."""
    reader = bam.BamReader({"path": str(path), "splitbytes": str(split)} | {k: str(v) for k, v in region.items()})
    out = []
    for part in reader.partitions():
        for batch in reader.read(part) if part.path else ():
            out += [tuple(d[f] for f in FIELDS) for d in batch.to_pylist()]
    return out, len([p for p in reader.partitions() if p.path])


@pytest.mark.parametrize("block,long_every", [(700, 0), (65_280, 0), (5_000, 40)])
def test_any_split(tmp_path, block, long_every):
    rows = sorted(rows_of(600 if long_every == 0 else 120, long_every=long_every), key=order)
    path = tmp_path / "s.bam"
    path.write_bytes(file_of(rows, block))
    parts = set()
    for split in (1 << 30, 20_000, 3_001, 997) if not long_every else (1 << 30, 300_000, 30_001):
        got, n = direct(path, split)
        parts.add(n)
        assert plain(got) == plain(rows), (split, n)
    assert len(parts) > 1


def test_virtual_offsets_rise(tmp_path):
    (tmp_path / "s.bam").write_bytes(file_of(sorted(rows_of(200), key=order)))
    file, size = bam.open_file(str(tmp_path / "s.bam"))
    ords = [r[-1] for r in bam.rows_of(file, size, bam.Part("s.bam", 0, size), None, 0, None)]
    assert ords == sorted(set(ords)) and len(ords) == 205


def test_regions_without_index(tmp_path):
    rows = rows_of(500, 3)
    for text, own in (("@HD\tVN:1.6\tSO:coordinate\n", sorted(rows, key=order)), ("@HD\tVN:1.6\n", rows)):
        (tmp_path / "s.bam").write_bytes(file_of(own, text=text))
        for chrom, start, end in (("chr1", 20_000, 30_000), ("chr2", 0, 10**7), ("chrM", 5, 6), ("chr9", 0, 5)):
            assert plain(direct(tmp_path / "s.bam", 4_000, chrom=chrom, start=start, end=end)[0]) == overlapping(own, chrom, start, end)
        assert plain(direct(tmp_path / "s.bam", 4_000, chrom="*")[0]) == plain(r for r in own if r[2] == "*")


def test_damaged_files(tmp_path):
    blob = file_of(sorted(rows_of(50), key=order))
    for cut, text in ((len(blob) // 2, "truncated"), (3, "BGZF")):
        (tmp_path / "x.bam").write_bytes(blob[:cut])
        with pytest.raises(ValueError, match=text):
            direct(tmp_path / "x.bam", 1 << 30)
    (tmp_path / "y.bam").write_bytes(bam.pack_block(b"no") + bam.EMPTY_BLOCK)
    with pytest.raises(ValueError):
        direct(tmp_path / "y.bam", 1 << 30)
    with pytest.raises(FileNotFoundError):
        bam.files_of(str(tmp_path / "none"))


def test_bins():
    assert [bam.bin_of(0, 1, 5), bam.bin_of(0, 1 << 14, 5), bam.bin_of(0, (1 << 14) + 1, 5), bam.bin_of(0, 1 << 29, 5), bam.bin_of(1 << 26, (1 << 26) + 9, 5)] == [4681, 4681, 585, 0, 4681 + 4096]
    r = random.Random(2)
    for depth in (5, 6):
        for _ in range(300):
            a, b = sorted(r.randrange(1 << (14 + 3 * depth)) for _ in range(2))
            x = r.randrange(a, b + 1)
            assert bam.bin_of(a, b + 1, depth) in bam.bins_of(x, x + 1, depth)


@pytest.mark.parametrize("scale", [1, 4_000])
def test_index_round_trip(scale):
    """Chunks of any region hold its records; a reference too long for five levels takes more."""
    refs = [("a", 3_000_000 * scale)]
    index, r = bam.Index(1, bam.Index.depth_for(refs)), random.Random(scale)
    spans = sorted((s, s + r.choice([1, 80, 50_000 * scale])) for s in (r.randrange(2_900_000 * scale) for _ in range(800)))
    at = [(k // 7) << 16 | k % 7 for k in range(len(spans) + 1)]
    for (s, e), a, b in zip(spans, at, at[1:]):
        index.add(0, s, e, a, b)
    again = bam.Index.parse(index.to_bytes())
    assert again.depth == index.depth == (5 if scale == 1 else 7)
    for _ in range(200):
        s = r.randrange(2_950_000 * scale)
        e = s + r.choice([1, 1_000, 400_000])
        for x in (index, again):
            chunks = x.chunks(0, s, e)
            assert all(any(a <= k < b for a, b in chunks) for (p, q), k in zip(spans, at) if p < e and q > s)
            assert all(a < b for a, b in chunks)
    assert again.chunks(0, 5, 5) == []
    with pytest.raises(ValueError):
        bam.Index.parse(b"none")


def test_tags_and_blocks():
    tags = ["XA:A:z", "XI:i:4000000000", "XJ:i:-7", "XF:f:0.25", "XZ:Z:a b:c", "XB:B:f,1.5,2", "XC:B:S,1,65535"]
    assert bam._tags(bam._pack_tags(tags)) == tags
    noise = random.Random(1).randbytes(65_280)
    block = bam.pack_block(noise)
    assert bam.block_size(block, 0) == len(block) and zlib.decompress(block, 31) == noise
    assert bam.block_size(b"\x1f\x8b\x08\x04" + bytes(20), 0) == 0


def test_written_files(spark, tmp_path):
    rows = rows_of(900, 5, long_every=300)
    df = spark.createDataFrame([(*r, "A" if i % 3 else "B") for i, r in enumerate(rows)], ROW + ", sample string")
    sizes = spark.createDataFrame(REFS, "chrom string, length long")
    path = str(tmp_path / "out")
    W.write_bam(df, sizes, path, 5)
    assert not (tmp_path / "out" / "_temporary").exists() and (tmp_path / "out" / "_SUCCESS").exists()
    for split in (1 << 25, 5_000):
        back = R.read_bam(spark, path, split_bytes=split)
        assert plain(tuple(r[f] for f in FIELDS) for r in back.collect()) == plain(rows)
        assert {r["sample"]: r["n"] for r in back.groupBy("sample").agg(F.count("*").alias("n")).collect()} == {"A": sum(i % 3 > 0 for i in range(905)), "B": sum(i % 3 == 0 for i in range(905))}
    assert sorted(tuple(r) for r in R.read_bam_header(spark, path).collect()) == sorted(REFS)
    whole = len(bam.BamReader({"path": path, "splitbytes": "5000"}).partitions())
    for chrom, start, end in (("chr2", 500_000, 520_000), ("chr1", 0, 10**6), ("chrM", 5, 6)):
        region = R.read_bam(spark, path, chrom, start, end, split_bytes=5_000)
        assert plain(tuple(r[f] for f in FIELDS) for r in region.collect()) == overlapping(rows, chrom, start, end)
        assert region.rdd.getNumPartitions() < whole
    assert R.read_bam(spark, path, "chr9").count() == 0 and R.read_bam(spark, path, "*").count() == 5
    assert R.read_bam(spark, f"{path}/A.bam").count() == sum(i % 3 > 0 for i in range(905))
    W.write_bam(df.limit(7).drop("sample", "tags").withColumn("nh", F.lit(2)).withColumn("md", F.lit("5")), sizes, path, 2, "overwrite")
    got = R.read_bam(spark, path).collect()
    assert len(got) == 7 and all((r["nh"], r["md"], r["sample"]) == (2, "5", "out") for r in got)


def test_a_frame_is_used_again(spark, tmp_path):
    """A filter of one query takes nothing from another that uses the same frame."""
    rows = rows_of(300, 6)
    W.write_bam(spark.createDataFrame(rows, ROW), spark.createDataFrame(REFS, "chrom string, length long"), str(tmp_path / "x.bam"), 3)
    every = R.read_bam(spark, str(tmp_path / "x.bam"), split_bytes=4_000)
    assert every.where("chrom = 'chr1' and start0 < 9000").count() == sum(r[2] == "chr1" and r[3] < 9000 for r in rows)
    assert every.count() == 305 and every.rdd.getNumPartitions() > 3


def test_unsorted_rows_are_refused(spark, tmp_path):
    spark.dataSource.register(bam.BamSource)
    df = spark.createDataFrame([("a", 0, "chr1", 9, 1, "1M", "A"), ("b", 0, "chr1", 3, 1, "1M", "A")], "qname string, flag int, chrom string, start0 long, mapq int, cigar string, seq string").coalesce(1)
    with pytest.raises(Exception, match="sorted"):
        df.write.format("bam").mode("append").option("references", "chr1:100").save(str(tmp_path / "z"))
    assert not list((tmp_path / "z").glob("**/*.bam"))


def test_paths_that_only_spark_reads(spark, tmp_path, monkeypatch):
    rows = sorted(rows_of(120, 8), key=order)
    (tmp_path / "s.bam").write_bytes(file_of(rows))

    def refuse(path):
        raise pa.ArrowInvalid(path)

    monkeypatch.setattr(bam, "located", refuse)
    assert plain(tuple(r[f] for f in FIELDS) for r in R.read_bam(spark, str(tmp_path / "s.bam")).collect()) == plain(rows)
    assert R.read_bam(spark, str(tmp_path / "s.bam"), "chr1", 0, 50_000).count() == sum(overlapping(rows, "chr1", 0, 50_000).values())


def test_tasks_grow_with_the_rows(spark, tmp_path, monkeypatch):
    """Writers are as many as the rows need; parts get longer where they would be very many."""
    rows = rows_of(3_000, 9)
    df, sizes = spark.createDataFrame(rows, ROW), spark.createDataFrame(REFS, "chrom string, length long")
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    W.write_bam(df, sizes, few)
    monkeypatch.setattr(W, "BAM_ROWS", 200)
    W.write_bam(df, sizes, many)
    assert len(bam.files_of(few)) <= 8 < len(bam.files_of(many)) <= 16
    for path in (few, many):
        assert plain(tuple(r[f] for f in FIELDS) for r in R.read_bam(spark, path, split_bytes=3_000).collect()) == plain(rows)
    monkeypatch.setattr(bam, "PARTS", 10)
    n = lambda split: len(bam.BamReader({"path": few, "splitbytes": str(split)}).partitions())
    assert 10 <= n(1_000) == n(10) < 25 and n(1 << 30) == len(bam.files_of(few))


def test_records_are_packed_together():
    """A batch gives the bytes of its rows one by one, wherever it is cut."""
    number = {n: i for i, (n, _) in enumerate(REFS)}
    rows = [dict(zip(FIELDS, r)) | {"nh": 2, "md": f"{i}A"} for i, r in enumerate(rows_of(200, 12, long_every=90))]
    for i, r in enumerate(rows):
        r["tags"] = None if i % 5 == 0 else r["tags"]
        if i % 7 == 0:
            r["seq"], r["qual"] = "*", None
    types = {"flag": pa.int32(), "start0": pa.int64(), "mapq": pa.int32(), "mate_start0": pa.int64(), "insert_size": pa.int32(), "tags": pa.list_(pa.string()), "nh": pa.int32()}
    whole = pa.RecordBatch.from_pylist(rows, pa.schema([(c, types.get(c, pa.string())) for c in [*FIELDS, "md", "nh"]]))
    data, size, ref, start, end = bam.pack_all(whole, number)
    assert data.tobytes() == b"".join(bam.pack(r, 0, number)[0] for r in rows) and size.sum() == len(data)
    assert bam.pack_all(whole.slice(33, 90), number)[0].tobytes() == data[size[:33].sum() : size[:123].sum()].tobytes()
    assert [r["chrom"] for r in rows] == [REFS[k][0] if k >= 0 else "*" for k in ref] and start.tolist() == [r["start0"] for r in rows]
    for bad in ({"qual": "I"}, {"flag": 70_000}, {"qname": "x" * 300}, {"qual": " " * 3}):
        with pytest.raises(ValueError):
            bam.pack({**rows[1], "seq": "ACG", "qual": "III"} | bad, 0, number)
    with pytest.raises(ValueError, match="damaged"):
        bam.Records(bam.Blocks(pa.BufferReader(b := bam.pack_block(struct.pack("<i", 5) * 9)), len(b), 0)).starts(1 << 40)
