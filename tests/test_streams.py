"""Deduplication over a stream: any split into batches, and a restart, give the rows of one table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sitemill.functions.names import name_umi
from sitemill.operators import dedup
from sitemill.streaming import batches as B

LINES = [
    (f"r{i}#{umi}", flag, pos, mapq)
    for i, (umi, flag, pos, mapq) in enumerate([("ACGT", 0, 101, 60), ("ACGT", 0, 101, 10), ("ACGA", 0, 101, 60), ("TTTT", 0, 101, 60), ("ACGT", 16, 90, 5), ("ACGT", 16, 90, 60), ("ACGT", 0, 101, 60), ("GGGG", 0, 500, 1)] * 3)
]


def files(folder, lines, size):
    folder.mkdir(exist_ok=True)
    start = len(list(folder.iterdir()))
    for k in range(0, len(lines), size):
        text = "".join(f"{n}\t{f}\tchr1\t{p}\t{q}\t20M\t*\t0\t0\t{'A' * 20}\t*\tNH:i:1\n" for n, f, p, q in lines[k : k + size])
        (folder / f"part{start + k // size:03d}.sam").write_text(text)


def one_sample(stream):
    return stream.withColumn("sample", F.lit("s")).withColumn("umi", name_umi(F.col("qname")))


def plain(df):
    return sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())


@pytest.mark.parametrize("size,at_once", [(1, 5), (5, 1), (24, 1)])
def test_any_split_and_a_restart(spark, tmp_path, size, at_once):
    go = lambda: B.keep_umi_sums(one_sample(B.stream_sam(spark, str(tmp_path / "in"), at_once)), str(tmp_path / "sums"), str(tmp_path / "state")).awaitTermination(200)
    files(tmp_path / "in", LINES[:10], size)
    go()
    files(tmp_path / "in", LINES[10:], size)
    go()  # goes on from its checkpoint
    from sitemill.sources.readers import read_sam

    whole = dedup.dedup_directional(one_sample(read_sam(spark, str(tmp_path / "in"))))
    got = B.streamed_dedup(spark, str(tmp_path / "sums"))
    assert plain(got) == plain(whole.select(*got.columns)) and got.agg(F.sum("reads")).first()[0] == len(LINES)
