"""Operators on hand-traced cases, against brute force, and by their properties."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from sitemill.functions.adapters import best_places
from sitemill.functions.lineage import SHUFFLES_GO, stored
from sitemill.operators import dedup, demux, filters, intervals, matrix, mutations, tracks
from sitemill.operators import pileup as P
from sitemill.plans import prep, sites

READ = "sample string, qname string, flag int, chrom string, start0 long, end0 long, strand string, mapq int, nh int, cigar string, md string, seq string, umi string, ord long"


def read(start, cigar, strand="+", *, end=None, name="r", flag=0, mapq=255, nh=1, md=None, seq=None, umi="ACG", order=0, sample="s"):
    return (sample, name, flag | (16 if strand == "-" else 0), "chr1", start, end, strand, mapq, nh, cigar, md, seq, umi, order)


def pile(spark, reads):
    return {(r["strand"], r["pos"]): (r["coverage"], r["truncations"], r["clean_truncations"], r["deletions"]) for r in P.pileup(spark.createDataFrame(reads, READ)).collect()}


def test_pileup_goldens(spark):
    got = pile(spark, [read(100, "30M")])
    assert got[("+", 99)] == (1, 1, 1, 0) and sorted(p for _, p in got) == list(range(99, 130))
    got = pile(spark, [read(100, "30M", "-")])
    assert got[("-", 130)] == (1, 1, 1, 0) and sorted(p for _, p in got) == list(range(100, 131))
    got = pile(spark, [read(100, "8M1D21M")])
    assert got[("+", 99)] == (1, 1, 0, 0) and got[("+", 108)] == (0, 0, 0, 1)
    got = pile(spark, [read(100, "10M100N12M")])
    assert sorted(p for _, p in got) == [*range(99, 110), *range(210, 222)] and all(v[3] == 0 for v in got.values())
    got = pile(spark, [read(0, "10M")])
    assert sorted(p for _, p in got) == list(range(10)) and all(v[1] == 0 for v in got.values())


def test_pileup_properties(spark):
    r = random.Random(3)
    reads = [read(r.randint(1, 200), r.choice(["20M", "8M1D12M", "6M4N10M"]), r.choice("+-"), order=i) for i in range(200)]
    got = P.pileup(spark.createDataFrame(reads, READ).repartition(5)).collect()
    assert sum(x["truncations"] for x in got) == 200
    assert all(x["clean_truncations"] <= x["truncations"] <= x["coverage"] for x in got)
    assert sum(x["coverage"] for x in got) == sum({"20M": 20, "8M1D12M": 20, "6M4N10M": 16}[x[9]] + 1 for x in reads)


def test_chromosome_end(spark):
    sizes = spark.createDataFrame([("chr1", 130)], "chrom string, length long")
    got = P.pileup(spark.createDataFrame([read(100, "30M", "-")], READ), sizes).collect()
    assert sum(x["truncations"] for x in got) == 0 and len(got) == 30


def test_substitutions_complement(spark):
    reads = [read(100, "30M", "-", md="5A24", seq="CCCCCG" + "C" * 24), read(0, "30M", md="5T24", seq="AAAAAC" + "A" * 24)]
    got = [tuple(x) for x in P.substitution_counts(spark.createDataFrame(reads, READ)).select("strand", "pos", "sub_type", "n").collect()]
    assert got == [("-", 105, "TC", 1)]


def test_background_fallback(spark):
    df = spark.createDataFrame([(10, 1 if i == 0 else 0) for i in range(200)], "coverage long, deletions long")
    assert P.background(df, "deletions").first()["lambda"] == pytest.approx(1 / 2000)
    df = spark.createDataFrame([(10, i % 5) for i in range(200)] + [(10, 10)], "coverage long, deletions long")
    assert P.background(df, "deletions").first()["lambda"] == pytest.approx(sum(i % 5 for i in range(200)) / 2000)
    assert P.background(df.limit(0), "deletions").first()["lambda"] == 0.0


def test_clusters(spark):
    df = spark.createDataFrame([("s", "c", "+", p, t, c) for p, t, c in ((10, 2, 5), (20, 0, 4), (45, 1, 6), (71, 1, 1))], "sample string, chrom string, strand string, pos long, clean_truncations long, coverage long")
    got = {r["pos"]: (r["cluster"], round(r["local_rate"], 6)) for r in P.cluster_rates(df).collect()}
    assert got == {10: (10, 0.2), 20: (10, 0.2), 45: (10, 0.2), 71: (71, 1.0)}  # named by their first position


def test_chunked_clusters_equal_plain_ones(spark):
    r = random.Random(1)
    rows = sorted({(r.choice("ab"), r.randint(0, 3000)) for _ in range(400)}) + [("c", p) for p in range(0, 900, 20)]
    df = spark.createDataFrame(rows, "k string, pos long")
    plain = intervals.gap_cluster(df, ["k"]).groupBy("k", "cluster").agg(F.sort_array(F.collect_list("pos")).alias("p"))
    want = {(x["k"], tuple(x["p"])) for x in plain.collect()}
    for chunk in (7, 50, 100_000):
        g = intervals.gap_cluster_chunked(df, ["k"], chunk=chunk).groupBy("k", "cluster").agg(F.sort_array(F.collect_list("pos")).alias("p"))
        assert {(x["k"], tuple(x["p"])) for x in g.collect()} == want


def test_tracks_in_chunks_equal_a_count_by_base(spark):
    r = random.Random(4)
    rows = [(r.choice("ab"), s, s + r.choice([0, 1, 5, 40, 300])) for s in (r.randint(0, 900) for _ in range(120))] + [("c", 3, 700), ("c", 650, 700), ("d", None, 4)]
    df = spark.createDataFrame(rows, "k string, start long, end long")
    depth = {}
    for k, s, e in rows:
        for p in range(s or 0, e if s is not None else 0):
            depth[k, p] = depth.get((k, p), 0) + 1
    for chunk in (7, 100, 10**6):
        got = sorted((x["k"], x["start"], x["end"], x["value"]) for x in intervals.depth_track(df, ["k"], chunk=chunk).collect())
        assert {(k, p): v for k, s, e, v in got for p in range(s, e)} == depth
        assert all(a[0] != b[0] or a[2] < b[1] or a[3] != b[3] for a, b in zip(got, got[1:], strict=False))  # nothing is left to join


def test_eclip_rules(spark):
    def check(mode, *headers):
        df = spark.createDataFrame(list(enumerate(headers)), "ord long, header string")
        return tuple(demux.check_eclip(df, mode).collect()[0])

    assert check("pe", "@ACGTN:r1 2:N:0", "x 2:N:0") == ("R2", "header_colon", 5, "ok")
    assert check("se", "r1 1:N:0") == ("R1", "sequence", 0, "ok")
    assert check("pe", "r1_ACGTACGT 2:N:0")[1:3] == ("header_underscore", 0)
    assert check("pe", "ACGT:r1 2:N:0")[1] == "sequence"  # four bases are too few
    assert check("pe", "ACGTACGTACG:r1 2:N:0")[1] == "sequence"  # eleven too many
    assert check("pe", "ACGTN:r1 1:N:0")[3] == "pe input is R2, not R1"
    assert check("se", "ACGTN:r1 1:N:0")[3] == "se input has the UMI in sequence, not in header_colon"
    assert check("se", "r1 1:N:0", "r2 2:N:0")[0] == "unknown"
    assert check("se", None, "r2 2:N:0")[0] == "unknown"
    assert demux.check_eclip(spark.createDataFrame([], "ord long, header string"), "pe").collect()[0]["mate"] == "unknown"
    with pytest.raises(ValueError):
        demux.check_eclip(spark.range(1).selectExpr("id AS ord", "'x' AS header"), "xx")


def test_peaks_of_each_group(spark):
    rows = [(g, "chr1", "+", 100, 120) for g in "aab" for _ in range(6)] + [("b", "chr1", "+", i, i + 20) for i in range(3000, 3900, 60)]
    df = spark.createDataFrame(rows, "grp string, chrom string, strand string, start long, end long")
    got = {(x["grp"], x["start"], x["score"]) for x in matrix.call_peaks(df, by=["grp"], pvalue=0.05).collect()}
    assert ("a", 100, 12) in got and ("b", 100, 6) in got


def test_interval_join(spark):
    r = random.Random(2)
    a = [(i, r.choice("xy"), s, s + r.randint(1, 900)) for i, s in enumerate(r.randint(0, 5000) for _ in range(80))]
    b = [(i, r.choice("xy"), s, s + r.randint(1, 3000)) for i, s in enumerate(r.randint(0, 5000) for _ in range(80))]
    left = spark.createDataFrame(a, "peak_id int, k string, start long, end long")
    right = spark.createDataFrame(b, "id int, k string, start long, end long")
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    for width in (100, 1000, 10**6):
        got = sorted((r["peak_id"], r["b_id"]) for r in intervals.overlap_pairs(left, right, ["k"], width).collect())
        assert got == want
    counts = {r["peak_id"]: r["n"] for r in intervals.overlap_counts(left, right, ["k"]).collect()}
    assert counts == {x[0]: sum(p == x[0] for p, _ in want) for x in a}


def test_tracks(spark):
    t = spark.createDataFrame([("A", 0, 10, 2.0), ("B", 5, 15, 4.0)], "sample string, start long, end long, value double").withColumns({"grp": F.lit("g"), "strand": F.lit("+"), "chrom": F.lit("c")})
    g = spark.createDataFrame([("A", "g"), ("B", "g")], "sample string, grp string")
    got = [(r["start"], r["end"], r["value"]) for r in tracks.group_track(t.drop("grp"), g).orderBy("start").collect()]
    assert got == [(0, 5, 1.0), (5, 10, 3.0), (10, 15, 2.0)]
    reads = spark.createDataFrame([read(100, "30M", end=130), read(100, "30M", "-", end=130), read(130, "5M", end=135), read(90, "5M9N5M", end=109)], READ)
    x = sorted((r["strand"], r["start"], r["end"], r["value"]) for r in tracks.crosslink_track(reads).collect())
    assert x == [("+", 90, 91, 1), ("+", 100, 101, 1), ("+", 130, 131, 1), ("-", 129, 130, 1)]
    rpm = tracks.rpm_track(reads, tracks.scale_factors(reads))
    assert sorted((r["strand"], r["start"], r["end"], r["value"]) for r in rpm.collect()) == [("+", 100, 135, 250_000.0), ("-", 100, 130, 250_000.0)]


def test_collapse(spark):
    df = spark.createDataFrame([("r1 x", "ACGT", "IIII", 0), ("r2", "ACGT", "FFFF", 1), ("r3", "GGGG", "IIII", 2)], "header string, seq string, qual string, ord long")
    got = sorted((r["name"], r["seq"], r["qual"]) for r in dedup.collapse_exact(df).collect())
    assert got == [("r1#2", "ACGT", "IIII"), ("r3#1", "GGGG", "IIII")]


def test_rescue(spark):
    unique = [read(1000 + d, "30M", name=f"u{d}") for d in (0, 10, 50)] + [read(2000, "30M", name="u")]
    multi = [
        read(1000, "30M", name="m", nh=2, flag=256, order=1),
        read(5000, "30M", name="m", nh=2, order=0),
        read(7000, "30M", name="t", nh=3, flag=256, order=0),
        read(8000, "30M", name="t", nh=3, flag=0, order=1),
        read(9000, "30M", name="f", nh=2, flag=256, order=0),
        read(9500, "30M", name="f", nh=2, flag=256 | 2048, order=1),
    ]
    starts = dedup.start_counts(spark.createDataFrame(unique, READ))
    got = {r["qname"]: (r["start0"], round(r["score"], 2), r["nh"], r["flag"]) for r in dedup.rescue_multimappers(spark.createDataFrame(multi, READ), starts).collect()}
    assert got == {"m": (1000, 3.1, 1, 0), "t": (8000, 0.1, 1, 0), "f": (9000, 0.1, 1, 0)}


def test_directional_networks(spark):
    counts = {"AAA": 10, "AAT": 5, "ATT": 3, "CCC": 4, "CCG": 4}
    reads = [read(100, "30M", end=130, umi=u, name=f"{u}{i}", order=i) for u, n in counts.items() for i in range(n)]
    reads += [read(100, "10M5N15M", end=130, umi="AAA", name="spliced")]
    got = sorted((r["umi"], r["reads"], r["spliced"]) for r in dedup.dedup_directional(spark.createDataFrame(reads, READ)).collect())
    # AAT joins AAA (10 >= 2*5-1), ATT joins through AAT (5 >= 2*3-1); CCG is as large as CCC
    assert got == [("AAA", 1, True), ("AAA", 18, False), ("CCC", 4, False), ("CCG", 4, False)]
    one = dedup.dedup_position(spark.createDataFrame(reads, READ)).collect()
    assert sorted(r["reads"] for r in one) == [1, 26]


def test_detect_umi(spark):
    d = lambda *n: tuple(dedup.detect_umi(spark.createDataFrame(list(zip(n, range(len(n)), strict=True)), "qname string, ord long")).first())
    assert d("a", "b#1#ACGT", "c#1#ACG", "d#ACG", "e#9") == (True, 3)
    assert d("b#1#ACGT", "c#1#ACG") == (True, 4) and d("a", "b#2") == (False, 0)


def test_substitution_sites_keep_their_type(spark):
    rows = [("A", "c", "+", 5, t, 3, 9, 0.3, 1e-4, 1e-3) for t in ("TC", "GA")]
    df = spark.createDataFrame(rows, "sample string, chrom string, strand string, pos long, sub_type string, signal long, coverage long, fraction double, pvalue double, qvalue double")
    assert [(r["sub_type"], r["name"]) for r in P.bed_sites(df, None).collect()] == [("GA", "GtoA:c:5:+"), ("TC", "TtoC:c:5:+")]
    assert P.bed_sites(df, "del").columns[0] == "sample"
    assert sites.parse_sub_types(["TTOC", "ttoc", "T>C", "xx"]) == ["TC", "TC", "TC"]


def test_human_chromosomes(spark):
    names = ["chr1", "chr01", "chr22", "chr23", "M", "chrM", "MT", "chrMT", "X", "chrX", "0", "05", "chr"]
    df = spark.createDataFrame([(x,) for x in names], "chrom string")
    assert {r[0] for r in df.where(filters.is_human_standard(F.col("chrom"))).collect()} == {"chr1", "chr01", "chr22", "chrM", "MT", "chrMT", "X", "chrX", "05"}


def test_filters(spark):
    reads = [read(1, "5M"), read(1, "5M", flag=4), read(1, "5M", flag=256), read(1, "5M", flag=2048), read(1, "*"), read(1, "5M", mapq=20, nh=1), read(1, "5M", mapq=20, nh=3), read(1, "5M", mapq=20, nh=None)]
    df = spark.createDataFrame(reads, READ)
    assert filters.pileup_reads(df).count() == 1 and filters.pileup_reads(df, 20).count() == 3
    assert filters.unique_reads(df).count() == 6 and filters.multimapped_reads(df).count() == 1
    c = lambda *n: spark.createDataFrame([(x,) for x in n], "chrom string")
    keep = lambda d: sorted(r["chrom"] for r in filters.canonical_chromosomes(d).collect())
    assert keep(c("chr1", "chrX", "chrM", "chrMT", "chrUn_1", "5")) == ["chr1", "chrM", "chrX"]
    assert keep(c("1", "MT", "KI27")) == ["1", "MT"] and keep(c("contig1", "contig2")) == ["contig1", "contig2"]


def test_barcodes(spark):
    b = lambda *s: spark.createDataFrame([(f"s{i}", x, i) for i, x in enumerate(s)], "sample string, barcode string, ord int")
    assert demux.barcode_collisions(b("AAAA", "AAAT"), 1).collect()[0]["variant"] == "AAAN"
    assert demux.barcode_collisions(b("AAAA", "AATT"), 1).count() == 0
    assert "AANN" in {r["variant"] for r in demux.barcode_collisions(b("AAAA", "AATT"), 2).collect()}
    assert demux.barcodes_too_near(b("AAAA", "AATT", "CCCC"), 2).count() == 1
    reads = spark.createDataFrame([("AAAAGG",), ("AATAGG",), ("GGGGGG",), ("CCCCAA",), ("TCCCCA",)], "seq string")
    got = [(r["seq"], r["sample"], r["errors"]) for r in demux.demultiplex(reads, b("AAAA", "CCCC"), 1, search=0).collect()]
    assert got == [("AAAAGG", "s0", 0), ("AATAGG", "s0", 1), ("GGGGGG", "unknown", None), ("CCCCAA", "s1", 0), ("TCCCCA", "s1", 1)]
    assert demux.demultiplex(reads.limit(5), b("CCCC"), 0, 1).where("sample = 's0'").count() == 2
    anywhere = spark.createDataFrame([("GGAAAAGG",), ("CCCGGGGG",), ("TGGCACCG",), ("GGGGGCCC",), ("",), (None,)], "seq string")
    got = [(r["seq"], r["sample"], r["barcode_start"], r["errors"]) for r in demux.demultiplex(anywhere, b("AAAA", "ACCC"), 1).collect()]
    assert got == [("GGAAAAGG", "s0", 2, 0), ("CCCGGGGG", "s1", 0, 0), ("TGGCACCG", "s1", 4, 1), ("GGGGGCCC", "s1", 4, 1)]
    assert demux.error_rate(b("AAAA", "CC"), 1) == 0.25


def test_places_against_brute_force():
    rng = random.Random(5)
    word = lambda n, letters="ACGT": "".join(rng.choice(letters) for _ in range(n))
    for _ in range(200):
        adapter, front, rate, least = word(rng.randint(1, 8), "ACGTN"), rng.random() < 0.5, rng.choice((0, 0.1, 0.25, 0.4)), rng.randint(1, 4)
        reads = [word(rng.randint(0, 20)) for _ in range(10)]
        score, place, errors = best_places([r.encode() for r in reads], adapter.encode(), rate, least, front)
        for i, read in enumerate(reads):
            best = (-1, 0, 0)
            for p in range(-len(adapter), len(read) + 1):
                pairs = [(a, read[p + j]) for j, a in enumerate(adapter) if 0 <= p + j < len(read)]
                if (p + len(adapter) > len(read)) if front else p < 0:
                    continue
                wrong = sum(a not in ("N", x) for a, x in pairs)
                if len(pairs) >= min(least, len(adapter)) and wrong <= int(rate * sum(a != "N" for a, _ in pairs) + 1e-9) and len(pairs) - 2 * wrong > best[0]:
                    best = (len(pairs) - 2 * wrong, p, wrong)
            assert score[i] == best[0]
            if best[0] >= 0:
                assert (place[i], errors[i]) == best[1:]


def test_groups(spark):
    g = spark.createDataFrame([("a", "x"), ("a-1", "y")], "sample string, grp string")
    df = spark.createDataFrame([("a",), ("a-1",), ("b",)], "sample string")
    assert {r["sample"]: r["grp"] for r in demux.assign_groups(df, g).collect()} == {"a": "x", "a-1": "y", "b": "b"}
    assert demux.assign_groups(df, g, fallback=False).count() == 2


def test_matrix_golden(spark):
    counts = spark.createDataFrame([(1, "s1", 0), (1, "s2", 4)], "peak_id int, sample string, tc long")
    groups = spark.createDataFrame([("s1", "g"), ("s2", "g")], "sample string, grp string")
    scales = spark.createDataFrame([("s1", 2.0), ("s2", 0.5)], "sample string, scale double")
    r = matrix.group_counts(counts, groups, scales).first()
    assert (r["bc"], r["tc"], r["normed"]) == (1, 4, 2.0)
    cols = ["peak_id", "chrom", "Cov_x", "TRUNC_a", "BC_g", "NormedTC_a", "TC_a"]
    assert matrix.matrix_order(cols) == ["peak_id", "chrom", "NormedTC_a", "BC_g", "TRUNC_a", "Cov_x"]
    assert matrix.matrix_order(cols, True)[2] == "TC_a"


def test_peaks(spark):
    rows = [("chr1", "+", 1000 + i % 5, 1020 + i % 5) for i in range(40)] + [("chr1", "+", 10_000 + 97 * i, 10_020 + 97 * i) for i in range(20)]
    reads = spark.createDataFrame(rows, "chrom string, strand string, start long, end long")
    got = matrix.call_peaks(reads).collect()
    assert len(got) == 1 and got[0]["start"] <= 1012 <= got[0]["end"]
    track = spark.createDataFrame([("c", "+", 0, 10, 5.0), ("c", "+", 10, 20, 0.4), ("c", "+", 20, 30, 6.0), ("c", "+", 200, 210, 1.0)], "chrom string, strand string, start long, end long, value double")
    assert sorted((r["start"], r["end"]) for r in matrix.valley_peaks(track).collect()) == [(0, 10), (20, 30), (200, 210)]


def test_mutation_rates(spark):
    tags = spark.createDataFrame([(f"t{i}", "c", "+", 100, 130) for i in range(20)], "qname string, chrom string, strand string, start long, end long")
    hot = spark.createDataFrame([(f"t{i}", "c", "+", 110) for i in range(15)], "qname string, chrom string, strand string, pos long")
    got = mutations.permuted_mutations(tags, hot, iterations=20).collect()
    assert len(got) == 1 and got[0]["k"] == 20 and got[0]["m"] == 15 and got[0]["fdr"] < 0.05
    again = mutations.permuted_mutations(tags.repartition(3), hot.repartition(2), iterations=20).collect()
    assert again[0]["fdr"] == got[0]["fdr"]


def test_mutation_rates_by_kind_and_of_long_tags(spark):
    """Kinds have the rates that each has alone; tags are counted at mutations only, not at each of their bases."""
    r = random.Random(4)
    tags = [(f"t{i}", r.choice("cd"), "+", s, s + 30) for i, s in enumerate(r.randint(99_900, 100_100) for _ in range(300))]
    at = [(q, c, "+", s + r.randrange(30), r.choice(("del", "sub"))) for q, c, _, s, _ in tags]
    names = "qname string, chrom string, strand string"
    t, m = spark.createDataFrame(tags, f"{names}, start long, end long"), spark.createDataFrame(at, f"{names}, pos long, mut_type string")
    both = mutations.permuted_mutations(t, m, by=["mut_type"])
    for kind in ("del", "sub"):
        alone = {tuple(x) for x in mutations.permuted_mutations(t, m.where(F.col("mut_type") == kind)).collect()}
        assert {tuple(x) for x in both.where(F.col("mut_type") == kind).drop("mut_type").collect()} == alone
        seen = [(c, p) for _, c, _, p, x in at if x == kind]
        assert {x[:5] for x in alone} == {(c, "+", p, sum(a == c and s <= p < e for _, a, _, s, e in tags), seen.count((c, p))) for c, p in seen}
    long = spark.createDataFrame([(f"t{i}", "c", "+", 10, 3_000_000_000) for i in range(3)], f"{names}, start long, end long")
    got = mutations.permuted_mutations(long, spark.createDataFrame([("t0", "c", "+", 2_500_000_000)], f"{names}, pos long")).collect()
    assert [(x["k"], x["m"]) for x in got] == [(3, 1)]


def _shuffled(spark, df):
    """Records that all stages of a run of ``df`` wrote to shuffles."""
    store, jvm = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    stages = lambda: store.stageList(None, False, False, jvm.new_array(spark.sparkContext._jvm.double, 0), None)
    before = {stages().apply(i).stageId() for i in range(stages().size())}
    df.write.format("noop").mode("overwrite").save()
    new = stages()
    return sum(s.shuffleWriteRecords() for s in (new.apply(i) for i in range(new.size())) if s.stageId() not in before)


def test_steps_inside_a_chunk_are_dealt_no_further(spark):
    df = spark.createDataFrame([("k", 30 * i, 30 * i + 20) for i in range(3000)], "k string, start long, end long")
    assert _shuffled(spark, intervals.depth_track(df, ["k"])) < 2.2 * 6000  # two shuffles of what begins and ends


def test_coverage_of_samples_deals_each_peak_once(spark):
    """Peaks are not repeated for each sample before the join; a sample that meets no peak has zeros."""
    peaks = spark.createDataFrame([(i, "c", "+", 100 * i, 100 * i + 50) for i in range(2000)], "peak_id long, chrom string, strand string, start long, end long")
    rows = [(f"s{j}", "c", "+", 100 * j, 100 * j + 10, float(j)) for j in range(30)] + [("far", "d", "+", 0, 5, 1.0)]
    got = matrix.coverage_stats(peaks, spark.createDataFrame(rows, "sample string, chrom string, strand string, start long, end long, value double"))
    assert _shuffled(spark, got) < 70_000  # the rows of the result, once
    seen = got.collect()
    assert len(seen) == 31 * 2000 and {(r["peak_id"], r["sample"], r["cov_max"]) for r in seen if r["cov_max"]} == {(j, f"s{j}", float(j)) for j in range(1, 30)}
    assert all(r["cov_sum"] == r["cov_mean"] == r["cov_max"] for r in seen)


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        every = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (every.apply(i).getName() for i in range(every.size())) if n.startswith("shuffle_")}

    before = files()
    t = stored(spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").agg(F.count("*").alias("n")))
    for _ in range(50):  # files go in the background
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and spark.conf.get(SHUFFLES_GO) == "false" and t.agg(F.sum("n")).first()[0] == 1000


def test_preprocessing(spark):
    reads = spark.createDataFrame([("r1/1", "AACCC" + "G" * 20, "I" * 25), ("r2", "AACCC" + "G" * 10, "I" * 15), ("r3", "AACCC" + "G" * 20, "#" * 25)], "name string, seq string, qual string")
    got = prep.standard(reads, umi=2, barcode=3).collect()
    assert [(r["name"], r["seq"]) for r in got] == [("r1#AA", "G" * 20)]
    e = spark.createDataFrame([("ACGTA:r1 2:N", "G" * 25, "I" * 25, 0), ("ACGTA:r2 2:N", "G" * 25, "I" * 25, 1)], "header string, seq string, qual string, ord long")
    got = prep.eclip_single(e, 5).collect()
    assert [(r["name"], r["seq"], r["count"]) for r in got] == [("r1#2#ACGTA", "G" * 25, 2)]
    p = prep.parclip(spark.createDataFrame([("r", "NN" + "A" * 20, "I" * 22, 0)], "header string, seq string, qual string, ord long")).collect()
    assert p[0]["seq"] == "A" * 20


def test_analysis_of_a_batch(spark):
    r = random.Random(9)
    reads = [read(1000, "30M", sample=s, name=f"{s}{i}") for s in "ab" for i in range(40)]
    reads += [read(r.randint(950, 1040), "30M", sample=s, name=f"{s}x{i}") for s in "ab" for i in range(60)]
    df = spark.createDataFrame(reads, READ)
    out = sites.analyse(df)
    assert {(x["sample"], x["start"]) for x in out["truncations"].collect()} >= {("a", 999), ("b", 999)}
    pooled = sites.analyse(df, spark.createDataFrame([("a", "g"), ("b", "g")], "sample string, grp string"), no_subs=True)
    assert {x["sample"] for x in pooled["truncations"].collect()} == {"g"}
    assert out["crosslinks"].where("start = 999").first()["score"] >= 40


def test_insertions_of_reads(spark):
    reads = [read(100, "5M2I10M3D4M1I2M", seq="AAAAACGAAAAAAAAAAAAAATAA", name="f", md="15^AAA6"), read(50, "2S8M3I9M", strand="-", seq="TTAAAAAAAAACGAAAAAAAAA", name="r", md="17"), read(70, "20M", name="n", md="20", seq="A" * 20)]
    got = mutations.mutation_list(spark.createDataFrame(reads, READ))
    rows = sorted((r["qname"], r["pos"], r["alt"]) for r in got.where("mut_type = 'ins'").collect())
    assert rows == [("f", 105, "CG"), ("f", 122, "T"), ("r", 58, "CGT")]
    assert sorted(r["pos"] for r in got.where("mut_type = 'del'").collect()) == [115, 116, 117]


def test_umi_length_of_headers_against_a_given_one(spark):
    heads = spark.createDataFrame([(f"ACGTAC:r{i} 2:N:0", i) for i in range(5)], "header string, ord long")
    assert demux.check_eclip(heads, "pe", umi_length=10).first()["warning"] == "UMI of 10 given, of 6 in the headers"
    assert demux.check_eclip(heads, "pe", umi_length=6).first()["warning"] is None
    assert "warning" not in demux.check_eclip(heads, "pe").columns


def test_valley_peaks_of_a_long_run(spark):
    """One run of 150,000 steps over chunk ends: the same peaks as a walk, in time that does not grow with its square."""
    import time

    depth = [1 + (i * i * 7919 % 50) if i % 40 > 3 else (i // 40) % 3 for i in range(150_000)]
    left, best = [], 0
    for v in depth:
        left.append(best := max(best, v))
    right, best = [], 0
    for v in reversed(depth):
        right.append(best := max(best, v))
    want, part = [], None
    for i, (v, a, b) in enumerate(zip(depth, left, reversed(right), strict=True)):
        if v < (1 - 0.9) * min(a, b):
            part = None
        elif part is None:
            want.append(part := [i * 10, i * 10 + 10, v, i * 10])
        else:
            part[1] = i * 10 + 10
            if v > part[2]:
                part[2:] = v, i * 10
    steps = spark.range(150_000).select(F.lit("c").alias("chrom"), F.lit("+").alias("strand"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 10).alias("end"))
    low = F.floor(F.col("start") / 400) % 3
    value = F.when(F.col("start") / 10 % 40 > 3, 1 + F.pmod(F.col("start") / 10 * (F.col("start") / 10) * 7919, F.lit(50))).otherwise(low).cast("long")
    began = time.monotonic()
    got = matrix.valley_peaks(steps.withColumn("value", value)).select("start", "end", "score", "top").orderBy("start").collect()
    assert time.monotonic() - began < 60
    assert [list(r) for r in got] == want


def test_cluster_numbers_in_chunks(spark):
    rows = [(k, p) for k in ("a", "b", None) for p in (1, 20, 60, 61, 99, 100, 130, 155, 180, 350, 351, 900)]
    df = spark.createDataFrame(rows, "k string, pos long")
    plain = intervals.gap_cluster(df, ["k"]).collect()
    for chunk in (7, 50, 100, 10_000):
        assert sorted(map(str, intervals.gap_cluster(df, ["k"], chunk=chunk).collect())) == sorted(map(str, plain))
        c = intervals.gap_cluster_chunked(df.withColumn("n", F.col("pos") % 7), ["k"], chunk=chunk, sums=["n"])
        totals = c.groupBy("k", "cluster").agg(F.sum("n").alias("own"), F.min("sum_n").alias("a"), F.max("sum_n").alias("b")).collect()
        assert all(r["own"] == r["a"] == r["b"] for r in totals)


def _plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[-1]


def test_positions_of_a_pileup_are_not_shuffled(spark):
    plan = _plan(P.pileup(spark.createDataFrame([read(100, "10M2D5M", order=1)], READ)))
    assert 0 <= plan.index("explode(sequence") < plan.index("Exchange")


def test_pileup_over_a_chunk_end(spark):
    end = intervals.CHUNK
    rows = [read(end - 5, "10M"), read(end - 5, "4M2D6M", strand="-", end=end + 7), read(end, "3M"), read(end - 3, "3M", strand="-", end=end), read(0, "2M")]
    got = {(r["strand"], r["pos"]): (r["coverage"], r["truncations"], r["clean_truncations"], r["deletions"]) for r in P.pileup(spark.createDataFrame(rows, READ)).collect()}
    plus = {("+", p): [0, 0, 0, 0] for p in [0, 1, *range(end - 6, end + 5)]}
    minus = {("-", p): [0, 0, 0, 0] for p in range(end - 5, end + 8)}
    for s, e in ((end - 5, end + 5), (end, end + 3), (0, 2)):
        for p in range(s, e):
            plus["+", p][0] += 1
    for p in (end - 6, end - 1):
        plus["+", p] = [plus["+", p][0] + 1, 1, 1, 0]
    for p in [*range(end - 5, end - 1), *range(end + 1, end + 7), *range(end - 3, end)]:
        minus["-", p][0] += 1
    minus["-", end - 1][3] = minus["-", end][3] = 1
    minus["-", end + 7] = [1, 1, 0, 0]
    minus["-", end] = [1, 1, 1, 1]
    assert got == {k: tuple(v) for k, v in (plus | minus).items()}


def test_no_window_of_a_whole_cluster(spark):
    """A run of near positions can be a whole chromosome."""
    piles = spark.createDataFrame([("s", "c", "+", 5, 9, 1)], "sample string, chrom string, strand string, pos long, coverage long, clean_truncations long")
    assert not any("cluster#" in line for line in _plan(P.cluster_rates(piles)).splitlines() if "Window [" in line)


def test_groups_and_scales_are_broadcast(spark):
    """A join that shuffles by sample or group would bring all of one to a task."""
    groups = spark.createDataFrame([("s", "g")], "sample string, grp string")
    rows = spark.createDataFrame([read(100, "10M")], READ)
    assert "SortMergeJoin" not in _plan(demux.assign_groups(rows, groups))
    track = tracks.rpm_track(rows, tracks.scale_factors(rows))
    assert "SortMergeJoin" not in _plan(track) and "SortMergeJoin" not in _plan(tracks.group_track(track, groups))


def test_reference_of_many_slices(spark):
    """60,000 slices of a sequence of six million bases: each taken from the whole would read it all."""
    import time

    from sitemill.functions.alignment import with_md

    ref = spark.range(1).select(F.lit("chr1").alias("name"), F.expr("repeat('ACGTTGCAAC', 600000)").alias("seq"))
    rows = spark.createDataFrame([read(5_999_985, "12M", seq="GCAACACGTTGA", order=1), read(95, "10M", seq="GCAACACGTT", order=2)], READ)
    began = time.monotonic()
    got = {r["ord"]: (r["md"], r["nm"]) for r in with_md(rows, ref, 100).collect()}
    assert time.monotonic() - began < 60
    assert got == {1: ("11C0", 1), 2: ("10", 0)}
