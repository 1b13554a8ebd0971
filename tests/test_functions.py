"""Column functions and plain helpers on hand-traced cases."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from sitemill.functions import names as N
from sitemill.functions import stats as S
from sitemill.functions.alignment import cigar_blocks, mismatches, reference_length, truncation_site
from sitemill.plans.config import Settings, layout
from sitemill.plans.sites import parse_sub_types


def rows(spark, cols, data, *exprs):
    return [tuple(r) for r in spark.createDataFrame(data, cols).select(*exprs).collect()]


def test_cigar_blocks(spark):
    cases = [
        ("8M1D21M", 100, [("M", 100, 108), ("D", 108, 109), ("M", 109, 130)], 30),
        ("5S10M100N12M2I3M", 100, [("M", 100, 110), ("M", 210, 222), ("M", 222, 225)], 125),
        ("30M", 0, [("M", 0, 30)], 30),
        ("3H2=1X4M2P", 7, [("M", 7, 9), ("M", 9, 10), ("M", 10, 14)], 7),
    ]
    got = rows(spark, "c string, s long", [(c, s) for c, s, _, _ in cases], cigar_blocks(F.col("c"), F.col("s")), reference_length(F.col("c")))
    assert [([tuple(b) for b in g], n) for g, n in got] == [(b, n) for _, _, b, n in cases]


def test_truncation_site(spark):
    got = rows(spark, "t string, s long, e long", [("+", 100, 130), ("-", 100, 130), ("+", 0, 5)], truncation_site(F.col("t"), F.col("s"), F.col("e")))
    assert got == [(99,), (130,), (-1,)]


def test_mismatches():
    assert list(mismatches("5T24", "30M", "AAAAAC" + "A" * 24, 100)) == [(105, "T", "C")]
    assert list(mismatches("8^A21", "8M1D21M", "A" * 29, 0)) == []
    assert list(mismatches("3G5C1", "2S4M10N7M", "NNAAATAAAAAGA", 10)) == [(13, "G", "T"), (29, "C", "G")]
    assert list(mismatches("0A0N1", "3M", "CGT", 5)) == [(5, "A", "C")]
    assert list(mismatches("2T1", "2M1I2M", "AAGTC", 0)) == []  # the base equals the reference


def test_names(spark):
    n = F.col("n")
    got = rows(spark, "n string", [("R1#4#ACGTN",), ("R1#4",), ("R1#ACG",), ("R1",), ("R1#2#AX",)], N.name_id(n), N.name_count(n), N.name_umi(n))
    assert got == [("R1", 4, "ACGTN"), ("R1", 4, None), ("R1", 1, "ACG"), ("R1", 1, None), ("R1", 2, None)]
    got = rows(spark, "n string", [("a/1",), ("a/2#5",), ("a/2 x",), ("a/12",)], N.strip_mate(n))
    assert [x for (x,) in got] == ["a", "a#5", "a x", "a/12"]
    got = rows(spark, "n string", [("/x/S1.fastq.gz",), ("S2_collapsed.fq",), ("S3",)], N.sample_name(n))
    assert [x for (x,) in got] == ["S1", "S2", "S3"]


def test_umi_moves(spark):
    got = rows(spark, "h string, s string, q string", [("@ACGTA:RID 2:N:0", "GG", "FF"), ("@RID 2:N:0", "GG", "FF")], *N.umi_to_sequence(F.col("h"), F.col("s"), F.col("q"), 5))
    assert got == [("@RID 2:N:0", "ACGTAGG", "IIIIIFF"), ("@RID 2:N:0", "GG", "FF")]
    got = rows(spark, "n string, s string, q string", [("r", "AACCCGGTTT", "0123456789")], *N.trim_layout(F.col("n"), F.col("s"), F.col("q"), 2, 3, 2))
    assert got == [("r#AA", "TTT", "789")]
    got = rows(spark, "n string, s string, q string", [("r", "AACCCGGTTT", "0123456789")], *N.trim_layout(F.col("n"), F.col("s"), F.col("q"), 3, 2, 2, True))
    assert got == [("r#CCC", "TTT", "789")]


def test_quality_and_distance(spark):
    got = rows(spark, "q string", [("IIII",), ("!I",), ("",)], N.mean_quality(F.col("q")), N.cut_tail(F.col("q")))
    assert got == [(40.0, 4), (20.0, 2), (None, 0)]
    assert rows(spark, "q string", [("IIIIII!!!!!!",)], N.cut_tail(F.col("q"))) == [(9,)]
    got = rows(spark, "a string, b string", [("ACGT", "ACGA"), ("A", "AC"), ("ACGT", "TGCA")], N.hamming(F.col("a"), F.col("b")))
    assert got == [(1,), (None,), (4,)]


def test_adapters(spark):
    got = rows(spark, "s string", [("TTTTAGATCGG",), ("TTTTAGATC",), ("TTTT",), ("TTTTAGCTCGGAA",)], N.adapter_cut(F.col("s"), "AGNTCGG"))
    assert [x for (x,) in got] == [4, 4, 4, 4]


def test_repeat_names(spark):
    got = rows(spark, "n string", [("AluSx#SINE/Alu",), ("MER#DNA",), ("tRNA-Ala-1",), ("U13369.1",)], *N.repeat_parts(F.col("n")))
    assert got == [("AluSx", "SINE", "SINE/Alu"), ("MER", "DNA", "DNA"), ("tRNA-Ala-1", "tRNA", "tRNA"), ("U13369.1", "rRNA", "rRNA/rDNA")]


def exact_tail(k, n, p):
    return math.fsum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1))


@pytest.mark.parametrize("deep", [False, True])
def test_binomial_tail(spark, deep):
    cases = [(3, 5, 0.2), (1, 1, 0.5), (10, 400, 0.001), (7, 7, 0.9), (50, 60, 0.4), (2, 1000, 0.0001)]
    odd = [(0, 5, 0.2, 1.0), (3, 5, 0.0, 0.0), (3, 5, 1.0, 1.0), (6, 5, 0.5, 0.0)]
    f = S.binom_sf_deep if deep else S.binom_sf
    got = rows(spark, "k long, n long, p double", [*cases, *[o[:3] for o in odd]], f(F.col("k"), F.col("n"), F.col("p")))
    for (x,), (k, n, p) in zip(got, cases, strict=False):
        assert x == pytest.approx(exact_tail(k, n, p), rel=1e-10)
    assert [x for (x,) in got[len(cases) :]] == [o[3] for o in odd]
    assert got[0][0] == pytest.approx(0.05792)


def test_bh_adjust(spark):
    df = spark.createDataFrame([(p,) for p in (0.02, 0.5, 0.01, 0.03)], "pvalue double").withColumn("f", F.lit(1))
    want = {0.01: 0.04, 0.02: 0.04, 0.03: 0.04, 0.5: 0.5}
    for d in (S.bh_adjust(df, ["f"]), S.bh_adjust(df.repartition(3), ["f"]), S.bh_adjust_ranged(df)):
        assert {r["pvalue"]: r["qvalue"] for r in d.collect()} == pytest.approx(want)


def test_bh_adjust_families_and_ties(spark):
    r = random.Random(5)
    cells = [(r.choice("ab"), r.choice([1.0, 0.0, 0.25, 1e-200, 10 ** r.uniform(-12, 0), r.random()]), i) for i in range(600)] + [("c", None, -1), ("c", 0.7, -2)]
    df = spark.createDataFrame(cells, "f string, pvalue double, i int").repartition(5)
    for few in (S.FEW_VALUES, 0):  # ranked at once, and in ranges
        got = {x["i"]: x["qvalue"] for x in S.bh_adjust(df, ["f"], few=few).collect()}
        for f in "abc":
            ps = sorted((p, i) for g, p, i in cells if g == f and p is not None)
            least = 1.0
            for rank in range(len(ps), 0, -1):
                p, i = ps[rank - 1]
                least = min(least, p * len(ps) / rank)
                assert got[i] == pytest.approx(least, rel=1e-12)
        assert got[-1] is None and len(got) == len(cells)
        assert S.bh_adjust(df.limit(0), ["f"], few=few).collect() == []


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_weighted_quantile(spark, bins):
    r = random.Random(bins)
    groups = {
        "ties": [(0.0, 900), (0.5, 3), (1.0, 1)],
        "one": [(0.25, 1)],
        "many": [(r.random(), r.randint(1, 4)) for _ in range(300)],
        "wide": [(10 ** r.uniform(-300, 300), 1) for _ in range(50)],
        "below": [(-r.random() * 5, r.randint(1, 3)) for _ in range(40)],
        None: [(1.0, 2), (2.0, 2)],
    }
    cells = [(g, v, w) for g, x in groups.items() for v, w in x] + [("none", None, 4), ("none", 3.0, 0), ("one", None, 9)]
    df = spark.createDataFrame(cells, "g string, v double, w int").repartition(3)
    for at in (0.99, 0.5, 0.0, 1.0, 0.37):
        got = {x["g"]: x["quantile"] for x in S.weighted_quantile(df.withColumn("g", F.coalesce("g", F.lit("?"))), "v", "w", ["g"], at, bins).collect()}
        assert set(got) == {g or "?" for g in groups}
        for g, x in groups.items():
            rows_ = sorted(v for v, w in x for _ in range(w))
            spot = (len(rows_) - 1) * at
            a, b = rows_[math.floor(spot)], rows_[math.ceil(spot)]
            assert got[g or "?"] == pytest.approx(a + (b - a) * (spot - math.floor(spot)), rel=1e-12)
    assert S.weighted_quantile(df.limit(0), "v", "w", [], 0.5).count() == 0
    assert S.weighted_quantile(df.where("g = 'many'"), "v", "w", [], 1.0).first()[0] == max(v for v, _ in groups["many"])


def test_scores(spark):
    got = rows(spark, "q double", [(0.04,), (0.0,), (1.0,)], S.site_score(F.col("q")))
    assert [x for (x,) in got] == [139, 1000, 0]
    got = rows(spark, "m double", [(3.0,), (30_000_000.0,)], S.truncate6(F.lit(1e6) / F.col("m")))
    assert [x for (x,) in got] == [333333.333333, 0.033333]


def test_settings():
    s = Settings.from_strings({"umi_length": "9", "multi_map": "yes", "fdr": "0.1", "filter_chromosomes": "n"})
    assert s.diff_vs_default() == {"umi_length": 9, "multi_map": True, "fdr": 0.1, "filter_chromosomes": False}
    assert s.to_cli() == ["--umi-length", "9", "--multi-map", "--no-filter-chromosomes", "--fdr", "0.1"]
    with pytest.raises(KeyError):
        Settings.from_strings({"nothing": "1"})
    with pytest.raises(ValueError):
        Settings.from_strings({"umi_length": "x"})
    assert layout("r")["matrix"] == "r/07_matrix" and layout("r", False)["matrix"] == "r/06_matrix"


def test_sub_types():
    assert parse_sub_types(["TC", "T>C", "TtoC", "XX"]) == ["TC", "TC", "TC"]
    assert parse_sub_types(None) is None and parse_sub_types(["QQ"]) is None


def test_binomial_tail_of_a_wide_cluster(spark):
    """An even share of two thousand million positions: few terms count, and no list of all is made."""
    rows = [(k, 2_000_000_000, m / 2e9) for m in (0.3, 2.0, 900.0) for k in (1, 2, 5, 40, 950)]
    got = spark.createDataFrame(rows, "k long, n long, p double").select("k", "n", "p", S.binom_sf(F.col("k"), F.col("n"), F.col("p")).alias("x")).collect()
    for x in got:
        k, n, p = x["k"], x["n"], x["p"]
        logs = [sum(math.log((n - k + i) / i) for i in range(1, k + 1)) + k * math.log(p) + (n - k) * math.log1p(-p)]
        for i in range(k + 1, k + 4000):
            logs.append(logs[-1] + math.log((n - i + 1) / i * p / (1 - p)))
        assert x["x"] == pytest.approx(math.exp(max(logs)) * math.fsum(math.exp(v - max(logs)) for v in logs), rel=1e-9)
