"""Peak calling and the peak by sample matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import settled, stored
from .intervals import join_null_safe, local_runs, overlap_counts, overlap_values, run_edges, with_run_edges

STRANDED = ["chrom", "strand"]
BASE = ["peak_id", "chrom", "start", "end", "name", "score", "strand"]
#: Order of column groups; others come last.
PREFIXES = ("TC_", "NormedTC_", "BC_", "DEL_", "SUB_", "TRUNC_", "BG")


def peak_counts(peaks: DataFrame, reads: DataFrame) -> DataFrame:
    """Long matrix (peak columns, sample, tc): aligned blocks over each peak on its strand."""
    return overlap_counts(peaks, reads.select("sample", *STRANDED, "start", "end"), STRANDED, ["sample"], name="tc")


def normed_counts(counts: DataFrame, scales: DataFrame) -> DataFrame:
    """Adds normed: count times the sample's scale, four decimals; a missing scale is one."""
    s = scales.select("sample", "scale")
    return counts.join(s, "sample", "left").withColumn("normed", F.round(F.col("tc") * F.coalesce("scale", F.lit(1.0)), 4)).drop("scale")


def group_counts(counts: DataFrame, groups: DataFrame, scales: DataFrame) -> DataFrame:
    """(peak_id, grp, bc, tc, normed): samples with reads, summed reads, summed scaled reads.

    Samples without a group take no part; those without a scale add nothing to normed.
    """
    g = counts.join(groups.select("sample", "grp").distinct(), "sample").join(scales.select("sample", "scale"), "sample", "left")
    return g.groupBy("peak_id", "grp").agg(
        F.sum((F.col("tc") > 0).cast("long")).alias("bc"), F.sum("tc").alias("tc"), F.round(F.sum(F.col("tc") * F.coalesce("scale", F.lit(0.0))), 4).alias("normed")
    )


def coverage_stats(peaks: DataFrame, tracks: DataFrame, by: str = "sample") -> DataFrame:
    """(peak_id, by, cov_sum, cov_mean, cov_max) of each sample's track; zeros where it is empty.

    The tracks are read twice, and so written first.
    """
    t = stored(tracks.select(by, *STRANDED, "start", "end", "value"))
    return overlap_values(peaks.select("peak_id", *STRANDED, "start", "end"), t, STRANDED, [by]).select("peak_id", by, "cov_sum", "cov_mean", "cov_max")


def site_counts(peaks: DataFrame, sites: DataFrame) -> DataFrame:
    """(peak_id, column, n): sites of each kind, named DEL_, SUB_ or TRUNC_ and the sample."""
    label = F.concat(F.upper("kind"), F.lit("_"), "sample").alias("column")
    return overlap_counts(peaks, sites.select(label, *STRANDED, "start", "end"), STRANDED, ["column"]).select("peak_id", "column", "n")


def matrix_order(columns: list[str], with_tc: bool = False) -> list[str]:
    """Columns by prefix group, in order within each; raw counts only if asked."""
    rest = [c for c in columns if c not in BASE]
    out = [c for c in BASE if c in columns]
    for p in PREFIXES:
        out += [c for c in rest if c.startswith(p) and (p != "TC_" or with_tc)]
    return out + [c for c in rest if not c.startswith(PREFIXES)]


def wide_matrix(peaks: DataFrame, counts: DataFrame, groups: DataFrame, scales: DataFrame, samples: list[str], group_names: list[str], with_tc: bool = False) -> DataFrame:
    """The matrix with a column for each sample and group; their names are given, not discovered."""
    n = normed_counts(counts, scales)
    per = n.groupBy("peak_id").pivot("sample", samples).agg(F.first("tc").alias("tc"), F.first("normed").alias("normed"))
    g = group_counts(counts, groups, scales).groupBy("peak_id").pivot("grp", group_names).agg(F.first("bc").alias("bc"), F.first("tc").alias("tc"), F.first("normed").alias("normed"))
    per = per.select("peak_id", *[F.col(f"`{s}_tc`").alias(f"TC_{s}") for s in samples], *[F.col(f"`{s}_normed`").alias(f"NormedTC_{s}") for s in samples])
    kinds = (("TC", "tc"), ("NormedTC", "normed"), ("BC", "bc"))
    g = g.select("peak_id", *[F.coalesce(F.col(f"`{x}_{c}`"), F.lit(0)).alias(f"{p}_grp_{x}") for p, c in kinds for x in group_names])
    out = peaks.join(per, "peak_id").join(g, "peak_id", "left")
    return out.select(*matrix_order(out.columns, with_tc))


def call_peaks(reads: DataFrame, size: int = 20, min_dist: int = 50, local: int = 1000, fold: float = 2.0, min_reads: int = 3, pvalue: float = 1e-4, by: list[str] | None = None) -> DataFrame:
    """Own caller of factor-like peaks: windows of ``size`` around local maxima of fragment centres.

    Counts per tile; a tile is a peak if it has ``min_reads``, is the largest within ``min_dist``,
    exceeds ``fold`` times its share of the density in ``local`` bases and a Poisson test.
    Windows run in stretches of positions with an overlap, so no task holds a chromosome. With
    ``by`` (a sample or group column), each of its values has its own peaks.
    """
    from ..functions.stats import binom_sf

    keys = [*(by or []), *STRANDED]

    tile = F.floor((F.col("start") + F.col("end")) / 2 / size)
    n = reads.groupBy(*keys, tile.alias("tile")).agg(F.count("*").alias("n"))
    reach, around = max(1, min_dist // size), max(1, local // size // 2)
    step = 100_000
    margin = max(reach, around)
    places = F.array_distinct(F.array(*[F.floor((F.col("tile") + d) / step) for d in (-margin, 0, margin)]))
    dealt = n.select("*", F.explode(places).alias("stretch"))
    w = Window.partitionBy(*keys, "stretch").orderBy("tile")
    near, wide = w.rangeBetween(-reach, reach), w.rangeBetween(-around, around)
    best = F.max(F.struct("n", -F.col("tile"))).over(near)
    scored = dealt.withColumn("top", best == F.struct("n", -F.col("tile"))).withColumn("around", F.sum("n").over(wide))
    scored = scored.where(F.floor(F.col("tile") / step) == F.col("stretch"))
    share = F.lit(1.0) / (2 * around + 1)
    scored = scored.where(F.col("top") & (F.col("n") >= min_reads) & (F.col("n") >= fold * F.col("around") * share))
    scored = scored.withColumn("pvalue", binom_sf(F.col("n"), F.col("around"), share)).where(F.col("pvalue") <= pvalue)
    start = F.col("tile") * size
    return scored.select(*keys, start.alias("start"), (start + size).alias("end"), F.concat_ws("-", "chrom", start.cast("string"), "strand").alias("name"), F.col("n").alias("score"), "pvalue")


def valley_peaks(track: DataFrame, gap: int = 50, valley: float = 0.9, by: list[str] | None = None) -> DataFrame:
    """Peaks of a step track: runs without a gap, split where depth falls by ``valley`` between two tops.

    With ``by`` (a sample or group column), each of its values has its own peaks.
    """
    keys = [*(by or []), *STRANDED]
    row, joins = F.struct("start", "end", "value"), lambda a, b: b["start"] - a["start"] <= gap
    c = local_runs(track.select(*keys, "start", "end", "value"), keys, "start", row, joins)
    edges = run_edges(c, keys, "start", row, joins, {"top": F.max("value")})
    whole = Window.partitionBy(*keys, "__run")
    before, after = (whole.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("__lo"), F.col("__lo").desc()))
    edges = edges.withColumn("__left", F.max("top").over(before)).withColumn("__right", F.max("top").over(after))
    part = Window.partitionBy(*keys, "__chunk", "__lo")
    up, down = (part.orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.col("start"), F.col("start").desc()))
    # tops from both ends inward: a frame up to the end of the run would be summed anew for each row
    marked = with_run_edges(c, edges, keys, __run=F.col("__lo"), __left=F.lit(None), __right=F.lit(None))
    marked = marked.withColumn("__right", F.greatest("__right", F.max("value").over(down))).withColumn("__left", F.greatest("__left", F.max("value").over(up)))
    marked = marked.withColumn("low", F.col("value") < (1 - valley) * F.least("__left", "__right"))
    marked = marked.withColumn("part", F.max(F.when(F.col("low"), F.col("start"))).over(up))
    pieces = settled(
        marked.groupBy(*keys, "__run", "__chunk", "part", "low").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max(F.struct("value", (-F.col("start")).alias("at"))).alias("top"))
    )
    # a chunk's rows before its first low belong to the part that the last low of the chunks before began
    lows = pieces.groupBy(*keys, "__run", "__chunk").agg(F.max("part").alias("__last"))
    earlier = whole.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    lows = lows.select(*keys, "__run", "__chunk", F.max("__last").over(earlier).alias("__from"))
    kept = join_null_safe(pieces.where(~F.col("low")), lows, [*keys, "__run", "__chunk"]).withColumn("part", F.coalesce("part", "__from"))
    out = kept.groupBy(*keys, "__run", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("top").alias("top"))
    return out.select(*keys, "start", "end", F.col("top.value").alias("score"), (-F.col("top.at")).alias("top"))
