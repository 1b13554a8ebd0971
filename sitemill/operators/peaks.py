"""Factor-like peaks with one threshold for the genome: greedy by rank, expected counts under a Poisson background."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import settled
from ..functions.stats import poisson_sf
from .matrix import STRANDED

#: Positions that a stretch of a chromosome spans.
STRETCH = 1 << 20


def _stretches(df: DataFrame, margin: int, step: int) -> DataFrame:
    """Rows with the stretches that need them: their own, and a neighbour's within ``margin``."""
    at = F.array_distinct(F.array(*[F.floor((F.col("pos") + d) / step) for d in (-margin, 0, margin)]))
    return df.select("*", F.explode(at).alias("stretch"))


def tag_windows(reads: DataFrame, size: int, local: int, by: list[str] | None = None, step: int = STRETCH) -> DataFrame:
    """(keys, pos, n, around): tags within half of ``size`` and half of ``local`` bases of each tag's centre."""
    keys = [*(by or []), *STRANDED]
    centres = reads.groupBy(*keys, F.floor((F.col("start") + F.col("end")) / 2).cast("long").alias("pos")).agg(F.count("*").alias("tags"))
    w = Window.partitionBy(*keys, "stretch").orderBy("pos")
    near, wide = w.rangeBetween(-(size // 2), size // 2), w.rangeBetween(-(local // 2), local // 2)
    out = _stretches(centres, max(size, local) // 2, step).withColumn("n", F.sum("tags").over(near)).withColumn("around", F.sum("tags").over(wide))
    return out.where(F.floor(F.col("pos") / step) == F.col("stretch")).select(*keys, "pos", "n", "around")


def greedy_by_rank(candidates: DataFrame, min_dist: int, keys: list[str], step: int = STRETCH) -> DataFrame:
    """The candidates that a walk from the largest n down (the first position on ties) takes, none within ``min_dist`` of one taken.

    In rounds: what ranks first among the undecided within the distance is taken, and what is near it
    goes. So the walk's result is found without its order, in stretches that overlap; each round
    settles at least the first of every chain, and rounds end when nothing is undecided.
    """
    state = settled(candidates.withColumn("taken", F.lit(False)))
    w = Window.partitionBy(*keys, "stretch").orderBy("pos").rangeBetween(-min_dist, min_dist)
    rank = F.struct("n", (-F.col("pos")).alias("p"))
    while state.where("not taken").head(1):
        d = _stretches(state.where("not taken"), 2 * min_dist, step)
        d = d.withColumn("taken", F.max(rank).over(w) == rank).withColumn("near", F.max("taken").over(w))
        d = d.where((F.floor(F.col("pos") / step) == F.col("stretch")) & (F.col("taken") | ~F.col("near")))
        state = settled(state.where("taken").unionByName(d.drop("stretch", "near")))
    return state.drop("taken")


def ranked_peaks(
    reads: DataFrame, sizes: DataFrame, size: int = 20, min_dist: int = 50, fdr: float = 0.001, local: int = 1000, fold: float = 2.0, by: list[str] | None = None, strands: int = 2, step: int = STRETCH
) -> DataFrame:
    """Peaks of (keys, start, end, name, score, expected_rate) whose tags reach the genome's threshold.

    Candidates are windows of ``size`` around tag centres, thinned by ``greedy_by_rank``. With tags
    thrown at random on the genome (``sizes``: chrom, length; both strands) a window has a Poisson count;
    at t tags as many windows as the genome holds side by side would give the expected peaks. The
    threshold is the least t whose expected peaks are at most ``fdr`` of the observed ones; then a peak
    needs ``fold`` times its share of the tags in ``local`` bases. With ``by`` (a sample or group) each value has
    its own threshold. Windows run in stretches: no task holds a chromosome.
    """
    keys, own, width = [*(by or []), *STRANDED], list(by or []), 2 * (size // 2) + 1
    found = greedy_by_rank(tag_windows(reads, size, local, by, step), min_dist, keys, step)
    genome = sizes.agg((F.sum("length") * strands).cast("double").alias("genome"))
    totals = reads.groupBy(*own).agg(F.count("*").alias("tags")).crossJoin(genome)  # a row for each value of by
    seen = found.groupBy(*own, "n").agg(F.count("*").alias("peaks"))
    down = Window.partitionBy(*(own or [F.lit(1)])).orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, 0)
    seen = seen.withColumn("observed", F.sum("peaks").over(down))
    seen = seen.join(totals, own) if own else seen.crossJoin(totals)
    rate = F.col("genome") / width * poisson_sf(F.col("n"), F.col("tags") * width / F.col("genome")) / F.col("observed")
    passing = seen.withColumn("rate", rate).where(F.col("rate") <= fdr)
    least = passing.groupBy(*own).agg(F.min("n").alias("least"))
    kept = (found.join(least, own) if own else found.crossJoin(least)).where((F.col("n") >= F.col("least")) & (F.col("n") * local >= fold * F.col("around") * size))
    kept = kept.join(seen.select(*own, "n", rate.alias("expected_rate")), [*own, "n"])
    start = F.greatest(F.col("pos") - size // 2, F.lit(0))
    return kept.select(*keys, start.alias("start"), (start + size).alias("end"), F.concat_ws("-", "chrom", start.cast("string"), "strand").alias("name"), F.col("n").alias("score"), "expected_rate")
