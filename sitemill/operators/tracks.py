"""Normalised coverage tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.alignment import UNMAPPED, crosslink_base, has_junction
from ..functions.lineage import counted, stored
from ..functions.stats import truncate6
from .intervals import depth_track, mean_track

KEYS = ["sample", "strand", "chrom"]


def scale_factors(reads: DataFrame) -> DataFrame:
    """(sample, mapped, scale): a million over the mapped alignments, cut to six decimals.

    Counts alignments, secondary ones too; samples without any have no row.
    """
    n = reads.where(F.col("flag").bitwiseAND(UNMAPPED) == 0).groupBy("sample").agg(F.count("*").alias("mapped"))
    return n.withColumn("scale", truncate6(F.lit(1_000_000.0) / F.col("mapped")))


def rpm_track(reads: DataFrame, scales: DataFrame) -> DataFrame:
    """Reads-per-million steps of each sample and strand; reads over a junction are left out, deletions count."""
    plain = reads.where((F.col("flag").bitwiseAND(UNMAPPED) == 0) & ~has_junction(F.col("cigar")))
    steps = depth_track(plain.select(*KEYS, F.col("start0").alias("start"), F.col("end0").alias("end")), KEYS)
    return steps.join(counted(scales.select("sample", "scale")), "sample").withColumn("value", F.col("value") * F.col("scale")).drop("scale")


def crosslink_track(reads: DataFrame, start: str = "start0", end: str = "end0") -> DataFrame:
    """Unscaled counts of first bases as steps."""
    at = crosslink_base(F.col("strand"), F.col(start), F.col(end))
    return depth_track(reads.select(*KEYS, at.alias("start"), (at + 1).alias("end")), KEYS)


def group_track(tracks: DataFrame, groups: DataFrame) -> DataFrame:
    """Average track of each group: the sum over the number of its samples that have a track.

    The tracks are read twice, and so written first.
    """
    tracks = stored(tracks.select("sample", "strand", "chrom", "start", "end", "value"))
    members = counted(groups.select("sample", "grp").distinct().join(counted(tracks.select("sample").distinct()), "sample"))
    n = members.groupBy("grp").agg(F.countDistinct("sample").alias("n_samples"))
    return mean_track(tracks.join(counted(members.join(n, "grp")), "sample"), ["grp", "strand", "chrom"], "n_samples").drop("n_samples")
