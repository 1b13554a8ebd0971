"""Tag-based site calls: mutations with a permutation rate, truncations by clusters, their flanks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import stored
from ..operators import mutations as M
from ..operators.demux import assign_groups
from ..operators.filters import cims_postfilter, is_numbered_or_named, singletons
from ..operators.intervals import flank
from .config import Settings


def tag_sites(tags: DataFrame, mutations: DataFrame, settings: Settings | None = None, cims: bool = True, cits: bool = True) -> dict[str, DataFrame]:
    """Site tables of one sample's collapsed tags (Q-CTK): deletions, substitutions, truncations, flanked sites.

    Tags have qname, chrom, strand, start, end; mutations qname, chrom, strand, pos, mut_type (del or
    sub). Mutations of tags that were not kept drop out first. An empty kind gives an empty table.
    Tags and their mutations are read several times, and so written first.
    """
    s = settings or Settings()
    tags = tags.where(is_numbered_or_named(F.col("chrom"))) if s.filter_chromosomes else tags
    tags = stored(tags.select("qname", "chrom", "strand", "start", "end"))
    kept = stored(M.of_kept_tags(mutations.where(F.col("mut_type").isin("del", "sub")), tags).select("qname", "chrom", "strand", "pos", "mut_type"))
    out: dict[str, DataFrame] = {}
    if cims:
        rated = M.permuted_mutations(tags, kept, s.cims_iterations, by=["mut_type"])
        for kind in ("del", "sub"):
            found = cims_postfilter(M.of_type(rated, kind), s.cims_fdr)
            out[kind] = found.select("chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), F.concat_ws(":", "chrom", F.col("pos").cast("string"), "strand").alias("name"), F.col("m").cast("double").alias("score"), "strand", "k", "m", "fdr")
    if cits:
        sites = singletons(M.truncation_clusters(tags, M.of_type(kept, "del"), s.cits_pvalue, s.cits_gap))
        out["trunc"] = sites.select("chrom", "start", "end", F.concat_ws(":", "chrom", F.col("start").cast("string"), "strand").alias("name"), F.col("truncations").cast("double").alias("score"), "strand", "pvalue")
    return out | {f"{k}_flanked": flank(v, s.flank).select("chrom", "start", "end", "name", "score", "strand") for k, v in out.items()}


def grouped_tag_sites(tags: DataFrame, mutations: DataFrame, groups: DataFrame, names: list[str], settings: Settings | None = None) -> dict[str, dict[str, DataFrame]]:
    """Tag sites of each group's pooled samples (Q-GCTK), for the given group names."""
    t, m = assign_groups(tags, groups), assign_groups(mutations, groups)
    return {g: tag_sites(t.where(F.col("grp") == g), m.where(F.col("grp") == g), settings) for g in names}
