"""Barcodes, groups and repeat references."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.adapters import claim
from ..functions.lineage import counted
from ..functions.names import hamming, repeat_parts

MAX_BARCODES = 10_000


def error_rate(barcodes: DataFrame, max_mismatches: int) -> float:
    """Mismatches as a share of the first barcode's length; partial barcodes get theirs in proportion."""
    first = barcodes.orderBy("ord").select("barcode").first()
    return max_mismatches / len(first["barcode"]) if first and first["barcode"] else 0.0


def demultiplex(reads: DataFrame, barcodes: DataFrame, max_mismatches: int = 1, search: int | None = None, least: int = 3) -> DataFrame:
    """Adds sample, barcode_start and errors; reads without a barcode get the sample ``unknown``.

    A barcode may start anywhere, or lack its first bases where the read starts, with ``least`` bases
    left; errors are a rate (``error_rate``). No indels. The most matches less errors win, then the
    leftmost place, then the order of the barcode table (ord). With ``search``, whole barcodes in the
    first ``search`` bases only (0: at the 5' end), fewest errors first. Empty reads are dropped, others
    not changed. The barcode table is counted: tens of rows, sent to every task.
    """
    rows = barcodes.select("sample", "barcode", "ord")
    if rows.count() > MAX_BARCODES:
        raise ValueError(f"more than {MAX_BARCODES} barcodes")
    reads = reads.where(F.length("seq") > 0)
    kept = [F.col(c) for c in reads.columns if c not in ("sample", "barcode_start", "errors")]
    if search is None:
        named = [(r["sample"], r["barcode"]) for r in rows.orderBy("ord").collect() if r["barcode"]]
        out = reads.withColumn("__hit", claim(F.col("seq"), named, error_rate(rows, max_mismatches), least))
    else:
        table = rows.groupBy().agg(F.sort_array(F.collect_list(F.struct("ord", "sample", "barcode"))).alias("table"))
        places = F.sequence(F.lit(0), F.lit(search))

        def best(b: F.Column, seq: F.Column) -> F.Column:
            at = lambda p: F.struct(hamming(F.substring(seq, p + 1, F.length(b["barcode"])), b["barcode"]).alias("errors"), p.alias("start"), b["ord"].alias("ord"), b["sample"].alias("sample"))
            return F.transform(places, at)

        found = F.flatten(F.transform("table", lambda b: best(b, F.col("seq"))))
        hit = F.array_min(F.filter(found, lambda x: x["errors"] <= max_mismatches))
        out = reads.crossJoin(F.broadcast(table)).withColumn("__hit", hit).withColumn("__hit", F.struct(F.col("__hit.sample").alias("sample"), F.col("__hit.start").alias("barcode_start"), F.col("__hit.errors").alias("errors")))
    return out.select(*kept, F.coalesce("__hit.sample", F.lit("unknown")).alias("sample"), F.col("__hit.barcode_start").alias("barcode_start"), F.col("__hit.errors").alias("errors"))


def barcode_collisions(barcodes: DataFrame, max_mismatches: int = 1) -> DataFrame:
    """Masked barcodes that more than one entry reaches by up to m wildcards: (variant, n).

    Variants have N in any m places, so two barcodes within m mismatches share one.
    """
    per = barcodes.select(F.monotonically_increasing_id().alias("id"), "barcode").where(F.length("barcode") > 0)
    one = per.select("id", F.col("barcode").alias("variant"))
    for _ in range(max_mismatches):
        places = F.sequence(F.lit(1), F.length("variant"))
        masked = F.transform(places, lambda p: F.concat(F.substring(F.col("variant"), F.lit(1), p - 1), F.lit("N"), F.substring(F.col("variant"), p + 1, F.length("variant"))))
        one = one.select("id", F.explode(masked).alias("variant"))
    return one.distinct().groupBy("variant").agg(F.count("*").alias("n")).where("n > 1")


def barcodes_too_near(barcodes: DataFrame, distance: int) -> DataFrame:
    """Pairs of barcodes within a Hamming distance; unambiguous decoding of m errors needs over 2m."""
    a = barcodes.select(F.col("sample").alias("a"), F.col("barcode").alias("x"), F.col("ord").alias("i"))
    b = barcodes.select(F.col("sample").alias("b"), F.col("barcode").alias("y"), F.col("ord").alias("j"))
    return a.join(F.broadcast(b), F.col("i") < F.col("j")).withColumn("distance", hamming(F.col("x"), F.col("y"))).where(F.col("distance") <= distance).select("a", "b", "distance")


def demux_summary(reads: DataFrame) -> DataFrame:
    """Reads of each sample and their percentage, one decimal."""
    n = reads.groupBy("sample").agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 1))


def assign_groups(df: DataFrame, groups: DataFrame, fallback: bool = True) -> DataFrame:
    """Adds grp by exact sample name; a sample that no group lists is its own, or is left out."""
    g = counted(groups.select("sample", "grp").distinct())
    if not fallback:
        return df.join(g, "sample")
    return df.join(g, "sample", "left").withColumn("grp", F.coalesce("grp", "sample"))


def repeat_elements(hits: DataFrame, totals: DataFrame, name: str = "ref") -> DataFrame:
    """(sample, element, class, family, raw_reads, rpm): hits of each repeat, rpm with two decimals.

    ``totals`` has the reads of each sample (total); references without a mapped read have no row.
    """
    element, kind, family = repeat_parts(F.col(name))
    n = hits.where(F.col(name) != "*").groupBy("sample", name).agg(F.count("*").alias("raw_reads"))
    out = n.join(totals.select("sample", "total"), "sample")
    return out.select("sample", element.alias("element"), kind.alias("class"), family.alias("family"), "raw_reads", F.round(F.col("raw_reads") / F.col("total") * 1e6, 2).alias("rpm"))


def repeat_families(elements: DataFrame) -> DataFrame:
    """Sums by family, of the already rounded rpm; the class is the last by element name."""
    return elements.groupBy("sample", "family").agg(F.max_by("class", "element").alias("class"), F.sum("raw_reads").alias("raw_reads"), F.round(F.sum("rpm"), 2).alias("rpm")).orderBy(
        "sample", F.col("raw_reads").desc(), "family"
    )


def divert_repeats(reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mapped to a repeat, the rest)."""
    mapped = F.col("flag").bitwiseAND(4) == 0
    return reads.where(mapped), reads.where(~mapped)


def check_eclip(reads: DataFrame, mode: str, header: str = "header", order: str = "ord", probe: int = 1000, umi_length: int | None = None) -> DataFrame:
    """Whether a file's headers fit paired (``pe``) or single (``se``) eCLIP input, as one row.

    (mate, umi_location, umi_length, verdict). The mate is the one that 95 % of the first headers
    name, else unknown. The first header tells where the UMI is: five to ten bases before a colon,
    the same after a last underscore, or in the sequence (length zero for these two). Paired input
    is read 2 with a colon UMI, single input read 1 with the UMI in the sequence; the verdict is
    ``ok`` or what is wrong. No reads: an unknown mate. With a given ``umi_length``, a column warning says
    if the headers have another one, which is then the one to use; else it is null.
    """
    if mode not in ("pe", "se"):
        raise ValueError(f"mode {mode}: pe or se")
    head = reads.orderBy(order).limit(probe).select(F.col(header).alias("h"), F.col(order).alias("o"))
    named = lambda n: F.avg(F.coalesce(F.col("h").rlike(rf"\s{n}:"), F.lit(False)).cast("double")) >= 0.95
    facts = head.agg(F.when(named(1), "R1").when(named(2), "R2").otherwise("unknown").alias("mate"), F.regexp_replace(F.split(F.min_by("h", "o"), " ")[0], "^@", "").alias("name"))
    colon = F.length(F.regexp_extract("name", "^([ACGTN]{5,10}):", 1))
    place = F.when(colon > 0, "header_colon").when(F.col("name").rlike("_[ACGTN]{5,10}$"), "header_underscore").otherwise("sequence")
    facts = facts.select("mate", place.alias("umi_location"), F.coalesce(colon, F.lit(0)).alias("umi_length"))
    mate, where = ("R2", "header_colon") if mode == "pe" else ("R1", "sequence")
    wrong = F.when(F.col("mate") == "unknown", "no mate in the headers").when(F.col("mate") != mate, F.concat(F.lit(f"{mode} input is {mate}, not "), "mate"))
    if umi_length is not None:
        other = (F.col("umi_length") > 0) & (F.col("umi_length") != umi_length)
        facts = facts.withColumn("warning", F.when(other, F.concat(F.lit(f"UMI of {umi_length} given, of "), F.col("umi_length").cast("string"), F.lit(" in the headers"))))
    return facts.withColumn("verdict", wrong.when(F.col("umi_location") != where, F.concat(F.lit(f"{mode} input has the UMI in {where}, not in "), "umi_location")).otherwise("ok"))


def known_samples(reads: DataFrame) -> DataFrame:
    """Reads that a barcode claimed."""
    return reads.where(F.col("sample") != "unknown")


def repeat_filter_summary(reads: DataFrame) -> DataFrame:
    """(sample, total, once, many, kept, percent): reads by how they hit the repeats; kept hit none."""
    mapped = F.col("flag").bitwiseAND(4) == 0
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    s = reads.groupBy("sample").agg(F.count("*").alias("total"), n(mapped & (F.coalesce("nh", F.lit(1)) <= 1)).alias("once"), n(mapped & (F.col("nh") > 1)).alias("many"), n(~mapped).alias("kept"))
    return s.withColumn("percent", F.round(100 * (F.col("once") + F.col("many")) / F.col("total"), 2))


def index_stats(reads: DataFrame) -> DataFrame:
    """(sample, ref, mapped, unmapped) by reference, as an index counts them; references without mapped reads are left out."""
    mapped = F.col("flag").bitwiseAND(4) == 0
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return reads.where(F.col("chrom") != "*").groupBy("sample", F.col("chrom").alias("ref")).agg(n(mapped).alias("mapped"), n(~mapped).alias("unmapped")).where("mapped > 0")
