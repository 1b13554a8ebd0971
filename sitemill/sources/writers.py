"""Writers. Text formats are projections to one string column; Parquet is the native store."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bam


def fastq_text(reads: DataFrame, name: str = "name") -> DataFrame:
    """One string for each record: header, sequence, plus, quality."""
    return reads.select(F.concat(F.lit("@"), name, F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value"))


def write_fastq(reads: DataFrame, path: str, gzip: bool = False, by_sample: bool = False) -> None:
    """FASTQ files, gzip on request only; with ``by_sample`` a folder for each sample."""
    w = reads.select(*(["sample"] if by_sample else []), F.concat(F.lit("@"), "name", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value")).write
    w = w.option("compression", "gzip") if gzip else w
    (w.partitionBy("sample") if by_sample else w).text(path)


def file_digests(spark: SparkSession, path: str, ending: str = "", chunk: int = 8 << 20) -> DataFrame:
    """(path, bytes, md5) of the files below a folder, each read as a stream, so of any size; a task takes a file at a time.

    Paths that Spark knows and Arrow doesn't are read whole, up to Spark's 2 GB for one file.
    """
    try:
        system, inner, prefix = bam.located(path)
    except (pa.ArrowInvalid, OSError):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{ending}").load(path)
        return files.select("path", F.col("length").alias("bytes"), F.md5("content").alias("md5"))
    found = [f.path for f in system.get_file_info(fs.FileSelector(inner, recursive=True)) if f.type == fs.FileType.File and f.path.endswith(ending)]
    names = spark.createDataFrame([(prefix + f,) for f in found], "path string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column(0).to_pylist():
                file, size = bam.open_file(name)
                md5 = hashlib.md5(usedforsecurity=False)
                while data := file.read(chunk):
                    md5.update(data)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([md5.hexdigest()])], names=["path", "bytes", "md5"])

    return names.repartition(max(1, len(found))).mapInArrow(digest, "path string, bytes long, md5 string")


def deposit(reads: DataFrame, path: str) -> DataFrame:
    """Compressed reads by sample, and (path, md5) of the files written."""
    write_fastq(reads, path, gzip=True, by_sample=True)
    return file_digests(reads.sparkSession, path, ".gz").select("path", "md5")


def deposit_summary(spark: SparkSession, path: str) -> DataFrame:
    """(sample, reads, percent) of a deposit, counted in what was written; percent of all, one decimal."""
    lines = spark.read.text(path).groupBy("sample").agg((F.count("*") / 4).cast("long").alias("reads"))
    every = lines.agg(F.sum("reads").alias("__all"))
    return lines.crossJoin(every).select(F.col("sample").cast("string").alias("sample"), "reads", F.round(100 * F.col("reads") / F.col("__all"), 1).alias("percent"))


def sam_text(reads: DataFrame) -> DataFrame:
    """Alignment rows as SAM lines with the NH and MD tags that they have; qualities are left out."""
    tag = lambda name, kind, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}:{kind}:"), F.col(c).cast("string")))
    fields = ["qname", "flag", "chrom", (F.col("start0") + 1).cast("string"), "mapq", "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", F.lit("*"), tag("NH", "i", "nh"), tag("MD", "Z", "md")]
    return reads.select(F.concat_ws("\t", *[F.col(f).cast("string") if isinstance(f, str) else f for f in fields]).alias("value"))


def write_sam(reads: DataFrame, sizes: DataFrame, path: str) -> None:
    """SAM lines in a folder, the references (chrom, length) in a file of their own, as every reader here takes them."""
    sam_text(reads).write.text(path)
    sizes.select(F.concat(F.lit("@SQ\tSN:"), "chrom", F.lit("\tLN:"), F.col("length").cast("string"))).coalesce(1).write.mode("append").text(path)


#: Rows of a BAM writer's task, about, where the caller gives no number of tasks.
BAM_ROWS = 500_000


def write_bam(reads: DataFrame, sizes: DataFrame, path: str, partitions: int | None = None, mode: str = "append") -> None:
    """Coordinate-sorted BAM files with indexes in a folder (one below it for each sample, if there is that column).

    ``sizes`` (chrom, length) gives the references by name; rows without one come last. Each task writes
    a range of the order, so the parts of a folder don't overlap and a region is read from a few. Tags are
    those of the column tags, else NH and MD from nh and md. Without ``partitions`` the rows are counted, and their
    number grows with them.
    """
    spark = reads.sparkSession
    refs = sorted((r["chrom"], r["length"]) for r in sizes.select("chrom", "length").distinct().collect())  # as many as the genome has
    number = spark.createDataFrame([(n, i) for i, (n, _) in enumerate(refs)], "chrom string, __ref int")
    if partitions is None:
        partitions = max(8, -(-reads.count() // BAM_ROWS))
    rows = reads.select(*[c for c in bam.WRITTEN if c in reads.columns]).join(F.broadcast(number), "chrom", "left").withColumn("__ref", F.coalesce("__ref", F.lit(len(refs))))
    order = [*(["sample"] if "sample" in reads.columns else []), "__ref", "start0", "qname", "flag"]
    rows = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).drop("__ref")
    spark.dataSource.register(bam.BamSource)
    rows.write.format("bam").mode(mode).option("references", "\n".join(f"{n}:{k}" for n, k in refs)).save(path)


def _number(c: Column, form: str) -> Column:
    return F.format_string(form, c)


SITE_HEADER = "#chrom\tstart\tend\tname\tscore\tstrand\tsignal\tcoverage\tfraction\tpvalue\tqvalue"


def site_bed_text(sites: DataFrame) -> DataFrame:
    """Site rows as text: fraction to four decimals, p and q in scientific form with three."""
    return sites.select(
        F.concat_ws(
            "\t", "chrom", *[F.col(c).cast("string") for c in ("start", "end", "name", "score", "strand", "signal", "coverage")], _number(F.col("fraction"), "%.4f"), _number(F.col("pvalue"), "%.3e"), _number(F.col("qvalue"), "%.3e")
        ).alias("value")
    )


def write_sites(sites: DataFrame, path: str) -> None:
    """Site rows with their header; substitution sites in a folder for each type."""
    if "sub_type" not in sites.columns:
        return write_text(site_bed_text(sites), path, SITE_HEADER)
    for kind in [r["sub_type"] for r in sites.select("sub_type").distinct().orderBy("sub_type").collect()]:  # twelve at most
        write_text(site_bed_text(sites.where(F.col("sub_type") == kind)), f"{path}/{kind[0]}to{kind[1]}", SITE_HEADER)
    return None


def bed_text(df: DataFrame) -> DataFrame:
    return df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in ("chrom", "start", "end", "name", "score", "strand")]).alias("value"))


def bedgraph_text(track: DataFrame, value: str = "value") -> DataFrame:
    return track.orderBy("chrom", "start").select(F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), F.col(value).cast("string")).alias("value"))


def write_bedgraph(track: DataFrame, path: str, name: str, value: str = "value") -> None:
    """One sample and strand as bedGraph text with its track line."""
    write_text(bedgraph_text(track, value), path, f'track type=bedGraph name="{name}"')


def with_header(text: DataFrame, header: str) -> DataFrame:
    """A header row before the rows, which keep their order, in a one-file write: for text that tools read, not for large tables."""
    first = text.sparkSession.createDataFrame([(-1, header)], "i long, value string")
    rows = text.select(F.monotonically_increasing_id().alias("i"), "value")  # in the order of the rows
    return first.unionByName(rows).coalesce(1).sortWithinPartitions("i").select("value")


def write_text(text: DataFrame, path: str, header: str | None = None) -> None:
    (with_header(text, header) if header else text).write.text(path)


#: Headers of the tag-based tables, in the order of their columns.
CITS_HEADER = "#chrom\tchromStart\tchromEnd\tname\tscore\tstrand"
CIMS_HEADER = CITS_HEADER + "\tk\tm\tFDR"


def write_truncation_table(sites: DataFrame, path: str) -> None:
    """Tag-based truncation sites of one base, with a header, in order of place."""
    write_text(bed_text(sites.orderBy("chrom", "start", "strand")), path, CITS_HEADER)


def write_mutation_table(sites: DataFrame, path: str) -> None:
    """Tag-based mutation sites with tags (k), mutations (m) and rate, by rising rate, falling m, rising k."""
    cells = [F.col(c).cast("string") for c in ("chrom", "start", "end", "name", "score", "strand", "k", "m", "fdr")]
    write_text(sites.orderBy("fdr", F.col("m").desc(), "k", "chrom", "start", "strand").select(F.concat_ws("\t", *cells).alias("value")), path, CIMS_HEADER)


def write_flanked(sites: DataFrame, path: str) -> None:
    """Flanked sites as BED without a header."""
    write_text(bed_text(sites.orderBy("chrom", "start", "strand")), path)


def write_repeat_tables(elements: DataFrame, families: DataFrame, path: str) -> None:
    """Elements and families of repeats as tables with headers, rates to two decimals, families by falling reads; a folder for each sample."""
    rpm = _number(F.col("rpm"), "%.2f").alias("rpm")
    for r in elements.select("sample").distinct().orderBy("sample").collect():  # as many as there are samples
        own = F.col("sample") == r["sample"]
        write_tsv(elements.where(own).orderBy("element").select("element", "class", "family", "raw_reads", rpm), f"{path}/{r['sample']}/repeat_elements")
        write_tsv(families.where(own).orderBy(F.col("raw_reads").desc(), "family").select("class", "family", "raw_reads", rpm), f"{path}/{r['sample']}/repeat_families")


def write_by_sample(text: DataFrame, path: str, *by: str) -> None:
    """Lines (value) in a folder for each sample, and for each of ``by`` below it."""
    text.write.partitionBy("sample", *by).text(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.option("sep", "\t").option("header", "true").csv(path)


def write_pileup(piles: DataFrame, path: str) -> None:
    """Partitioned by chromosome and strand, which later reads prune."""
    piles.write.partitionBy("chrom", "strand").parquet(path)


def write_alignments(reads: DataFrame, path: str, partitions: int = 200) -> None:
    """Coordinate-sorted alignment rows, partitioned by chromosome."""
    reads.repartitionByRange(partitions, "chrom", "start0").sortWithinPartitions("chrom", "start0").write.partitionBy("chrom").parquet(path)
