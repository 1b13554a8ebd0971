"""Readers of sequencing and interval files, through Spark's file sources wherever they may lie."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.alignment import reference_length, strand_of
from ..functions.names import sample_name
from . import bam

FASTQ_GLOB = "*.{fastq,fq,fastq.gz,fq.gz}"


def numbered_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, line, value): lines with their number in the file, however the file is split.

    Rows of a split are in order; a count for each split, placed by its offset, shifts their numbers.
    """
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    t = reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id")
    )
    parts = t.groupBy("path", "at").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    order = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("path", "at", "first", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return t.join(F.broadcast(parts), ["path", "at"]).select("path", (F.col("base") + F.col("id") - F.col("first")).alias("line"), "value")


def read_fastq(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(sample, header, seq, qual, ord): four-line records of a file or of a directory's FASTQ files.

    Plain files are split, gzip files are not. A record without qualities is truncated: an error,
    or with ``strict`` off left out. ``ord`` is the place in the file.
    """
    lines = numbered_lines(spark, path, None if "*" in path or path.endswith((".gz", ".fastq", ".fq")) else FASTQ_GLOB)
    part = lambda i: F.max(F.when(F.col("line") % 4 == i, F.col("value")))
    rec = lines.groupBy("path", F.floor(F.col("line") / 4).alias("ord")).agg(part(0).alias("header"), part(1).alias("seq"), part(3).alias("qual"))
    rec = rec.where(F.coalesce(F.col("header"), F.lit("")) != "")
    broken = F.coalesce(F.col("qual"), F.lit("")) == ""
    if strict:
        rec = rec.withColumn("qual", F.when(broken, F.raise_error(F.concat(F.lit("truncated record "), "header"))).otherwise(F.col("qual")))
    else:
        rec = rec.where(~broken)
    return rec.select(sample_name(F.col("path")).alias("sample"), F.regexp_replace("header", "^@", "").alias("header"), "seq", "qual", "ord")


def first_reads(reads: DataFrame, n: int) -> DataFrame:
    """The first n records of a file, a trial run."""
    return reads.orderBy("ord").limit(n)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq) of a small FASTA file, sequences over several lines joined; genomes: ``read_fasta_slices``."""
    t = numbered_lines(spark, path).where(F.length("value") > 0)
    w = Window.partitionBy("path").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("k", F.sum(F.col("value").startswith(">").cast("int")).over(w))
    name = F.max(F.when(F.col("value").startswith(">"), F.substring("value", 2, 1 << 20)))
    seq = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~F.col("value").startswith(">"), F.struct("line", "value")))), lambda x: x["value"]), "")
    return t.groupBy("path", "k").agg(name.alias("name"), seq.alias("seq")).select("name", "seq")


def read_fasta_slices(spark: SparkSession, path: str, size: int = 100_000) -> DataFrame:
    """(name, slice, bases): sequences of any length in slices of ``size`` bases, the last one shorter.

    The name is the first word of a header. Files are split: a task counts bases from the headers that it
    meets, and one row for each split (its bases before the first header and after the last) tells the next
    ones where they start. No row holds more than a slice, or what a batch of lines has of one sequence.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(path, at, header number in the split, name or None, bases so far, joined lines) of consecutive lines."""
        split, k, name, done = None, 0, None, 0
        for b in batches:
            parts: list[str] = []
            for value, path, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
                header = value.startswith(">")
                if (path, at) != split or header:
                    if split is not None:
                        yield (*split, k, name, done, "".join(parts))
                    parts = []
                    k, name, done = (k + 1 if (path, at) == split else int(header)), None, 0
                    if header:
                        name = (value[1:].split() or [""])[0]
                    split = (path, at)
                if not header:
                    parts.append(value.strip())
            if split is not None and parts:
                text = "".join(parts)
                yield (*split, k, name, done, text)
                done += len(text)
        if split is not None:
            yield (*split, k, name, done, "")

    schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("k", pa.int64()), ("name", pa.string()), ("start", pa.int64()), ("bases", pa.string())])

    def decode(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in runs(batches):
                if whole:
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(r, schema.types)], schema=schema)
                else:
                    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*r[:3], r[4] + len(r[5]))] + [pa.array([r[3]], pa.string())], names=["path", "at", "k", "bases", "name"])

        return run

    seen = lines.mapInArrow(decode(False), "path string, at long, k long, bases long, name string").groupBy("path", "at", "k").agg(F.max("bases").alias("bases"), F.max("name").alias("name"))
    ends = seen.groupBy("path", "at").agg(F.max_by(F.struct("k", "bases", "name"), "k").alias("last"))
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("headers", F.sum((F.col("last.k") > 0).cast("int")).over(Window.partitionBy("path").orderBy("at")))
    since = Window.partitionBy("path", "headers").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("bases", F.sum("last.bases").over(since))
    carry = ends.select("path", "at", F.last("last.name", ignorenulls=True).over(before).alias("old"), F.lag("bases").over(Window.partitionBy("path").orderBy("at")).alias("base"))
    pieces = lines.mapInArrow(decode(True), "path string, at long, k long, name string, start long, bases string").where(F.length("bases") > 0)
    # one row a split: 128 MB of a file
    pieces = pieces.join(carry, ["path", "at"])
    first = F.col("k") == 0
    pieces = pieces.select(F.when(first, F.col("old")).otherwise(F.col("name")).alias("name"), (F.col("start") + F.when(first, F.coalesce("base", F.lit(0))).otherwise(0)).alias("start"), "bases")
    end = F.col("start") + F.length("bases")
    dealt = pieces.where("name is not null").select("*", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((end - 1) / size))).alias("slice"))
    low, high = F.greatest(F.col("start"), F.col("slice") * size), F.least(end, (F.col("slice") + 1) * size)
    cut = dealt.select("name", "slice", low.alias("low"), F.substring("bases", (low - F.col("start") + 1).cast("int"), (high - low).cast("int")).alias("part"))
    return cut.groupBy("name", "slice").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("low", "part"))), lambda x: x["part"]), "").alias("bases"))


def sam_columns(rows: DataFrame) -> DataFrame:
    """Named columns of raw SAM fields f (array of strings), with sample and ord."""
    f = lambda i: F.get("f", F.lit(i))  # noqa: E731  header lines may still be here when a filter is pushed down
    tag = lambda name, kind: F.regexp_extract(F.array_join(F.slice("f", 12, 1 << 20), "\t"), rf"(?:^|\t){name}:{kind}:([^\t]*)", 1)
    out = rows.select(
        "sample",
        f(0).alias("qname"),
        f(1).try_cast("int").alias("flag"),
        f(2).alias("chrom"),
        (f(3).try_cast("long") - 1).alias("start0"),
        f(4).try_cast("int").alias("mapq"),
        f(5).alias("cigar"),
        f(9).alias("seq"),
        F.when(tag("NH", "i") != "", tag("NH", "i").cast("int")).alias("nh"),
        F.when(tag("MD", "Z") != "", tag("MD", "Z")).alias("md"),
        "ord",
    )
    return out.withColumn("strand", strand_of(F.col("flag"))).withColumn("end0", F.col("start0") + reference_length(F.col("cigar")))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment rows of SAM text: the columns of ``sam_columns``; header lines are left out."""
    t = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("ord")).where(~F.col("value").startswith("@"))
    return sam_columns(t.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.sam(\.gz)?$", "").alias("sample"), F.split("value", "\t").alias("f"), "ord"))


def read_sam_header(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, length) of the reference sequences."""
    t = spark.read.text(path).where(F.col("value").startswith("@SQ"))
    return t.select(F.regexp_extract("value", r"\tSN:([^\t]*)", 1).alias("chrom"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("long").alias("length")).distinct()


def read_bam(spark: SparkSession, path: str, chrom: str | None = None, start: int = 0, end: int | None = None, split_bytes: int = bam.SPLIT_BYTES) -> DataFrame:
    """Alignment rows of BAM files (a file, a folder, a pattern), many tasks a file.

    ``chrom`` keeps one reference (``*``: rows without one), ``start`` and ``end`` what overlaps the region;
    with an index beside a file only the blocks of the region are read. ``ord`` is a record's virtual offset
    in its file, so it rises and doesn't depend on the splits. Paths that Spark knows and Arrow doesn't are
    read one task a file, whole.
    """
    try:
        bam.located(path)
    except (pa.ArrowInvalid, OSError):
        raw = _whole_bam(spark, path, chrom, start, end)
    else:
        spark.dataSource.register(bam.BamSource)
        options = {"splitBytes": str(split_bytes), "start": str(start)} | ({"chrom": chrom} if chrom else {}) | ({"end": str(end)} if end is not None else {})
        raw = spark.read.format("bam").options(**options).load(path)
    tag = lambda name: F.nullif(F.substr(F.get(F.filter("tags", lambda t: t.startswith(f"{name}:i:") | t.startswith(f"{name}:Z:")), F.lit(0)), F.lit(6)), F.lit(""))
    out = raw.withColumn("nh", tag("NH").cast("int")).withColumn("md", tag("MD")).withColumn("strand", strand_of(F.col("flag")))
    return out.select("sample", "qname", "flag", "chrom", "start0", "mapq", "cigar", "seq", "nh", "md", "ord", "strand", "end0", "mate_chrom", "mate_start0", "insert_size", "qual", "tags")


def _whole_bam(spark: SparkSession, path: str, chrom: str | None, start: int, end: int | None) -> DataFrame:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                file, size = pa.BufferReader(blob.as_buffer()), len(blob.as_buffer())
                refs = [n for n, _ in bam.read_header(file, size).refs]
                if chrom in (None, "*") or chrom in refs:
                    yield from bam.batches_of(file, size, bam.Part(p, 0, size, None, refs.index(chrom) if chrom in refs else None), chrom, start, end)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.bam").load(path).select("path", "content").mapInArrow(decode, bam.SCHEMA)


def read_bam_header(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, length) of BAM files; only their first blocks are read, in the tasks."""
    files = spark.createDataFrame([(f,) for f in bam.files_of(path)], "path string")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            refs = [r for p in b.column(0).to_pylist() for r in bam.read_header(*bam.open_file(p)).refs]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in refs], pa.string()), pa.array([k for _, k in refs], pa.int64())], names=["chrom", "length"])

    return files.mapInArrow(decode, "chrom string, length long").distinct()


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """BED6 rows with their sample (file name); comments and track lines are left out."""
    t = spark.read.text(path).select(F.split("value", "\t").alias("f"), F.col("_metadata.file_path").alias("path")).where(~F.col("value").rlike("^(#|track|browser|$)"))
    g = lambda i: F.try_element_at("f", F.lit(i + 1))
    sample = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(_collapsed)?\.bed(\.gz)?$", "")
    return t.select(
        sample.alias("sample"), g(0).alias("chrom"), g(1).try_cast("long").alias("start"), g(2).try_cast("long").alias("end"), g(3).alias("name"), g(4).try_cast("double").alias("score"), g(5).alias("strand")
    )


def read_bedgraph(spark: SparkSession, path: str, strand: str | None = None) -> DataFrame:
    """(sample, strand, chrom, start, end, value); fields between tabs or spaces, track lines left out."""
    t = spark.read.text(path).select(F.split("value", r"[\t ]+").alias("f"), F.col("_metadata.file_path").alias("path")).where(~F.col("value").rlike("^(#|track|browser|$)"))
    sample = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.(bedgraph|bg)$", "")
    return t.select(sample.alias("sample"), F.lit(strand).alias("strand"), F.get("f", F.lit(0)).alias("chrom"), F.get("f", F.lit(1)).try_cast("long").alias("start"), F.get("f", F.lit(2)).try_cast("long").alias("end"), F.get("f", F.lit(3)).try_cast("double").alias("value"))


def _tsv(spark: SparkSession, path: str, names: list[str], strict: bool = False) -> DataFrame:
    """Tab-separated rows without comments, empty lines and carriage returns, in file order (ord)."""
    t = numbered_lines(spark, path).withColumn("value", F.regexp_replace("value", "\r$", "")).where(~F.col("value").rlike(r"^\s*(#|$)"))
    f = F.split("value", "\t")
    if strict:
        t = t.withColumn("value", F.when(F.col("value").contains("\t"), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no tab in line: "), "value"))))
    return t.select(*[F.trim(F.try_element_at(f, F.lit(i + 1))).alias(n) for i, n in enumerate(names)], F.col("line").alias("ord"))


def read_barcodes(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, ["sample", "barcode"])


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """(sample, grp); FASTQ extensions come off the sample; a line without a tab is an error."""
    return _tsv(spark, path, ["sample", "grp"], strict=True).select(sample_name(F.col("sample")).alias("sample"), "grp")


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, ["chrom", "length"]).select("chrom", F.col("length").cast("long").alias("length"))


def read_scale_factors(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, ["sample", "mapped", "scale"]).select("sample", F.col("mapped").cast("long").alias("mapped"), F.col("scale").cast("double").alias("scale"))


def read_called_peaks(spark: SparkSession, path: str) -> DataFrame:
    """BED6 of a peak caller's table: columns 2, 3, 4, 1, 6, 5; the start is not shifted."""
    t = _tsv(spark, path, ["name", "chrom", "start", "end", "strand", "score"])
    return t.select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "name", F.col("score").cast("double").alias("score"), "strand")


def read_index_stats(spark: SparkSession, path: str) -> DataFrame:
    """(ref, length, mapped, unmapped) of references with mapped reads."""
    t = _tsv(spark, path, ["ref", "length", "mapped", "unmapped"])
    t = t.select("ref", *[F.col(c).cast("long").alias(c) for c in ("length", "mapped", "unmapped")])
    return t.where((F.col("ref") != "*") & (F.col("mapped") > 0))


def read_aligner_stats(spark: SparkSession, path: str) -> DataFrame:
    """(path, total, once, many, rate) out of an aligner's summary text."""
    t = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    n = lambda p: F.regexp_extract("value", p, 1).try_cast("long")
    return t.select("path", n(r"(\d+) reads; of these:").alias("total"), n(r"(\d+) \([^)]*\) aligned exactly 1 time").alias("once"), n(r"(\d+) \([^)]*\) aligned >1 times").alias("many"), F.regexp_extract("value", r"([\d.]+)% overall alignment rate", 1).try_cast("double").alias("rate"))


def read_pileup(spark: SparkSession, path: str) -> DataFrame:
    """A stored pileup; older ones without clean truncations take all truncations, without a strand +."""
    p = spark.read.parquet(path)
    if "clean_truncations" not in p.columns:
        p = p.withColumn("clean_truncations", F.col("truncations"))
    return p if "strand" in p.columns else p.withColumn("strand", F.lit("+"))


def _arrays(blob: bytes) -> tuple[dict[str, np.ndarray], list[tuple[str, str, str]]]:
    """The arrays of a compressed file by name, and (prefix, chrom, strand) of each chromosome and strand in it."""
    z = np.load(io.BytesIO(blob))
    data = {k: z[k] for k in z.files}
    bases = [k[: -len("__positions")] for k in data if k.endswith("__positions")]
    return data, [(b, b.partition("__")[0], "-" if b.partition("__")[2] == "rev" else "+") for b in bases]


def import_pileup_arrays(spark: SparkSession, path: str, sample: str) -> DataFrame:
    """A pileup of compressed arrays: keys chrom__strand__field, or chrom__field without strands.

    Their substitution counts are read by ``import_substitution_arrays``.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob in b.column(0).to_pylist():
                data, parts = _arrays(blob)
                for base, chrom, strand in parts:
                    pos = data[f"{base}__positions"].astype("i8")
                    none = np.zeros(len(pos), "i8")
                    get = lambda f, other, base=base, data=data: data.get(f"{base}__{f}", other).astype("i8")
                    trunc = get("truncations", none)
                    cols = [get("coverage", none), trunc, get("clean_truncations", trunc), get("deletions", none)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([sample] * len(pos)), pa.array([chrom] * len(pos)), pa.array([strand] * len(pos)), pa.array(pos), *map(pa.array, cols)],
                        names=["sample", "chrom", "strand", "pos", "coverage", "truncations", "clean_truncations", "deletions"],
                    )

    schema = "sample string, chrom string, strand string, pos long, coverage long, truncations long, clean_truncations long, deletions long"
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(decode, schema)


def import_substitution_arrays(spark: SparkSession, path: str, sample: str) -> DataFrame:
    """(sample, chrom, strand, pos, sub_type, n) of a pileup of compressed arrays: keys end in ``__sub__TC``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob in b.column(0).to_pylist():
                data, parts = _arrays(blob)
                for base, chrom, strand in parts:
                    for key in [k for k in data if k.startswith(f"{base}__sub__")]:
                        seen = np.flatnonzero(data[key])
                        own = [pa.array([x] * len(seen), pa.string()) for x in (sample, chrom, strand, key[-2:])]
                        pos, n = (pa.array(data[k][seen].astype("i8")) for k in (f"{base}__positions", key))
                        yield pa.RecordBatch.from_arrays([*own[:3], pos, own[3], n], names=["sample", "chrom", "strand", "pos", "sub_type", "n"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(decode, "sample string, chrom string, strand string, pos long, sub_type string, n long")
