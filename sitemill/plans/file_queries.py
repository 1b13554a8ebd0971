"""Queries over files: the derived views are written by the writers and read back by the readers.

The SQL side is the view itself, so a query holds a writer and a reader to each other and to the rows.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import demux, filters, mutations, tracks
from ..operators import pileup as P
from ..sources import readers as R
from ..sources import writers as W
from ..streaming import batches as B
from . import sites
from .queries import CITS, DELS, KEPT, PILE, SCALES, SQL, SUBS, SUBSITES, _pile, _steps, _subs, query
from .views import FASTQ, PEAKS, READS, duck, fastq, peaks, reads


def scratch(spark: SparkSession) -> str:
    """A new folder name for a query's files, in the session's checkpoint folder.

    Where that is unset, a local session gets a temporary folder that ends with the process; on a
    cluster that is an error, since executors don't share such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="files")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root}/files-{uuid.uuid4().hex}"


def _lines(df: DataFrame, path: str, *columns: str) -> str:
    W.write_text(df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in columns])), path)
    return path


# --- reads ------------------------------------------------------------------------------------
@query(duck(FASTQ) + " SELECT header, seq, qual FROM fastq")
def fastq_files(spark: SparkSession, d: str) -> DataFrame:
    root, r = scratch(spark), fastq(spark, d).withColumn("name", F.col("header"))
    W.write_fastq(r.where("ord % 2 = 0"), f"{root}/plain")
    W.write_fastq(r.where("ord % 2 = 1"), f"{root}/packed", gzip=True)
    return R.read_fastq(spark, f"{root}/plain/*.txt").unionByName(R.read_fastq(spark, f"{root}/packed/*.gz")).select("header", "seq", "qual")


@query(duck(FASTQ) + ", n AS (SELECT concat('s', CAST(ord % 4 AS VARCHAR)) AS sample, count(*) AS reads FROM fastq GROUP BY ALL) SELECT sample, reads, round(100 * reads / sum(reads) OVER (), 1) AS percent FROM n")
def deposit_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    W.deposit(fastq(spark, d).withColumn("name", F.col("header")).withColumn("sample", F.concat(F.lit("s"), (F.col("ord") % 4).cast("string"))), path)
    return W.deposit_summary(spark, path)


@query(duck(FASTQ) + " SELECT DISTINCT concat('s', CAST(ord % 4 AS VARCHAR)) AS sample, true AS same FROM fastq")
def deposit_digests(spark: SparkSession, d: str) -> DataFrame:
    """Digests of the deposited files, read as streams, against those of their whole contents."""
    path = scratch(spark)
    mine = W.deposit(fastq(spark, d).withColumn("name", F.col("header")).withColumn("sample", F.concat(F.lit("s"), (F.col("ord") % 4).cast("string"))), path)
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    name = F.regexp_extract("path", "sample=[^/]*/[^/]*$", 0).alias("file")
    both = mine.select(name, "md5").join(whole.select(name, F.md5("content").alias("other")), "file", "full")
    return both.groupBy(F.regexp_extract("file", "sample=([^/]*)/", 1).alias("sample")).agg(F.bool_and(F.coalesce(F.col("md5") == F.col("other"), F.lit(False))).alias("same"))


@query(duck(FASTQ) + " SELECT header, seq FROM fastq ORDER BY ord LIMIT 100")
def trial_reads(spark: SparkSession, d: str) -> DataFrame:
    return R.first_reads(fastq(spark, d), 100).select("header", "seq")


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN concat('SRR', p_partkey) WHEN 1 THEN concat('SRR', p_partkey, '#3') WHEN 2 THEN concat('SRR', p_partkey, '/12') ELSE concat('SRR', p_partkey, ' x') END AS name FROM part")
def mate_stripped(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    end = F.when(k % 4 == 0, "/1").when(k % 4 == 1, "/2#3").when(k % 4 == 2, "/12").otherwise("/2 x")
    return spark.read.parquet(f"{d}/part.parquet").select(k, N.strip_mate(F.concat(F.lit("SRR"), k.cast("string"), end)).alias("name"))


@query("SELECT p_partkey, concat('S', p_partkey) AS sample FROM part")
def sample_names(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    end = F.when(k % 4 == 0, ".fastq.gz").when(k % 4 == 1, "_collapsed.fq").when(k % 4 == 2, "_collapsed.fastq").otherwise(".fq.gz")
    return spark.read.parquet(f"{d}/part.parquet").select(k, N.sample_name(F.concat(F.lit("/run/S"), k.cast("string"), end)).alias("sample"))


@query("SELECT concat('a', p_partkey) AS name, concat('ACGT', repeat('GA', CAST(p_size AS INT))) AS seq FROM part")
def fasta_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    W.write_text(spark.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit(">a"), F.col("p_partkey").cast("string"), F.lit("\nACGT\n"), F.expr("repeat('GA', cast(p_size as int))")).alias("value")), path)
    return R.read_fasta(spark, path)


@query("SELECT concat('c', CAST(p_partkey AS VARCHAR)) AS name, CAST(4 + 2 * p_size AS BIGINT) AS bases, concat('ACGT', repeat('GA', CAST(p_size AS INT))) AS seq FROM part")
def fasta_slices(spark: SparkSession, d: str) -> DataFrame:
    """Sequences read in slices of seven bases, and put together again."""
    path = scratch(spark)
    W.write_text(spark.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit(">c"), F.col("p_partkey").cast("string"), F.lit(" text\nACGT\n"), F.expr("repeat('GA', cast(p_size as int))")).alias("value")), path)
    s = R.read_fasta_slices(spark, path, 7)
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("slice", "bases"))), lambda x: x["bases"]), "")
    return s.groupBy("name").agg(F.sum(F.length("bases")).alias("bases"), whole.alias("seq"))


# --- alignments ---------------------------------------------------------------------------------
ALIGNED = ["qname", "flag", "chrom", "start0", "end0", "mapq", "cigar", "seq", "nh", "md", "strand"]


@query(duck(READS) + f" SELECT {', '.join(ALIGNED)} FROM reads")
def sam_files(spark: SparkSession, d: str) -> DataFrame:
    path, r = scratch(spark), reads(spark, d)
    W.write_sam(r, r.groupBy("chrom").agg(F.max("end0").alias("length")), path)
    return R.read_sam(spark, path).select(*ALIGNED)


@query(duck(READS) + " SELECT chrom, max(end0) AS length FROM reads GROUP BY chrom")
def sam_header(spark: SparkSession, d: str) -> DataFrame:
    path, r = scratch(spark), reads(spark, d)
    W.write_sam(r.limit(10), r.groupBy("chrom").agg(F.max("end0").alias("length")), path)
    return R.read_sam_header(spark, path)


def _bam_files(spark: SparkSession, d: str) -> str:
    path, r = scratch(spark), reads(spark, d)
    W.write_bam(r, r.groupBy("chrom").agg(F.max("end0").alias("length")), path)
    return path


@query(duck(READS) + f" SELECT {', '.join(ALIGNED)}, sample, concat('NH:i:', nh, ' MD:Z:', md) AS tags FROM reads")
def bam_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """BAM files with indexes, one folder a sample, read in parts of 200 kB, longer ones beyond a thousand."""
    return R.read_bam(spark, _bam_files(spark, d), split_bytes=200_000).select(*ALIGNED, "sample", F.array_join("tags", " ").alias("tags"))


@query(duck(READS) + " SELECT qname, sample, chrom, start0, end0, cigar FROM reads WHERE chrom = 'chr2' AND start0 < 9000 AND end0 > 400")
def bam_region(spark: SparkSession, d: str) -> DataFrame:
    """A region, of which the index names the blocks."""
    return R.read_bam(spark, _bam_files(spark, d), "chr2", 400, 9000, split_bytes=50_000).select("qname", "sample", "chrom", "start0", "end0", "cigar")


@query(duck(READS) + " SELECT chrom, max(end0) AS length FROM reads GROUP BY chrom")
def bam_header(spark: SparkSession, d: str) -> DataFrame:
    return R.read_bam_header(spark, _bam_files(spark, d))


@query(duck(READS) + " SELECT qname, sample, chrom, start0, cigar FROM reads")
def alignment_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    W.write_alignments(reads(spark, d), path, 8)
    return spark.read.parquet(path).select("qname", "sample", "chrom", "start0", "cigar")


@query(duck(READS, "k AS (SELECT * FROM reads WHERE mapq >= 1 AND length(seq) >= 16)") + """
SELECT sample, qname, chrom, strand, start0 + 5 AS pos, 'sub' AS mut_type, CASE WHEN strand = '-' THEN 'A' ELSE 'T' END AS ref, CASE WHEN strand = '-' THEN 'G' ELSE 'C' END AS alt FROM k WHERE has_sub = 1
UNION ALL SELECT sample, qname, chrom, strand, start0 + 8, 'del', NULL, NULL FROM k WHERE shape = 'D'""")
def mutation_table(spark: SparkSession, d: str) -> DataFrame:
    return mutations.mutation_list(reads(spark, d))


@query(duck(READS) + " SELECT qname, start0 + 8 AS pos FROM reads WHERE mapq >= 1 AND length(seq) >= 16 AND shape = 'D'")
def deletion_table(spark: SparkSession, d: str) -> DataFrame:
    return mutations.of_type(mutations.mutation_list(reads(spark, d)), "del").select("qname", "pos")


@query("SELECT c_custkey, concat(CASE WHEN c_custkey % 2 = 0 THEN 'chr' ELSE '' END, CAST(c_custkey % 30 AS VARCHAR)) AS chrom FROM customer WHERE c_custkey % 30 BETWEEN 1 AND 22")
def tag_chrom_filter(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    c = spark.read.parquet(f"{d}/customer.parquet").select(k, F.concat(F.when(k % 2 == 0, "chr").otherwise(""), (k % 30).cast("string")).alias("chrom"))
    return c.where(filters.is_numbered_or_named(F.col("chrom")))


# --- intervals and tracks -------------------------------------------------------------------------
@query(duck(PEAKS) + ' SELECT chrom, start, "end", name, score, strand FROM peaks')
def bed_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    W.write_text(W.bed_text(peaks(spark, d)), path, "#chrom\tstart\tend\tname\tscore\tstrand")
    return R.read_bed(spark, path).drop("sample")


@query(duck(PEAKS) + ' SELECT chrom, start, "end", name, score, strand FROM peaks')
def called_peak_files(spark: SparkSession, d: str) -> DataFrame:
    path = _lines(peaks(spark, d), scratch(spark), "name", "chrom", "start", "end", "strand", "score")
    return R.read_called_peaks(spark, path)


FIRST = "u AS (SELECT sample, strand, chrom, CASE WHEN strand = '-' THEN end0 - 1 ELSE start0 END AS s, CASE WHEN strand = '-' THEN end0 ELSE start0 + 1 END AS e, 1 AS v FROM reads WHERE sample = 'A' AND strand = '+')"


@query(duck(READS, FIRST, _steps("track", "u", "sample, strand, chrom")) + ' SELECT strand, chrom, s AS start, e AS "end", CAST(v AS DOUBLE) AS value FROM track')
def bedgraph_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    W.write_bedgraph(tracks.crosslink_track(reads(spark, d).where("sample = 'A' AND strand = '+'")), path, "A +")
    return R.read_bedgraph(spark, path, "+").drop("sample")


# --- tables ---------------------------------------------------------------------------------------
@query(duck(READS, SCALES) + " SELECT sample, mapped, scale FROM scales")
def scale_files(spark: SparkSession, d: str) -> DataFrame:
    return R.read_scale_factors(spark, _lines(tracks.scale_factors(reads(spark, d)), scratch(spark), "sample", "mapped", "scale"))


@query("SELECT concat('S', c_custkey) AS sample, concat('g', c_nationkey) AS grp FROM customer")
def group_files(spark: SparkSession, d: str) -> DataFrame:
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.concat(F.lit("S"), F.col("c_custkey").cast("string"), F.lit(".fastq.gz")).alias("sample"), F.concat(F.lit("g"), F.col("c_nationkey").cast("string")).alias("grp"))
    path = scratch(spark)
    W.write_text(c.select(F.concat_ws("\t", "sample", "grp").alias("value")), path, "# sample, group")
    return R.read_groups(spark, path)


@query("SELECT concat('chr', p_partkey) AS chrom, p_size AS length FROM part")
def size_files(spark: SparkSession, d: str) -> DataFrame:
    p = spark.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit("chr"), F.col("p_partkey").cast("string")).alias("chrom"), F.col("p_size").alias("length"))
    return R.read_chrom_sizes(spark, _lines(p, scratch(spark), "chrom", "length"))


@query("SELECT concat('S', p_partkey) AS sample, translate(CAST(p_partkey + 10000 AS VARCHAR), '0123456789', 'ACGTACGTAC') AS barcode FROM part")
def barcode_files(spark: SparkSession, d: str) -> DataFrame:
    p = spark.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("sample"), F.translate((F.col("p_partkey") + 10000).cast("string"), "0123456789", "ACGTACGTAC").alias("barcode"))
    return R.read_barcodes(spark, _lines(p, scratch(spark), "sample", "barcode")).select("sample", "barcode")


@query(duck(READS) + " SELECT chrom AS ref, max(end0) AS length, count(*) AS mapped, CAST(0 AS BIGINT) AS unmapped FROM reads GROUP BY chrom")
def index_stat_files(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d)
    n = demux.index_stats(r).groupBy("ref").agg(F.sum("mapped").alias("mapped"), F.sum("unmapped").alias("unmapped")).join(r.groupBy(F.col("chrom").alias("ref")).agg(F.max("end0").alias("length")), "ref")
    none = spark.createDataFrame([("*", 0, 0, 4), ("chrUn", 9, 0, 1)], "ref string, length long, mapped long, unmapped long")
    return R.read_index_stats(spark, _lines(n.unionByName(none), scratch(spark), "ref", "length", "mapped", "unmapped"))


@query(duck(READS) + " SELECT count(*) AS total, count(*) FILTER (nh = 1) AS once, count(*) FILTER (nh > 1) AS many, 87.5::DOUBLE AS rate FROM reads")
def aligner_stat_files(spark: SparkSession, d: str) -> DataFrame:
    n = reads(spark, d).agg(F.count("*").alias("t"), F.count_if(F.col("nh") == 1).alias("o"), F.count_if(F.col("nh") > 1).alias("m"))
    text = F.format_string("%d reads; of these:\n  0 (0.00%%) aligned 0 times\n  %d (50.00%%) aligned exactly 1 time\n  %d (37.50%%) aligned >1 times\n87.50%% overall alignment rate", "t", "o", "m")
    path = scratch(spark)
    W.write_text(n.select(text.alias("value")), path)
    return R.read_aligner_stats(spark, path).where("total is not null").drop("path")


# --- pileups and sites -----------------------------------------------------------------------------
@query(duck(READS, KEPT, PILE) + " SELECT * FROM pile")
def pileup_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    W.write_pileup(_pile(spark, d), path)
    return R.read_pileup(spark, path).select(*P.KEYS, "pos", "coverage", "truncations", "clean_truncations", "deletions")


NAMED = "concat_ws(':', {label}, chrom, pos, strand) AS name, CAST(least(floor(-log10(greatest(qvalue, 1e-300)) * 100), 1000) AS BIGINT) AS score"


@query(duck(READS, KEPT, PILE, SUBS, SUBSITES) + " SELECT sample, " + NAMED.format(label="concat(left(sub_type, 1), 'to', right(sub_type, 1))") + " FROM hits WHERE qvalue <= 0.05 AND sub_type = 'TC'")
def converted_sites(spark: SparkSession, d: str) -> DataFrame:
    kinds = sites.parse_sub_types(["TtoC", "t>c", "XY"])
    return P.bed_sites(sites.substitution_sites(_pile(spark, d), _subs(spark, d), kinds), None).select("sample", "name", "score")


@query(duck(READS, KEPT, PILE, DELS) + " SELECT chrom, pos AS start, pos + 1 AS \"end\", " + NAMED.format(label="'del'") + ", strand FROM dels WHERE qvalue <= 0.05")
def site_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    W.write_sites(P.bed_sites(sites.deletion_sites(_pile(spark, d)), "del"), path)
    return R.read_bed(spark, path).select("chrom", "start", "end", "name", F.col("score").cast("long").alias("score"), "strand")


@query(
    duck(READS, KEPT, PILE, CITS)
    + " SELECT 'truncations' AS kind, sample, count(*) AS n FROM cits WHERE qvalue <= 0.05 GROUP BY sample UNION ALL SELECT 'crosslinks', sample, count(*) FROM pile WHERE truncations >= 1 GROUP BY sample UNION ALL SELECT 'pileup', sample, count(*) FROM pile GROUP BY sample"
)
def sample_run(spark: SparkSession, d: str) -> DataFrame:
    out = sites.analyse(reads(spark, d))
    parts = [out[k].groupBy("sample").agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "sample", "n") for k in ("truncations", "crosslinks", "pileup")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(SQL["umi_directional_dedup"])
def streamed_umi_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Reads in files, a fourth of them a batch of a stream, whose state gives the networks of one table."""
    root = scratch(spark)
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))  # a fourth of them a batch
    reads(spark, d).repartition(files).write.parquet(f"{root}/in")
    rows = spark.readStream.schema(spark.read.parquet(f"{root}/in").schema).option("maxFilesPerTrigger", -(-files // 4)).parquet(f"{root}/in")
    B.keep_umi_sums(filters.unique_reads(rows), f"{root}/sums", f"{root}/state").awaitTermination()
    return B.streamed_dedup(spark, f"{root}/sums")
