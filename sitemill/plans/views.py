"""Alignment, peak and name views derived from the star-schema tables, one SQL text for Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Common table expressions; every clause is read alike by both engines.
READS = """
base AS (
  SELECT l_orderkey * 8 + l_linenumber AS read_id, concat('chr', CAST(l_suppkey % 5 + 1 AS STRING)) AS chrom,
    l_partkey * 10 + CASE WHEN l_partkey % 10 = 0 THEN 0 ELSE l_linenumber END AS start0,
    l_partkey * 10 + CASE WHEN l_partkey % 10 = 0 THEN 0 ELSE l_linenumber END + 20 + CAST(l_quantity AS BIGINT) % 16 AS end0,
    CASE WHEN l_linestatus = 'O' THEN '-' ELSE '+' END AS strand, l_returnflag AS sample,
    l_suppkey AS a, l_partkey AS b, l_linenumber AS c, CAST(l_quantity AS BIGINT) AS q,
    CASE WHEN l_suppkey % 11 = 0 THEN 'D' WHEN l_suppkey % 13 = 0 THEN 'N' ELSE 'M' END AS shape
  FROM {lineitem}),
ranked AS (
  SELECT *, end0 - start0 AS len, CASE WHEN q % 5 = 0 AND shape = 'M' THEN 1 ELSE 0 END AS has_sub,
    row_number() OVER (PARTITION BY read_id ORDER BY chrom, start0, end0, strand, sample, a, b, q) AS ord,
    count(*) OVER (PARTITION BY read_id) AS hits
  FROM base),
reads AS (
  SELECT read_id, CAST(read_id AS STRING) AS qname, chrom, start0, end0, strand, sample, shape, len, has_sub, CAST(ord AS BIGINT) AS ord,
    CASE WHEN shape = 'D' THEN concat('8M1D', CAST(len - 9 AS STRING), 'M') WHEN shape = 'N' THEN concat('6M4N', CAST(len - 10 AS STRING), 'M') ELSE concat(CAST(len AS STRING), 'M') END AS cigar,
    CASE WHEN shape = 'D' THEN concat('8^A', CAST(len - 9 AS STRING)) WHEN has_sub = 1 THEN concat('5T', CAST(len - 6 AS STRING)) WHEN shape = 'N' THEN CAST(len - 4 AS STRING) ELSE CAST(len AS STRING) END AS md,
    concat('AAAAA', CASE WHEN has_sub = 1 THEN 'C' ELSE 'A' END, repeat('A', CAST(len - 6 - CASE WHEN shape = 'D' THEN 1 WHEN shape = 'N' THEN 4 ELSE 0 END AS INT))) AS seq,
    CAST(CASE WHEN strand = '-' THEN 16 ELSE 0 END + CASE WHEN ord > 1 THEN 256 ELSE 0 END AS INT) AS flag,
    CAST(hits AS INT) AS nh, CAST(CASE WHEN hits = 1 THEN 255 ELSE 3 END AS INT) AS mapq,
    concat(translate(CAST(b % 4 AS STRING), '0123', 'ACGT'), translate(CAST(a % 4 AS STRING), '0123', 'ACGT'), translate(CAST(c % 4 AS STRING), '0123', 'ACGT')) AS umi
  FROM ranked)
"""
PEAKS = """
peaks AS (
  SELECT p_partkey AS peak_id, concat('chr', CAST(p_partkey % 5 + 1 AS STRING)) AS chrom, p_partkey * 10 AS start, p_partkey * 10 + 20 + p_size AS "end",
    concat('peak', CAST(p_partkey AS STRING)) AS name, CAST(p_size AS DOUBLE) AS score, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand
  FROM {part})
"""
FASTQ = """
fastq AS (
  SELECT CAST(o_orderkey AS BIGINT) AS ord, concat('R', CAST(o_orderkey AS STRING), ' 2:N:0') AS header,
    concat(translate(CAST(o_custkey % 4 AS STRING), '0123', 'ACGT'), translate(CAST(o_custkey % 3 AS STRING), '012', 'GAT'), 'ACGTACGTACGTACGTACGT', translate(CAST(o_custkey % 10 AS STRING), '0123456789', 'ACGTACGTAC')) AS seq,
    concat(repeat(CASE WHEN o_orderkey % 3 = 0 THEN '#' ELSE 'I' END, 10), repeat('F', 13)) AS qual,
    concat('R', CAST(o_orderkey AS STRING), '#', CAST(o_orderkey % 5 + 1 AS STRING), CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE concat('#', translate(CAST(o_custkey % 1000 + 1000 AS STRING), '0123456789', 'ACGTACGTAN')) END) AS name
  FROM {orders})
"""
GROUPS = "grp AS (SELECT 'A' AS sample, 'g1' AS grp UNION ALL SELECT 'N', 'g1' UNION ALL SELECT 'R', 'g2')"


def view(spark: SparkSession, sf_dir: str, text: str, name: str) -> DataFrame:
    """One of the views above as a DataFrame over a data directory."""
    tables = [t for t in ("lineitem", "part", "orders") if f"{{{t}}}" in text]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    return spark.sql(f"WITH {text.replace(chr(34) + 'end' + chr(34), 'end')} SELECT * FROM {name}", **frames)


def duck(*texts: str) -> str:
    """The views as the start of a DuckDB query."""
    joined = ",".join(t.strip() for t in texts)
    for t in ("lineitem", "part", "orders"):
        joined = joined.replace(f"{{{t}}}", t)
    return f"WITH {joined}"


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, READS, "reads")


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, PEAKS, "peaks")


def fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, FASTQ, "fastq")


def groups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("A", "g1"), ("N", "g1"), ("R", "g2")], "sample string, grp string")
