"""Every operator as a query over the derived views, with DuckDB SQL written apart from the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.alignment import cigar_blocks, with_md
from ..functions.lineage import stored
from ..functions.sql import register
from ..functions.stats import binom_sf, binom_sf_deep, site_score
from ..operators import collapse, dedup, demux, filters, intervals, matrix, mutations, tracks
from ..operators import peaks as peaking
from ..operators import pileup as P
from ..streaming.batches import windowed_counts
from . import prep, sites, tags
from .views import FASTQ, GROUPS, PEAKS, READS, duck, fastq, groups, peaks, reads

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# --- common table expressions of the SQL side -----------------------------------------------
KEPT = "kept AS (SELECT * FROM reads WHERE (flag & 256) = 0 AND mapq >= 255)"
BLOCKS = """
blocks AS (
  SELECT sample, chrom, strand, 'M' AS kind, start0 AS s, CASE shape WHEN 'D' THEN start0 + 8 WHEN 'N' THEN start0 + 6 ELSE end0 END AS e FROM kept
  UNION ALL SELECT sample, chrom, strand, 'M', CASE shape WHEN 'D' THEN start0 + 9 ELSE start0 + 10 END, end0 FROM kept WHERE shape <> 'M'
  UNION ALL SELECT sample, chrom, strand, 'D', start0 + 8, start0 + 9 FROM kept WHERE shape = 'D')"""
PILE = (
    BLOCKS
    + """,
sites AS (SELECT sample, chrom, strand, CASE shape WHEN 'D' THEN 'T' ELSE 'C' END AS kind, CASE WHEN strand = '-' THEN end0 ELSE start0 - 1 END AS t FROM kept),
marks AS (
  SELECT sample, chrom, strand, kind, unnest(range(s, e)) AS pos FROM blocks
  UNION ALL SELECT sample, chrom, strand, kind, t FROM sites WHERE t >= 0),
pile AS (
  SELECT sample, chrom, strand, pos, CAST(count(*) FILTER (kind <> 'D') AS BIGINT) AS coverage, CAST(count(*) FILTER (kind IN ('T', 'C')) AS BIGINT) AS truncations,
    CAST(count(*) FILTER (kind = 'C') AS BIGINT) AS clean_truncations, CAST(count(*) FILTER (kind = 'D') AS BIGINT) AS deletions
  FROM marks GROUP BY ALL)"""
)
SUBS = """
subs AS (
  SELECT sample, chrom, strand, start0 + 5 AS pos, CASE WHEN strand = '-' THEN 'AG' ELSE 'TC' END AS sub_type, least(count(*), 65535) AS n
  FROM kept WHERE has_sub = 1 AND NOT (strand = '+' AND start0 = 0) GROUP BY ALL)"""
CLUSTERS = """
flagged AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 25 THEN 0 ELSE 1 END AS new FROM pile WINDOW w AS (PARTITION BY sample, chrom, strand ORDER BY pos)),
clusters AS (SELECT * EXCLUDE (new), CAST(sum(new) OVER (PARTITION BY sample, chrom, strand ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM flagged),
rated AS (
  SELECT *, CASE WHEN sum(coverage) OVER w > 0 THEN sum(clean_truncations) OVER w / sum(coverage) OVER w ELSE 0 END AS local_rate
  FROM clusters WINDOW w AS (PARTITION BY sample, chrom, strand, cluster))"""


def _lambda(name: str, source: str, signal: str, by: str) -> str:
    return f"""
{name}_f AS (SELECT {by}, {signal} AS s, coverage AS c, {signal} / coverage AS f FROM {source} WHERE coverage >= 5),
{name}_t AS (SELECT {by}, quantile_cont(f, 0.99) AS t FROM {name}_f GROUP BY ALL),
{name} AS (
  SELECT {by}, CASE WHEN max(t) > 0 AND coalesce(sum(c) FILTER (f <= t), 0) > 0 THEN sum(s) FILTER (f <= t) / sum(c) FILTER (f <= t) ELSE sum(s) / sum(c) END AS lam
  FROM {name}_f JOIN {name}_t USING ({by}) GROUP BY {by})"""


PVALUE = "CASE WHEN r <= 0 OR r >= 1 THEN 1.0 ELSE least(1.0, list_sum(list_transform(range(k, m + 1), lambda i: exp(lgamma(m + 1) - lgamma(i + 1) - CASE WHEN i = m THEN 0 ELSE lgamma(m - i + 1) END + i * ln(r) + (m - i) * ln(1 - r))))) END"


def _tested(name: str, source: str, signal: str, rate: str, family: str) -> str:
    return f"""
{name}_t AS (SELECT *, {signal} AS k, coverage AS m, {rate} AS r FROM {source} WHERE coverage >= 5 AND {signal} >= 1 AND {signal} / coverage >= 0.05),
{name}_p AS (
  SELECT *, {PVALUE} AS pvalue
  FROM {name}_t),
{name}_r AS (SELECT *, pvalue * count(*) OVER (PARTITION BY {family}) / row_number() OVER (PARTITION BY {family} ORDER BY pvalue) AS adj, row_number() OVER (PARTITION BY {family} ORDER BY pvalue) AS rk FROM {name}_p),
{name} AS (SELECT *, least(1.0, min(adj) OVER (PARTITION BY {family} ORDER BY rk DESC ROWS UNBOUNDED PRECEDING)) AS qvalue FROM {name}_r)"""


FAMILY = "sample, chrom, strand"
LAM_CLEAN = _lambda("lam", "pile", "clean_truncations", "sample")
CITS = CLUSTERS + "," + LAM_CLEAN + "," + "src AS (SELECT rated.* FROM rated JOIN lam USING (sample) WHERE lam > 0)," + _tested("cits", "src", "clean_truncations", "local_rate", FAMILY)
DELS = _lambda("lam", "pile", "deletions", "sample") + ", src AS (SELECT pile.*, lam FROM pile JOIN lam USING (sample) WHERE lam > 0)," + _tested("dels", "src", "deletions", "lam", FAMILY)
SUBLAM = """
slices AS (SELECT DISTINCT sample, chrom, strand, sub_type FROM subs),
subrows AS (SELECT p.sample, p.coverage, s.sub_type, coalesce(n, 0) AS n FROM pile p JOIN slices s USING (sample, chrom, strand) LEFT JOIN subs USING (sample, chrom, strand, pos, sub_type)),""" + _lambda("lam", "subrows", "n", "sample, sub_type")
SUBSITES = SUBLAM + ", src AS (SELECT p.*, n, sub_type, lam FROM pile p JOIN subs USING (sample, chrom, strand, pos) JOIN lam USING (sample, sub_type) WHERE lam > 0)," + _tested("hits", "src", "n", "lam", "sample, chrom, strand, sub_type")
SCALES = "scales AS (SELECT sample, count(*) AS mapped, floor(1000000.0::DOUBLE / count(*) * 1000000) / 1000000 AS scale FROM reads GROUP BY sample)"
TC = """
features AS (SELECT sample, chrom, strand, start0 AS s, end0 AS e FROM reads WHERE (flag & 256) = 0),
tc AS (
  SELECT k.*, x.sample, (SELECT count(*) FROM features f WHERE f.sample = x.sample AND f.chrom = k.chrom AND f.strand = k.strand AND f.s < k."end" AND k.start < f.e) AS tc
  FROM peaks k, (SELECT DISTINCT sample FROM features) x)"""
#: Steps of a sweep as SQL: events, running sums, merged islands.


def _steps(name: str, source: str, keys: str) -> str:
    return f"""
{name}_e AS (SELECT {keys}, pos, sum(d) AS d FROM (SELECT {keys}, s AS pos, v AS d FROM {source} UNION ALL SELECT {keys}, e, -v FROM {source}) GROUP BY ALL),
{name}_s AS (SELECT {keys}, pos AS s, lead(pos) OVER w AS e, sum(d) OVER (PARTITION BY {keys} ORDER BY pos ROWS UNBOUNDED PRECEDING) AS v FROM {name}_e WHERE d <> 0 WINDOW w AS (PARTITION BY {keys} ORDER BY pos)),
{name}_n AS (SELECT *, CASE WHEN lag(e) OVER w = s AND lag(v) OVER w = v THEN 0 ELSE 1 END AS new FROM {name}_s WHERE e IS NOT NULL AND abs(v) > 1e-12 WINDOW w AS (PARTITION BY {keys} ORDER BY s)),
{name}_i AS (SELECT *, sum(new) OVER (PARTITION BY {keys} ORDER BY s ROWS UNBOUNDED PRECEDING) AS isl FROM {name}_n),
{name} AS (SELECT {keys}, min(s) AS s, max(e) AS e, any_value(v) AS v FROM {name}_i GROUP BY {keys}, isl)"""


PLAIN = "plain AS (SELECT sample, strand, chrom, start0 AS s, end0 AS e, 1 AS v FROM reads WHERE shape <> 'N')"
RPM = PLAIN + "," + _steps("steps", "plain", "sample, strand, chrom")
REPEATS = """
hits AS (SELECT sample, CASE WHEN read_id % 9 = 0 THEN '*' WHEN read_id % 4 = 0 THEN concat('Alu', CAST(read_id % 13 AS STRING), '#SINE/Alu') WHEN read_id % 4 = 1 THEN concat('MER', CAST(read_id % 7 AS STRING), '#DNA')
  WHEN read_id % 4 = 2 THEN concat('tRNA-Ala-', CAST(read_id % 5 AS STRING)) ELSE 'U13369.1' END AS ref FROM reads)"""
ELEMENTS = (
    REPEATS
    + """,
totals AS (SELECT sample, count(*) AS total FROM hits GROUP BY sample),
elements AS (
  SELECT sample, CASE WHEN contains(ref, '#') THEN split_part(ref, '#', 1) ELSE ref END AS element, CASE WHEN contains(ref, '#') THEN split_part(split_part(ref, '#', 2), '/', 1) WHEN contains(ref, 'tRNA') THEN 'tRNA' ELSE 'rRNA' END AS class,
    CASE WHEN contains(ref, '#') THEN split_part(ref, '#', 2) WHEN contains(ref, 'tRNA') THEN 'tRNA' ELSE 'rRNA/rDNA' END AS family, count(*) AS raw_reads, round(count(*) / any_value(total) * 1e6, 2) AS rpm
  FROM hits JOIN totals USING (sample) WHERE ref <> '*' GROUP BY sample, ref)"""
)
BARCODES = "barcodes AS (SELECT 'b1' AS sample, 'AGAC' AS barcode, 0 AS ord UNION ALL SELECT 'b2', 'CAAC', 1 UNION ALL SELECT 'b3', 'GTAC', 2 UNION ALL SELECT 'b4', 'TGAC', 3)"


#: Tag-based parts of the SQL side.
def _thrown(kind: str, pos: str) -> str:
    """Counts of real and thrown mutations of one kind, and their rates by (k, m)."""
    return f"""
muts AS (SELECT qname, chrom, strand, {pos} AS pos FROM u WHERE {kind}),
cover AS (SELECT chrom, strand, pos, count(*) AS k FROM (SELECT chrom, strand, unnest(range(start0, end0)) AS pos FROM u) GROUP BY ALL),
seen AS (SELECT chrom, strand, pos, k, count(*) AS m FROM muts JOIN cover USING (chrom, strand, pos) GROUP BY ALL),
numbered AS (SELECT u.*, row_number() OVER (PARTITION BY qname ORDER BY start0) AS i FROM muts JOIN u USING (qname)),
thrown AS (SELECT it, chrom, strand, start0 + CAST(concat('0x', left(md5(concat_ws('|', qname, i, it, 1)), 8)) AS BIGINT) % (end0 - start0) AS pos FROM numbered, range(1, 6) t(it)),
nulls AS (SELECT k, m, count(*) / 5 AS n_null FROM (SELECT it, chrom, strand, pos, count(*) AS m FROM thrown GROUP BY ALL) JOIN cover USING (chrom, strand, pos) GROUP BY ALL),
reals AS (SELECT k, m, count(*) AS n_real FROM seen GROUP BY ALL),
sums AS (SELECT k, m, sum(coalesce(n_real, 0)) OVER w AS a, sum(coalesce(n_null, 0)) OVER w AS b FROM reals FULL JOIN nulls USING (k, m) WINDOW w AS (PARTITION BY k ORDER BY m DESC ROWS UNBOUNDED PRECEDING)),
rates AS (SELECT k, m, CASE WHEN a > 0 THEN least(b / a, 1.0) ELSE 1.0 END AS fdr FROM sums)"""


def _truncated(keys: str, source: str = "u") -> str:
    """Tested truncations of tags without a deletion, in clusters by gap."""
    return f"""
n AS (SELECT {keys}, CASE WHEN strand = '-' THEN end0 ELSE start0 - 1 END AS pos, count(*) AS k FROM {source} WHERE qname NOT IN (SELECT qname FROM u WHERE shape = 'D') GROUP BY ALL),
f AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 25 THEN 0 ELSE 1 END AS new FROM n WHERE pos >= 0 WINDOW w AS (PARTITION BY {keys} ORDER BY pos)),
c AS (SELECT *, sum(new) OVER (PARTITION BY {keys} ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cluster FROM f),
t AS (SELECT *, CAST(sum(k) OVER w AS BIGINT) AS m, 1.0::DOUBLE / (max(pos) OVER w - min(pos) OVER w + 1) AS r FROM c WINDOW w AS (PARTITION BY {keys}, cluster)),
p AS (SELECT *, {PVALUE} AS pvalue FROM t)"""


def _tiles(keys: str, source: str) -> str:
    """Peaks as the largest tiles of 20 bases around, against the share of 51 tiles."""
    return f"""
tiles AS (SELECT {keys}, CAST(floor((start0 + end0) / 2 / 20) AS BIGINT) AS tile, count(*) AS k FROM {source} GROUP BY ALL),
near AS (
  SELECT *, 1.0::DOUBLE / 51 AS r, CAST(sum(k) OVER (PARTITION BY {keys} ORDER BY tile RANGE BETWEEN 25 PRECEDING AND 25 FOLLOWING) AS BIGINT) AS m,
    k * 10000000000 - tile = max(k * 10000000000 - tile) OVER (PARTITION BY {keys} ORDER BY tile RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS top FROM tiles),
called AS (SELECT *, {PVALUE} AS pvalue FROM near WHERE top AND k >= 3 AND k >= 2.0 * m / 51)"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function as a query, and its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _pile(spark: SparkSession, d: str, chunks: bool = False) -> DataFrame:
    return P.pileup(filters.pileup_reads(reads(spark, d)), chunks=chunks)


def _subs(spark: SparkSession, d: str) -> DataFrame:
    return P.substitution_counts(filters.pileup_reads(reads(spark, d)))


def _log(c: str) -> F.Column:
    return F.round(-F.log10(c), 4)


# --- reads and blocks -------------------------------------------------------------------------
@query(duck(READS, KEPT, BLOCKS) + " SELECT sample, chrom, strand, kind, s AS start, e AS \"end\" FROM blocks")
def cigar_blocks_query(spark: SparkSession, d: str) -> DataFrame:
    r = filters.pileup_reads(reads(spark, d))
    return r.select("sample", "chrom", "strand", F.inline(cigar_blocks(F.col("cigar"), F.col("start0")))).select("sample", "chrom", "strand", "kind", F.col("s").alias("start"), F.col("e").alias("end"))


@query(duck(READS) + " SELECT qname, sample FROM reads WHERE nh <= 1")
def nh_unique_filter(spark: SparkSession, d: str) -> DataFrame:
    return filters.unique_reads(reads(spark, d)).select("qname", "sample")


@query(duck(READS) + " SELECT qname, sample, nh FROM reads WHERE nh > 1")
def nh_multi_extract(spark: SparkSession, d: str) -> DataFrame:
    return filters.multimapped_reads(reads(spark, d)).select("qname", "sample", "nh")


@query(duck(READS) + " SELECT qname, sample, mapq, flag FROM reads WHERE (flag & 256) = 0 AND mapq >= 3 AND nh <= 2")
def pileup_read_filter(spark: SparkSession, d: str) -> DataFrame:
    return filters.pileup_reads(reads(spark, d), 3, 2).select("qname", "sample", "mapq", "flag")


@query("SELECT concat('chr', CASE WHEN c_custkey % 30 = 0 THEN 'Un_KI' ELSE CAST(c_custkey % 30 AS VARCHAR) END) AS chrom, count(*) AS n FROM customer WHERE c_custkey % 30 <> 0 GROUP BY 1")
def canonical_chrom_filter(spark: SparkSession, d: str) -> DataFrame:
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.concat(F.lit("chr"), F.when(F.col("c_custkey") % 30 == 0, "Un_KI").otherwise((F.col("c_custkey") % 30).cast("string"))).alias("chrom"))
    return filters.canonical_chromosomes(c).groupBy("chrom").agg(F.count("*").alias("n"))


@query("SELECT concat('chr', CAST(c_custkey % 30 AS VARCHAR)) AS chrom, count(*) AS n FROM customer WHERE c_custkey % 30 BETWEEN 1 AND 22 GROUP BY 1")
def standard_chrom_filter(spark: SparkSession, d: str) -> DataFrame:
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.concat(F.lit("chr"), (F.col("c_custkey") % 30).cast("string")).alias("chrom"))
    return c.where(filters.is_human_standard(F.col("chrom"))).groupBy("chrom").agg(F.count("*").alias("n"))


@query(duck(READS) + " SELECT sample, count(*) AS mapped FROM reads GROUP BY sample")
def mapped_read_count(spark: SparkSession, d: str) -> DataFrame:
    return tracks.scale_factors(reads(spark, d)).select("sample", "mapped")


# --- pileup -----------------------------------------------------------------------------------
@query(duck(READS, KEPT, PILE) + " SELECT * FROM pile")
def pileup(spark: SparkSession, d: str) -> DataFrame:
    return _pile(spark, d)


@query(duck(READS, KEPT, SUBS) + " SELECT sample, chrom, strand, pos, sub_type, CAST(n AS BIGINT) AS n FROM subs")
def substitution_counts(spark: SparkSession, d: str) -> DataFrame:
    return _subs(spark, d)


@query(
    duck(READS, KEPT, PILE)
    + " SELECT sample, chrom, (SELECT count(*) FROM kept k WHERE k.sample = p.sample AND k.chrom = p.chrom) AS n_reads, count(*) AS n_pos, CAST(sum(truncations) AS BIGINT) AS truncations, CAST(sum(deletions) AS BIGINT) AS deletions FROM pile p GROUP BY sample, chrom"
)
def chrom_summary(spark: SparkSession, d: str) -> DataFrame:
    r = filters.pileup_reads(reads(spark, d))
    n = r.groupBy("sample", "chrom").agg(F.count("*").alias("n_reads"))
    s = P.pileup(r).groupBy("sample", "chrom").agg(F.count("*").alias("n_pos"), F.sum("truncations").alias("truncations"), F.sum("deletions").alias("deletions"))
    return n.join(s, ["sample", "chrom"])


@query(duck(READS, KEPT, PILE) + " SELECT sample, chrom, strand, pos, truncations FROM pile ORDER BY truncations DESC, sample, chrom, strand, pos LIMIT 20")
def top_truncation_sites(spark: SparkSession, d: str) -> DataFrame:
    return _pile(spark, d).select("sample", "chrom", "strand", "pos", "truncations").orderBy(F.col("truncations").desc(), "sample", "chrom", "strand", "pos").limit(20)


@query(
    duck(READS, KEPT, PILE)
    + " SELECT sample, chrom, pos AS start, pos + 1 AS \"end\", concat(chrom, ':', CAST(pos AS VARCHAR), ':', strand) AS name, least(truncations, 1000) AS score, strand FROM pile WHERE truncations >= 1"
)
def all_crosslinks(spark: SparkSession, d: str) -> DataFrame:
    return sites.all_crosslinks(_pile(spark, d))


# --- backgrounds, clusters, tests ---------------------------------------------------------------
@query(duck(READS, KEPT, PILE, LAM_CLEAN) + " SELECT sample, round(lam, 9) AS lambda FROM lam")
def background_lambda(spark: SparkSession, d: str) -> DataFrame:
    return P.background(_pile(spark, d), "clean_truncations", ["sample"]).select("sample", F.round("lambda", 9).alias("lambda"))


@query(duck(READS, KEPT, PILE, SUBS, SUBLAM) + " SELECT sample, sub_type, round(lam, 9) AS lambda FROM lam")
def background_lambda_by_type(spark: SparkSession, d: str) -> DataFrame:
    return sites.substitution_background(_pile(spark, d), _subs(spark, d)).select("sample", "sub_type", F.round("lambda", 9).alias("lambda"))


@query(duck(READS, KEPT, PILE, CLUSTERS) + " SELECT sample, chrom, strand, pos, cluster FROM clusters")
def gap_clusters(spark: SparkSession, d: str) -> DataFrame:
    return intervals.gap_cluster(_pile(spark, d, True), P.KEYS, chunk=intervals.CHUNK).select(*P.KEYS, "pos", F.col("cluster").cast("long").alias("cluster"))


@query(duck(READS, KEPT, PILE, CLUSTERS) + " SELECT sample, chrom, strand, pos, min(pos) OVER (PARTITION BY sample, chrom, strand, cluster) AS cluster FROM clusters")
def gap_clusters_chunked(spark: SparkSession, d: str) -> DataFrame:
    return intervals.gap_cluster_chunked(_pile(spark, d), P.KEYS, chunk=500).select(*P.KEYS, "pos", "cluster")


@query("WITH e AS (SELECT user_id, event_id, epoch(ts)::BIGINT AS pos FROM events), f AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 3600 THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY pos, event_id)) SELECT user_id, CAST(sum(new) AS BIGINT) AS sessions FROM f GROUP BY user_id")
def event_gap_clusters(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet").select("user_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000 + 0.5).alias("pos"))
    return intervals.gap_cluster(e, ["user_id"], "pos", 3600).groupBy("user_id").agg(F.max("cluster").alias("sessions"))


@query(duck(READS, KEPT, PILE, CLUSTERS) + " SELECT sample, chrom, strand, pos, round(local_rate, 9) AS local_rate FROM rated")
def local_cluster_rate(spark: SparkSession, d: str) -> DataFrame:
    return P.cluster_rates(_pile(spark, d, True)).select(*P.KEYS, "pos", F.round("local_rate", 9).alias("local_rate"))


TAIL = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, k, n, round(-log10(least(1.0, list_sum(list_transform(range(k, n + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p) + (n - i) * ln(1 - p)))))), 4) AS logp FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linenumber AS k, l_linenumber + CAST(l_quantity AS BIGINT) AS n, 0.01 + l_discount / 2 AS p FROM lineitem)"


def _tails(spark: SparkSession, d: str) -> DataFrame:
    t = spark.read.parquet(f"{d}/lineitem.parquet")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return t.select(*keys, F.col("l_linenumber").alias("k"), (F.col("l_linenumber") + F.col("l_quantity").cast("long")).alias("n"), (F.lit(0.01) + F.col("l_discount") / 2).alias("p"))


@query(TAIL)
def binom_pvalue(spark: SparkSession, d: str) -> DataFrame:
    return _tails(spark, d).withColumn("x", binom_sf(F.col("k"), F.col("n"), F.col("p"))).withColumn("logp", _log("x")).drop("x", "p")


@query(TAIL)
def binom_pvalue_deep(spark: SparkSession, d: str) -> DataFrame:
    return _tails(spark, d).withColumn("x", binom_sf_deep(F.col("k").cast("long"), F.col("n"), F.col("p"))).withColumn("logp", _log("x")).drop("x", "p")


SITE = "sample, chrom, strand, pos, coverage"
SITE_STATS = "round(-log10(pvalue), 4) AS logp, round(qvalue, 6) AS qvalue"


@query(duck(READS, KEPT, PILE, CITS) + f" SELECT {SITE}, clean_truncations, {SITE_STATS} FROM cits")
def bh_qvalue(spark: SparkSession, d: str) -> DataFrame:
    t = P.test_sites(P.cluster_rates(_pile(spark, d, True)), "clean_truncations", "local_rate")
    return t.select(*P.KEYS, "pos", "coverage", "clean_truncations", _log("pvalue").alias("logp"), F.round("qvalue", 6).alias("qvalue"))


@query("WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_orderkey * 37 + l_linenumber * 11 + l_partkey * 7 + l_suppkey + 1) % 9973 / 9973.0 AS p FROM lineitem), r AS (SELECT *, p * count(*) OVER () / row_number() OVER (ORDER BY p) AS adj, row_number() OVER (ORDER BY p) AS rk FROM p) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(least(1.0, min(adj) OVER (ORDER BY rk DESC ROWS UNBOUNDED PRECEDING)), 6) AS q FROM r")
def bh_qvalue_ranged(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.stats import bh_adjust_ranged

    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    t = spark.read.parquet(f"{d}/lineitem.parquet").select(*keys, ((F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11 + F.col("l_partkey") * 7 + F.col("l_suppkey") + 1) % 9973 / F.lit(9973.0)).alias("p"))
    return bh_adjust_ranged(t, "p", "q").select(*keys, F.round("q", 6).alias("q"))


@query(duck(READS, KEPT, PILE, CITS) + f" SELECT {SITE}, clean_truncations AS signal, round(fraction, 6) AS fraction, {SITE_STATS}, CAST(least(floor(-log10(greatest(qvalue, 1e-300)) * 100), 1000) AS BIGINT) AS score FROM (SELECT *, clean_truncations / coverage AS fraction FROM cits) WHERE qvalue <= 0.05")
def cits_sites(spark: SparkSession, d: str) -> DataFrame:
    t = sites.truncation_sites(_pile(spark, d, True))
    return t.select(*P.KEYS, "pos", "coverage", "signal", F.round("fraction", 6).alias("fraction"), _log("pvalue").alias("logp"), F.round("qvalue", 6).alias("qvalue"), site_score(F.col("qvalue")).alias("score"))


@query(duck(READS, KEPT, PILE, DELS) + f" SELECT {SITE}, deletions, {SITE_STATS} FROM dels WHERE qvalue <= 0.05")
def cims_deletions(spark: SparkSession, d: str) -> DataFrame:
    t = sites.deletion_sites(_pile(spark, d))
    return t.select(*P.KEYS, "pos", "coverage", "deletions", _log("pvalue").alias("logp"), F.round("qvalue", 6).alias("qvalue"))


@query(duck(READS, KEPT, PILE, SUBS, SUBSITES) + f" SELECT {SITE}, sub_type, CAST(n AS BIGINT) AS n, {SITE_STATS} FROM hits WHERE qvalue <= 0.05")
def cims_substitutions(spark: SparkSession, d: str) -> DataFrame:
    t = sites.substitution_sites(_pile(spark, d), _subs(spark, d))
    return t.select(*P.KEYS, "pos", "coverage", "sub_type", "n", _log("pvalue").alias("logp"), F.round("qvalue", 6).alias("qvalue"))


@query(
    duck(READS, KEPT, PILE, LAM_CLEAN, "src AS (SELECT pile.*, lam FROM pile JOIN lam USING (sample) WHERE lam > 0)", _tested("tested", "src", "clean_truncations", "lam", FAMILY))
    + f" SELECT {SITE}, clean_truncations, {SITE_STATS} FROM tested WHERE qvalue <= 0.05"
)
def legacy_global_sites(spark: SparkSession, d: str) -> DataFrame:
    t = sites.truncation_sites(_pile(spark, d), rates="global")
    return t.select(*P.KEYS, "pos", "coverage", "clean_truncations", _log("pvalue").alias("logp"), F.round("qvalue", 6).alias("qvalue"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(least(floor(-log10(greatest(pow(10.0, -l_quantity / 4), 1e-300)) * 100 + 0.5), 1000) AS BIGINT) AS score FROM lineitem")
def bed_score(spark: SparkSession, d: str) -> DataFrame:
    t = spark.read.parquet(f"{d}/lineitem.parquet")
    q = F.pow(F.lit(10.0), -F.col("l_quantity") / 4 - 0.005)
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", site_score(q).alias("score"))


@query(duck(READS, GROUPS, "pooled AS (SELECT * REPLACE (grp AS sample) FROM reads JOIN grp USING (sample))", KEPT.replace("reads", "pooled"), PILE) + " SELECT * FROM pile")
def grouped_pileup(spark: SparkSession, d: str) -> DataFrame:
    g = demux.assign_groups(reads(spark, d), groups(spark)).drop("sample").withColumnRenamed("grp", "sample")
    return P.pileup(filters.pileup_reads(g))


# --- deduplication ------------------------------------------------------------------------------
@query(duck(FASTQ) + " SELECT concat(split_part(arg_min(header, ord), ' ', 1), '#', CAST(count(*) AS VARCHAR)) AS name, seq, arg_min(qual, ord) AS qual, count(*) AS \"count\", min(ord) AS ord FROM fastq GROUP BY seq")
def fastq_collapse(spark: SparkSession, d: str) -> DataFrame:
    return dedup.collapse_exact(fastq(spark, d))


@query("SELECT concat('d', CAST(min(doc_id) AS VARCHAR), '#', CAST(count(*) AS VARCHAR)) AS name, md5(text) AS digest, count(*) AS n FROM documents GROUP BY text")
def text_collapse(spark: SparkSession, d: str) -> DataFrame:
    t = spark.read.parquet(f"{d}/documents.parquet").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("header"), F.col("text").alias("seq"), F.lit("").alias("qual"), F.col("doc_id").alias("ord"))
    return dedup.collapse_exact(t).select("name", F.md5("seq").alias("digest"), F.col("count").alias("n"))


@query(duck(READS) + " SELECT sample, chrom, strand, start0, count(*) AS n FROM reads WHERE nh = 1 GROUP BY ALL")
def start_pileup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.start_counts(filters.unique_reads(reads(spark, d)))


@query(
    duck(READS, "starts AS (SELECT sample, chrom, strand, start0, count(*) AS n FROM reads WHERE nh = 1 GROUP BY ALL)", "multi AS (SELECT * FROM reads WHERE nh > 1)")
    + """, scored AS (SELECT m.*, 0.1 + coalesce((SELECT sum(n) FROM starts s WHERE s.sample = m.sample AND s.chrom = m.chrom AND s.strand = m.strand AND s.start0 BETWEEN m.start0 - 50 AND m.start0 + 50), 0) AS score FROM multi m),
best AS (SELECT *, row_number() OVER (PARTITION BY sample, qname ORDER BY score DESC, CASE WHEN (flag & 256) = 0 THEN 0 ELSE 1 END, ord) AS r FROM scored)
SELECT qname, sample, chrom, strand, start0, CAST(round(score, 3) AS DOUBLE) AS score, CAST(flag & 16 AS INT) AS flag, 1 AS nh FROM best WHERE r = 1"""
)
def multimap_rescue(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d)
    out = dedup.rescue_multimappers(filters.multimapped_reads(r), dedup.start_counts(filters.unique_reads(r)))
    return out.select("qname", "sample", "chrom", "strand", "start0", F.round("score", 3).alias("score"), "flag", "nh")


@query(
    duck(READS, "keyed AS (SELECT *, CASE WHEN strand = '-' THEN end0 ELSE start0 END AS site, shape = 'N' AS spliced FROM reads WHERE nh = 1)")
    + ", r AS (SELECT *, row_number() OVER w AS rk, count(*) OVER (PARTITION BY sample, chrom, strand, site, spliced) AS reads FROM keyed WINDOW w AS (PARTITION BY sample, chrom, strand, site, spliced ORDER BY mapq DESC, qname, ord)) SELECT sample, chrom, strand, site, spliced, reads, qname, start0, end0, flag, mapq, cigar FROM r WHERE rk = 1"
)
def umi_position_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_position(filters.unique_reads(reads(spark, d)))


def _networks(names: str, weight: str) -> str:
    """Directional UMI networks as tables: a UMI belongs to the heaviest that reaches it over falling edges."""
    bundle = "sample, chrom, strand, site, spliced"
    return duck(
        READS,
        f"keyed AS (SELECT * REPLACE ({names} AS qname), CASE WHEN strand = '-' THEN end0 ELSE start0 END AS site, shape = 'N' AS spliced FROM reads WHERE nh = 1)",
        f"placed AS (SELECT *, row_number() OVER (PARTITION BY {bundle}, umi ORDER BY mapq DESC, qname, ord) AS rk, sum({weight}) OVER (PARTITION BY {bundle}, umi) AS w, count(*) OVER (PARTITION BY {bundle}, umi) AS n FROM keyed)",
        f"umis AS (SELECT *, row_number() OVER (ORDER BY {bundle}, w DESC, umi) AS id FROM placed WHERE rk = 1)",
        "edges AS (SELECT a.id AS i, b.id AS j FROM umis a JOIN umis b ON a.sample = b.sample AND a.chrom = b.chrom AND a.strand = b.strand AND a.site = b.site AND a.spliced = b.spliced AND a.id <> b.id AND length(a.umi) = length(b.umi) AND a.w >= 2 * b.w - 1 AND hamming(a.umi, b.umi) = 1)",
        "reach(i, j) AS (SELECT id, id FROM umis UNION SELECT reach.i, edges.j FROM reach JOIN edges ON edges.i = reach.j)",
        "owned AS (SELECT j, min(i) AS i FROM reach GROUP BY j)",
        "nets AS (SELECT i, sum(n) AS reads, sum(w) AS score, arg_min(struct_pack(q := u.qname, s := u.start0, e := u.end0, f := u.flag, m := u.mapq, c := u.cigar), struct_pack(m := -u.mapq, q := u.qname)) AS r FROM owned JOIN umis u ON u.id = owned.j GROUP BY i)",
    ).replace("WITH ", "WITH RECURSIVE ", 1) + (
        " SELECT u.sample, u.chrom, u.strand, u.site, u.spliced, u.umi, CAST(reads AS BIGINT) AS reads, r.q AS qname, r.s AS start0, r.e AS end0, r.f AS flag, r.m AS mapq, r.c AS cigar"
    )


@query(_networks("qname", "1") + " FROM nets JOIN umis u ON u.id = nets.i")
def umi_directional_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_directional(filters.unique_reads(reads(spark, d)))


@query(duck(FASTQ) + " SELECT name, split_part(name, '#', 1) AS id, CAST(split_part(name, '#', 2) AS BIGINT) AS n, CASE WHEN split_part(name, '#', 3) <> '' THEN split_part(name, '#', 3) END AS umi FROM fastq")
def readname_parse(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("name")
    return fastq(spark, d).select("name", N.name_id(n).alias("id"), N.name_count(n).alias("n"), N.name_umi(n).alias("umi"))


@query(duck(FASTQ) + ", head AS (SELECT CASE WHEN split_part(name, '#', 3) <> '' THEN split_part(name, '#', 3) END AS u FROM (SELECT * FROM fastq ORDER BY ord LIMIT 200)) SELECT count(u) > 0 AS has_umi, coalesce(CAST(mode(length(u)) AS INT), 0) AS umi_length FROM head")
def umi_detect_length(spark: SparkSession, d: str) -> DataFrame:
    return dedup.detect_umi(fastq(spark, d), name="name")


# --- preprocessing -----------------------------------------------------------------------------
@query(duck(FASTQ) + " SELECT concat(split_part(header, ' ', 1), ' 2:N:0') AS header, concat(substr(seq, 1, 5), seq) AS seq, concat('IIIII', qual) AS qual FROM fastq")
def eclip_umi_to_seq(spark: SparkSession, d: str) -> DataFrame:
    r = fastq(spark, d).withColumn("header", F.concat(F.substring("seq", 1, 5), F.lit(":"), "header"))
    h, s, q = N.umi_to_sequence(F.col("header"), F.col("seq"), F.col("qual"), 5)
    return r.select(h.alias("header"), s.alias("seq"), q.alias("qual"))


@query(duck(FASTQ) + " SELECT concat(name, '#', substr(seq, 1, 7)) AS name, substr(seq, 8) AS seq, substr(qual, 8) AS qual FROM fastq")
def strip_umi(spark: SparkSession, d: str) -> DataFrame:
    n, s, q = N.strip_prefix_to_name(F.col("name"), F.col("seq"), F.col("qual"), 7)
    return fastq(spark, d).select(n.alias("name"), s.alias("seq"), q.alias("qual"))


@query(duck(FASTQ) + " SELECT concat(name, '#', substr(seq, 4, 5)) AS name, substr(seq, 11) AS seq, substr(qual, 11) AS qual FROM fastq")
def trim_layouts(spark: SparkSession, d: str) -> DataFrame:
    n, s, q = N.trim_layout(F.col("name"), F.col("seq"), F.col("qual"), 5, 3, 2, True)
    return fastq(spark, d).select(n.alias("name"), s.alias("seq"), q.alias("qual"))


@query(duck(FASTQ) + " SELECT name, round(list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) / length(qual), 6) AS quality FROM fastq WHERE length(seq) >= 16 AND list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) / length(qual) >= 30")
def quality_filter(spark: SparkSession, d: str) -> DataFrame:
    return filters.long_enough(fastq(spark, d)).select("name", F.round(N.mean_quality(F.col("qual")), 6).alias("quality"))


TRIMMED = "CASE WHEN contains(seq, 'ACGTACGTAC') THEN strpos(seq, 'ACGTACGTAC') - 1 ELSE length(seq) - coalesce(list_max(list_filter(range(5, 10), lambda n: ends_with(seq, left('ACGTACGTAC', n)))), 0) END"


@query(duck(FASTQ) + f" SELECT name, left(seq, {TRIMMED}) AS seq, left(qual, {TRIMMED}) AS qual FROM fastq")
def adapter_trim(spark: SparkSession, d: str) -> DataFrame:
    return prep.trim_adapters(fastq(spark, d), ["ACGTACGTAC"]).select("name", "seq", "qual")


@query(
    duck(FASTQ, "cut AS (SELECT concat(name, '#', left(seq, 5)) AS name, substr(seq, 6) AS seq, substr(qual, 6) AS qual FROM fastq)")
    + " SELECT * FROM cut WHERE length(seq) >= 16 AND list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) / length(qual) >= 25"
)
def standard_preprocessing(spark: SparkSession, d: str) -> DataFrame:
    return prep.standard(fastq(spark, d), umi=5, min_length=16, min_quality=25.0).select("name", "seq", "qual")


def _barcodes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("b1", "AGAC", 0), ("b2", "CAAC", 1), ("b3", "GTAC", 2), ("b4", "TGAC", 3)], "sample string, barcode string, ord int")


HAMMING = "list_sum(list_transform(range(1, 5), lambda i: CASE WHEN substr(f.seq, i, 1) = substr(b.barcode, i, 1) THEN 0 ELSE 1 END))"
DEMUX = BARCODES + f""",
near AS (SELECT f.ord AS o, b.sample, b.ord, {HAMMING} AS errors FROM fastq f, barcodes b),
first AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY errors, ord) AS r FROM near WHERE errors <= 1),
demuxed AS (SELECT f.ord, coalesce(x.sample, 'unknown') AS sample, CAST(x.errors AS INT) AS errors FROM fastq f LEFT JOIN first x ON x.o = f.ord AND x.r = 1)"""


@query(duck(FASTQ, DEMUX) + " SELECT * FROM demuxed")
def barcode_demux(spark: SparkSession, d: str) -> DataFrame:
    return demux.demultiplex(fastq(spark, d), _barcodes(spark), search=0).select("ord", "sample", "errors")


@query(
    duck(
        FASTQ,
        "codes AS (SELECT 'c1' AS sample, 'AGACGT' AS barcode, 0 AS bo UNION ALL SELECT 'c2', 'CAACGT', 1 UNION ALL SELECT 'c3', 'TTTCGA', 2 UNION ALL SELECT 'c4', 'TACCAA', 3)",
        "places AS (SELECT f.ord AS o, sample, bo, p, 6 + least(p, 0) AS over, hamming(right(barcode, 6 + least(p, 0)), substr(seq, greatest(p, 0) + 1, 6 + least(p, 0))) AS errors FROM fastq f, codes, range(-3, 18) t(p))",
        "best AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY over - 2 * errors DESC, p, bo) AS r FROM places WHERE errors <= over // 6)",
    )
    + " SELECT f.ord, coalesce(b.sample, 'unknown') AS sample, CASE WHEN b.p IS NOT NULL THEN CAST(greatest(b.p, 0) AS INT) END AS barcode_start, CAST(b.errors AS INT) AS errors FROM fastq f LEFT JOIN best b ON b.o = f.ord AND b.r = 1"
)
def barcode_search(spark: SparkSession, d: str) -> DataFrame:
    codes = spark.createDataFrame([("c1", "AGACGT", 0), ("c2", "CAACGT", 1), ("c3", "TTTCGA", 2), ("c4", "TACCAA", 3)], "sample string, barcode string, ord int")
    return demux.demultiplex(fastq(spark, d), codes).select("ord", "sample", "barcode_start", "errors")


@query(
    duck(FASTQ, "places AS (SELECT ord, seq, qual, p, least(10, 23 - p) AS over, hamming(left('ACGTACCTAC', CAST(least(10, 23 - p) AS INT)), substr(seq, p + 1, least(10, 23 - p))) AS errors FROM fastq, range(0, 19) t(p))",
         "best AS (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY over - 2 * errors DESC, p) AS r FROM places WHERE errors <= floor(over * 0.1 + 1e-9))")
    + " SELECT f.ord, left(f.seq, CAST(coalesce(b.p, 23) AS INT)) AS seq, left(f.qual, CAST(coalesce(b.p, 23) AS INT)) AS qual FROM fastq f LEFT JOIN best b ON b.ord = f.ord AND b.r = 1"
)
def adapter_trim_near(spark: SparkSession, d: str) -> DataFrame:
    return prep.trim_adapters(fastq(spark, d), ["ACGTACCTAC"], 0.1).select("ord", "seq", "qual")


@query(duck(FASTQ, DEMUX) + " SELECT sample, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 1) AS percent FROM demuxed GROUP BY sample")
def demux_summary(spark: SparkSession, d: str) -> DataFrame:
    return demux.demux_summary(demux.demultiplex(fastq(spark, d), _barcodes(spark), search=0))


@query(
    "WITH b AS (SELECT p_partkey AS id, concat(translate(CAST(p_partkey % 4 AS VARCHAR), '0123', 'ACGT'), translate(CAST(p_partkey // 4 % 4 AS VARCHAR), '0123', 'ACGT'), translate(CAST(p_size % 4 AS VARCHAR), '0123', 'ACGT'), 'AC') AS barcode FROM part), v AS (SELECT DISTINCT id, concat(substr(barcode, 1, i - 1), 'N', substr(barcode, i + 1)) AS variant FROM b, range(1, 6) t(i)) SELECT variant, count(*) AS n FROM v GROUP BY variant HAVING count(*) > 1"
)
def barcode_collision(spark: SparkSession, d: str) -> DataFrame:
    base = lambda c: F.translate(c.cast("string"), "0123", "ACGT")
    k = F.col("p_partkey")
    b = spark.read.parquet(f"{d}/part.parquet").select(F.concat(base(k % 4), base(F.floor(k / 4) % 4), base(F.col("p_size") % 4), F.lit("AC")).alias("barcode"))
    return demux.barcode_collisions(b, 1)


def _hits(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("read_id")
    ref = (
        F.when(i % 9 == 0, "*").when(i % 4 == 0, F.concat(F.lit("Alu"), (i % 13).cast("string"), F.lit("#SINE/Alu"))).when(i % 4 == 1, F.concat(F.lit("MER"), (i % 7).cast("string"), F.lit("#DNA"))).when(i % 4 == 2, F.concat(F.lit("tRNA-Ala-"), (i % 5).cast("string"))).otherwise("U13369.1")
    )
    return reads(spark, d).select("sample", ref.alias("ref"))


def _elements(spark: SparkSession, d: str) -> DataFrame:
    h = _hits(spark, d)
    return demux.repeat_elements(h, h.groupBy("sample").agg(F.count("*").alias("total")))


@query(duck(READS, ELEMENTS) + " SELECT * FROM elements")
def repeat_elements(spark: SparkSession, d: str) -> DataFrame:
    return _elements(spark, d)


@query(duck(READS, ELEMENTS) + " SELECT sample, family, arg_max(class, element) AS class, CAST(sum(raw_reads) AS BIGINT) AS raw_reads, round(sum(rpm), 2) AS rpm FROM elements GROUP BY sample, family")
def repeat_families(spark: SparkSession, d: str) -> DataFrame:
    return demux.repeat_families(_elements(spark, d))


# --- tracks, joins, matrix -----------------------------------------------------------------------
@query(duck(READS, SCALES) + " SELECT sample, mapped, round(scale, 6) AS scale FROM scales")
def scale_factors(spark: SparkSession, d: str) -> DataFrame:
    return tracks.scale_factors(reads(spark, d)).withColumn("scale", F.round("scale", 6))


def _stored_reads(spark: SparkSession, d: str) -> DataFrame:
    """What tracks take of the reads, written: they are counted first, then swept."""
    return stored(reads(spark, d).select("sample", "strand", "chrom", "start0", "end0", "flag", "cigar"))


@query(duck(READS, SCALES, RPM) + " SELECT sample, strand, chrom, s AS start, e AS \"end\", round(v * scale, 6) AS \"value\" FROM steps JOIN scales USING (sample)")
def rpm_bedgraph(spark: SparkSession, d: str) -> DataFrame:
    r = _stored_reads(spark, d)
    return tracks.rpm_track(r, tracks.scale_factors(r)).select("sample", "strand", "chrom", "start", "end", F.round("value", 6).alias("value"))


@query(duck(READS, "firsts AS (SELECT sample, strand, chrom, CASE WHEN strand = '-' THEN end0 - 1 ELSE start0 END AS s, CASE WHEN strand = '-' THEN end0 ELSE start0 + 1 END AS e, 1 AS v FROM reads)", _steps("steps", "firsts", "sample, strand, chrom")) + " SELECT sample, strand, chrom, s AS start, e AS \"end\", CAST(v AS BIGINT) AS \"value\" FROM steps")
def crosslink_5p_coverage(spark: SparkSession, d: str) -> DataFrame:
    return tracks.crosslink_track(reads(spark, d))


GROUP_TRACK = "weighted AS (SELECT grp, strand, chrom, s, e, v * scale AS v FROM steps JOIN scales USING (sample) JOIN grp USING (sample)), counts AS (SELECT grp, count(*) AS n FROM grp GROUP BY grp)"


@query(duck(READS, GROUPS, SCALES, RPM, GROUP_TRACK) + ", perbase AS (SELECT grp, strand, chrom, unnest(range(s, e)) AS pos, v FROM weighted) SELECT grp, strand, chrom, pos, round(sum(v) / any_value(n), 3) AS \"value\" FROM perbase JOIN counts USING (grp) GROUP BY grp, strand, chrom, pos")
def group_mean_bedgraph(spark: SparkSession, d: str) -> DataFrame:
    r = _stored_reads(spark, d)
    t = tracks.group_track(tracks.rpm_track(r, tracks.scale_factors(r)), groups(spark))
    return t.select("grp", "strand", "chrom", F.explode(F.sequence("start", F.col("end") - 1)).alias("pos"), F.round("value", 3).alias("value"))


@query(duck(READS) + " SELECT qname, chrom, start0 AS start, CASE WHEN shape = 'N' THEN start0 + 6 ELSE end0 END AS \"end\", strand FROM reads UNION ALL SELECT qname, chrom, start0 + 10, end0, strand FROM reads WHERE shape = 'N'")
def bed_split_blocks(spark: SparkSession, d: str) -> DataFrame:
    return split_blocks(reads(spark, d)).select("qname", "chrom", "start", "end", "strand")


def split_blocks(r: DataFrame) -> DataFrame:
    """Reads cut at introns into BED rows; deletions stay inside a block."""
    joined = F.regexp_replace("cigar", "[0-9]+[ISHP]", "")
    r = r.withColumn("__b", cigar_blocks(F.regexp_replace(joined, "D", "M"), F.col("start0"))).withColumn("__n", cigar_blocks(F.translate(joined, "MDN", "NND"), F.col("start0")))
    # the gaps are the introns; blocks lie between them
    edges = F.concat(F.array(F.col("start0")), F.flatten(F.transform("__n", lambda g: F.array(g["s"], g["e"]))), F.array(F.col("end0")))
    k = F.sequence(F.lit(0), (F.size(edges) / 2 - 1).cast("int"))
    return r.withColumn("__e", F.explode(F.transform(k, lambda i: F.struct(edges[i * 2].alias("start"), edges[i * 2 + 1].alias("end"))))).select(*[c for c in r.columns if not c.startswith("__")], "__e.*")


@query(duck(READS, PEAKS, TC) + " SELECT peak_id, sample, CAST(tc AS BIGINT) AS tc FROM tc")
def peak_tc_counts(spark: SparkSession, d: str) -> DataFrame:
    return _tc(spark, d).select("peak_id", "sample", "tc")


def _tc(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d).where(F.col("flag").bitwiseAND(256) == 0).withColumnRenamed("start0", "start").withColumnRenamed("end0", "end")
    return matrix.peak_counts(peaks(spark, d), r)


@query(duck(READS, PEAKS, TC, SCALES) + " SELECT peak_id, sample, CAST(round(CAST(tc * scale AS DECIMAL(30, 8)), 4) AS DOUBLE) AS normed FROM tc JOIN scales USING (sample)")
def matrix_normed(spark: SparkSession, d: str) -> DataFrame:
    return matrix.normed_counts(_tc(spark, d), tracks.scale_factors(reads(spark, d))).select("peak_id", "sample", "normed")


@query(duck(READS, PEAKS, TC, SCALES, GROUPS) + " SELECT peak_id, grp, CAST(count(*) FILTER (tc > 0) AS BIGINT) AS bc, CAST(sum(tc) AS BIGINT) AS tc, CAST(round(CAST(sum(tc * scale) AS DECIMAL(30, 8)), 4) AS DOUBLE) AS normed FROM tc JOIN scales USING (sample) JOIN grp USING (sample) GROUP BY peak_id, grp")
def matrix_group_sums(spark: SparkSession, d: str) -> DataFrame:
    return matrix.group_counts(_tc(spark, d), groups(spark), tracks.scale_factors(reads(spark, d)))


@query(
    duck(READS, PEAKS, SCALES, RPM)
    + ", t AS (SELECT sample, strand, chrom, s, e, v * scale AS v FROM steps JOIN scales USING (sample)) SELECT k.peak_id, x.sample, round(coalesce(sum(v), 0) + 1e-7, 3) AS cov_sum, round(coalesce(avg(v), 0) + 1e-7, 3) AS cov_mean, round(coalesce(max(v), 0) + 1e-7, 3) AS cov_max FROM peaks k CROSS JOIN (SELECT DISTINCT sample FROM t) x LEFT JOIN t ON t.sample = x.sample AND t.chrom = k.chrom AND t.strand = k.strand AND t.s < k.\"end\" AND k.start < t.e GROUP BY k.peak_id, x.sample"
)
def matrix_cov_stats(spark: SparkSession, d: str) -> DataFrame:
    r = _stored_reads(spark, d)
    out = matrix.coverage_stats(peaks(spark, d), tracks.rpm_track(r, tracks.scale_factors(r)))
    # halves of a last digit go up on both sides
    return out.select("peak_id", "sample", *[F.round(F.col(c) + 1e-7, 3).alias(c) for c in ("cov_sum", "cov_mean", "cov_max")])


@query(
    duck(READS, PEAKS, TC, SCALES, GROUPS)
    + ", j AS (SELECT * FROM tc JOIN scales USING (sample) JOIN grp USING (sample)) SELECT peak_id, chrom, start, \"end\", name, score, strand, "
    + ", ".join(f"CAST(round(CAST(max(tc * scale) FILTER (sample = '{s}') AS DECIMAL(30, 8)), 4) AS DOUBLE) AS \"NormedTC_{s}\"" for s in "ANR")
    + ", "
    + ", ".join(f"CAST(round(CAST(sum(tc * scale) FILTER (grp = '{g}') AS DECIMAL(30, 8)), 4) AS DOUBLE) AS \"NormedTC_grp_{g}\", CAST(count(*) FILTER (grp = '{g}' AND tc > 0) AS BIGINT) AS \"BC_grp_{g}\"" for g in ("g1", "g2"))
    + " FROM j GROUP BY ALL"
)
def matrix_wide(spark: SparkSession, d: str) -> DataFrame:
    return matrix.wide_matrix(peaks(spark, d), _tc(spark, d), groups(spark), tracks.scale_factors(reads(spark, d)), ["A", "N", "R"], ["g1", "g2"])


@query(duck(READS, PEAKS, KEPT, PILE) + ", dels AS (SELECT * FROM pile WHERE deletions > 0) SELECT k.peak_id, x.\"column\", (SELECT count(*) FROM dels f WHERE concat('DEL_', f.sample) = x.\"column\" AND f.chrom = k.chrom AND f.strand = k.strand AND f.pos < k.\"end\" AND k.start <= f.pos) AS n FROM peaks k, (SELECT DISTINCT concat('DEL_', sample) AS \"column\" FROM dels) x")
def matrix_site_counts(spark: SparkSession, d: str) -> DataFrame:
    s = _pile(spark, d).where("deletions > 0").select("sample", "chrom", "strand", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), F.lit("del").alias("kind"))
    return matrix.site_counts(peaks(spark, d), s)


# --- mutation tables -----------------------------------------------------------------------------
@query(duck(READS) + " SELECT qname, chrom, strand, start0 + 5 AS pos FROM reads r WHERE has_sub = 1 AND EXISTS (SELECT 1 FROM reads t WHERE t.qname = r.qname AND t.nh = 1)")
def mutation_semi_join(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d)
    m = r.where("has_sub = 1").select("qname", "chrom", "strand", (F.col("start0") + 5).alias("pos"))
    return mutations.of_kept_tags(m, filters.unique_reads(r))


@query(duck(READS) + " SELECT qname, chrom, start0, strand FROM reads r WHERE NOT EXISTS (SELECT 1 FROM reads t WHERE t.qname = r.qname AND t.shape = 'D')")
def readthrough_anti_join(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d)
    return mutations.without_read_through(r, r.where("shape = 'D'")).select("qname", "chrom", "start0", "strand")


@query(duck(PEAKS) + " SELECT name, greatest(start - 30, 0) AS start, \"end\" + 30 AS \"end\" FROM peaks")
def flank_bed(spark: SparkSession, d: str) -> DataFrame:
    return intervals.flank(peaks(spark, d), 30).select("name", "start", "end")


@query(duck(PEAKS) + " SELECT name FROM peaks WHERE \"end\" - start - 40 = 1")
def cits_singletons(spark: SparkSession, d: str) -> DataFrame:
    return filters.singletons(peaks(spark, d).withColumn("end", F.col("end") - 40)).select("name")


@query("SELECT l_orderkey, l_linenumber AS k, CAST(l_quantity AS BIGINT) AS m, l_discount AS fdr FROM lineitem WHERE l_discount < 0.03")
def cims_postfilter(spark: SparkSession, d: str) -> DataFrame:
    t = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", F.col("l_linenumber").alias("k"), F.col("l_quantity").cast("long").alias("m"), F.col("l_discount").alias("fdr"))
    return filters.cims_postfilter(t, 0.03)


@query(duck(READS) + " SELECT sample, qname AS name, chrom, start0 AS start, end0 AS \"end\", strand FROM reads WHERE mapq >= 1 AND length(seq) >= 25")
def parse_alignments(spark: SparkSession, d: str) -> DataFrame:
    return mutations.parse_alignments(reads(spark, d), 1, 25).select("sample", "name", "chrom", "start", "end", "strand")


@query(
    duck(READS, "u AS (SELECT * FROM reads WHERE nh <= 1)", _thrown("has_sub = 1", "start0 + 5")) + " SELECT chrom, strand, pos, k, m, round(fdr, 9) AS fdr FROM seen JOIN rates USING (k, m)"
)
def cims_permutation(spark: SparkSession, d: str) -> DataFrame:
    r = filters.unique_reads(reads(spark, d)).withColumnRenamed("start0", "start").withColumnRenamed("end0", "end")
    m = r.where("has_sub = 1").select("qname", "chrom", "strand", (F.col("start") + 5).alias("pos"))
    return mutations.permuted_mutations(r, m).withColumn("fdr", F.round("fdr", 9))


@query(
    duck(
        READS,
        "u AS (SELECT * FROM reads WHERE nh <= 1)",
        "n AS (SELECT chrom, strand, CASE WHEN strand = '-' THEN end0 ELSE start0 - 1 END AS pos, count(*) AS k FROM u WHERE qname NOT IN (SELECT qname FROM u WHERE shape = 'D') GROUP BY ALL)",
        "f AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 25 THEN 0 ELSE 1 END AS new FROM n WHERE pos >= 0 WINDOW w AS (PARTITION BY chrom, strand ORDER BY pos))",
        "c AS (SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cluster FROM f)",
        "t AS (SELECT *, CAST(sum(k) OVER w AS BIGINT) AS m, 1.0::DOUBLE / (max(pos) OVER w - min(pos) OVER w + 1) AS r FROM c WINDOW w AS (PARTITION BY chrom, strand, cluster))",
        f"p AS (SELECT *, {PVALUE} AS pvalue FROM t)",
    )
    + ' SELECT chrom, pos AS start, pos + 1 AS "end", k AS truncations, strand, round(-log10(pvalue), 4) AS logp FROM p WHERE pvalue < 0.05'
)
def cits_clusters(spark: SparkSession, d: str) -> DataFrame:
    r = filters.unique_reads(reads(spark, d)).withColumnRenamed("start0", "start").withColumnRenamed("end0", "end")
    return mutations.truncation_clusters(r, r.where("shape = 'D'"), 0.05).withColumn("logp", _log("pvalue")).drop("pvalue")


@query(
    duck(READS, "u AS (SELECT * FROM reads WHERE nh <= 1)", _tiles("chrom, strand", "u"))
    + " SELECT chrom, strand, tile * 20 AS start, tile * 20 + 20 AS \"end\", concat_ws('-', chrom, tile * 20, strand) AS name, k AS score, round(-log10(pvalue), 4) AS logp FROM called WHERE pvalue <= 0.01"
)
def called_peaks(spark: SparkSession, d: str) -> DataFrame:
    r = filters.unique_reads(reads(spark, d)).withColumnRenamed("start0", "start").withColumnRenamed("end0", "end")
    return matrix.call_peaks(r, pvalue=0.01).withColumn("logp", _log("pvalue")).drop("pvalue")


@query(
    duck(READS, GROUPS, "u AS (SELECT * FROM reads WHERE nh <= 1)", "g AS (SELECT * FROM u JOIN grp USING (sample))", _tiles("grp, chrom, strand", "g"))
    + " SELECT grp, chrom, strand, tile * 20 AS start, tile * 20 + 20 AS \"end\", concat_ws('-', chrom, tile * 20, strand) AS name, k AS score, round(-log10(pvalue), 4) AS logp FROM called WHERE pvalue <= 0.01"
)
def grouped_peaks(spark: SparkSession, d: str) -> DataFrame:
    r = filters.unique_reads(demux.assign_groups(reads(spark, d), groups(spark))).withColumnRenamed("start0", "start").withColumnRenamed("end0", "end")
    return matrix.call_peaks(r, pvalue=0.01, by=["grp"]).withColumn("logp", _log("pvalue")).drop("pvalue")


def _ranked(by: str, source: str, rounds: int = 14) -> str:
    """Greedy peaks in so many rounds, more than any table here needs, and the threshold of each ``by``."""
    keys, own = f"{by}chrom, strand", by.rstrip(", ")
    near = f"OVER (PARTITION BY {keys} ORDER BY pos RANGE BETWEEN 50 PRECEDING AND 50 FOLLOWING)"
    steps = [
        f"tag AS (SELECT {keys}, (start0 + end0) // 2 AS pos, count(*) AS tags FROM {source} GROUP BY ALL)",
        f"st0 AS (SELECT {keys}, pos, CAST(sum(tags) OVER (PARTITION BY {keys} ORDER BY pos RANGE BETWEEN 10 PRECEDING AND 10 FOLLOWING) AS BIGINT) AS n, CAST(sum(tags) OVER (PARTITION BY {keys} ORDER BY pos RANGE BETWEEN 500 PRECEDING AND 500 FOLLOWING) AS BIGINT) AS around FROM tag)",
    ]
    for k in range(1, rounds + 1):
        steps.append(f"nw{k} AS (SELECT *, max(n * 1000000000 - pos) {near} = n * 1000000000 - pos AS taken FROM st{k - 1})")
        steps.append(f"hit{k} AS (SELECT *, bool_or(taken) {near} AS near FROM nw{k})")
        steps.append(f"st{k} AS (SELECT {keys}, pos, n, around FROM hit{k} WHERE NOT near)")
    steps.append("found AS (" + " UNION ALL ".join(f"SELECT {keys}, pos, n, around FROM hit{k} WHERE taken" for k in range(1, rounds + 1)) + ")")
    steps.append(f"total AS (SELECT {by}count(*) AS tags, (SELECT 2.0 * sum(x) FROM (SELECT max(end0) AS x FROM reads GROUP BY chrom)) AS genome FROM {source} {'GROUP BY ' + own if own else ''})")
    steps.append(f"seen AS (SELECT *, sum(peaks) OVER ({'PARTITION BY ' + own if own else ''} ORDER BY n DESC) AS observed, tags * 21 / genome AS mean FROM (SELECT {by}n, count(*) AS peaks FROM found GROUP BY ALL) JOIN total {'USING (' + own + ')' if own else 'ON true'})")
    tail = "CASE WHEN n > mean THEN list_sum(list_transform(range(0, 101), lambda j: exp((n + j) * ln(mean) - mean - lgamma(n + j + 1)))) ELSE 1 - list_sum(list_transform(range(0, n), lambda j: exp(j * ln(mean) - mean - lgamma(j + 1)))) END"
    steps.append(f"rated AS (SELECT *, genome / 21 * least({tail}, 1) / observed AS rate FROM seen)")
    steps.append(f"cut AS (SELECT {by}min(n) AS least FROM rated WHERE rate <= 0.5 {'GROUP BY ' + own if own else ''})")
    join = f"USING ({own})" if own else "ON true"
    return ", ".join(steps) + (
        f" SELECT {keys}, greatest(pos - 10, 0) AS start, greatest(pos - 10, 0) + 20 AS \"end\", n AS score, round(rate, 6) AS expected_rate "
        f"FROM found JOIN cut {join} JOIN (SELECT {by}n, rate FROM rated) r USING ({by}n) WHERE n >= least AND n * 1000 >= 2.0 * around * 20"
    )


def _ranked_of(r: DataFrame, every: DataFrame, by: list[str] | None) -> DataFrame:
    tags = r.withColumnRenamed("start0", "start").withColumnRenamed("end0", "end")
    out = peaking.ranked_peaks(tags, every.groupBy("chrom").agg(F.max("end0").alias("length")), fdr=0.5, by=by)
    return out.drop("name").withColumn("expected_rate", F.round("expected_rate", 6))


@query(duck(READS, _ranked("", "reads")))
def ranked_peaks(spark: SparkSession, d: str) -> DataFrame:
    """Peaks of all reads, with one threshold."""
    r = reads(spark, d)
    return _ranked_of(r, r, None)


@query(duck(READS, _ranked("sample, ", "reads")))
def ranked_sample_peaks(spark: SparkSession, d: str) -> DataFrame:
    """Peaks of each sample, with a threshold of its own."""
    r = reads(spark, d)
    return _ranked_of(r, r, ["sample"])


@query(
    duck(
        READS,
        "u AS (SELECT chrom, strand, start0 AS s, end0 AS e, 1 AS v FROM reads WHERE nh <= 1)",
        _steps("track", "u", "chrom, strand"),
        "news AS (SELECT *, CASE WHEN s - lag(s) OVER w <= 50 THEN 0 ELSE 1 END AS new FROM track WINDOW w AS (PARTITION BY chrom, strand ORDER BY s))",
        "runs AS (SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY s ROWS UNBOUNDED PRECEDING) AS run FROM news)",
        "lows AS (SELECT *, v < (1 - 0.9::DOUBLE) * least(max(v) OVER (w ROWS UNBOUNDED PRECEDING), max(v) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS low FROM runs WINDOW w AS (PARTITION BY chrom, strand, run ORDER BY s))",
        "parts AS (SELECT *, sum(CASE WHEN low THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand, run ORDER BY s ROWS UNBOUNDED PRECEDING) AS part FROM lows)",
    )
    + " SELECT chrom, strand, min(s) AS start, max(e) AS \"end\", CAST(max(v) AS BIGINT) AS score, arg_max(s, v * 1000000000000 - s) AS top FROM parts WHERE NOT low GROUP BY chrom, strand, run, part"
)
def valley_peaks(spark: SparkSession, d: str) -> DataFrame:
    r = filters.unique_reads(reads(spark, d)).withColumnRenamed("start0", "start").withColumnRenamed("end0", "end")
    return matrix.valley_peaks(intervals.depth_track(r, ["chrom", "strand"])).withColumn("score", F.col("score").cast("long"))


def _mutated(r: DataFrame) -> DataFrame:
    """The substitution or deletion of each read that has one (no read has both), in one pass over the reads."""
    sub = F.col("has_sub") == 1
    pos = F.col("start") + F.when(sub, 5).otherwise(8)
    return r.where(sub | (F.col("shape") == "D")).select("qname", "sample", "chrom", "strand", pos.alias("pos"), F.when(sub, "sub").otherwise("del").alias("mut_type"))


@query(
    duck(READS, "u AS (SELECT * FROM reads WHERE nh <= 1)", _truncated("chrom, strand"))
    + " SELECT chrom, pos AS start, strand, 'trunc' AS kind, CAST(k AS DOUBLE) AS score FROM p WHERE pvalue < 0.001"
    + " UNION ALL SELECT chrom, start0 + 5, strand, 'sub', CAST(count(*) AS DOUBLE) FROM u WHERE has_sub = 1 GROUP BY ALL"
    + " UNION ALL SELECT chrom, start0 + 8, strand, 'del', CAST(count(*) AS DOUBLE) FROM u WHERE shape = 'D' GROUP BY ALL"
)
def tag_sites(spark: SparkSession, d: str) -> DataFrame:
    r = filters.unique_reads(reads(spark, d)).withColumnRenamed("start0", "start").withColumnRenamed("end0", "end")
    r = stored(r.select("qname", "sample", "chrom", "strand", "start", "end", "has_sub", "shape"))
    out = tags.tag_sites(r, _mutated(r))
    return out["del"].select("chrom", "start", "strand", F.lit("del").alias("kind"), "score").unionByName(out["sub"].select("chrom", "start", "strand", F.lit("sub").alias("kind"), "score")).unionByName(
        out["trunc"].select("chrom", "start", "strand", F.lit("trunc").alias("kind"), "score")
    )


def _coded(spark: SparkSession, d: str) -> DataFrame:
    return fastq(spark, d).withColumn("header", F.concat(F.substring("seq", 1, 5), F.lit(":"), "header"))


@query(duck(FASTQ) + " SELECT 'R2' AS mate, 'header_colon' AS umi_location, 5 AS umi_length, 'ok' AS verdict FROM fastq GROUP BY ALL HAVING count(*) FILTER (contains(header, ' 2:')) >= 0.95 * count(*)")
def eclip_check(spark: SparkSession, d: str) -> DataFrame:
    return demux.check_eclip(_coded(spark, d), "pe")


def _collapsed(seq: str, header: str = "header", qual: str = "qual") -> str:
    return f"one AS (SELECT concat(split_part(arg_min({header}, ord), ' ', 1), '#', CAST(count(*) AS VARCHAR)) AS name, {seq} AS seq, arg_min({qual}, ord) AS qual, count(*) AS n FROM fastq GROUP BY {seq})"


@query(duck(FASTQ, _collapsed("seq")) + " SELECT concat(name, '#', left(seq, 5)) AS name, substr(seq, 6) AS seq, substr(qual, 6) AS qual, n AS \"count\" FROM one WHERE length(seq) - 5 >= 16")
def eclip_paired_preprocessing(spark: SparkSession, d: str) -> DataFrame:
    return prep.eclip_paired(fastq(spark, d), 5, min_length=16).select("name", "seq", "qual", "count")


@query(
    duck(FASTQ, _collapsed("concat(left(seq, 5), seq)", qual="concat('IIIII', qual)"))
    + " SELECT concat(name, '#', left(seq, 5)) AS name, substr(seq, 6) AS seq, substr(qual, 6) AS qual, n AS \"count\" FROM one WHERE length(seq) - 5 >= 20"
)
def eclip_single_preprocessing(spark: SparkSession, d: str) -> DataFrame:
    return prep.eclip_single(_coded(spark, d), 5).select("name", "seq", "qual", "count")


@query(duck(FASTQ, _collapsed("seq")) + " SELECT concat(name, '#', left(seq, 3)) AS name, substr(seq, 6) AS seq, substr(qual, 6) AS qual, n AS \"count\" FROM one WHERE length(seq) - 5 >= 16")
def parclip_preprocessing(spark: SparkSession, d: str) -> DataFrame:
    return prep.parclip(fastq(spark, d), umi=3, spacer=2).select("name", "seq", "qual", "count")


@query(
    duck(FASTQ, "q AS (SELECT ord, CASE WHEN ord % 3 = 0 THEN qual ELSE concat(left(qual, 10), repeat('#', 13)) END AS q FROM fastq)")
    + " SELECT ord, CAST(coalesce(list_max(list_filter(range(1, length(q) + 1), lambda i: list_sum(list_transform(range(greatest(i - 3, 1), i + 1), lambda j: ascii(substr(q, j, 1)) - 33)) >= 5 * least(i, 4))), 0) AS INT) AS kept FROM q"
)
def quality_tail(spark: SparkSession, d: str) -> DataFrame:
    swapped = F.when(F.col("ord") % 3 == 0, F.col("qual")).otherwise(F.concat(F.substring("qual", 1, 10), F.lit("#" * 13)))
    return fastq(spark, d).select("ord", N.cut_tail(swapped).alias("kept"))


@query(duck(FASTQ) + ", n AS (SELECT ord % 3 = 0 AS mapped, count(*) AS n FROM fastq GROUP BY ALL) SELECT * FROM n")
def repeat_divert(spark: SparkSession, d: str) -> DataFrame:
    r = fastq(spark, d).withColumn("flag", F.when(F.col("ord") % 3 == 0, 0).otherwise(4))
    hit, rest = demux.divert_repeats(r)
    return hit.select(F.lit(True).alias("mapped")).unionByName(rest.select(F.lit(False).alias("mapped"))).groupBy("mapped").agg(F.count("*").alias("n"))


@query(duck(READS, PEAKS, GROUPS, SCALES, RPM, GROUP_TRACK) + """, perbase AS (SELECT grp, strand, chrom, unnest(range(s, e)) AS pos, v FROM weighted),
means AS (SELECT grp, strand, chrom, pos, sum(v) / any_value(n) AS v FROM perbase JOIN counts USING (grp) GROUP BY grp, strand, chrom, pos)
SELECT k.peak_id, x.grp, round(coalesce(max(v), 0) + 1e-7, 3) AS cov_max FROM peaks k CROSS JOIN (SELECT DISTINCT grp FROM grp) x LEFT JOIN means b ON b.grp = x.grp AND b.chrom = k.chrom AND b.strand = k.strand AND b.pos >= k.start AND b.pos < k."end" GROUP BY k.peak_id, x.grp""")
def matrix_group_cov(spark: SparkSession, d: str) -> DataFrame:
    r = _stored_reads(spark, d)
    t = tracks.group_track(tracks.rpm_track(r, tracks.scale_factors(r)), groups(spark))
    return matrix.coverage_stats(peaks(spark, d), t, "grp").select("peak_id", "grp", F.round(F.col("cov_max") + 1e-7, 3).alias("cov_max"))


@query(
    duck(READS, "starts AS (SELECT sample, chrom, strand, start0, count(*) AS n FROM reads WHERE nh = 1 GROUP BY ALL)", "multi AS (SELECT * FROM reads WHERE nh > 1)")
    + """, scored AS (SELECT m.*, coalesce((SELECT sum(n) FROM starts s WHERE s.sample = m.sample AND s.chrom = m.chrom AND s.strand = m.strand AND s.start0 BETWEEN m.start0 - 50 AND m.start0 + 50), 0) AS score FROM multi m),
best AS (SELECT *, row_number() OVER (PARTITION BY sample, qname ORDER BY score DESC, CASE WHEN (flag & 256) = 0 THEN 0 ELSE 1 END, ord) AS r FROM scored),
src AS (SELECT 0 AS part, sample, chrom, strand, start0, end0, shape, mapq, qname, ord FROM reads WHERE nh = 1 UNION ALL SELECT 1, sample, chrom, strand, start0, end0, shape, mapq, qname, ord FROM best WHERE r = 1),
keyed AS (SELECT *, CASE WHEN strand = '-' THEN end0 ELSE start0 END AS site, shape = 'N' AS spliced FROM src),
ranked2 AS (SELECT *, row_number() OVER w AS rk, count(*) OVER (PARTITION BY part, sample, chrom, strand, site, spliced) AS n FROM keyed WINDOW w AS (PARTITION BY part, sample, chrom, strand, site, spliced ORDER BY mapq DESC, qname, ord))
SELECT sample, chrom, strand, site, spliced, n AS reads, qname FROM ranked2 WHERE rk = 1"""
)
def rescued_dedup(spark: SparkSession, d: str) -> DataFrame:
    return sites.dedup_reads(reads(spark, d), 0, multi_map=True).select("sample", "chrom", "strand", "site", "spliced", "reads", "qname")


@query(
    duck(READS, GROUPS, "u AS (SELECT * FROM reads WHERE nh <= 1)", "g AS (SELECT * FROM u JOIN grp USING (sample))", _truncated("grp, chrom, strand", "g"))
    + " SELECT grp, chrom, pos AS start, strand, CAST(k AS DOUBLE) AS score FROM p WHERE pvalue < 0.001"
)
def grouped_tag_sites(spark: SparkSession, d: str) -> DataFrame:
    r = filters.unique_reads(reads(spark, d)).withColumnRenamed("start0", "start").withColumnRenamed("end0", "end")
    r = stored(r.select("qname", "sample", "chrom", "strand", "start", "end", "has_sub", "shape"))
    out = tags.grouped_tag_sites(r, _mutated(r), groups(spark), ["g1", "g2"])
    sides = [out[g]["trunc"].select(F.lit(g).alias("grp"), "chrom", "start", "strand", "score") for g in ("g1", "g2")]
    return sides[0].unionByName(sides[1])


@query(duck(READS) + " SELECT sample, chrom AS ref, count(*) AS mapped, CAST(0 AS BIGINT) AS unmapped FROM reads GROUP BY ALL")
def index_stats(spark: SparkSession, d: str) -> DataFrame:
    return demux.index_stats(reads(spark, d))


@query(duck(READS) + " SELECT sample, count(*) AS total, CAST(count(*) FILTER (read_id % 3 <> 0 AND nh <= 1) AS BIGINT) AS once, CAST(count(*) FILTER (read_id % 3 <> 0 AND nh > 1) AS BIGINT) AS many, CAST(count(*) FILTER (read_id % 3 = 0) AS BIGINT) AS kept, round(100 * count(*) FILTER (read_id % 3 <> 0) / count(*), 2) AS percent FROM reads GROUP BY sample")
def repeat_filter_summary(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d)
    return demux.repeat_filter_summary(r.withColumn("flag", F.when(F.col("read_id") % 3 == 0, F.col("flag").bitwiseOR(4)).otherwise(F.col("flag"))))


@query(duck(FASTQ, DEMUX) + " SELECT sample, count(*) AS n FROM demuxed WHERE sample <> 'unknown' GROUP BY sample")
def known_samples(spark: SparkSession, d: str) -> DataFrame:
    return demux.known_samples(demux.demultiplex(fastq(spark, d), _barcodes(spark), search=0)).groupBy("sample").agg(F.count("*").alias("n"))


@query(duck(READS) + " SELECT qname, ord, CASE WHEN shape = 'D' THEN concat('8^A', CAST(len - 9 AS VARCHAR)) WHEN has_sub = 1 THEN concat('5A', CAST(len - 6 AS VARCHAR)) WHEN shape = 'N' THEN CAST(len - 4 AS VARCHAR) ELSE CAST(len AS VARCHAR) END AS md, CAST(CASE WHEN shape = 'D' OR has_sub = 1 THEN 1 ELSE 0 END AS INT) AS nm FROM reads")
def recomputed_md(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d)
    ref = r.groupBy(F.col("chrom").alias("name")).agg(F.max("end0").cast("int").alias("n")).select("name", F.expr("repeat('A', n)").alias("seq"))
    return with_md(r, ref, 1000).select("qname", "ord", "md", "nm")


def _em(rounds: int, final: str) -> str:
    """Parents of UMIs by so many rounds, each a table of its own."""
    b = "sample, chrom, strand, site, spliced"
    weight = "share * pow(1 - e, length(u) - d) * pow(e / 3, d)"
    steps = [
        f"em_sums AS (SELECT sample, chrom, strand, CASE WHEN strand = '-' THEN end0 ELSE start0 END AS site, shape = 'N' AS spliced, umi, sum(read_id % 3 + 1) AS copies, count(*) AS n FROM reads GROUP BY ALL)",
        f"em_total AS (SELECT {b}, sum(copies) AS total FROM em_sums GROUP BY ALL)",
        f"em0 AS (SELECT {b}, x.umi AS u, y.umi AS v, hamming(x.umi, y.umi) AS d, CAST(x.copies AS DOUBLE) AS copies, CAST(total AS DOUBLE) AS total, CAST(y.copies AS DOUBLE) AS share FROM em_sums x JOIN em_sums y USING ({b}) JOIN em_total USING ({b}) WHERE hamming(x.umi, y.umi) <= 1)",
        "rate0 AS (SELECT 0.01::DOUBLE AS e)",
    ]
    for k in range(1, rounds + 1):
        steps.append(f"em{k}w AS (SELECT *, {weight} AS w FROM em{k - 1}, rate{k - 1})")
        steps.append(f"em{k}s AS (SELECT *, sum(w) OVER (PARTITION BY {b}, u) AS s FROM em{k}w)")
        steps.append(f"em{k}c AS (SELECT *, sum(10 * copies * log10(s / least(s, greatest(s - w, total * pow(e / 3, 2))))) OVER (PARTITION BY {b}, v) >= 30 AS stays FROM em{k}s)")
        steps.append(f"em{k}k AS (SELECT * FROM em{k}c QUALIFY stays OR NOT bool_or(stays) OVER (PARTITION BY {b}, u))")
        steps.append(f"em{k}g AS (SELECT *, copies * w / sum(w) OVER (PARTITION BY {b}, u) AS given FROM em{k}k)")
        steps.append(f"em{k} AS (SELECT {b}, u, v, d, copies, total, sum(given) OVER (PARTITION BY {b}, v) AS share, given * d AS wrong FROM em{k}g)")
        steps.append(f"rate{k} AS (SELECT least(greatest(sum(wrong) / (SELECT sum(copies * length(umi)) FROM em_sums), 1e-6), 0.25) AS e FROM em{k})")
    steps.append(f"best AS (SELECT {b}, u, v AS x, row_number() OVER (PARTITION BY {b}, u ORDER BY v <> u, {weight} DESC, v) AS k FROM em{rounds}, rate{rounds})")
    steps.append(f"em_owner AS (SELECT {b}, m.umi, coalesce(x, m.umi) AS owner, copies, n FROM em_sums m LEFT JOIN (SELECT {b}, u AS umi, x FROM best WHERE k = 1) USING ({b}, umi))")
    return duck(READS, *steps) + final


EM_BUNDLE = "sample, chrom, strand, site, spliced"


@query(_em(1, f" SELECT {EM_BUNDLE}, u, v, CAST(d AS INT) AS d, round(share, 9) AS share FROM em1"))
def em_parents_step(spark: SparkSession, d: str) -> DataFrame:
    """One round of the parents of UMIs."""
    r = reads(spark, d)
    sums = collapse.umi_sums(r, "umi", F.col("read_id") % 3 + 1)
    return collapse.em_step(collapse.parent_edges(sums), collapse.ERROR).select(*dedup.BUNDLE, "u", "v", "d", F.round("share", 9).alias("share"))


@query(_em(3, f" SELECT {EM_BUNDLE}, owner AS umi, CAST(sum(n) AS BIGINT) AS reads, CAST(sum(copies) AS BIGINT) AS score FROM em_owner GROUP BY ALL"))
def em_collapse(spark: SparkSession, d: str) -> DataFrame:
    """Tags by three rounds, whatever they change."""
    r = reads(spark, d).withColumn("qname", F.concat("qname", F.lit("#"), (F.col("read_id") % 3 + 1).cast("string")))
    return collapse.collapse_em(r, iterations=3, tolerance=0.0).select(*dedup.BUNDLE, "umi", "reads", "score")


@query(_networks("concat(qname, '#', CAST(read_id % 3 + 1 AS VARCHAR))", "read_id % 3 + 1") + ", CAST(score AS BIGINT) AS score FROM nets JOIN umis u ON u.id = nets.i")
def weighted_collapse(spark: SparkSession, d: str) -> DataFrame:
    r = filters.unique_reads(reads(spark, d)).withColumn("qname", F.concat("qname", F.lit("#"), (F.col("read_id") % 3 + 1).cast("string")))
    return dedup.collapse_weighted(r)


# --- the library's functions in SQL text ----------------------------------------------------------
@query(duck(READS) + """ SELECT qname, ord, kind, s, e FROM (
SELECT qname, ord, 'M' AS kind, start0 AS s, CASE shape WHEN 'D' THEN start0 + 8 WHEN 'N' THEN start0 + 6 ELSE end0 END AS e FROM reads
UNION ALL SELECT qname, ord, 'M', CASE shape WHEN 'D' THEN start0 + 9 ELSE start0 + 10 END, end0 FROM reads WHERE shape <> 'M'
UNION ALL SELECT qname, ord, 'D', start0 + 8, start0 + 9 FROM reads WHERE shape = 'D')""")
def sql_cigar_blocks(spark: SparkSession, d: str) -> DataFrame:
    register(spark)
    return spark.sql("SELECT qname, ord, b.kind, b.s, b.e FROM {r} r, LATERAL cigar_blocks(r.start0, r.cigar) b", r=reads(spark, d))


@query(duck(READS, KEPT, PILE) + """, total AS (SELECT sample, sum(deletions) / sum(coverage) AS rate FROM pile GROUP BY sample),
test AS (SELECT sample, chrom, strand, pos, coverage AS n, deletions AS k, rate AS p FROM pile JOIN total USING (sample) WHERE deletions > 0 AND coverage >= 5)
SELECT sample, chrom, strand, pos, round(-log10(CASE WHEN k = 0 THEN 1 ELSE (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p) + (n - i) * ln(1 - p))) FROM (SELECT unnest(range(k, n + 1)) AS i)) END), 4) AS logp FROM test""")
def sql_deletion_tails(spark: SparkSession, d: str) -> DataFrame:
    """A site test in SQL text: tails of deletions against the rate of the sample."""
    register(spark)
    return spark.sql(
        """WITH total AS (SELECT sample, sum(deletions) / sum(coverage) AS rate FROM {p} GROUP BY sample)
        SELECT sample, chrom, strand, pos, round(-log10(binom_sf(deletions, coverage, rate)), 4) AS logp FROM {p} JOIN total USING (sample) WHERE deletions > 0 AND coverage >= 5""",
        p=_pile(spark, d),
    )


@query(duck(FASTQ) + " SELECT name, hamming(substr(seq, 1, 4), substr(seq, 3, 4)) AS distance FROM fastq WHERE hamming(substr(seq, 1, 4), substr(seq, 3, 4)) <= 3")
def sql_hamming(spark: SparkSession, d: str) -> DataFrame:
    register(spark)
    return spark.sql("SELECT * FROM (SELECT name, hamming(substr(seq, 1, 4), substr(seq, 3, 4)) AS distance FROM {f}) WHERE distance <= 3", f=fastq(spark, d))


# --- sets, groups, streams ------------------------------------------------------------------------
@query(duck(READS) + " SELECT chrom, strand, count(*) AS n, count(DISTINCT sample) AS n_samples FROM (SELECT chrom, strand, sample FROM reads WHERE sample = 'A' UNION ALL SELECT chrom, strand, sample FROM reads WHERE sample <> 'A') GROUP BY ALL")
def aggregate_union(spark: SparkSession, d: str) -> DataFrame:
    r = reads(spark, d).select("chrom", "strand", "sample")
    return r.where("sample = 'A'").unionByName(r.where("sample <> 'A'")).groupBy("chrom", "strand").agg(F.count("*").alias("n"), F.countDistinct("sample").alias("n_samples"))


@query("SELECT n_name AS sample, CASE WHEN r_name LIKE 'A%' THEN r_name ELSE n_name END AS grp FROM nation JOIN region ON n_regionkey = r_regionkey")
def group_assignment(spark: SparkSession, d: str) -> DataFrame:
    n, r = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("nation", "region"))
    g = n.join(r, n["n_regionkey"] == r["r_regionkey"]).where("r_name like 'A%'").select(F.col("n_name").alias("sample"), F.col("r_name").alias("grp"))
    return demux.assign_groups(n.select(F.col("n_name").alias("sample")), g)


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    return windowed_counts(spark.read.parquet(f"{d}/events.parquet"))
