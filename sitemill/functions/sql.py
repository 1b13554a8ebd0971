"""The library's functions for ``spark.sql``: plain SQL that Catalyst inlines, no Python in the tasks."""

from __future__ import annotations

from pyspark.sql import SparkSession

_OPS = "regexp_extract_all(cigar, '([0-9]+[MIDNSHP=X])', 1)"
_SIZE = "CAST(left({0}, length({0}) - 1) AS BIGINT)"

FUNCTIONS = (
    "hamming(a STRING, b STRING) RETURNS INT COMMENT 'Differing places of two strings of one length, else null' "
    "RETURN CASE WHEN length(a) = length(b) THEN aggregate(zip_with(split(a, ''), split(b, ''), (x, y) -> IF(x = y, 0, 1)), 0, (s, x) -> s + x) END",
    "reference_length(cigar STRING) RETURNS BIGINT COMMENT 'Reference bases that a CIGAR spans' "
    "RETURN aggregate(regexp_extract_all(cigar, '([0-9]+)[MDN=X]', 1), 0L, (s, x) -> s + CAST(x AS BIGINT))",
    "binom_sf(k BIGINT, n BIGINT, p DOUBLE) RETURNS DOUBLE COMMENT 'P(X >= k) of a binomial' "
    "RETURN CASE WHEN k <= 0 THEN 1D WHEN p <= 0 OR k > n THEN 0D WHEN p >= 1 THEN 1D ELSE least(1D, exp("
    "aggregate(sequence(1L, k), 0D, (s, i) -> s + ln((n - k + i) / i)) + k * ln(p) + (n - k) * log1p(-p) + ln(aggregate("
    "IF(k < n, sequence(k + 1, n), array()), named_struct('term', 1D, 'total', 1D), "
    "(s, i) -> named_struct('term', s.term * ((n - i + 1) / i) * (p / (1 - p)), 'total', s.total + s.term * ((n - i + 1) / i) * (p / (1 - p))), s -> s.total)))) END",
    "cigar_blocks(start0 BIGINT, cigar STRING) RETURNS TABLE(kind STRING, s BIGINT, e BIGINT) COMMENT 'Aligned (M) and deleted (D) blocks of a read' "
    "RETURN SELECT IF(x.op = 'D', 'D', 'M'), start0 + x.before, start0 + x.before + x.n FROM (SELECT explode(filter(transform("
    f"{_OPS}, (o, i) -> named_struct('op', right(o, 1), 'n', {_SIZE.format('o')}, 'before', "
    f"aggregate(slice({_OPS}, 1, i), 0L, (a, c) -> a + IF(right(c, 1) IN ('M', '=', 'X', 'D', 'N'), {_SIZE.format('c')}, 0L)))), "
    "x -> x.op IN ('M', '=', 'X', 'D'))) AS x)",
)


def register(spark: SparkSession) -> None:
    """Temporary functions of this session; ``cigar_blocks`` is a table function, for ``FROM reads, LATERAL cigar_blocks(start0, cigar)``."""
    for f in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {f}")
