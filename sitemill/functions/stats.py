"""Binomial tails, false discovery rates, exact quantiles, truncation to decimals."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from .lineage import settled


def binom_sf(k: Column, n: Column, p: Column) -> Column:
    """P(X >= k) for X ~ Bin(n, p), by summing terms in the JVM; fit for coverage in the thousands.

    The first term is built in logarithms, so tails below 1e-300 reach zero and no earlier step
    does. k <= 0 gives 1, p <= 0 gives 0, p >= 1 gives 1, k > n gives 0. Terms end where no later one
    can change the last bit of the sum: past i = c*n*p/(1-p) each is under 1/c of the one before, so 62
    (c = 2) or 17 (c = 16) terms later it is under 2^-61 of the sum. A wide cluster's even share costs few terms.
    k, n and p are bound once: as plain expressions they would be worked out anew for each term.
    """
    one = F.struct(k.cast("long").alias("k"), n.cast("long").alias("n"), p.alias("p"))
    return F.transform(F.array(one), lambda x: _binom_sum(x["k"], x["n"], x["p"]))[0]


def _binom_sum(k: Column, n: Column, p: Column) -> Column:
    log_choose = F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.lit(0.0), lambda s, i: s + F.log((n - k + i) / i))
    first = log_choose + k * F.log(p) + (n - k) * F.log1p(-p)

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] * ((n - i + 1) / i) * (p / (1 - p))
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    odds = n * p / (1 - p)
    last = F.least(*[F.greatest(k.cast("double"), F.ceil(c * odds).cast("double")) + more for c, more in ((2, 62), (16, 17))], n.cast("double")).cast("long")
    later = F.when(k < n, F.sequence(k + 1, last)).otherwise(F.array().cast("array<bigint>"))
    ratio = F.aggregate(later, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")), add, lambda acc: acc["total"])
    return F.when(k <= 0, 1.0).when((p <= 0) | (k > n), 0.0).when(p >= 1, 1.0).otherwise(F.least(F.exp(first + F.log(ratio)), F.lit(1.0)))


def poisson_sf(k: Column, mean: Column) -> Column:
    """P(X >= k) for a Poisson mean, by summing the nearer tail in the JVM; k <= 0 gives 1, a mean of zero 0."""
    k, mean = k.cast("long"), mean.cast("double")

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] * mean / i
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    log_first = F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.lit(0.0), lambda s, i: s + F.log(mean / i)) - mean
    ratio = F.aggregate(F.sequence(k + 1, k + 100), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")), add, lambda acc: acc["total"])
    below = F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.struct(F.exp(-mean).alias("term"), F.lit(0.0).alias("total")), lambda acc, i: F.struct((acc["term"] * mean / i).alias("term"), (acc["total"] + acc["term"]).alias("total")), lambda acc: acc["total"])
    tail = F.when(k > mean, F.exp(log_first + F.log(ratio))).otherwise(F.greatest(1 - below, F.lit(0.0)))
    return F.when(k <= 0, 1.0).when(mean <= 0, 0.0).otherwise(F.least(tail, F.lit(1.0)))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny, c, d = 1e-300, 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            c = 1 + num / c
            d = 1 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def binom_tail(k: int, n: int, p: float) -> float:
    """P(X >= k) by the regularised incomplete beta function: constant time for any coverage."""
    if k <= 0 or p >= 1:
        return 1.0
    if p <= 0 or k > n:
        return 0.0
    a, b = float(k), float(n - k + 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(p) + b * math.log1p(-p))
    if p < (a + 1) / (a + b + 2):
        return min(1.0, front * _beta_fraction(a, b, p) / a)
    return max(0.0, 1 - front * _beta_fraction(b, a, 1 - p) / b)


@pandas_udf(DoubleType())
def binom_sf_deep(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    """As binom_sf, Arrow-batched, for coverage beyond what a sum of terms is fit for."""
    return pd.Series(np.fromiter((binom_tail(int(a), int(b), float(c)) for a, b, c in zip(k, n, p, strict=True)), float, len(k)))


#: Distinct values of p of at most so many (some 40 bytes each) are ranked by plain windows, and broadcast.
FEW_VALUES = 200_000


def bh_adjust(df: DataFrame, family: list[str], p: str = "pvalue", q: str = "qvalue", few: int = FEW_VALUES) -> DataFrame:
    """Adds Benjamini-Hochberg q values within each family: least p*m/rank over this and later ranks.

    Rows are counted by distinct p first, since ties share the least of their values, which is that
    of the last of them. If the counts are ``few``, they are ranked and broadcast, and the rows stay
    where they are. Otherwise no task sorts a whole family: distinct values are dealt to ranges a
    256th of a power of two wide, and one row for each range shifts the ranks in it and bounds its
    values by the least of later ranges. Rows of p = 1, often a large part, have q = 1 and meet no
    one. Rows without a p get no q. The rows are read twice.
    """
    from ..operators.intervals import join_null_safe

    n = settled(df.where(F.col(p).isNotNull()).groupBy(*family, p).agg(F.count("*").alias("__n")))
    every = Window.partitionBy(*family)
    if n.count() <= few:
        up = every.orderBy(p).rowsBetween(Window.unboundedPreceding, 0)
        down = every.orderBy(F.col(p).desc()).rowsBetween(Window.unboundedPreceding, 0)
        adj = n.withColumn("__adj", F.col(p) * F.sum("__n").over(every) / F.sum("__n").over(up))
        table = F.broadcast(adj.select(*family, p, F.least(F.lit(1.0), F.min("__adj").over(down)).alias(q)))
        return join_null_safe(df.drop(q), table, [*family, p]).select(*[c for c in df.columns if c != q], q)
    n = n.withColumn("__b", F.floor(F.log2(F.greatest(F.col(p), F.lit(1e-300))) * 256))
    up = every.orderBy("__b")
    ranges = n.groupBy(*family, "__b").agg(F.sum("__n").alias("n"))
    ranges = ranges.select(*family, "__b", (F.sum("n").over(up) - F.col("n")).alias("__base"), F.sum("n").over(every).alias("__m"))
    inside = Window.partitionBy(*family, "__b").orderBy(p).rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_null_safe(n, ranges, [*family, "__b"]).withColumn("__adj", F.col(p) * F.col("__m") / (F.col("__base") + F.sum("__n").over(inside)))
    lows = ranked.groupBy(*family, "__b").agg(F.min("__adj").alias("low"))
    after = every.orderBy(F.col("__b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    lows = lows.select(*family, "__b", F.min("low").over(after).alias("__later"))
    down = Window.partitionBy(*family, "__b").orderBy(F.col(p).desc()).rowsBetween(Window.unboundedPreceding, 0)
    value = F.least(F.lit(1.0), F.min("__adj").over(down), F.col("__later"))
    table = join_null_safe(ranked, lows, [*family, "__b"]).where(F.col(p) < 1).select(*family, p, F.lit(0).alias("__part"), value.alias(q))
    part = F.when(F.col(p) >= 1, 1 + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(1 << 20))).otherwise(0).cast("int")
    out = join_null_safe(df.drop(q).withColumn("__part", part), table, [*family, p, "__part"])
    return out.withColumn(q, F.when(F.col(p) >= 1, 1.0).otherwise(F.col(q))).select(*[c for c in df.columns if c != q], q)


def weighted_quantile(df: DataFrame, value: str, weight: str, by: list[str], at: float, bins: int = 4096) -> DataFrame:
    """(by, quantile): exact, interpolated linearly between the rows around rank (rows - 1) * at.

    A row stands for ``weight`` rows. The two ranks are looked for from the top: counts in equal
    bins between the least and the largest value, then in bins of the bin that has the rank, then by
    distinct value in that. So no task gets a group, only its bins. Null values and weights of zero
    take no part; a group without any has no row.
    """
    d = df.where(F.col(value).isNotNull() & (F.col(weight) > 0)).select(*by, F.col(value).cast("double").alias("__v"), F.col(weight).cast("long").alias("__w"))
    d = d.withColumn("__all", F.lit(1))
    keys = ["__all", *by]
    spot = (F.col("__rows") - 1) * at
    ranks = d.groupBy(*keys).agg(F.sum("__w").alias("__rows"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    ranks = ranks.select(*keys, (spot - F.floor(spot)).alias("__frac"), F.explode(F.array(F.floor(spot), F.ceil(spot))).alias("__rank"), "__lo", "__hi").distinct()
    order = Window.partitionBy(*keys, "__first").orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)

    def found(counted: DataFrame) -> DataFrame:
        """The bin with the rank, which is then counted from that bin on."""
        c = counted.withColumn("__upto", F.sum("__n").over(order))
        return c.where((F.col("__rank") < F.col("__upto")) & (F.col("__rank") >= F.col("__upto") - F.col("__n"))).withColumn("__rank", F.col("__rank") - F.col("__upto") + F.col("__n"))

    left = d.join(ranks, keys).withColumn("__first", F.col("__rank"))
    state = ["__first", "__rank", "__frac"]
    for _ in range(2):
        wide = (F.col("__hi") - F.col("__lo")) / bins
        left = left.withColumn("__bin", F.when(wide > 0, F.least(F.floor((F.col("__v") - F.col("__lo")) / wide), F.lit(bins - 1))).otherwise(0))
        counted = left.groupBy(*keys, *state, "__bin").agg(F.sum("__w").alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        picked = found(counted).select(*keys, "__first", "__bin", F.col("__rank").alias("__new"), F.col("__lo").alias("__l"), F.col("__hi").alias("__h"))
        left = left.join(picked, [*keys, "__first", "__bin"]).select(*keys, "__v", "__w", "__first", "__frac", F.col("__new").alias("__rank"), F.col("__l").alias("__lo"), F.col("__h").alias("__hi"))
    last = left.groupBy(*keys, *state, F.col("__v").alias("__bin")).agg(F.sum("__w").alias("__n"))
    ends = found(last).groupBy(*by, "__all").agg(F.min("__bin").alias("a"), F.max("__bin").alias("b"), F.first("__frac").alias("f"))
    return ends.select(*by, (F.col("a") + (F.col("b") - F.col("a")) * F.col("f")).alias("quantile"))


def bh_adjust_ranged(df: DataFrame, p: str = "pvalue", q: str = "qvalue") -> DataFrame:
    """Benjamini-Hochberg q values of all rows as one family."""
    return bh_adjust(df.withColumn("__all", F.lit(1)), ["__all"], p, q).drop("__all")


def truncate6(x: Column) -> Column:
    """Cut (not rounded) to six decimals."""
    return F.floor(x * 1_000_000) / 1_000_000


def site_score(q: Column) -> Column:
    """min(int(-log10(max(q, 1e-300)) * 100), 1000)."""
    return F.least(F.floor(-F.log10(F.greatest(q, F.lit(1e-300))) * 100), F.lit(1000)).cast("long")
