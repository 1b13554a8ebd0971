"""Interval joins, gap clusters, coverage tracks and their unions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import counted

#: Bases that one task sorts at a time.
CHUNK = 100_000


def interval_bins(start: Column, end: Column, width: int) -> Column:
    """Bins that a half-open interval touches; an empty one touches its start's."""
    return F.sequence(F.floor(start / width), F.floor(F.greatest(end - 1, start) / width))


def overlap_pairs(a: DataFrame, b: DataFrame, keys: list[str], bin_width: int = 1000) -> DataFrame:
    """Pairs of rows of a and b that overlap by a base or more on equal keys; b's columns get a ``b_`` prefix.

    Both sides are dealt to fixed bins, so the join is an equi-join on (keys, bin) that Spark can
    shuffle, broadcast by size or split when skewed. A pair that shares several bins is kept in the
    first one only: no distinct is needed. Intervals of both sides have start and end columns.
    """
    left = a.withColumn("__bin", F.explode(interval_bins(F.col("start"), F.col("end"), bin_width)))
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns]).withColumn("__bbin", F.explode(interval_bins(F.col("b_start"), F.col("b_end"), bin_width)))
    same = [F.col(k) == F.col(f"b_{k}") for k in keys]
    on = [*same, F.col("__bin") == F.col("__bbin"), F.col("start") < F.col("b_end"), F.col("b_start") < F.col("end")]
    first = F.floor(F.greatest("start", "b_start") / bin_width) == F.col("__bin")
    out = left.join(right, on, "inner").where(first)
    return out.drop("__bin", "__bbin")


def overlap_counts(peaks: DataFrame, features: DataFrame, keys: list[str], by: list[str] | None = None, bin_width: int = 1000, name: str = "n") -> DataFrame:
    """Features that overlap each peak, for each value of ``by``; peaks without any keep a zero.

    ``peaks`` has a unique peak_id. With ``by``, every peak gets a row for each value that the
    features have (a sample without reads at a peak counts zero there).
    """
    by = by or []
    small = features.select(*keys, "start", "end", *by)
    pairs = overlap_pairs(peaks.select("peak_id", "start", "end", *keys), small, keys, bin_width)
    counts = pairs.groupBy("peak_id", *[F.col(f"b_{c}").alias(c) for c in by]).agg(F.count("*").alias(name))
    frame = peaks
    if by:
        frame = peaks.crossJoin(features.select(*by).distinct())  # the shape of the result
    return frame.join(counts, ["peak_id", *by], "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))


def overlap_values(peaks: DataFrame, track: DataFrame, keys: list[str], by: list[str] | None = None, bin_width: int = 1000) -> DataFrame:
    """Sum, unweighted mean and maximum of the track intervals over each peak; zero where there is none.

    Also the mean weighted by overlapping bases, which the plain one is not. With ``by``, every peak gets a
    row for each value that the track has; peaks are dealt to bins once, not for each of these.
    """
    by = by or []
    pairs = overlap_pairs(peaks.select("peak_id", "start", "end", *keys), track.select(*keys, "start", "end", "value", *by), keys, bin_width)
    bases = F.least("end", "b_end") - F.greatest("start", "b_start")
    stats = pairs.groupBy("peak_id", *[F.col(f"b_{c}").alias(c) for c in by]).agg(
        F.sum("b_value").alias("cov_sum"), F.avg("b_value").alias("cov_mean"), F.max("b_value").alias("cov_max"), (F.sum(F.col("b_value") * bases) / F.sum(bases)).alias("cov_weighted")
    )
    frame = peaks.crossJoin(counted(track.select(*by).distinct())) if by else peaks
    out = frame.join(stats, ["peak_id", *by], "left")
    return out.fillna(0.0, ["cov_sum", "cov_mean", "cov_max", "cov_weighted"])


def gap_cluster(df: DataFrame, keys: list[str], pos: str = "pos", max_gap: int = 25, name: str = "cluster", chunk: int | None = None) -> DataFrame:
    """Adds a cluster number within ``keys``: a new one starts where the gap exceeds ``max_gap``.

    With ``chunk`` the numbers are counted in chunks of so many positions, each from the count of those
    before it, so no task needs all rows of a key.
    """
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(pos)
        new = F.when(F.col(pos) - F.lag(pos).over(w) <= max_gap, 0).otherwise(1)
        return df.withColumn("__new", new).withColumn(name, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")
    row, joins = F.struct(pos), lambda a, b: b[pos] - a[pos] <= max_gap
    c = local_runs(df, keys, pos, row, joins, chunk)
    on = F.col("__on").cast("long")
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = run_edges(c, keys, pos, row, joins).where("__i = 0")
    first = first.select(*keys, "__chunk", (F.coalesce(F.sum(F.col("__n") - on).over(before), F.lit(0)) - on).alias("__base"))
    inside = Window.partitionBy(*keys, "__chunk").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("__k", F.count_if("__new").over(inside))
    return join_null_safe(c, first, [*keys, "__chunk"]).withColumn(name, F.col("__k") + F.col("__base")).drop("__chunk", "__new", "__lo", "__k", "__base")


def join_null_safe(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys where null equals null.

    No filter for nulls is then pushed into either side, so two sides of one origin keep one shuffle.
    """
    right = b.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)], *[c for c in b.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__r{i}")) for i, k in enumerate(keys)]
    return a.join(right, on, "left").drop(*[f"__r{i}" for i in range(len(keys))])


def local_runs(df: DataFrame, keys: list[str], start: str, row: Column, joins: Callable[[Column, Column], Column], chunk: int = CHUNK) -> DataFrame:
    """Adds __chunk, and __lo: the first ``start`` of each row's run within its chunk of positions.

    A row joins the run of the row before it if ``joins`` says so of the two as ``row``. Rows that
    have a __chunk already, by which they lie together, keep it and stay where they are.
    """
    w = Window.partitionBy(*keys, "__chunk").orderBy(start)
    c = df if "__chunk" in df.columns else df.withColumn("__chunk", F.floor(F.col(start) / chunk))
    c = c.withColumn("__new", ~F.coalesce(joins(F.lag(row).over(w), row), F.lit(False)))
    return c.withColumn("__lo", F.max(F.when(F.col("__new"), F.col(start))).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def run_edges(c: DataFrame, keys: list[str], start: str, row: Column, joins: Callable[[Column, Column], Column], aggs: dict[str, Column] | None = None) -> DataFrame:
    """The first and the last local run of each chunk: __chunk, __i, __lo, __n (runs of the chunk), __on, __run, and ``aggs`` of its rows.

    __on tells a chunk's first run that goes on from the chunk before; __run is the first start of the
    whole run. Two rows for each chunk take part in that, however many it holds.
    """
    aggs = aggs or {}
    local = c.groupBy(*keys, "__chunk", "__lo").agg(F.min_by(row, start).alias("__f"), F.max_by(row, start).alias("__l"), *[a.alias(n) for n, a in aggs.items()])
    one = F.struct("__lo", "__f", "__l", *aggs)
    ends = local.groupBy(*keys, "__chunk").agg(F.min_by(one, "__lo").alias("__a"), F.max_by(one, "__lo").alias("__b"), F.count("*").alias("__n"))
    both = F.when(F.col("__a.__lo") == F.col("__b.__lo"), F.array("__a")).otherwise(F.array("__a", "__b"))
    e = ends.select(*keys, "__chunk", "__n", F.posexplode(both).alias("__i", "__e")).select(*keys, "__chunk", "__n", "__i", "__e.*")
    order = Window.partitionBy(*keys).orderBy("__lo")
    on = (F.col("__i") == 0) & F.coalesce(joins(F.lag("__l").over(order), F.col("__f")), F.lit(False))
    e = e.withColumn("__on", on)
    return e.withColumn("__run", F.max(F.when(~F.col("__on"), F.col("__lo"))).over(order.rowsBetween(Window.unboundedPreceding, 0)))


def with_run_edges(c: DataFrame, edges: DataFrame, keys: list[str], **columns: Column) -> DataFrame:
    """Rows of ``local_runs`` with columns of their whole run: those of ``run_edges`` by name, else (an inner run) the given ones."""
    one = F.struct("__lo", *columns)
    ends = edges.groupBy(*keys, "__chunk").agg(F.min_by(one, "__lo").alias("__a"), F.max_by(one, "__lo").alias("__b"))
    out = join_null_safe(c, ends, [*keys, "__chunk"])
    pick = lambda n, own: F.when(F.col("__lo") == F.col("__a.__lo"), F.col("__a")[n]).when(F.col("__lo") == F.col("__b.__lo"), F.col("__b")[n]).otherwise(own)
    return out.withColumns({n: pick(n, own) for n, own in columns.items()}).drop("__a", "__b")


def gap_cluster_chunked(
    df: DataFrame, keys: list[str], pos: str = "pos", max_gap: int = 25, chunk: int = CHUNK, name: str = "cluster", carry: list[str] | None = None, sums: list[str] | None = None, last: str | None = None
) -> DataFrame:
    """As gap_cluster, but no task needs a whole chromosome: cluster names are the first position.

    Name in ``carry`` the columns that are used later: both passes over the rows then read the same
    columns, and Spark shuffles what they come from once. ``sums`` adds sum_<column> over each
    cluster, and ``last`` its last position, of which a task holds no more than a chunk's part either.
    """
    row, joins = F.struct(pos, *(carry or [])), lambda a, b: b[pos] - a[pos] <= max_gap
    c = local_runs(df, keys, pos, row, joins, chunk)
    total = {f"sum_{s}": (F.sum, s) for s in sums or []} | ({last: (F.max, pos)} if last else {})
    whole, part = Window.partitionBy(*keys, "__run"), Window.partitionBy(*keys, "__chunk", "__lo")
    edges = run_edges(c, keys, pos, row, joins, {n: f(x) for n, (f, x) in total.items()})
    edges = edges.withColumns({n: f(n).over(whole) for n, (f, _) in total.items()}) if total else edges
    c = c.withColumns({n: f(x).over(part) for n, (f, x) in total.items()}).withColumnsRenamed({n: f"__{n}" for n in total}) if total else c
    out = with_run_edges(c, edges, keys, __run=F.col("__lo"), **{n: F.col(f"__{n}") for n in total})
    return out.drop("__chunk", "__new", "__lo", *[f"__{n}" for n in total]).withColumnRenamed("__run", name)


def depth_track(intervals: DataFrame, keys: list[str], weight: Column | None = None, chunk: int = CHUNK) -> DataFrame:
    """Sweep of intervals to a step function: (keys, start, end, value), zero steps left out.

    Intervals are cut at chunk ends, so each chunk is swept by itself. Two events an interval,
    summed by position before the sort, so deep places cost one row; where the sum stays, no step
    begins. Of each chunk only the steps at its two ends meet those of its neighbours (the others are dealt
    no further), and join them at equal values (with weights that are no whole numbers, if both sums came out equal). Empty
    intervals, and those without a start or an end, add nothing. Weights are above zero.
    """
    w = F.lit(1).cast("long") if weight is None else weight
    lo, hi = F.col("__c") * chunk, (F.col("__c") + 1) * chunk
    cut = intervals.where(F.col("start") < F.col("end")).select(*keys, "start", "end", w.alias("__d"), F.explode(interval_bins(F.col("start"), F.col("end"), chunk)).alias("__c"))
    edge = lambda at, d, n: F.struct(at.cast("long").alias("__pos"), d.alias("__v"), F.lit(n).cast("long").alias("__n"))
    both = F.array(edge(F.greatest("start", lo), F.col("__d"), 1), edge(F.least("end", hi), -F.col("__d"), -1))
    events = cut.select(*keys, "__c", F.inline(both)).groupBy(*keys, "__c", "__pos").agg(F.sum("__v").alias("__v"), F.sum("__n").alias("__n"))
    order = Window.partitionBy(*keys, "__c").orderBy("__pos")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    swept = events.select("*", F.sum("__v").over(running).alias("value"), F.sum("__n").over(running).alias("__open"))
    # open intervals, not the sum of their weights, tell an empty step: floats leave residues
    same = (F.col("__v") == 0) & (F.col("__open") > 0) & (F.col("__open") > F.col("__n"))
    steps = swept.where(~same).withColumn("end", F.lead("__pos").over(order)).where(F.col("end").isNotNull() & (F.col("__open") > 0))
    # equal also where null, so that no filter for nulls is pushed into one branch: both read one shuffle
    outer = F.col("__pos").eqNullSafe(lo) | F.col("end").eqNullSafe(hi)
    steps = steps.select(*keys, F.col("__pos").alias("start"), "end", "value", outer.alias("__outer"))
    side = Window.partitionBy(*keys).orderBy("start")
    goes_on = (F.lag("end").over(side) == F.col("start")) & (F.lag("value").over(side) == F.col("value"))
    runs = steps.where("__outer").withColumn("__new", ~F.coalesce(goes_on, F.lit(False)))
    runs = runs.withColumn("__run", F.max(F.when(F.col("__new"), F.col("start"))).over(side.rowsBetween(Window.unboundedPreceding, 0)))
    joined = runs.groupBy(*keys, "__run").agg(F.max("end").alias("end"), F.first("value").alias("value"))
    return steps.where("not __outer").select(*keys, "start", "end", "value").unionByName(joined.select(*keys, F.col("__run").alias("start"), "end", "value"))


def depth_at(points: DataFrame, intervals: DataFrame, keys: list[str], pos: str = "pos", name: str = "depth", chunk: int = CHUNK) -> DataFrame:
    """Adds to points how many intervals cover their position.

    Both are swept together in chunks of positions: an interval is one or two rows, not one for each
    of its bases, and what begins and ends at a position is summed before.
    """
    lo, hi = F.col("__c") * chunk, (F.col("__c") + 1) * chunk
    cut = intervals.where(F.col("start") < F.col("end")).select(*keys, "start", "end", F.explode(interval_bins(F.col("start"), F.col("end"), chunk)).alias("__c"))
    edge = lambda at, d: F.struct(at.cast("long").alias(pos), F.lit(d).cast("long").alias("__d"))
    both = F.array(edge(F.greatest("start", lo), 1), edge(F.least("end", hi), -1))
    edges = cut.select(*keys, "__c", F.inline(both)).groupBy(*keys, "__c", pos).agg(F.sum("__d").alias("__d")).where("__d <> 0")
    at = points.withColumn("__c", F.floor(F.col(pos) / chunk)).withColumn("__d", F.lit(None).cast("long"))
    # the frame takes all rows of a position: what begins or ends there counts for its points
    upto = Window.partitionBy(*keys, "__c").orderBy(pos).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    swept = at.unionByName(edges, allowMissingColumns=True).withColumn(name, F.coalesce(F.sum("__d").over(upto), F.lit(0)))
    return swept.where(F.col("__d").isNull()).drop("__c", "__d")


def mean_track(tracks: DataFrame, keys: list[str], n_col: str) -> DataFrame:
    """Average of several step functions: their sum over ``n_col`` samples, missing as zero."""
    total = depth_track(tracks.select(*keys, n_col, "start", "end", "value"), [*keys, n_col], F.col("value"))
    return total.withColumn("value", F.col("value") / F.col(n_col))


def flank(df: DataFrame, n: int = 10) -> DataFrame:
    """Intervals widened by n on both sides, not below zero; the far end is not clamped."""
    return df.withColumn("start", F.greatest(F.col("start") - n, F.lit(0))).withColumn("end", F.col("end") + n)
