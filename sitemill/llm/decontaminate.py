"""Benchmark decontamination by SimHash over item-sized windows (operator 3), DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, cut, named

SHINGLE = 5
SIMILARITY = 0.8
#: Fingerprints of 128 bits within so many are verified. At a similarity of 0.8 a fifth of the bits
#: differ, 26 with a deviation of 4.6; of unrelated ones half, 64.
RADIUS = 42
#: Blocks of 32 bits: two fingerprints within the radius differ in RADIUS // BLOCKS bits at most in one.
BLOCKS = 4
#: Window starts whose windows are cut out of a text in one row.
CHUNK = 4096
#: A table is broadcast only if it was counted and has no more rows than this.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(hashes: Column, k: int) -> Column:
    """Hashes of every k words in a row; none if there are fewer words."""
    n = F.size(hashes)
    at = lambda i: F.xxhash64(F.lit(k), *[hashes[i + j] for j in range(k)])
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), at)).otherwise(F.array().cast("array<long>"))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint if the counted rows allow it; else Spark joins by shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _fingerprint(grams: Column) -> Column:
    """64 bits: those whose shingles with the bit set outweigh the others; grams: array<struct<s,w>>."""
    vote = lambda b: F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.when(F.getbit(g["s"], b) == 1, g["w"]).otherwise(-g["w"]))
    up = lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(F.when(x > 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), vote), F.lit(0).cast("long"), up)


def _profiles(windows: DataFrame, weights: DataFrame, n_weights: int, keys: list[str]) -> DataFrame:
    """For each window (keys, grams): its weighted SimHash as two longs f0, f1, the distinct grams and their total weight.

    A shingle weighs one over the number of benchmark items that have it, one if none has.
    """
    flat = windows.select(*keys, F.explode(F.array_distinct("grams")).alias("s"))
    flat = flat.join(_bounded(weights, n_weights), "s", "left").withColumn("w", F.coalesce("w", F.lit(1.0)))
    sums = flat.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("s", "w"))).alias("g"))
    other = F.transform("g", lambda x: F.struct(F.xxhash64(x["s"]).alias("s"), x["w"].alias("w")))
    total = F.aggregate("g", F.lit(0.0), lambda acc, x: acc + x["w"])
    return sums.select(*keys, F.col("g.s").alias("grams"), total.alias("total"), _fingerprint(F.col("g")).alias("f0"), _fingerprint(other).alias("f1"))


def within_blocks(a: list[Column], b: list[Column], radius: int = RADIUS) -> Column:
    """Whether some of the blocks of two fingerprints (two longs each) differ in its share of the radius at most.

    Of more differing bits than the share in every block the sum would be over the radius.
    """
    out = F.lit(False)
    for x, y in zip(a, b, strict=True):
        d = x.bitwiseXOR(y)
        for at in range(0, 64, 128 // BLOCKS):
            block = F.shiftrightunsigned(d, at).bitwiseAND(F.lit((1 << 128 // BLOCKS) - 1).cast("long"))
            out = out | (F.bit_count(block) <= radius // BLOCKS)
    return out


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    threshold: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """(doc_id, __rid, item_id, start_word, n_words, hamming, similarity): the best window for each pair.

    1. Where a document has a shingle of an item, a window of the item's size is laid at the same
       offset, and the item is its partner. Pairs without such a shingle have similarity zero, so
       this loses nothing, and an item never meets windows that it shares nothing with.
    2. Windows and items get 128-bit weighted SimHashes, indexed by item and compared block by
       block: four blocks of 32 bits, of which one differs in a quarter of the radius at most if
       the fingerprints lie within it. So every pair within the radius stays.
    3. Each such pair is verified: the weighted Dice coefficient of the two shingle sets must
       reach ``threshold``. Lower thresholds than 0.8 need a larger ``radius``; one of 128 keeps all.

    Items without words match nothing; those of fewer than five words are one shingle. Null texts
    are empty. ``__rid`` is a hash of the text, so that rows of one or no id stay apart; equal rows
    give one result. Items repeated under several ids are each reported. Windows at the ends of a
    text are shorter.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), words(F.col(item_text)).alias("w")).where(F.size("w") > 0)
    items = items.select("item_id", F.transform("w", lambda x: F.xxhash64(x)).alias("wh"), F.size("w").alias("len"))
    items = items.withColumn("k", F.least("len", F.lit(SHINGLE)))
    pick = F.array().cast("array<long>")
    for k in range(1, SHINGLE + 1):
        pick = F.when(F.col("k") == k, shingle_hashes(F.col("wh"), k)).otherwise(pick)
    items = cut(items.select("item_id", "len", "k", pick.alias("grams")).distinct())
    sizes = [r["k"] for r in items.select("k").distinct().collect()]  # five values at most
    seeds = items.select("item_id", "len", "k", F.posexplode("grams").alias("off", "s"))
    weights = seeds.groupBy("s").agg((F.lit(1.0) / F.countDistinct("item_id")).alias("w"))
    seeds = cut(seeds)
    n_seeds = seeds.count()

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("__rid"), F.col(text_col).cast("string").alias("text"))
    hashed = lambda d: d.select("doc_id", "__rid", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("wh"), *[c for c in d.columns if c == "spots"])
    keys = ["doc_id", "__rid", "k", "a", "b"]
    marks = None
    for k in sizes or [SHINGLE]:
        flat = hashed(base).select("doc_id", "__rid", F.size("wh").alias("n"), F.posexplode(shingle_hashes(F.col("wh"), k)).alias("pos", "s"))
        own = seeds.where(F.col("k") == k).select("item_id", "s", "k", "off", "len")
        start, end = F.greatest(F.col("pos") - F.col("off"), F.lit(0)), F.least(F.col("pos") - F.col("off") + F.col("len"), F.col("n"))
        part = flat.join(_bounded(own, n_seeds), "s").select("doc_id", "__rid", "k", start.alias("a"), end.alias("b"), "item_id")
        marks = part if marks is None else marks.unionByName(part)
    marks = cut(marks.distinct())
    spots = marks.select(*keys).distinct().groupBy("doc_id", "__rid", F.expr(f"a div {CHUNK}").alias("chunk")).agg(F.collect_list(F.struct("k", "a", "b")).alias("spots"))
    spots = cut(spots)
    few = _bounded(spots, marks.count())
    found = base.join(few, base["doc_id"].eqNullSafe(spots["doc_id"]) & (base["__rid"] == spots["__rid"]))
    found = hashed(found.select(base["doc_id"], base["__rid"], "text", "spots"))
    grams = pick_grams(F.col("wh"), F.col("k"), F.col("a"), F.col("b"), sizes or [SHINGLE])
    windows = found.select("doc_id", "__rid", "wh", F.explode("spots").alias("x")).select("doc_id", "__rid", "wh", "x.k", "x.a", "x.b")
    windows = windows.select(*keys, grams.alias("grams")).dropDuplicates(keys)
    left = cut(_profiles(windows, weights, n_seeds, keys))
    right = _profiles(items.select("item_id", "grams"), weights, n_seeds, ["item_id"])
    right = right.select("item_id", F.col("grams").alias("igrams"), F.col("total").alias("itotal"), F.col("f0").alias("i0"), F.col("f1").alias("i1"))
    right = _bounded(cut(right), n_seeds)
    same = left["doc_id"].eqNullSafe(marks["doc_id"])
    for c in keys[1:]:
        same = same & (left[c] == marks[c])
    near = left.join(marks, same).select(*[left[c] for c in left.columns], "item_id").join(right, "item_id")
    near = near.where(within_blocks([F.col("f0"), F.col("f1")], [F.col("i0"), F.col("i1")], radius))
    apart = F.bit_count(F.col("f0").bitwiseXOR(F.col("i0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("i1")))
    near = near.withColumn("hamming", apart.cast("int")).where(F.col("hamming") <= radius)
    both = near.select(*keys, "item_id", "hamming", "total", "itotal", F.explode(F.array_intersect("grams", "igrams")).alias("s"))
    both = both.join(_bounded(weights, n_seeds), "s").groupBy(*keys, "item_id", "hamming", "total", "itotal").agg(F.sum("w").alias("common"))
    both = both.withColumn("similarity", F.round(2 * F.col("common") / (F.col("total") + F.col("itotal")), 9)).where(F.col("similarity") >= threshold)
    best = F.max_by(F.struct(F.col("a").alias("start_word"), (F.col("b") - F.col("a")).alias("n_words"), "hamming", "similarity"), F.struct("similarity", -F.col("a"), -F.col("b")))
    return both.groupBy("doc_id", "__rid", "item_id").agg(best.alias("x")).select("doc_id", "__rid", "item_id", "x.*")


def pick_grams(hashes: Column, k: Column, a: Column, b: Column, sizes: list[int]) -> Column:
    """Shingle hashes of the words a to b."""
    out = F.array().cast("array<long>")
    for size in sizes:
        out = F.when(k == size, shingle_hashes(F.slice(hashes, a + 1, b - a), size)).otherwise(out)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark passage, columns unchanged."""
    bad = contamination(docs, benchmark, id_col, text_col).select("doc_id", "__rid").distinct()
    d = docs.select(boxed(docs), named(id_col).cast("long").alias("key"), F.xxhash64(named(text_col).cast("string")).alias("h"))
    return d.join(bad, d["key"].eqNullSafe(bad["doc_id"]) & (d["h"] == bad["__rid"]), "left_anti").select("row.*")
