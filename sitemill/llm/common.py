"""What several corpus operators share: lineage cuts, connected components, Arrow helpers."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory, by whatever file system the path names."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the cluster's shared checkpoint folder and cut its lineage there.

    The folder is ``spark.checkpoint.dir`` of the session. Where that is unset, a local session
    (tests on one machine) gets a temporary one; on a cluster that is an error, since executors
    would write to disks that the others can't read. Never localCheckpoint: a lost executor loses
    nothing.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint"))
    return df.checkpoint(eager=True)


def named(name: str) -> Column:
    """The column of that very name, dots and backticks in it or not."""
    return F.col(f"`{name.replace('`', '``')}`")


def boxed(docs: DataFrame, alias: str = "row") -> Column:
    """All columns as one struct, so that a step's own columns clash with none; ``alias.*`` gives them back."""
    return F.struct(*[named(c) for c in docs.columns]).alias(alias)


def fresh(docs: DataFrame, stem: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in docs.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


#: Edge tables of at most so many rows (16 bytes each) are contracted in one task.
SMALL_EDGES = 1_000_000


def _roots_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of an edge table of bounded size."""
    got = list(batches)
    if not got:
        return
    u, v = (np.concatenate([b.column(i).to_numpy() for b in got]) for i in (0, 1))
    node, at = np.unique(np.r_[u, v], return_inverse=True)
    comp = np.arange(len(node))
    join_labels(comp, at[: len(u)], at[len(u) :])
    for k in range(0, len(node), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(node[k : k + 100_000]), pa.array(node[comp[k : k + 100_000]])], names=["node", "root"])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 50, small: int = SMALL_EDGES) -> DataFrame:
    """Smallest reachable id for each node of an undirected edge table: columns node, root.

    A table that counts ``small`` edges at most is contracted in one task. A larger one takes
    alternating large-star and small-star rounds: each is a partial aggregate (the smallest
    neighbour, so a hub is one row per task) and a join on the node, which AQE may split when it is
    skewed; no neighbour list is ever gathered. Rounds are cut by checkpoints and end when the edge
    set no longer changes. Both ways give the same rows. Self-loops and null ends are ignored; no
    edges give an empty table.
    """
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    e = edges.where(F.col(src) != F.col(dst)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = cut(e)
    if e.count() <= small:
        return e.coalesce(1).mapInArrow(_roots_of, "node long, root long")
    sign = None
    for _ in range(max_rounds):
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (now["n"], now["h"]) == sign:
            break
        sign = (now["n"], now["h"])
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        big = big.where(F.col("u") != F.col("v")).distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        rest = big.join(low, "u")
        e = rest.select("u", F.col("m").alias("v")).union(
            rest.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        e = cut(e.distinct())
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, target_rows: int) -> Iterator[pa.Table]:
    """Join batches that are sorted by ``key`` into tables of about ``target_rows`` that split no key."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < target_rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        k = t.column(key).to_numpy()
        at = int(k.searchsorted(k[-1], "left"))
        if at:
            yield t.slice(0, at)
        held = t.slice(at).to_batches()
        rows = t.num_rows - at
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def join_labels(comp: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the classes of i and j in place; comp[x] is the smallest index of x's class."""
    while len(i):
        a, b = comp[i], comp[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(comp, np.maximum(a, b), np.minimum(a, b))
        while True:
            jump = comp[comp]
            if (jump == comp).all():
                break
            comp[:] = jump
