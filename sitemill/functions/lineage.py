"""Tables that a loop goes on from: written once, so that a lost executor costs no loop."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of at most so many (some 40 bytes each) are broadcast.
FEW_ROWS = 200_000
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the session's checkpoint folder, from which later steps read it.

    A local session without such a folder gets a temporary one; on a cluster that is an error, since
    executors don't share it.
    """
    _folder(df)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As settled, in columns: a small part of the bytes for tables of many rows, but what lay together is dealt anew.

    Shuffle files that led to the table go when it is written; else they would stay on the executors'
    disks until the driver's memory is collected.
    """
    path, conf = f"{_folder(df)}/stored-{uuid.uuid4().hex}", df.sparkSession.conf
    before = conf.get(SHUFFLES_GO, None)
    conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(SHUFFLES_GO) if before is None else conf.set(SHUFFLES_GO, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, few: int = FEW_ROWS) -> DataFrame:
    """The small side of a join on few values, such as samples: written, counted, and broadcast if ``few``.

    Unless it is broadcast, each value's rows of the other side come to one task.
    """
    out = settled(df)
    return F.broadcast(out) if out.count() <= few else out


def _folder(df: DataFrame) -> str:
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local") or context.master.startswith("local-cluster") and not folder:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="settled"))
    return context._jsc.sc().getCheckpointDir().get()
