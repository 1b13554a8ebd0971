"""A directory of samples as a stream: new files are analysed as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.dedup import BUNDLE, LEAD, networks_of, umi_sums

SAM_LINES = "value string"


def stream_sam(spark: SparkSession, directory: str, files_at_once: int = 8) -> DataFrame:
    """Alignment rows of SAM files in a directory, file by file, with their sample."""
    from ..sources.readers import sam_columns

    t = spark.readStream.schema(SAM_LINES).option("maxFilesPerTrigger", files_at_once).format("text").load(directory)
    t = t.select("value", F.col("_metadata.file_path").alias("path")).where(~F.col("value").startswith("@"))
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.sam(\.gz)?$", "")
    return sam_columns(t.select(name.alias("sample"), F.split("value", "\t").alias("f"), F.lit(0).cast("long").alias("ord")))


def run_batches(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Calls ``work`` on each batch of new rows; ``availableNow`` ends when the directory is done."""
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str = "ts", by: str = "event_type", window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Event counts by tumbling window, for a stream or a table; rows later than the watermark are dropped from a stream."""
    e = events.withWatermark(time, late) if events.isStreaming else events
    return e.groupBy(F.window(time, window).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def keep_umi_sums(stream: DataFrame, path: str, checkpoint: str, umi: str = "umi") -> StreamingQuery:
    """UMI sums of a stream of alignment rows, held as state over all batches; what a batch changes is written below ``path``.

    The state has a row for each distinct UMI of a bundle. A batch that runs again after a failure
    writes its own folder again, so nothing counts twice.
    """
    sums = umi_sums(stream, umi, True, F.lit(1).cast("long"))
    write = lambda df, i: df.write.mode("overwrite").parquet(f"{path}/batch={i}")
    return sums.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def streamed_dedup(spark: SparkSession, path: str) -> DataFrame:
    """One read for each directional UMI network of all that a stream has brought so far, as of one table."""
    rows = spark.read.parquet(path)
    fields = ["weight", "n", *LEAD]
    last = rows.groupBy(*BUNDLE, "umi").agg(F.max_by(F.struct(*fields), "batch").alias("r")).select(*BUNDLE, "umi", "r.*")
    return networks_of(last).select(*BUNDLE, "umi", F.col("n").alias("reads"), *LEAD)
