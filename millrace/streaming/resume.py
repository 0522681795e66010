"""Incremental runs as a structured stream over a folder of responses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def run_available(spark: SparkSession, folder: str, schema: StructType, checkpoint: str, sink: Callable[[DataFrame, int], None], files_per_batch: int = 10) -> int:
    """Processes the files that no earlier run with the same checkpoint has seen, some files to a batch, and stops.

    The checkpoint is the ledger: after a crash the batch that didn't end is repeated under its number, so a sink
    that overwrites by batch number has every row once. Returns the batches of this run.
    """
    done = []

    def each(batch: DataFrame, number: int) -> None:
        sink(batch, number)
        done.append(number)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)


def status_by_window(responses: DataFrame, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """Requests per window of creation and status; as a stream, rows later than `late` are let go."""
    rows = responses.withWatermark("created_at", late) if responses.isStreaming else responses
    return rows.groupBy(F.window("created_at", width).alias("w"), F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "status", "n")
