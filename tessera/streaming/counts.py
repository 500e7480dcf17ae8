"""Count per key kept up to date as files arrive (Structured Streaming).

An ``availableNow`` query over a file source keeps the counts; every
micro-batch adds the counts it changed as a new folder under the session's
checkpoint folder (a replayed batch replaces only its own folder), and the
result is the largest, which is the latest, count per key.  What is there is
never overwritten, so a reader or a crash in between sees the last state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.streaming._common import file_stream, run_dir


def stream_counts(spark: SparkSession, source: str, schema: str, key: str,
                  files_per_trigger: int | None = 1000, fmt: str = "parquet", glob: str | None = None) -> DataFrame:
    """Count per ``key`` kept up to date as files arrive; returns the final
    table (``key, n``).  ``source`` is a table: one file or a folder of files
    (with ``glob``, a folder and a filter of file names)."""
    base = run_dir(spark, "counts")
    stream = file_stream(spark, source, schema, fmt, files_per_trigger, glob)
    counts = stream.groupBy(key).agg(F.count("*").alias("n"))
    empty = spark.createDataFrame([], counts.schema)
    empty.write.parquet(f"{base}/table/batch=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/table/batch={batch_id}")

    q = (counts.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{base}/table").groupBy(key).agg(F.max("n").alias("n"))
