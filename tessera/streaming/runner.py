"""Structured Streaming plumbing: table streams, shared sink folders, and an
`availableNow` runner whose output is read back as a batch DataFrame."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.session import ensure_checkpoint_dir


def stream_table(spark: SparkSession, sf_dir: str, name: str, batches: int = 8) -> DataFrame:
    """A streaming read of one driver table (its batch schema, declared up front), which may
    be a file or a folder of files, in about as many micro-batches as given."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    rows = spark.read.parquet(path)
    # As a pattern the path may name a file too; as a plain path only a folder.
    return (spark.readStream.schema(rows.schema)
            .option("maxFilesPerTrigger", max(1, -(-len(rows.inputFiles()) // batches)))
            .parquet(f"{path[:-1]}[{path[-1]}]"))


def stream_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never machine-local on a cluster)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/streams/{name}-{uuid.uuid4().hex}"


def staged_stream(spark: SparkSession, parts: list[DataFrame], name: str) -> DataFrame:
    """Write the parts one after the other and read them as a stream that takes about a part's
    files at a time, in the order in which they were written."""
    folder = f"{stream_folder(spark, name)}/in"
    for part in parts:
        part.write.mode("append").parquet(folder)
    files = len(spark.read.schema(parts[0].schema).parquet(folder).inputFiles())
    return (spark.readStream.schema(parts[0].schema)
            .option("maxFilesPerTrigger", max(1, files // len(parts))).parquet(folder))


def run_available_now(df: DataFrame, name: str, output_mode: str = "append",
                      foreach_batch=None) -> str:
    """Run a streaming DataFrame over all available input, then stop.

    Output goes to a parquet file sink (exactly-once with the checkpoint); with
    `foreach_batch` the caller writes each micro-batch itself. Returns the folder.
    """
    spark = df.sparkSession
    base = stream_folder(spark, name)
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", f"{base}/_checkpoint")
    if foreach_batch is not None:
        w = w.foreachBatch(lambda b, epoch: foreach_batch(b, epoch, base))
    else:
        w = w.format("parquet").option("path", f"{base}/out")
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return base
