"""Helpers shared by the training-data operators: inputs, folds and shared tables."""

from __future__ import annotations

import math
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

#: White space that ends a word (`[^\x20\x09-\x0D]+`); `bytes.split()` splits on the same bytes.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id is read as empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def held_out(doc_id: Column, n: int) -> Column:
    return fold(doc_id, n) == 0


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text as UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-llm-{uuid.uuid4().hex}"


#: While a table is written: its shuffle files go with the write, and Python workers get texts in small batches.
WHILE_STORED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the block; afterwards those of before."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors, leaves no shuffle files."""
    with settings(df.sparkSession, WHILE_STORED):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets(total: float, each: float, least: int = 8) -> int:
    """Number of hash buckets so that each holds about `each` of `total`."""
    return max(least, math.ceil((total or 0) / each))
