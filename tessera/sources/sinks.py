"""Sinks (K1–K7): ordered response JSONL, reshaped inputs, reports, evaluation
datasets, per-label results, summary documents. All are DataFrame writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_responses(responses: DataFrame, path: str, order_cols: Sequence[str]) -> None:
    """K1: compact JSON lines, success and error lines side by side, partitioned by
    status. Rows are range-partitioned on (status, order), so request order is
    kept across files (file name order) and inside each file, without funnelling
    one status through a single task."""
    from tessera.functions.ordered import num_partitions
    status = F.when(F.col("error").isNull(), "ok").otherwise("error")
    df = responses.withColumn("status", status)
    (df.repartitionByRange(num_partitions(df), "status", *order_cols)
     .sortWithinPartitions("status", *order_cols).write.mode("overwrite").partitionBy("status")
     .json(path))


def write_inputs_by_source(lines: DataFrame, path: str, source_col: str = "source_file") -> None:
    """K2: reshaped inputs written under their relative source path."""
    lines.write.mode("overwrite").partitionBy(source_col).json(path)


def na(c: Column) -> Column:
    """Report cell: 'n/a' for null or zero, the value as text otherwise."""
    zero = F.coalesce(c.try_cast("double") == 0, F.lit(False))
    return F.coalesce(F.when(~zero, c.cast("string")), F.lit("n/a"))


def markdown_rows(report: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K3: one markdown table row per run (`| a | b |`), null/zero shown as n/a."""
    cells = [na(F.col(c)) for c in cols]
    return report.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias(
        "markdown"))


def write_report(report: DataFrame, path: str) -> None:
    """K3/K4: report rows (one per run, or one comparison row) as JSON."""
    report.write.mode("overwrite").json(path)


def write_eval_dataset(rows: DataFrame, path: str) -> None:
    """K5: evaluation dataset JSONL (overwrite)."""
    rows.write.mode("overwrite").json(path)


def run_label(label: Column) -> Column:
    """K6: label sanitised: '+' → '_', lower case."""
    return F.lower(F.replace(label, F.lit("+"), F.lit("_")))


def write_results_by_label(results: DataFrame, path: str, label_col: str = "run_label") -> None:
    """K6: result items partitioned by sanitised run label."""
    results.withColumn(label_col, run_label(F.col(label_col))).write.mode("overwrite").partitionBy(
        label_col).json(path)


def summary_documents(parts: DataFrame, key: str = "message_id") -> DataFrame:
    """K7: per message the text parts joined by blank lines in order, then a
    References list of unique URLs in first-seen order (title falls back to URL).

    Input: (message_id, part_no, text, refs: array<struct<url,title>>).
    """
    body = parts.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("part_no", "text"))), lambda x: x.text), "\n\n").alias("body"))
    refs = parts.select(key, "part_no", F.posexplode("refs").alias("ref_no", "r")).select(
        key, F.struct("part_no", "ref_no").alias("pos"), F.col("r.url").alias("url"),
        F.col("r.title").alias("title"))
    first = refs.groupBy(key, "url").agg(F.min("pos").alias("pos"),
                                         F.min_by("title", F.col("pos")).alias("title"))
    lines = first.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(
        "pos", F.concat(F.lit("- ["), F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("url")),
                        F.lit("]("), F.col("url"), F.lit(")")).alias("line")))).alias("_l"))
    doc = body.join(lines, key, "left").select(
        key, F.when(F.size(F.coalesce(F.col("_l"), F.array())) > 0, F.concat(
            F.col("body"), F.lit("\n\n## References\n"), F.array_join(F.col("_l.line"), "\n")))
        .otherwise(F.col("body")).alias("document"))
    return doc
