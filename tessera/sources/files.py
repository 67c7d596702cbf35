"""File sources (S1–S10): request JSONL folders, embedding outputs, run folders,
span logs, metric reports, cohort CSVs, corpora, evaluation rows, failure logs.

All readers are `spark.read` with declared schemas or VARIANT parsing; line
numbers come from `posexplode(split(wholetext))` so rejects can name file:line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import prepare

OUTPUT_SCHEMA = T.StructType([
    T.StructField("object", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("usage", T.StructType([T.StructField("prompt_tokens", T.LongType()),
                                         T.StructField("total_tokens", T.LongType())])),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("object", T.StringType()), T.StructField("index", T.IntegerType()),
        T.StructField("input_id", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType()))]))),
    T.StructField("input_ids", T.ArrayType(T.StringType())),
    T.StructField("error", T.StructType([T.StructField("code", T.StringType()),
                                         T.StructField("message", T.StringType())])),
])

REQUEST_LOG_SCHEMA = T.StructType([
    T.StructField("sequence", T.LongType()), T.StructField("status_code", T.LongType()),
    T.StructField("duration_ms", T.DoubleType()), T.StructField("start_offset_seconds", T.DoubleType()),
    T.StructField("input_count", T.LongType()), T.StructField("correlated_inputs", T.LongType()),
    T.StructField("prompt_tokens", T.LongType()), T.StructField("estimated_tokens", T.LongType()),
    T.StructField("retry_after", T.DoubleType()), T.StructField("error_code", T.StringType()),
    T.StructField("error_message", T.StringType()), T.StructField("backend_id", T.StringType()),
    T.StructField("backend_type", T.StringType()), T.StructField("backend_region", T.StringType()),
    *[T.StructField(f"rate_limit_{a}_{b}", T.StringType())
      for a in ("limit", "remaining", "reset") for b in ("requests", "tokens")],
])

COHORT_CLINICAL = ("PATIENT_ID INT, GENDER STRING, AGE INT, SMOKING STRING, YELLOW_FINGERS STRING, "
                   "ANXIETY STRING, PEER_PRESSURE STRING, CHRONIC_DISEASE STRING, FATIGUE STRING, "
                   "ALLERGY STRING, WHEEZING STRING, ALCOHOL_CONSUMING STRING, COUGHING STRING, "
                   "SHORTNESS_OF_BREATH STRING, SWALLOWING_DIFFICULTY STRING, CHEST_PAIN STRING, "
                   "LUNG_CANCER STRING")
COHORT_SYMPTOMS = ("PATIENT_ID INT, CANCER_STAGE STRING, TUMOR_SIZE_CM DOUBLE, DIAGNOSIS_DATE DATE, "
                   "TREATMENT_RECEIVED STRING")


def file_lines(spark: SparkSession, path: str, glob: str, whole_files: bool = False) -> DataFrame:
    """Every line of every matching file (recursive): file, line_no (1-based), line.

    Files are read line by line (splittable, so a huge file is spread over many
    tasks); exact line numbers come from a distributed rank over
    (file, split start, position in split). `whole_files=True` reads each file
    as one row instead (only for small files).
    """
    from tessera.functions.ordered import rank_within
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if whole_files:
        raw = reader.text(path, wholetext=True).select(
            F.col("_metadata.file_path").alias("file"), "value")
        return raw.select("file", F.posexplode(F.split("value", "\n", -1)).alias("i", "line")
                          ).select("file", (F.col("i") + 1).alias("line_no"), F.col("line"))
    raw = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"), F.col("value").alias("line"))
    ranked = rank_within(raw, ["file"], ["_block", "_pos"])
    return ranked.select("file", (F.col("_rank") + 1).alias("line_no"), "line")


def _vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def read_requests(spark: SparkSession, input_dir: str, expected_model: str | None) -> DataFrame:
    """S1 + P3 + P4: request JSONL lines (only `*.jsonl`, sorted path + line order,
    blank lines skipped) parsed as VARIANT and validated in one pass.

    Result columns: source (`file:line`), order keys, the normalised typed
    columns, `errors`, `error`, `accepted`, `input_ids`, `texts`, `input_count`.
    Unparsable lines carry `error = 'invalid_json'`.
    """
    return parse_requests(file_lines(spark, input_dir, "*.jsonl"), expected_model)


def parse_requests(lines: DataFrame, expected_model: str | None) -> DataFrame:
    """P3 + P4 over lines given as (file, line_no, line); blank lines are skipped."""
    lines = lines.where(F.trim(F.col("line")) != "")
    v = F.try_parse_json(F.col("line"))
    base = lines.withColumn("_v", v).withColumn(
        "source", F.concat(F.element_at(F.split("file", "/"), -1), F.lit(":"),
                           F.col("line_no").cast("string")))

    def field(name: str) -> Column:
        return F.expr(f"try_variant_get(_v, '$.{name}', 'variant')")

    def kind(name: str) -> Column:
        t = _vtype(field(name))
        return F.when(t == "STRING", "string").when(t.startswith("ARRAY"), "array").otherwise(
            "other")

    def arr(name: str) -> Column:
        return F.expr(f"try_variant_get(_v, '$.{name}', 'array<variant>')")

    def arr_strings(name: str) -> Column:
        return F.forall(arr(name), lambda e: F.schema_of_variant(e) == "STRING")

    def arr_values(name: str) -> Column:
        return F.transform(arr(name), lambda e: F.when(
            F.schema_of_variant(e) == "STRING", e.cast("string")))

    def scalar(name: str, typ: str) -> Column:
        return F.expr(f"try_variant_get(_v, '$.{name}', '{typ}')")

    enc_t = _vtype(field("encoding_format"))
    dim_t = _vtype(field("dimensions"))
    user_t = _vtype(field("user"))
    norm = base.select(
        "file", "line_no", "source", "line",
        F.coalesce(_vtype(F.col("_v")).startswith("OBJECT"), F.lit(False)).alias("is_object"),
        F.array_except(F.coalesce(F.json_object_keys("line"), F.array().cast("array<string>")),
                       F.array(*[F.lit(f) for f in prepare.ALLOWED_FIELDS])).alias(
            "unknown_fields"),
        F.when(_vtype(field("model")) == "STRING", scalar("model", "string")).alias("model"),
        kind("input").alias("input_kind"),
        F.when(kind("input") == "string", scalar("input", "string")).alias("input_str"),
        F.when(kind("input") == "array", arr_values("input")).alias("input_arr"),
        F.when(kind("input") == "array", arr_strings("input")).alias("input_arr_strings"),
        kind("input_id").alias("input_id_kind"),
        F.when(kind("input_id") == "string", scalar("input_id", "string")).alias("input_id_str"),
        F.when(kind("input_id") == "array", arr_values("input_id")).alias("input_id_arr"),
        F.when(kind("input_id") == "array", arr_strings("input_id")).alias(
            "input_id_arr_strings"),
        # A present-but-null encoding is invalid; an absent one defaults to float.
        F.when(enc_t == "STRING", scalar("encoding_format", "string")).when(
            enc_t.isNotNull(), F.lit("")).alias("encoding_format"),
        F.lit(True).alias("encoding_is_string"),
        F.when(dim_t != "VOID", dim_t).alias("dimensions_type"),
        F.when(dim_t == "BIGINT", scalar("dimensions", "bigint")).alias("dimensions"),
        F.when(user_t != "VOID", user_t).alias("user_type"),
        F.when(user_t == "STRING", scalar("user", "string")).alias("user"),
        F.col("_v").isNull().alias("_bad_json"),
    )
    val = prepare.validate_requests(norm, expected_model)
    bad = F.col("_bad_json")
    return val.withColumns({
        "errors": F.when(bad, F.array(F.lit("invalid_json"))).otherwise(F.col("errors")),
        "error": F.when(bad, F.lit("invalid_json")).otherwise(F.col("error")),
        "accepted": F.when(bad, F.lit(False)).otherwise(F.col("accepted")),
        "input_ids": F.when(bad, F.lit(None)).otherwise(F.col("input_ids")),
        "texts": F.when(bad, F.lit(None)).otherwise(F.col("texts")),
    }).withColumn("input_count", F.size("texts")).drop("_bad_json")


def load_route(spark: SparkSession, path: str, label: str) -> dict[str, DataFrame]:
    """Embedding output JSONL → vectors (one row per returned item, with a
    global position for first-wins), error rows, batch sizes per record, and rejects
    (broken lines, and items without an id, with file and reason)."""
    schema = T.StructType([*OUTPUT_SCHEMA.fields, T.StructField("_broken", T.StringType())])
    raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_broken").json(path).withColumn(
        "_rec", F.monotonically_increasing_id()).withColumn("_file", F.col("_metadata.file_path"))
    files = raw.select("_file").distinct().count()
    if files != 1:
        raise ValueError(f"{label}: expected exactly one output file, found {files}")
    ok = raw.where(F.col("error").isNull() & F.col("_broken").isNull())
    items = ok.select("_file", "_rec", "model", F.posexplode("data").alias("_i", "d"))
    no_id = F.coalesce(F.col("d.input_id"), F.lit("")) == ""
    # Spark refuses a scan of the broken-line column alone, so the filter names another column.
    broken = F.col("_broken").isNotNull() & (F.coalesce(F.length("model"), F.lit(0)) >= 0)
    rejects = raw.where(broken).select(
        F.col("_file").alias("file"), F.lit("invalid_json").alias("reason"), "model", F.col("_broken").alias("record")).unionByName(
        items.where(no_id).select(F.col("_file").alias("file"), F.lit("missing_input_id").alias("reason"), "model",
                                  F.to_json("d").alias("record")))
    vectors = items.where(~no_id).select(
        F.col("d.input_id").alias("input_id"), F.col("d.index").alias("index"),
        F.col("d.embedding").alias("embedding"), "model",
        F.struct("_rec", "_i").alias("pos"))
    return {
        "vectors": vectors.withColumn("label", F.lit(label)),
        "rejects": rejects.withColumn("label", F.lit(label)),
        "errors": raw.where(F.col("error").isNotNull() & F.col("_broken").isNull()).select("input_ids", "error"),
        "batch_sizes": ok.select("_rec", F.size("data").alias("batch_size"),
                                 F.col("usage.prompt_tokens").alias("prompt_tokens")),
    }


def read_runs(spark: SparkSession, run_dirs: list[str]) -> tuple[DataFrame, DataFrame]:
    """S3: per run folder `summary.json` + `requests.jsonl`; runs whose log is
    empty fall back to the inline `summary.requests`."""
    summaries = spark.read.option("multiLine", True).json(
        [f"{d}/summary.json" for d in run_dirs]).withColumn(
        "run_id", F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/summary\\.json$", 1))
    logs = spark.read.schema(REQUEST_LOG_SCHEMA).json(
        [f"{d}/requests.jsonl" for d in run_dirs]).withColumn(
        "run_id", F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/requests\\.jsonl$", 1))
    if "requests" in summaries.columns:
        with_log = logs.select("run_id").distinct()
        inline = summaries.join(with_log, "run_id", "left_anti").select(
            "run_id", F.explode("requests").alias("r")).select("run_id", "r.*")
        cols = [c for c in logs.columns if c in inline.columns]
        logs = logs.unionByName(inline.select(*cols), allowMissingColumns=True)
    return summaries, logs


def read_spans(spark: SparkSession, path: str, root_name: str,
               request_name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Span log → (root spans, request spans: those named `request_name`, by default all others)."""
    spans = spark.read.json(path)
    name = F.col("name")
    return spans.where(name == root_name), spans.where(name == request_name if request_name else name != root_name)


def read_metric_reports(spark: SparkSession, path: str) -> DataFrame:
    """Metric reports (map of prefixed names) → long rows with the prefix stripped."""
    rep = spark.read.option("multiLine", True).json(path)
    m = rep.select(F.col("_metadata.file_name").alias("file"), "metric_prefix",
                   F.explode(F.from_json(F.to_json("metrics"), "map<string,double>")).alias(
                       "key", "value"))
    pref = F.concat(F.col("metric_prefix"), F.lit("."))
    return m.where(F.col("key").startswith(pref)).select(
        "file", "metric_prefix", F.expr("substring(key, length(metric_prefix) + 2)").alias("metric"),
        "value")


def read_cohort_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Only `*.csv` files, header row, declared schema (dates typed)."""
    return (spark.read.option("header", True).option("pathGlobFilter", "*.csv")
            .option("dateFormat", "yyyy-MM-dd").schema(schema).csv(path))


def read_corpus(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """Whole files as documents (name, text)."""
    return (spark.read.option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob).text(path, wholetext=True)
            .select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text")))


def read_eval_rows(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation rows JSONL with the declared evaluation schema; a broken line fails the job."""
    return spark.read.option("mode", "FAILFAST").schema("query STRING, ground_truth STRING, response STRING, "
                             "context STRING, latency DOUBLE, response_length INT").json(path)


def count_records(spark: SparkSession, path: str) -> int:
    """Non-empty records; an empty input is an error."""
    n = spark.read.text(path).where(F.trim("value") != "").count()
    if n == 0:
        raise ValueError(f"no records in {path}")
    return n


def failure_trace(spark: SparkSession, path: str, pattern: str, log_lines: int = 12,
                  txt_chars: int = 4000, files: int = 5) -> DataFrame:
    """Last `log_lines` matching lines of each `.log`, last `txt_chars`
    characters of each matching `.txt`, for the first `files` files by name."""
    logs = file_lines(spark, path, "*.log").where(F.col("line").rlike(pattern))
    w = Window.partitionBy("file").orderBy(F.col("line_no").desc())
    tail = logs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= log_lines).groupBy(
        "file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
            F.struct("line_no", "line"))), lambda x: x.line), "\n").alias("trace"))
    txt = (spark.read.option("recursiveFileLookup", True)
           .option("pathGlobFilter", "*.txt").text(path, wholetext=True)
           .select(F.col("_metadata.file_path").alias("file"), "value")
           .where(F.col("value").rlike(pattern))
           .select("file", F.expr(f"right(value, {txt_chars})").alias("trace")))
    # Text files come first, then logs, each by name.
    return (txt.withColumn("_kind", F.lit(0)).unionByName(tail.withColumn("_kind", F.lit(1)))
            .orderBy("_kind", "file").limit(files).drop("_kind"))
