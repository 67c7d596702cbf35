"""Request preparation: normalise, validate, unpack, dedupe, gate, fan out.

Validation is a scan-once quarantine: each request line gets the ordered list
of rule codes it breaks; accepted and rejected rows share one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.ordered import join_small

# Single-request shape limits and batch ceiling.
MAX_ARRAY_INPUTS = 2048
MAX_TOKENS_PER_INPUT = 8192
MAX_REQUEST_TOKENS = 300_000
MAX_BATCH_INPUTS = 50_000
ALLOWED_FIELDS = ("input_id", "input", "model", "dimensions", "encoding_format", "user")
ENCODINGS = ("float", "base64")
DEFAULT_ENCODING = "float"

# Rule codes, in the order the rules are checked.
RULES = (
    "not_object", "unknown_fields", "model_mismatch", "empty_input", "bad_input_id",
    "bad_input", "too_many_inputs", "non_string_input", "id_count_mismatch",
    "bad_input_ids", "duplicate_ids_in_row", "bad_encoding", "bad_dimensions", "bad_user",
)


def normalise_typed(df: DataFrame, id_col: str = "input_id", input_col: str = "input") -> DataFrame:
    """Typed scalar requests (one string id, one string text) → normalised columns."""
    return df.withColumns({
        "is_object": F.lit(True),
        "unknown_fields": F.array().cast("array<string>"),
        "input_kind": F.when(F.col(input_col).isNull(), "other").otherwise("string"),
        "input_str": F.col(input_col),
        "input_arr": F.lit(None).cast("array<string>"),
        "input_arr_strings": F.lit(None).cast("boolean"),
        "input_id_kind": F.when(F.col(id_col).isNull(), "other").otherwise("string"),
        "input_id_str": F.col(id_col),
        "input_id_arr": F.lit(None).cast("array<string>"),
        "input_id_arr_strings": F.lit(None).cast("boolean"),
        "encoding_is_string": F.lit(True),
        "dimensions_type": F.when(F.col("dimensions").isNotNull(), "BIGINT"),
        "user_type": F.when(F.col("user").isNotNull(), "STRING"),
    })


def _t(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def validate_requests(norm: DataFrame, expected_model: str | Column | None,
                      max_array_inputs: int = MAX_ARRAY_INPUTS) -> DataFrame:
    """Add `errors` (ordered rule codes), `error` (first), `accepted`,
    and the normalised parallel arrays `input_ids`, `texts`, `input_count`."""
    model_ok = F.lit(True) if expected_model is None else (
        F.col("model") == (expected_model if isinstance(expected_model, Column)
                           else F.lit(expected_model)))
    is_str = F.col("input_kind") == "string"
    is_arr = (F.col("input_kind") == "array") & (F.size("input_arr") > 0)
    ids_are_arr = F.col("input_id_kind") == "array"
    scalar_ids = F.array(F.col("input_id_str"))
    ids = F.when(is_str, scalar_ids).when(is_arr, F.col("input_id_arr"))
    arr_checks_ok = (~_t(F.size("input_arr") > max_array_inputs)
                     & _t(F.col("input_arr_strings"))
                     & _t(F.forall("input_arr", lambda x: F.length(x) > 0)))
    ids_len_ok = ids_are_arr & _t(F.size("input_id_arr") == F.size("input_arr"))
    conds = [
        ~_t(F.col("is_object")),
        _t(F.size("unknown_fields") > 0),
        ~_t(model_ok),
        is_str & _t(F.length("input_str") == 0),
        is_str & ~_t(F.length("input_str") == 0) & ~(
            (F.col("input_id_kind") == "string") & _t(F.length("input_id_str") > 0)),
        ~is_str & ~is_arr,
        is_arr & _t(F.size("input_arr") > max_array_inputs),
        is_arr & ~_t(F.size("input_arr") > max_array_inputs) & ~(
            _t(F.col("input_arr_strings")) & _t(F.forall("input_arr", lambda x: F.length(x) > 0))),
        is_arr & arr_checks_ok & ~ids_len_ok,
        is_arr & arr_checks_ok & ids_len_ok & ~(
            _t(F.col("input_id_arr_strings"))
            & _t(F.forall("input_id_arr", lambda x: F.length(x) > 0))),
        _t(F.size(F.array_distinct(ids)) != F.size(ids)),
        ~(F.col("encoding_format").isNull() | (
            _t(F.col("encoding_is_string")) & F.col("encoding_format").isin(*ENCODINGS))),
        F.col("dimensions_type").isNotNull() & ~(
            (F.col("dimensions_type") == "BIGINT") & _t(F.col("dimensions") > 0)),
        F.col("user_type").isNotNull() & (F.col("user_type") != "STRING"),
    ]
    codes = F.array(*[F.when(c, F.lit(code)) for c, code in zip(conds, RULES)])
    errors = F.filter(codes, lambda x: x.isNotNull())
    return norm.withColumns({
        "errors": errors,
    }).withColumns({
        "error": F.get(F.col("errors"), 0),
        "accepted": F.size("errors") == 0,
        "input_ids": F.when(F.size("errors") == 0, ids),
        "texts": F.when(F.size("errors") == 0, F.when(is_str, F.array(F.col("input_str")))
                        .otherwise(F.col("input_arr"))),
    }).withColumn("input_count", F.size("texts"))


def explode_inputs(requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per logical input (strict parallel zip of ids and texts)."""
    zipped = F.arrays_zip(F.col("input_ids").alias("input_id"), F.col("texts").alias("text"))
    return requests.select(*keep, F.posexplode(zipped).alias("input_pos", "_it")).select(
        *keep, "input_pos", F.col("_it.input_id").alias("input_id"),
        F.col("_it.text").alias("text"))


def settings_key(model: str = "model", dimensions: str = "dimensions",
                 encoding_format: str = "encoding_format", user: str = "user") -> Column:
    """Null-safe settings group key; encoding defaults to float."""
    return F.to_json(F.struct(
        F.col(model).alias("model"), F.col(dimensions).alias("dimensions"),
        F.coalesce(F.col(encoding_format), F.lit(DEFAULT_ENCODING)).alias("encoding_format"),
        F.col(user).alias("user")))


def duplicate_inputs(inputs: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """P5: every occurrence of an input_id after its first (in order) is an offender.

    First occurrences come from a partial aggregate (`min` of the order struct,
    map-side combined, skew-safe); offenders are found by a join back, which AQE
    splits when one id is hot.
    """
    order = F.struct(*[F.col(c) for c in order_cols])
    first = inputs.groupBy("input_id").agg(F.min(order).alias("_first"),
                                          F.count(F.lit(1)).alias("occurrences"))
    first = first.where(F.col("occurrences") > 1)
    dup = inputs.join(first, "input_id", "inner").where(order != F.col("_first"))
    return dup.drop("_first")


def input_ceiling(requests: DataFrame, ceiling: int = MAX_BATCH_INPUTS) -> DataFrame:
    """Batch-wide input total against the ceiling (one row)."""
    return requests.agg(F.coalesce(F.sum("input_count"), F.lit(0)).alias("total_inputs")).select(
        "total_inputs", F.lit(ceiling).alias("ceiling"),
        (F.col("total_inputs") > ceiling).alias("exceeds"))


def oversized_inputs(inputs: DataFrame, tokens_col: str, max_tokens: int) -> DataFrame:
    """P10: logical inputs whose own token count is above the request ceiling."""
    return inputs.where(F.col(tokens_col) > max_tokens)


def shape_violations(requests: DataFrame, tokens_col: str = "estimated_tokens",
                     per_input_tokens: Column | None = None) -> DataFrame:
    """Requests breaking the single-request shape limits, one row per rule hit."""
    checks = [
        ("max_inputs", F.col("input_count") > MAX_ARRAY_INPUTS, F.lit(MAX_ARRAY_INPUTS)),
        ("max_request_tokens", F.col(tokens_col) > MAX_REQUEST_TOKENS, F.lit(MAX_REQUEST_TOKENS)),
    ]
    if per_input_tokens is not None:
        checks.append(("max_input_tokens", per_input_tokens > MAX_TOKENS_PER_INPUT,
                       F.lit(MAX_TOKENS_PER_INPUT)))
    hits = F.array(*[F.when(c, F.struct(F.lit(n).alias("rule"), lim.cast("long").alias("limit")))
                     for n, c, lim in checks])
    return requests.withColumn("_hit", F.explode(F.filter(hits, lambda h: h.isNotNull()))).select(
        "*", F.col("_hit.rule").alias("rule"), F.col("_hit.limit").alias("limit")).drop("_hit")


def fan_out(lines: DataFrame, repetitions: int, model: str | None = None,
            id_col: str = "input_id") -> DataFrame:
    """Repeat each row N times (1..100); ids get `-repeat-%02d` only when N > 1.

    Works on a scalar string id column or an array-of-ids column.
    """
    if repetitions < 1 or repetitions > 100:
        raise ValueError("repetitions must be in 1..100")
    out = lines.withColumn("repeat_no", F.explode(F.sequence(F.lit(1), F.lit(repetitions))))
    if repetitions > 1:
        suffix = F.format_string("-repeat-%02d", F.col("repeat_no"))
        is_arr = dict(lines.dtypes)[id_col].startswith("array")
        new_id = (F.transform(F.col(id_col), lambda x: F.concat(x, suffix)) if is_arr
                  else F.concat(F.col(id_col), suffix))
        out = out.withColumn(id_col, new_id)
    if model is not None:
        out = out.withColumn("model", F.lit(model))
    return out


def reject_report(validated: DataFrame) -> DataFrame:
    """Rejected request count per first-failing rule."""
    return validated.where(~F.col("accepted")).groupBy("error").agg(
        F.count(F.lit(1)).alias("rejected"))


__all__ = ["normalise_typed", "validate_requests", "explode_inputs", "settings_key",
           "duplicate_inputs", "input_ceiling", "oversized_inputs", "shape_violations",
           "fan_out", "reject_report", "join_small"]


def first_over_ceiling(requests: DataFrame, order_cols: Sequence[str], ceiling: int = MAX_BATCH_INPUTS
                       ) -> DataFrame:
    """The request at which the running input total first exceeds the
    ceiling (empty when it never does). The running total is a distributed
    range scan over the request order, not a single-partition window."""
    from tessera.functions.ordered import running_sum_within
    r = requests.withColumn("_all", F.lit(0))
    cs = running_sum_within(r, ["_all"], list(order_cols), "input_count", "running_inputs")
    over = cs.where(F.col("running_inputs") > ceiling)
    first = over.agg(F.min(F.struct(*[F.col(c) for c in order_cols])).alias("_o"))
    return over.join(first, F.struct(*[F.col(c) for c in order_cols]) == F.col("_o")).drop(
        "_o", "_all")


TOKEN_CEILING = "token_ceiling"


def split_by_ceiling(items: DataFrame, max_tokens: int, token_col: str = "tokens") -> tuple[DataFrame, DataFrame]:
    """P10: items that fit a request, and a reject table (all columns and `reason`) of those that
    cannot be packed: more tokens than the ceiling, or an unknown number."""
    fits = F.coalesce(F.col(token_col) <= max_tokens, F.lit(False))
    return items.where(fits), items.where(~fits).withColumn("reason", F.lit(TOKEN_CEILING))
