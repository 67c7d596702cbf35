"""Embedding-set comparison (J*): load routes, validate, join on id (never by
position), cosine / abs-diff / L2 gates, distinct vectors per source text.

Vector math is JVM-side higher-order functions (`aggregate`, `zip_with`), kept
inside whole-stage codegen; only ids and scalars are shuffled after the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default gates and sample size.
DEFAULT_COSINE_MIN = 0.999999
DEFAULT_MAX_ABS_DIFF = 1e-6
DEFAULT_GROUP_SEPARATOR = "-repeat-"
SAMPLE_LIMIT = 5
UNIT_NORM_TOLERANCE = 1.2e-7


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    """Dot / (|a| |b|); null when a norm is zero (reported as an issue)."""
    den = norm(a) * norm(b)
    return F.when(den != 0, dot(a, b) / den)


def max_abs_diff(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def all_finite(a: Column) -> Column:
    return F.forall(a, lambda x: ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))


def first_vectors(route: DataFrame, id_col: str = "input_id", pos_col: str = "pos") -> DataFrame:
    """First vector per id wins (partial aggregate, skew-safe); `occurrences`."""
    return route.groupBy(id_col).agg(
        F.min_by(F.struct("embedding", "model"), F.col(pos_col)).alias("_first"),
        F.count(F.lit(1)).alias("occurrences"),
        F.min(pos_col).alias(pos_col),
    ).select(id_col, pos_col, F.col("_first.embedding").alias("embedding"),
             F.col("_first.model").alias("model"), "occurrences")


def route_summary(route: DataFrame, label: str, expected_dim: int | None = None,
                  id_col: str = "input_id") -> DataFrame:
    """One row of validation facts per route; duplicate_ids counts the extra occurrences."""
    firsts = first_vectors(route, id_col)
    return firsts.agg(
        F.count(F.lit(1)).alias("vectors"),
        F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).cast("bigint").alias("duplicate_ids"),
        F.sort_array(F.collect_set(F.size("embedding"))).alias("dimensions"),
        F.sort_array(F.collect_set("model")).alias("models"),
        F.count_if(~all_finite(F.col("embedding"))).alias("nonfinite"),
        F.count_if(norm(F.col("embedding")) == 0).alias("zero_magnitude"),
    ).select(F.lit(label).alias("label"), "*").withColumn(
        "dimension_ok", (F.size("dimensions") == 1) & (
            F.lit(True) if expected_dim is None else (F.col("dimensions")[0] == expected_dim)))


def compare_pairs(base: DataFrame, cand: DataFrame, cosine_min: float = DEFAULT_COSINE_MIN,
                  max_abs: float = DEFAULT_MAX_ABS_DIFF, id_col: str = "input_id") -> DataFrame:
    """Equi-join on id, per-pair metrics and gate flags."""
    b = base.select(id_col, F.col("embedding").alias("_a"))
    c = cand.select(id_col, F.col("embedding").alias("_b"))
    j = b.join(c, id_col, "inner")
    same_len = F.size("_a") == F.size("_b")
    out = j.select(
        id_col,
        same_len.alias("same_length"),
        (same_len & (F.col("_a") == F.col("_b")) & ~F.exists("_a", lambda x: F.isnan(x))).alias(
            "identical"),
        F.when(same_len, cosine(F.col("_a"), F.col("_b"))).alias("cosine"),
        F.when(same_len, max_abs_diff(F.col("_a"), F.col("_b"))).alias("max_abs_diff"),
        F.when(same_len, l2_distance(F.col("_a"), F.col("_b"))).alias("l2_distance"),
    )
    return out.withColumn("below_cosine_min", F.col("same_length") & (F.col("cosine") < cosine_min)
                          ).withColumn("above_abs_tolerance",
                                       ~F.col("same_length") | (F.col("max_abs_diff") > max_abs))


def one_sided(base: DataFrame, cand: DataFrame, id_col: str = "input_id") -> DataFrame:
    """Ids present on only one side, both directions."""
    b = base.select(id_col).distinct()
    c = cand.select(id_col).distinct()
    return b.join(c, id_col, "left_anti").withColumn("side", F.lit("only_baseline")).unionByName(
        c.join(b, id_col, "left_anti").withColumn("side", F.lit("only_candidate")))


def comparison(pairs: DataFrame) -> DataFrame:
    """One aggregate row; metric columns null when no cosine was computed."""
    has = F.count("cosine") > 0
    return pairs.agg(
        F.count(F.lit(1)).alias("common"),
        F.count_if("identical").alias("identical"),
        F.min("cosine").alias("cosine_min"),
        F.avg("cosine").alias("cosine_mean"),
        F.when(has, F.max("max_abs_diff")).alias("max_abs_diff"),
        F.when(has, F.max("l2_distance")).alias("max_l2_distance"),
        F.count_if("below_cosine_min").alias("below_cosine_min"),
        F.count_if("above_abs_tolerance").alias("above_abs_tolerance"),
    )


def group_base(id_col: Column, separator: str = DEFAULT_GROUP_SEPARATOR) -> Column:
    """Source-text key: the id up to the last separator (whole id without one)."""
    import re
    sep = re.escape(separator)
    return F.regexp_replace(id_col, f"{sep}(?!.*{sep}).*$", "")


def distinct_vectors_by_group(route: DataFrame, separator: str = DEFAULT_GROUP_SEPARATOR,
                              id_col: str = "input_id") -> DataFrame:
    """Distinct vectors per source text (first vector per id)."""
    firsts = first_vectors(route, id_col)
    return firsts.groupBy(group_base(F.col(id_col), separator).alias("base")).agg(
        F.count_distinct("embedding").alias("distinct_vectors"))


def clusters_by_group(route: DataFrame, separator: str = DEFAULT_GROUP_SEPARATOR,
                      id_col: str = "input_id") -> DataFrame:
    """Clusters of equal vectors per source text, sizes sorted descending.

    Two partial aggregates; the size list per text is bounded by the number of
    distinct vectors of that text.
    """
    firsts = first_vectors(route, id_col)
    sizes = firsts.groupBy(group_base(F.col(id_col), separator).alias("base"), "embedding").agg(
        F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("base").agg(
        F.count(F.lit(1)).alias("clusters"),
        F.reverse(F.sort_array(F.collect_list("size"))).alias("sizes"))


def unit_norm_check(route: DataFrame, key: str, tolerance: float = UNIT_NORM_TOLERANCE) -> DataFrame:
    """Worst |norm - 1| and vectors outside the tolerance, per key."""
    dev = F.abs(norm(F.col("embedding")) - 1)
    return route.groupBy(key).agg(F.max(dev).alias("max_norm_deviation"),
                                  F.count_if(dev > tolerance).alias("outside_tolerance"))


def samples(df: DataFrame, id_col: str, n: int = SAMPLE_LIMIT) -> DataFrame:
    """The first n ids by id (distributed top-n, never a full collect)."""
    return df.select(id_col).orderBy(id_col).limit(n)


def positional_pairs(left: DataFrame, right: DataFrame, key_cols: list[str]) -> DataFrame:
    """Pair vectors by (request, index); min cosine and max abs diff per request."""
    a = left.select(*key_cols, F.col("embedding").alias("_a"))
    b = right.select(*key_cols, F.col("embedding").alias("_b"))
    j = a.join(b, key_cols, "inner")
    return j.select(*key_cols, cosine(F.col("_a"), F.col("_b")).alias("cos"),
                    max_abs_diff(F.col("_a"), F.col("_b")).alias("mad"))


def gate_issues(base_summary: DataFrame, cand_summary: DataFrame, comp: DataFrame,
                sided: DataFrame, require_identical: bool = False, errors: DataFrame | None = None) -> DataFrame:
    """Issue rows in a fixed order (`ord`); the comparison passes when there are none.
    `errors` holds a row with its route's `label` for every failed record. A route without
    vectors reports that alone."""
    s = base_summary.unionByName(cand_summary)
    route_issues = s.select(F.col("label"), F.explode(F.array(
        F.when(F.col("vectors") == 0, F.struct(F.lit(1).alias("ord"), F.lit("no vectors").alias(
            "issue"), F.lit(1).cast("long").alias("count"))),
        F.when(F.col("duplicate_ids") > 0, F.struct(F.lit(2).alias("ord"), F.lit("duplicate input_id").alias("issue"), (F.col("duplicate_ids").cast("long").alias("count")))),
        F.when((F.col("vectors") > 0) & ~F.col("dimension_ok"), F.struct(F.lit(3).alias("ord"), F.lit("dimension mismatch").alias("issue"), (F.size("dimensions").cast("long").alias("count")))),
        F.when(F.size("models") > 1, F.struct(F.lit(4).alias("ord"), F.lit("mixed models").alias("issue"), (F.size("models").cast("long").alias("count")))),
        F.when(F.col("nonfinite") > 0, F.struct(F.lit(5).alias("ord"), F.lit("non-finite values").alias("issue"), (F.col("nonfinite").cast("long").alias("count")))),
        F.when(F.col("zero_magnitude") > 0, F.struct(F.lit(5).alias("ord"), F.lit("zero-magnitude vectors").alias("issue"), (F.col("zero_magnitude").cast("long").alias("count")))),
    )).alias("i")).where(F.col("i").isNotNull()).select(
        "label", F.col("i.ord").alias("ord"), F.col("i.issue").alias("issue"),
        F.col("i.count").alias("count"))
    sided_n = sided.agg(F.count(F.lit(1)).alias("n"))
    set_issue = sided_n.where(F.col("n") > 0).select(
        F.lit("both").alias("label"), F.lit(6).alias("ord"), F.lit("input_id sets differ").alias(
            "issue"), F.col("n").cast("long").alias("count"))
    def issue(o, text, count):
        return F.struct(F.lit(o).alias("ord"), F.lit(text).alias("issue"),
                        count.cast("long").alias("count"))

    comp_rows = comp.select(F.explode(F.array(
        F.when(F.col("common") == 0, issue(7, "no shared input_id values", F.lit(1))),
        F.when((F.col("common") > 0) & (F.col("below_cosine_min") > 0),
               issue(8, "below cosine min", F.col("below_cosine_min"))),
        F.when((F.col("common") > 0) & (F.col("above_abs_tolerance") > 0),
               issue(9, "above max abs diff", F.col("above_abs_tolerance"))),
        F.when(F.lit(require_identical) & (F.col("common") > 0)
               & (F.col("identical") != F.col("common")),
               issue(10, "not bit-identical", F.col("common") - F.col("identical"))),
    )).alias("i")).where(F.col("i").isNotNull()).select(
        F.lit("both").alias("label"), F.col("i.ord").alias("ord"), F.col("i.issue").alias("issue"),
        F.col("i.count").alias("count"))
    if errors is not None:
        route_issues = errors.groupBy("label").agg(F.count(F.lit(1)).alias("count")).select(
            "label", F.lit(0).alias("ord"), F.lit("error records").alias("issue"), "count").unionByName(route_issues)
    return route_issues.unionByName(set_issue).unionByName(comp_rows)


def route_facts(routes: DataFrame, errors: DataFrame | None = None, label: str = "label",
                id_col: str = "input_id", pos_col: str = "pos") -> DataFrame:
    """J2 for any number of routes (`label`), failed records included: a row a route. The first vector
    of an id counts; only its length, model and checks are shuffled, never the vector. A route that has
    failed records alone shows no vectors."""
    v = F.col("embedding")
    checks = F.struct(F.size(v).alias("dim"), F.col("model").alias("model"), F.coalesce(all_finite(v), F.lit(False)).alias("finite"),
                      F.coalesce(norm(v) == 0, F.lit(False)).alias("zero"))
    firsts = routes.where(v.isNotNull()).select(label, id_col, pos_col, checks.alias("_c")).groupBy(label, id_col).agg(
        F.min_by("_c", pos_col).alias("_c"), F.count(F.lit(1)).alias("_n"))
    facts = firsts.groupBy(label).agg(
        F.count(F.lit(1)).alias("vectors"), F.sum(F.col("_n") - 1).cast("long").alias("duplicate_ids"),
        F.sort_array(F.collect_set("_c.dim")).alias("dimensions"), F.sort_array(F.collect_set("_c.model")).alias("models"),
        F.count_if(~F.col("_c.finite")).alias("nonfinite"), F.count_if(F.col("_c.zero")).alias("zero_magnitude"))
    if errors is None:
        return facts.withColumn("error_records", F.lit(0).cast("long"))
    failed = errors.groupBy(label).agg(F.count(F.lit(1)).alias("error_records"))
    zero = F.lit(0).cast("long")
    return facts.join(failed, label, "full_outer").select(
        label, *[F.coalesce(c, zero).alias(c) for c in ("vectors", "duplicate_ids")],
        F.coalesce("dimensions", F.array().cast("array<int>")).alias("dimensions"),
        F.coalesce("models", F.array().cast("array<string>")).alias("models"),
        *[F.coalesce(c, zero).alias(c) for c in ("nonfinite", "zero_magnitude", "error_records")])


def route_issues(facts: DataFrame, expected_dim: int | None = None, label: str = "label") -> DataFrame:
    """The issues of each route in report order (`ord`): none at all, or no vectors alone, or
    repeated ids, failed records, mixed dimensions or else an unexpected one, mixed models,
    non-finite and zero vectors."""
    dims = F.size("dimensions")
    wrong = F.lit(False) if expected_dim is None else (dims == 1) & (F.get("dimensions", F.lit(0)) != expected_dim)
    rules = (("duplicate input_id", F.col("duplicate_ids") > 0, F.col("duplicate_ids")),
             ("error records", F.col("error_records") > 0, F.col("error_records")),
             ("mixed dimensions", dims > 1, dims), ("unexpected dimension", wrong, F.get("dimensions", F.lit(0))),
             ("mixed models", F.size("models") > 1, F.size("models")),
             ("non-finite values", F.col("nonfinite") > 0, F.col("nonfinite")),
             ("zero-magnitude vectors", F.col("zero_magnitude") > 0, F.col("zero_magnitude")))

    def row(i, text, count):
        return F.struct(F.lit(i).alias("ord"), F.lit(text).alias("issue"), count.cast("long").alias("count"))
    found = F.array(*[F.when(c, row(i, t, n)) for i, (t, c, n) in enumerate(rules, 1)])
    none = F.array(row(0, "no vectors", F.lit(0)))
    return facts.select(label, F.explode(F.when(F.col("vectors") == 0, none).otherwise(
        F.filter(found, lambda x: x.isNotNull()))).alias("i")).select(label, "i.*")
