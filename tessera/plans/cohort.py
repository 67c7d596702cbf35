"""Cohort queries (T*) over customers joined 1:1 with their open-order aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.ordered import exact_percentiles
from tessera.operators import cohort as T
from tessera.plans.registry import register
from tessera.sources.tables import table

NUMERIC = ("c_acctbal", "open_orders", "open_total", "open_max")
LOF_K = 5
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def open_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O")
    return o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("double").alias("open_orders"),
        F.sum("o_totalprice").alias("open_total"), F.max("o_totalprice").alias("open_max"))


def cohort_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    return T.full_outer_on(cust, open_orders(spark, sf_dir), "c_custkey", "o_custkey", "custkey")


def cohort_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    agg = open_orders(spark, sf_dir)
    return cust.join(agg, cust.c_custkey == agg.o_custkey, "inner").drop("o_custkey")


COHORT_CTE = """
oo AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS open_orders, sum(o_totalprice) AS open_total,
              max(o_totalprice) AS open_max
       FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey),
ci AS (SELECT c.*, oo.open_orders, oo.open_total, oo.open_max
       FROM customer c JOIN oo ON c.c_custkey = oo.o_custkey),
co AS (SELECT coalesce(c.c_custkey, oo.o_custkey) AS custkey, c.c_name, c.c_nationkey, c.c_acctbal,
              c.c_mktsegment, oo.open_orders, oo.open_total, oo.open_max
       FROM customer c FULL OUTER JOIN oo ON c.c_custkey = oo.o_custkey)"""

T1_SQL = "WITH " + COHORT_CTE + """
SELECT c_custkey, c_mktsegment, c_nationkey, c_acctbal, CAST(open_orders AS BIGINT) AS open_orders,
       round_even(open_total, 4) AS open_total, open_max FROM ci"""


@register("t1_cohort_join", T1_SQL)
def t1_cohort_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner 1:1 join of customers and their open-order aggregate."""
    c = cohort_inner(spark, sf_dir)
    return c.select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal",
                    F.col("open_orders").cast("long").alias("open_orders"),
                    F.bround("open_total", 4).alias("open_total"), "open_max")


T2_SQL = "WITH " + COHORT_CTE + """
SELECT CASE WHEN c_name IS NULL THEN 'orders_only' WHEN open_orders IS NULL THEN 'customer_only'
            ELSE 'both' END AS side, CAST(count(*) AS BIGINT) AS rows
FROM co GROUP BY ALL"""


@register("t2_full_outer", T2_SQL)
def t2_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full outer join (all data kept) with a coalesced key; rows per side."""
    co = cohort_outer(spark, sf_dir)
    side = (F.when(F.col("c_name").isNull(), "orders_only")
            .when(F.col("open_orders").isNull(), "customer_only").otherwise("both"))
    return co.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("rows"))


T3_SQL = "WITH " + COHORT_CTE + """,
aff AS (SELECT count(*) FILTER (WHERE c_acctbal IS NULL OR open_orders IS NULL OR open_total IS NULL
               OR open_max IS NULL OR c_mktsegment IS NULL) / count(*) AS r FROM co),
med AS (
  SELECT 'c_acctbal' AS feature, quantile_cont(c_acctbal, 0.5) AS fill FROM co
  UNION ALL SELECT 'open_orders', quantile_cont(open_orders, 0.5) FROM co
  UNION ALL SELECT 'open_total', quantile_cont(open_total, 0.5) FROM co
  UNION ALL SELECT 'open_max', quantile_cont(open_max, 0.5) FROM co
)
SELECT feature, round_even(fill, 6) AS fill_value, round_even((SELECT r FROM aff), 6) AS affected_ratio,
       (SELECT c_mktsegment FROM co WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
        ORDER BY count(*) DESC, c_mktsegment LIMIT 1) AS segment_mode
FROM med"""


@register("t3_imputation", T3_SQL)
def t3_imputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median / mode fill values for the outer-joined cohort and the affected share."""
    co = cohort_outer(spark, sf_dir)
    _, fills = T.impute(co, NUMERIC, ["c_mktsegment"])
    rows = [(f, float(fills[f]) if fills[f] is not None else None) for f in NUMERIC]
    df = spark.createDataFrame(rows, "feature string, fill_value double")
    return df.select("feature", F.bround("fill_value", 6).alias("fill_value"),
                     F.bround(F.lit(float(fills["_affected_ratio"])), 6).alias("affected_ratio"),
                     F.lit(fills["c_mktsegment"]).alias("segment_mode"))


def _z_sql(cols) -> str:
    return ", ".join(f"(x.{c} - s.m_{c}) / s.s_{c} AS {c}_z" for c in cols)


Z_CTE = COHORT_CTE + f""",
s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in NUMERIC)} FROM ci),
z AS (SELECT x.c_custkey, {_z_sql(NUMERIC)} FROM ci x, s)"""

T4_SQL = "WITH " + Z_CTE + "\nSELECT c_custkey, " + ", ".join(
    f"round_even({c}_z, 6) AS {c}_z" for c in NUMERIC) + " FROM z"


def zscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.zscores(cohort_inner(spark, sf_dir), NUMERIC)


@register("t4_zscores", T4_SQL)
def t4_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = zscored(spark, sf_dir)
    return z.select("c_custkey", *[F.bround(f"{c}_z", 6).alias(f"{c}_z") for c in NUMERIC])


LOF_CTE = Z_CTE + f""",
pts AS (SELECT c_custkey AS id, c_acctbal_z AS x, open_total_z AS y FROM z),
d AS (SELECT a.id AS p, b.id AS o, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d
      FROM pts a, pts b WHERE a.id <> b.id),
kd AS (SELECT p, d AS kdist FROM (
         SELECT p, d, row_number() OVER (PARTITION BY p ORDER BY d, o) AS rn FROM d) WHERE rn = {LOF_K}),
nb AS (SELECT d.p, d.o, d.d FROM d JOIN kd USING (p) WHERE d.d <= kd.kdist),
rd AS (SELECT nb.p, greatest(k2.kdist, nb.d) AS reach FROM nb JOIN kd k2 ON k2.p = nb.o),
lrd AS (SELECT p, CASE WHEN avg(reach) > 0 THEN 1 / avg(reach) END AS lrd FROM rd GROUP BY p),
lof AS (SELECT nb.p AS id, avg(l2.lrd) / l1.lrd AS lof FROM nb JOIN lrd l2 ON l2.p = nb.o
        JOIN lrd l1 ON l1.p = nb.p GROUP BY nb.p, l1.lrd)"""

T5_SQL = "WITH " + LOF_CTE + f"""
SELECT lof.id AS c_custkey, round_even(lof, 6) AS lof, round_even(kd.kdist, 6) AS kdist,
       coalesce(lof > {T.OUTLIER_LOF}, false) AS outlier
FROM lof JOIN kd ON kd.p = lof.id"""


def lof_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = zscored(spark, sf_dir)
    return T.local_outlier_factor(z.select("c_custkey", "c_acctbal_z", "open_total_z"),
                                  "c_custkey", ["c_acctbal_z", "open_total_z"], LOF_K)


@register("t5_local_outlier_factor", T5_SQL)
def t5_local_outlier_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOF (MinPts 5) on z-scored balance and open-order total; exact kNN via grid cells."""
    lof = lof_scores(spark, sf_dir)
    return lof.select("c_custkey", F.bround("lof", 6).alias("lof"),
                      F.bround("kdist", 6).alias("kdist"), "outlier")


T6_SQL = "WITH " + COHORT_CTE + """,
l AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM ci" for c in NUMERIC) + """),
st AS (SELECT feature, count(DISTINCT v) AS distinct_values, min(v) AS lo, max(v) AS hi
       FROM l GROUP BY feature),
sv AS (SELECT feature, distinct_values,
              var_pop(CASE WHEN hi > lo THEN (v - lo) / (hi - lo) ELSE 0.0 END) AS scaled_variance
       FROM l JOIN st USING (feature) WHERE distinct_values > 2 GROUP BY feature, distinct_values)
SELECT feature, CAST(distinct_values AS BIGINT) AS distinct_values,
       round_even(scaled_variance, 9) AS scaled_variance,
       CAST(row_number() OVER (ORDER BY scaled_variance DESC, feature) AS INTEGER) AS rank,
       row_number() OVER (ORDER BY scaled_variance DESC, feature) <= 2 AS selected
FROM sv"""


@register("t6_feature_ranking", T6_SQL)
def t6_feature_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two most discriminative continuous features (min-max scaled variance)."""
    r = T.rank_features(cohort_inner(spark, sf_dir), NUMERIC)
    return r.select("feature", "distinct_values", F.bround("scaled_variance", 9).alias(
        "scaled_variance"), F.col("rank").cast("int").alias("rank"), "selected")


T8_SQL = "WITH " + LOF_CTE + f"""
SELECT ci.c_custkey, ci.c_name, ci.c_mktsegment, n.n_name,
       list_filter([CASE WHEN ci.c_acctbal < 0 THEN 'negative_balance' END,
                    CASE WHEN ci.open_orders >= 10 THEN 'many_open_orders' END],
                   lambda x: x IS NOT NULL) AS risk_factors,
       round_even(lof.lof, 6) AS lof
FROM lof JOIN ci ON ci.c_custkey = lof.id JOIN nation n ON n.n_nationkey = ci.c_nationkey
WHERE lof.lof > {T.OUTLIER_LOF}"""


@register("t8_outlier_profiles", T8_SQL)
def t8_outlier_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of the LOF outliers: segment, nation, positive risk factors, score."""
    lof = lof_scores(spark, sf_dir).where("outlier")
    ci = cohort_inner(spark, sf_dir)
    nation = table(spark, sf_dir, "nation")
    j = lof.join(ci, "c_custkey").join(F.broadcast(nation), F.col("c_nationkey") == F.col(
        "n_nationkey"))
    flags = F.filter(F.array(F.when(F.col("c_acctbal") < 0, F.lit("negative_balance")),
                             F.when(F.col("open_orders") >= 10, F.lit("many_open_orders"))),
                     lambda x: x.isNotNull())
    return j.select("c_custkey", "c_name", "c_mktsegment", "n_name", flags.alias("risk_factors"),
                    F.bround("lof", 6).alias("lof"))


T9_SQL = "WITH " + Z_CTE + """,
l AS (""" + " UNION ALL ".join(
    f"SELECT c_custkey, '{c}_z' AS feature, {c}_z AS z FROM z" for c in NUMERIC) + """)
SELECT c_custkey, CAST(rank AS INTEGER) AS rank, feature, round_even(z, 6) AS z FROM (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(z) DESC, feature) AS rank FROM l
) WHERE rank <= 2"""


@register("t9_top_deviations", T9_SQL)
def t9_top_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two most deviating features (|z|) of every customer."""
    z = zscored(spark, sf_dir)
    d = T.top_deviations(z, "c_custkey", [f"{c}_z" for c in NUMERIC], 2)
    return d.select("c_custkey", F.col("rank").cast("int").alias("rank"), "feature",
                    F.bround("z", 6).alias("z"))


T10_SQL = "WITH " + COHORT_CTE + """
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS customers, round_even(avg(c_acctbal), 6) AS mean_acctbal,
       round_even(quantile_cont(open_total, 0.5), 6) AS median_open_total,
       CAST(max(open_orders) AS BIGINT) AS max_open_orders
FROM ci GROUP BY c_mktsegment"""


@register("t10_group_distributions", T10_SQL)
def t10_group_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution per segment: count, mean balance, exact median open total."""
    ci = cohort_inner(spark, sf_dir)
    base = ci.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.bround(F.avg("c_acctbal"), 6).alias("mean_acctbal"),
        F.max("open_orders").cast("long").alias("max_open_orders"))
    med = exact_percentiles(ci, ["c_mktsegment"], "open_total", {"median_open_total": 50})
    return base.join(med, "c_mktsegment").select(
        "c_mktsegment", "customers", "mean_acctbal",
        F.bround("median_open_total", 6).alias("median_open_total"), "max_open_orders")


T13_SQL = "WITH " + COHORT_CTE + f""",
chk AS (
  SELECT co.*, n.n_nationkey IS NOT NULL AS nation_ok FROM co
  LEFT JOIN nation n ON n.n_nationkey = co.c_nationkey
)
SELECT rule, CAST(violations AS BIGINT) AS violations FROM (
  SELECT
    count(*) FILTER (WHERE NOT coalesce(c_acctbal BETWEEN -999.99 AND 9999.99, false)) AS acctbal_range,
    count(*) FILTER (WHERE NOT coalesce(c_mktsegment IN ({', '.join(repr(s) for s in SEGMENTS)}), false))
      AS segment_domain,
    count(*) FILTER (WHERE NOT nation_ok) AS nation_exists,
    count(*) FILTER (WHERE NOT coalesce(open_orders >= 1, false)) AS has_open_orders
  FROM chk
) UNPIVOT (violations FOR rule IN (acctbal_range, segment_domain, nation_exists, has_open_orders))"""


@register("t13_domain_checks", T13_SQL)
def t13_domain_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule table over the outer-joined cohort: violations per rule."""
    co = cohort_outer(spark, sf_dir)
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey"), F.lit(True).alias("_nk"))
    chk = co.join(F.broadcast(nation), co.c_nationkey == nation.n_nationkey, "left")
    rules = [
        ("acctbal_range", F.col("c_acctbal").between(-999.99, 9999.99)),
        ("segment_domain", F.col("c_mktsegment").isin(*SEGMENTS)),
        ("nation_exists", F.col("_nk").isNotNull()),
        ("has_open_orders", F.col("open_orders") >= 1),
    ]
    return T.domain_violations(chk, rules)


_JITTER = ("((CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8)) AS BIGINT) % 1000)"
           " / 1000.0 - 0.5) * 0.01")
T7_SQL = "WITH " + Z_CTE + f"""
SELECT z.c_custkey, round_even(z.c_acctbal_z + {_JITTER}, 6) AS x,
       round_even(z.open_total_z + {_JITTER}, 6) AS y,
       ci.open_orders >= 5 AS in_cohort, ci.c_acctbal < 0 AS is_target
FROM z JOIN ci USING (c_custkey)"""


@register("t7_scatter_table", T7_SQL)
def t7_scatter_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scatter rows: z-scored balance vs open total with an id-seeded jitter."""
    z = zscored(spark, sf_dir)
    s = T.scatter_table(z, "c_custkey", "c_acctbal_z", "open_total_z",
                        F.col("open_orders") >= 5, F.col("c_acctbal") < 0)
    return s.select("c_custkey", F.bround("x", 6).alias("x"), F.bround("y", 6).alias("y"),
                    "in_cohort", "is_target")


T11_SQL = "WITH " + COHORT_CTE + """,
top2 AS (SELECT c_custkey, row_number() OVER (ORDER BY open_total DESC, c_custkey) AS side FROM ci),
t AS (SELECT ci.*, side FROM ci JOIN top2 USING (c_custkey) WHERE side <= 2),
l AS (
  SELECT side, 'c_mktsegment' AS feature, c_mktsegment AS value FROM t
  UNION ALL SELECT side, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM t
  UNION ALL SELECT side, 'open_orders', CAST(CAST(open_orders AS BIGINT) AS VARCHAR) FROM t
)
SELECT feature, max(CASE WHEN side = 1 THEN value END) AS left_value,
       max(CASE WHEN side = 2 THEN value END) AS right_value
FROM l GROUP BY feature"""


@register("t11_side_by_side", T11_SQL)
def t11_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two customers with the largest open-order totals, feature by feature."""
    ci = cohort_inner(spark, sf_dir).withColumn("open_orders", F.col("open_orders").cast("long"))
    ids = [r[0] for r in ci.orderBy(F.col("open_total").desc(), "c_custkey").limit(2)
           .select("c_custkey").collect()]
    return T.side_by_side(ci, "c_custkey", ids, ["c_mktsegment", "c_nationkey", "open_orders"])


def _distribution_sql(group: str, measure: str, source: str) -> str:
    cols = [f"avg({measure}) AS mean", f"min({measure}) AS least", f"max({measure}) AS greatest"]
    cols += [f"quantile_cont({measure}, {p / 100}) AS p{p}" for p in (25, 50, 75)]
    return (f"SELECT {group}, count(*) AS rows, count({measure}) AS known, "
            + ", ".join(f"round_even({c.replace(' AS ', ', 4) AS ')}" for c in cols) + f" FROM {source} GROUP BY {group}")


def _distribution(df: DataFrame, group: str, measure: str) -> DataFrame:
    out = T.group_distribution(df, [group], measure)
    return out.select(group, "rows", "known", *[F.bround(c, 4).alias(c) for c in ("mean", "least", "greatest", "p25", "p50", "p75")])


@register("t10_price_by_priority", _distribution_sql("o_orderpriority", "o_totalprice", "orders"))
def t10_price_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution of the price over all orders by priority."""
    return _distribution(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")


@register("t10_balance_by_nation", _distribution_sql("c_nationkey", "c_acctbal", "customer"))
def t10_balance_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution of the balance over all customers by nation."""
    return _distribution(table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal")


T10_COUNTS_SQL = """
SELECT o_orderpriority, o_orderstatus, count(*) AS rows,
       round_even(count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 6) AS share
FROM orders GROUP BY o_orderpriority, o_orderstatus"""


@register("t10_status_by_priority", T10_COUNTS_SQL)
def t10_status_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each status occurs in each priority, over all orders."""
    out = T.category_counts(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")
    return out.withColumn("share", F.bround("share", 6))
