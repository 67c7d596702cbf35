"""Cohort analytics (T*): joins, imputation, normalisation, Local Outlier Factor,
feature ranking, deviations, group distributions, domain checks.

Column statistics are single aggregates whose few scalars are applied as
literals (no cross join). LOF neighbours come from density-adaptive grid cells
(see `lof_adaptive`): the result is the exact kNN without pairing dense regions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ordered import exact_percentiles, join_small
from tessera.session import ensure_checkpoint_dir

OUTLIER_LOF = 1.5


def full_outer_on(left: DataFrame, right: DataFrame, lkey: str, rkey: str, key: str) -> DataFrame:
    """Full outer join with one coalesced key column."""
    j = left.join(right, left[lkey] == right[rkey], "full_outer")
    return j.withColumn(key, F.coalesce(left[lkey], right[rkey])).drop(lkey, rkey)


def impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
           max_drop_ratio: float = 0.05) -> tuple[DataFrame, dict]:
    """Numeric → median (exact, interpolated), categorical → mode (ties: the
    smallest value). Returns the imputed frame and the fill values. When fewer
    than `max_drop_ratio` of rows are affected the caller may drop them instead;
    the ratio is reported under `_affected_ratio`."""
    total = df.count()
    any_null = None
    for c in [*numeric, *categorical]:
        cond = F.col(c).isNull()
        any_null = cond if any_null is None else (any_null | cond)
    affected = df.where(any_null).count() if any_null is not None else 0
    fills: dict = {}
    if numeric:
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in numeric
        ])).alias("s")).select("s.name", "s.v")
        med = exact_percentiles(long, ["name"], "v", {"median": 50}).collect()
        fills.update({r["name"]: r["median"] for r in med})
    for c in categorical:
        top = df.where(F.col(c).isNotNull()).groupBy(c).count().orderBy(
            F.col("count").desc(), F.col(c)).first()
        fills[c] = top[0] if top else None
    out = df
    for c in [*numeric, *categorical]:
        if fills.get(c) is not None:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(fills[c]).cast(
                dict(df.dtypes)[c])))
    fills["_affected_ratio"] = affected / total if total else 0.0
    return out, fills


def zscores(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """T4: z-score every numeric column from one aggregate (population stddev)."""
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                   *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    out = df
    for c in cols:
        m, s = stats[f"m_{c}"], stats[f"s_{c}"]
        z = (F.col(c) - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
        out = out.withColumn(c + suffix, z)
    return out


def local_outlier_factor(points: DataFrame, id_col: str, coords: Sequence[str], k: int = 5
                         ) -> DataFrame:
    """T5: LOF (Breunig et al. 2000) with MinPts = k; see `lof_adaptive`."""
    return lof_adaptive(points, id_col, coords, k)


def rank_features(df: DataFrame, cols: Sequence[str], top: int = 2) -> DataFrame:
    """Continuous features (> 2 distinct values) ranked by the variance of
    their min-max scaled values; the first `top` are flagged."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("s")).select("s.feature", "s.v")
    st = long.groupBy("feature").agg(F.count_distinct("v").alias("distinct_values"),
                                     F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    scaled = long.join(F.broadcast(st), "feature").where(F.col("distinct_values") > 2).withColumn(
        "_s", F.when(F.col("_hi") > F.col("_lo"),
                     (F.col("v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(0.0))
    var = scaled.groupBy("feature", "distinct_values").agg(F.var_pop("_s").alias("scaled_variance"))
    w = Window.orderBy(F.col("scaled_variance").desc(), F.col("feature"))
    # One row per feature: the ordering window is over the (tiny) feature list.
    return var.withColumn("rank", F.row_number().over(w)).withColumn(
        "selected", F.col("rank") <= top)


def top_deviations(df: DataFrame, id_col: str, zcols: Sequence[str], top: int = 2) -> DataFrame:
    """Each row's features with the largest |z| (per-row, bounded by #features)."""
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("z")) for c in zcols])
    ranked = F.slice(F.array_sort(arr, lambda a, b: F.when(F.abs(a.z) > F.abs(b.z), -1).when(
        F.abs(a.z) < F.abs(b.z), 1).when(a.feature < b.feature, -1).when(
        a.feature > b.feature, 1).otherwise(0)), 1, top)
    return df.select(id_col, F.posexplode(ranked).alias("rank", "d")).select(
        id_col, (F.col("rank") + 1).alias("rank"), F.col("d.feature").alias("feature"),
        F.col("d.z").alias("z"))


def domain_violations(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row per rule with the count of violating rows (one aggregate)."""
    agg = df.agg(*[F.count_if(~F.coalesce(cond, F.lit(False))).alias(name) for name, cond in rules])
    return agg.unpivot([], [n for n, _ in rules], "rule", "violations")


def side_by_side(df: DataFrame, id_col: str, ids: Sequence, cols: Sequence[str]) -> DataFrame:
    """Features of two entities side by side: feature, left_value, right_value."""
    long = df.where(F.col(id_col).isin(*ids)).select(
        id_col, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"),
                                             F.col(c).cast("string").alias("value")) for c in cols])
                          ).alias("s")).select(id_col, "s.feature", "s.value")
    return long.groupBy("feature").agg(
        F.max(F.when(F.col(id_col) == ids[0], F.col("value"))).alias("left_value"),
        F.max(F.when(F.col(id_col) == ids[1], F.col("value"))).alias("right_value"))


def scatter_table(df: DataFrame, id_col: str, x: str, y: str, flag: Column, target: Column,
                  jitter: float = 0.01) -> DataFrame:
    """X, y with a deterministic id-seeded jitter, cohort and target flags."""
    u = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long") % 1000
    j = (u / 1000.0 - 0.5) * jitter
    return df.select(id_col, (F.col(x) + j).alias("x"), (F.col(y) + j).alias("y"),
                     flag.alias("in_cohort"), target.alias("is_target"))


# Risk-factor rules for the guideline lookup
# (name, condition on the patient row, keyword searched in a section).
RISK_RULES = (
    ("age_over_70", "AGE > 70", "older"),
    ("age_under_50", "AGE < 50", "younger"),
    ("smoking", "SMOKING = 'Yes'", "smok"),
    ("chronic_disease", "CHRONIC_DISEASE = 'Yes'", "chronic"),
    ("anxiety", "ANXIETY = 'Yes'", "anxiety"),
)


def guideline_lookup(patients: DataFrame, sections: DataFrame) -> DataFrame:
    """Match each patient's stage and positive risk factors to guideline
    sections, as equi-joins: a section's stage key is the `Stage <roman><letter>`
    in its title (patients' `Stage_IIIA` is normalised to `Stage IIIA`); a
    section lists the risk factors whose keyword its title or body mentions."""
    stage = F.regexp_replace(F.col("CANCER_STAGE"), "_", " ")
    factors = F.filter(F.array(*[F.when(F.expr(cond), F.lit(name))
                                 for name, cond, _ in RISK_RULES]), lambda x: x.isNotNull())
    p = patients.select("PATIENT_ID", F.lower(stage).alias("stage"), factors.alias("risk_factors"))
    text = F.lower(F.concat_ws(" ", F.col("title"), F.col("body")))
    sec = sections.select(
        "title", F.lower(F.regexp_extract(F.col("title"), "(?i)(stage [ivx]+[abc]?)", 1)).alias(
            "stage_key"),
        F.filter(F.array(*[F.when(text.contains(kw), F.lit(name)) for name, _, kw in RISK_RULES]),
                 lambda x: x.isNotNull()).alias("mentions"))
    by_stage = p.join(sec.where(F.col("stage_key") != "").select("title", "stage_key"),
                      p.stage == F.col("stage_key")).select(
        "PATIENT_ID", F.lit("stage").alias("reason"), "stage", "title")
    rf = p.select("PATIENT_ID", "stage", F.explode("risk_factors").alias("reason"))
    sm = sec.select("title", F.explode("mentions").alias("reason"))
    by_risk = rf.join(sm, "reason").select("PATIENT_ID", "reason", "stage", "title")
    return by_stage.unionByName(by_risk)


def lof_adaptive(points: DataFrame, id_col: str, coords: Sequence[str], k: int = 5,
                 cell_cap: int | None = None, levels: int = 8) -> DataFrame:
    """T5 at scale: exact LOF where dense regions never pair all their points.

    * Exact duplicates collapse into one weighted location (multiplicity), so a
      pile of identical points costs one row, not its square.
    * Each location searches on the finest grid level (cell side halves per
      level) whose cell holds at most `cell_cap` points, and only the rings it
      needs there; a ring r at side s guarantees every point within r*s.
    Results equal the textbook definition with duplicates counted as points;
    a location whose k-distance is 0 has an undefined LOF (null).
    """
    from pyspark import StorageLevel
    ensure_checkpoint_dir(points.sparkSession)
    dims = list(coords)
    cap = cell_cap or 4 * (k + 1)
    locs = points.groupBy(*dims).agg(F.min(id_col).alias("_loc"), F.count(F.lit(1)).alias("_m"))
    locs = locs.persist(StorageLevel.MEMORY_AND_DISK)
    st = locs.agg(F.sum("_m").alias("n"), *[F.min(c).alias(f"lo_{c}") for c in dims],
                  *[F.max(c).alias(f"hi_{c}") for c in dims]).first()
    if st["n"] <= k:
        raise ValueError("need more points than k")
    spans = [max(st[f"hi_{c}"] - st[f"lo_{c}"], 1e-12) for c in dims]
    s0 = max((math.prod(spans) * 2 * k / st["n"]) ** (1.0 / len(dims)), max(spans) / 1e6)
    lv = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("_l")
    grid = locs.select("_loc", "_m", *dims, lv)
    for i, c in enumerate(dims):
        grid = grid.withColumn(f"_g{i}", F.floor((F.col(c) - F.lit(st[f"lo_{c}"])) / (
            F.lit(s0) / F.pow(F.lit(2.0), F.col("_l")))).cast("long"))
    gcols = [f"_g{i}" for i in range(len(dims))]
    occ = grid.groupBy("_l", *gcols).agg(F.sum("_m").alias("_occ"))
    lvl = grid.join(occ, ["_l", *gcols]).groupBy("_loc").agg(
        F.coalesce(F.min(F.when(F.col("_occ") <= cap, F.col("_l"))), F.lit(levels)).alias("_lev"))
    index = grid.persist(StorageLevel.MEMORY_AND_DISK)
    probe0 = index.join(lvl, "_loc").where(F.col("_l") == F.col("_lev")).drop("_lev")
    pending = probe0.select("_loc", "_m", "_l", *dims, *gcols).persist(StorageLevel.MEMORY_AND_DISK)

    def dist() -> Column:
        acc = None
        for c in dims:
            t = (F.col(f"p.{c}") - F.col(f"o.{c}")) * (F.col(f"p.{c}") - F.col(f"o.{c}"))
            acc = t if acc is None else acc + t
        return F.sqrt(acc)

    results = []
    ring, max_ring = 1, int(max(math.ceil(s / s0) for s in spans) * 2 ** levels) + 1
    while True:
        offs = F.sequence(F.lit(-ring), F.lit(ring))
        pr = pending
        for i in range(len(dims)):
            pr = pr.withColumn(f"_o{i}", F.explode(offs)).withColumn(
                f"_h{i}", F.col(f"_g{i}") + F.col(f"_o{i}")).drop(f"_o{i}")
        p, o = pr.alias("p"), index.alias("o")
        cond = F.col("p._l") == F.col("o._l")
        for i in range(len(dims)):
            cond = cond & (F.col(f"p._h{i}") == F.col(f"o._g{i}"))
        others = p.join(o, cond & (F.col("p._loc") != F.col("o._loc"))).select(
            F.col("p._loc").alias("p"), F.col("p._l").alias("lev"), F.col("o._loc").alias("o"),
            dist().alias("d"), F.col("o._m").alias("w"))
        selfs = pending.where(F.col("_m") > 1).select(
            F.col("_loc").alias("p"), F.col("_l").alias("lev"), F.col("_loc").alias("o"),
            F.lit(0.0).alias("d"), (F.col("_m") - 1).alias("w"))
        cand = others.unionByName(selfs).persist(StorageLevel.MEMORY_AND_DISK)
        wcum = Window.partitionBy("p").orderBy("d", "o").rowsBetween(Window.unboundedPreceding, 0)
        kth = cand.withColumn("_cum", F.sum("w").over(wcum)).where(
            (F.col("_cum") >= k) & (F.col("_cum") - F.col("w") < k)).select(
            "p", "lev", F.col("d").alias("kdist"))
        side = F.lit(s0) / F.pow(F.lit(2.0), F.col("lev"))
        ok = kth.where(F.col("kdist") <= side * ring) if ring < max_ring else kth
        res = cand.join(ok.drop("lev"), "p").where(F.col("d") <= F.col("kdist")).drop("lev")
        results.append(res.checkpoint())
        pending = pending.join(ok.select(F.col("p").alias("_loc")), "_loc", "left_anti").checkpoint()
        cand.unpersist()
        if ring >= max_ring or pending.count() == 0:
            break
        ring = min(ring * 2, max_ring)
    nb = results[0]
    for r in results[1:]:
        nb = nb.unionByName(r)
    kd = nb.select("p", "kdist").distinct()
    rd = nb.join(kd.select(F.col("p").alias("o"), F.col("kdist").alias("kdist_o")), "o").withColumn(
        "reach", F.greatest("kdist_o", "d"))
    lrd = rd.groupBy("p").agg((F.sum("w") / F.sum(F.col("w") * F.col("reach"))).alias("lrd"),
                              F.sum(F.col("w") * F.col("reach")).alias("_sr"))
    lrd = lrd.select("p", F.when(F.col("_sr") > 0, F.col("lrd")).alias("lrd"))
    lo = nb.join(lrd.select(F.col("p").alias("o"), F.col("lrd").alias("lrd_o")), "o").groupBy("p").agg(
        (F.sum(F.col("w") * F.col("lrd_o")) / F.sum("w")).alias("_m"),
        F.count_if(F.col("lrd_o").isNull()).alias("_undef"))
    out = lo.join(lrd, "p").join(kd, "p").select(
        F.col("p").alias("_loc"), "kdist", "lrd",
        F.when((F.col("_undef") == 0) & F.col("lrd").isNotNull(),
               F.try_divide(F.col("_m"), F.col("lrd"))).alias("lof"))
    back = points.join(locs.select(*dims, "_loc"), dims)
    res = back.join(out, "_loc").select(id_col, "kdist", "lrd", "lof").withColumn(
        "outlier", F.coalesce(F.col("lof") > OUTLIER_LOF, F.lit(False)))
    index.unpersist()
    return res


def group_distribution(df: DataFrame, groups: list[str], measure: str,
                       percentiles: Sequence[float] = (25, 50, 75)) -> DataFrame:
    """Count, known values, mean, least, greatest and exact percentiles of a measure by group
    (null groups are a group; a group without known values has null numbers)."""
    v = F.col(measure).cast("double")
    base = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("rows"), F.count(v).alias("known"), F.avg(v).alias("mean"),
                                   F.min(v).alias("least"), F.max(v).alias("greatest"))
    pct = exact_percentiles(df.where(v.isNotNull()), groups, measure, {f"p{p:g}": p for p in percentiles})
    return join_small(base, pct, groups, "left")


def category_counts(df: DataFrame, group: str, category: str) -> DataFrame:
    """How often each category occurs in each group, and its share of the group. A group of any
    size is counted in parts before the shuffle."""
    n = df.groupBy(group, category).agg(F.count(F.lit(1)).alias("rows"))
    total = n.groupBy(group).agg(F.sum("rows").alias("_all"))
    return join_small(n, total, [group]).select(group, category, "rows", (F.col("rows") / F.col("_all")).alias("share"))
