"""URL filter by association rules.

Spark's FP-growth mines combinations of URL tokens that go with a label
(`block` / `allow`); rules are pruned by support and confidence and kept as an
inverted index: each rule is posted once, under its rarest token, and a URL's
tokens look the index up. Among the rules whose tokens a URL all has, the one
with the highest confidence, then support, then length decides; without one the
default verdict holds. A list of explicit (host, path) rules goes first.

Only DataFrame functions: no Python on the executors. URLs are judged per
distinct token set and joined back.

Tokens: scheme, all host labels, all path segments, the file extension, whether
there is a query, and the keys and key=value pairs of the query. Mined are those of at
least MIN_COUNT labelled URLs, however many URLs there are. Tokens that occur
in the same labelled URLs (the segments of a deep path) are mined as one item, as any
of them gives the same rules; a URL that has one of them has the item. FP-growth still
finds all combinations of the items that MIN_COUNT URLs share.

Edge cases: null URLs and URLs without `://` have empty host and path and get the
default verdict; repeated rows are judged one by one; without labelled URLs of
both kinds there are no mined rules; other columns are not carried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii, parts

LABEL = "label="
MIN_COUNT = 10            # labelled URLs that a rule rests on, at least
MIN_CONFIDENCE = 0.6


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


LISTED = (UrlRule("net", "/", "block"), UrlRule("example.net", "/en/", "allow"),
          UrlRule("example.com", "/de/", "block"), UrlRule("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules=LISTED) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits, else nulls."""
    rule = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        if rule is None:
            rule, verdict = F.when(fits, r.text), F.when(fits, r.verdict)
        else:
            rule, verdict = rule.when(fits, r.text), verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def tokens(url: Column, host: Column, path: Column) -> Column:
    labels = F.split(host, r"\.")
    last = F.element_at(F.split(path, "/"), -1)
    segments = F.filter(F.split(F.lower(path), "/"), lambda s: s != "")
    query = F.filter(F.split(F.lower(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)), "[&;]"), lambda x: x != "")
    found = F.concat(
        F.transform(F.filter(labels, lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x)),
        F.transform(segments, lambda x: F.concat(F.lit("p:"), x)),
        F.transform(query, lambda x: F.concat(F.lit("k:"), F.substring_index(x, "=", 1))),
        F.transform(F.filter(query, lambda x: F.instr(x, "=") > 0), lambda x: F.concat(F.lit("q:"), x)),
        F.array(F.concat(F.lit("s:"), F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]{0,15})://", 1))),
                F.concat(F.lit("x:"), F.lower(F.regexp_extract(last, r"\.([A-Za-z][A-Za-z0-9]{0,5})$", 1))),
                F.when(F.instr(url, "?") > 0, F.lit("q:1")).otherwise(F.lit("q:0"))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(found)))


def mine(labelled: DataFrame, min_support: float = 0.0, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (groups, verdict, confidence, support, at) from labelled(tokens, verdict). A URL has the antecedent
    if it has a token of each group; `at` is a token of the rarest group, each of which the rule is posted under."""
    spark = labelled.sparkSession
    sets = (labelled.where(F.size("tokens") > 0).groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("times")))
    n = sets.agg(F.sum("times")).first()[0]
    if not n:
        return spark.createDataFrame([], "groups array<array<string>>, verdict string, confidence double, support double, at string")
    each = sets.withColumn("token", F.explode("tokens"))
    # Tokens of the same URLs are one item, named by the first of them.
    items = (each.groupBy("token").agg(F.sum("times").alias("freq"), F.bit_xor(F.xxhash64("tokens", "verdict")).alias("one"),
                                       F.bit_xor(F.xxhash64("verdict", "tokens")).alias("two"))
             .where(F.col("freq") >= MIN_COUNT).groupBy("freq", "one", "two")
             .agg(F.min("token").alias("item"), F.collect_list("token").alias("tokens")).select("item", "freq", F.col("tokens").alias("group")))
    rows = (each.join(items.select("item", F.explode("group").alias("token")), "token", "left")
            .groupBy("tokens", "verdict").agg(F.first("times").alias("times"), F.collect_set("item").alias("items"))
            .select(F.array_append("items", F.concat(F.lit(LABEL), "verdict")).alias("items"),
                    F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))).select("items"))
    # Half a URL less, as FP-growth rounds the count up.
    model = FPGrowth(minSupport=min(1.0, max(min_support, (MIN_COUNT - 0.5) / n)), minConfidence=min_confidence, numPartitions=parts(spark)).fit(rows)
    rules = (model.associationRules.where(F.col("consequent")[0].startswith(LABEL))
             .select("antecedent", F.substring(F.col("consequent")[0], len(LABEL) + 1, 1 << 20).alias("verdict"),
                     "confidence", "support"))
    return (rules.withColumn("item", F.explode("antecedent")).join(items, "item")
            .groupBy("antecedent", "verdict", "confidence", "support")
            .agg(F.collect_list("group").alias("groups"), F.min_by("group", F.struct("freq", "item")).alias("rarest"))
            .select("groups", "verdict", "confidence", "support", F.explode("rarest").alias("at")))


def matched(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct token set, the best rule that it contains: (tokens, mined). Only the tokens that occur in
    rules are looked up, so that sets that differ in others are matched once."""
    useful = rules.select(F.explode(F.flatten("groups")).alias("token")).distinct()
    kept = (sets.select("tokens", F.explode("tokens").alias("token")).join(useful, "token")
            .groupBy("tokens").agg(F.array_sort(F.collect_set("token")).alias("kept")))
    few = kept.select(F.col("kept").alias("tokens")).distinct()
    hit = (few.select("tokens", F.explode("tokens").alias("at")).join(rules, "at")
           .where(F.forall("groups", lambda g: F.arrays_overlap(g, F.col("tokens")))))
    antecedent = F.array_sort(F.array_intersect(F.flatten("groups"), F.col("tokens")))
    best = F.struct("confidence", "support", F.size(antecedent).alias("n"),
                    F.array_join(antecedent, " ").alias("antecedent"), "verdict")
    found = hit.groupBy(F.col("tokens").alias("kept")).agg(F.max(best).alias("mined"))
    return kept.join(found, "kept").select("tokens", "mined")


def judge(pages: DataFrame, labels: DataFrame, rules=LISTED, default: str = "allow",
          min_support: float = 0.0, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule, mined_confidence of pages(page_id, url).

    labels(page_id, verdict) names the labelled pages; several labels of a page are
    one transaction each, null verdicts none.
    """
    urls = pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    urls = urls.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))
    known = labels.select("page_id", "verdict").where(F.col("verdict").isNotNull())
    mined = mine(urls.join(known, "page_id").select("tokens", "verdict"), min_support, min_confidence)
    best = matched(urls.where(F.size("tokens") > 0).select("tokens").distinct(), mined)
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    return (urls.join(best, "tokens", "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, F.col("mined.verdict"), F.lit(default)).alias("verdict"),
                    F.col("mined.antecedent").alias("mined_rule"), F.col("mined.confidence").alias("mined_confidence")))
