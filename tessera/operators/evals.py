"""Conversation and evaluation tables (V*).

Transcripts are folded per conversation with `max_by` / ordered aggregates.
Text scorers (token F1, BLEU, METEOR exact stage) run as token and n-gram
tables joined per (row, token): no per-row Python.

Scorer definitions are the published ones (the reference delegates scoring to
a hosted service): SQuAD-style token F1; BLEU (Papineni et al. 2002) with
brevity penalty and add-epsilon smoothing (0.1) for empty n-gram matches;
METEOR (Banerjee & Lavie 2005) exact-match stage, alpha 0.9, beta 3, gamma 0.5.
"""

from __future__ import annotations

import base64
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ordered import rank_within

DEFAULT_LATENCY = 8.5
F1_THRESHOLD = 0.2
BLEU_THRESHOLD = 0.01
METEOR_THRESHOLD = 0.4
REVIEW_APPROVE_SCORE = 80

# ASCII punctuation ranges and English articles for answer normalisation.
PUNCT = "[!-/:-@\\[-`{-~]"
ARTICLES = ("a", "an", "the")
WORD = "[\\p{L}\\p{N}]+"
WS = "[ \\t\\n\\r]+"


def eval_rows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text", latency: float | None = None) -> DataFrame:
    """V1: transcript → evaluation row per conversation.

    context = system texts joined by ' | ' in turn order; query = the last user
    message; response = the last non-empty assistant message.
    """
    sys_items = F.when(F.col(role) == "system", F.struct(F.col(turn).alias("t"),
                                                         F.col(text).alias("x")))
    out = turns.groupBy(conv).agg(
        F.max_by(F.col(text), F.when(F.col(role) == "user", F.col(turn))).alias("query"),
        F.max_by(F.col(text), F.when((F.col(role) == "assistant") & (F.length(F.col(text)) > 0),
                                     F.col(turn))).alias("response"),
        F.array_sort(F.collect_list(sys_items)).alias("_sys"),
    )
    return out.select(
        conv,
        F.coalesce(F.col("query"), F.lit("")).alias("query"),
        F.coalesce(F.col("response"), F.lit("")).alias("response"),
        F.array_join(F.col("_sys.x"), " | ").alias("context"),
        F.lit(DEFAULT_LATENCY if latency is None else latency).cast("double").alias("latency"),
        F.length(F.coalesce(F.col("response"), F.lit(""))).alias("response_length"),
    )


def last_message(turns: DataFrame, role_value: str, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """V2: the last message of a role per conversation."""
    return turns.where(F.col(role) == role_value).groupBy(conv).agg(
        F.max_by(F.struct(turn, text), F.col(turn)).alias("m")).select(
        conv, F.col(f"m.{turn}").alias(turn), F.col(f"m.{text}").alias(text))


def normalized_tokens(text: Column) -> Column:
    """SQuAD answer normalisation: lower, drop punctuation and articles, split."""
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), PUNCT, "")
    t = F.regexp_replace(t, "^[ \\t\\n\\r]+|[ \\t\\n\\r]+$", "")
    # Articles are dropped as whole tokens (Unicode word semantics, engine-independent).
    return F.filter(F.split(t, WS), lambda x: (F.length(x) > 0) & ~x.isin(*ARTICLES))


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 0)


def _counts(df: DataFrame, key: str, tokens: Column, name: str) -> DataFrame:
    return df.select(key, F.explode(tokens).alias("token")).groupBy(key, "token").agg(
        F.count(F.lit(1)).alias(name))


def token_f1(rows: DataFrame, key: str, pred: str, truth: str) -> DataFrame:
    """V3: bag-of-token F1 per row (multiset overlap via per-token min counts)."""
    lens = rows.select(key, F.size(normalized_tokens(F.col(pred))).alias("pred_len"),
                       F.size(normalized_tokens(F.col(truth))).alias("truth_len"))
    p = _counts(rows, key, normalized_tokens(F.col(pred)), "cp")
    t = _counts(rows, key, normalized_tokens(F.col(truth)), "ct")
    common = p.join(t, [key, "token"]).groupBy(key).agg(
        F.sum(F.least("cp", "ct")).alias("common"))
    j = lens.join(common, key, "left").fillna(0, ["common"])
    prec = F.col("common") / F.col("pred_len")
    rec = F.col("common") / F.col("truth_len")
    f1 = F.when(F.col("common") == 0, F.lit(0.0)).otherwise(2 * prec * rec / (prec + rec))
    return j.select(key, "common", "pred_len", "truth_len", f1.alias("f1_score")).withColumn(
        "f1_pass", F.col("f1_score") >= F1_THRESHOLD)


def _ngrams(tokens: Column, n: int) -> Column:
    starts = F.sequence(F.lit(1), F.size(tokens) - n + 1)
    return F.when(F.size(tokens) >= n, F.transform(
        starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(
        F.array().cast("array<string>"))


def bleu(rows: DataFrame, key: str, hyp: str, ref: str, max_n: int = 4,
         epsilon: float = 0.1) -> DataFrame:
    """V4: sentence BLEU with clipped n-gram precision, brevity penalty, smoothing."""
    base = rows.select(key, word_tokens(F.col(hyp)).alias("_h"), word_tokens(F.col(ref)).alias("_r"))
    parts = []
    for n in range(1, max_n + 1):
        h = base.select(key, F.explode(_ngrams(F.col("_h"), n)).alias("g")).groupBy(key, "g").agg(
            F.count(F.lit(1)).alias("ch"))
        r = base.select(key, F.explode(_ngrams(F.col("_r"), n)).alias("g")).groupBy(key, "g").agg(
            F.count(F.lit(1)).alias("cr"))
        m = h.join(r, [key, "g"]).groupBy(key).agg(F.sum(F.least("ch", "cr")).alias(f"m{n}"))
        parts.append(m)
    out = base.select(key, F.size("_h").alias("hyp_len"), F.size("_r").alias("ref_len"))
    for n, m in enumerate(parts, start=1):
        out = out.join(m, key, "left").fillna(0, [f"m{n}"])
    logs = []
    for n in range(1, max_n + 1):
        total = F.col("hyp_len") - (n - 1)
        p = F.when(F.col(f"m{n}") > 0, F.col(f"m{n}") / total).otherwise(F.lit(epsilon) / total)
        logs.append(F.log(p))
    mean_log = sum(logs[1:], logs[0]) / max_n
    bp = F.when(F.col("hyp_len") > F.col("ref_len"), F.lit(1.0)).otherwise(
        F.exp(1 - F.col("ref_len") / F.col("hyp_len")))
    score = F.when(F.col("hyp_len") < max_n, F.lit(0.0)).otherwise(bp * F.exp(mean_log))
    return out.select(key, "hyp_len", "ref_len", score.alias("bleu_score")).withColumn(
        "bleu_pass", F.col("bleu_score") >= BLEU_THRESHOLD)


def meteor(rows: DataFrame, key: str, hyp: str, ref: str, alpha: float = 0.9, beta: float = 3.0,
           gamma: float = 0.5) -> DataFrame:
    """V5: METEOR exact stage. Unigrams align by (token, occurrence number); a
    chunk is a maximal run adjacent in both hypothesis and reference."""
    def occ(col: str, side: str) -> DataFrame:
        t = rows.select(key, F.posexplode(word_tokens(F.col(col))).alias("pos", "token"))
        w = Window.partitionBy(key, "token").orderBy("pos")
        return t.withColumn("nth", F.row_number().over(w)).withColumnRenamed("pos", f"{side}_pos")

    h, r = occ(hyp, "h"), occ(ref, "r")
    al = h.join(r, [key, "token", "nth"])
    w = Window.partitionBy(key).orderBy("h_pos")
    starts = al.withColumn("_ph", F.lag("h_pos").over(w)).withColumn("_pr", F.lag("r_pos").over(w))
    new_chunk = ~((F.col("_ph") == F.col("h_pos") - 1) & (F.col("_pr") == F.col("r_pos") - 1))
    agg = starts.groupBy(key).agg(F.count(F.lit(1)).alias("matches"),
                                  F.count_if(F.coalesce(new_chunk, F.lit(True))).alias("chunks"))
    lens = rows.select(key, F.size(word_tokens(F.col(hyp))).alias("hyp_len"),
                       F.size(word_tokens(F.col(ref))).alias("ref_len"))
    j = lens.join(agg, key, "left").fillna(0, ["matches", "chunks"])
    p = F.col("matches") / F.col("hyp_len")
    rc = F.col("matches") / F.col("ref_len")
    fmean = p * rc / (alpha * p + (1 - alpha) * rc)
    pen = gamma * F.pow(F.col("chunks") / F.col("matches"), beta)
    score = F.when(F.col("matches") == 0, F.lit(0.0)).otherwise(fmean * (1 - pen))
    return j.select(key, "matches", "chunks", "hyp_len", "ref_len", score.alias("meteor_score")
                    ).withColumn("meteor_pass", F.col("meteor_score") >= METEOR_THRESHOLD)


def result_counts(results: DataFrame, name: str = "name", label: str = "label",
                  score: str = "score") -> DataFrame:
    """V6: per criterion passed / failed / errored / total and mean score."""
    return results.groupBy(name).agg(
        F.count_if(F.col(label) == "pass").alias("passed"),
        F.count_if(F.col(label) == "fail").alias("failed"),
        F.count_if(F.col(label).isNull() | ~F.col(label).isin("pass", "fail")).alias("errored"),
        F.count(F.lit(1)).alias("total"),
        F.avg(score).alias("mean_score"))


def apply_mapping(df: DataFrame, mapping: Mapping[str, str], sources: Mapping[str, DataFrame]
                  | None = None) -> DataFrame:
    """V7: `{target: "{{item.x}}" | "${data.x}" | "{{sample.y}}"}` → projection.

    `item`/`data` refer to columns of `df`; `sample` to generated columns that
    must already be on `df` under their own name. Unknown fields raise.
    """
    import re
    pat = re.compile(r"^\s*(?:\{\{\s*(item|sample)\.([A-Za-z_][\w]*)\s*\}\}|\$\{data\.([A-Za-z_][\w]*)\})\s*$")
    cols = []
    for target, ref in mapping.items():
        m = pat.match(ref)
        if not m:
            raise ValueError(f"unsupported mapping {ref!r}")
        field = m.group(2) or m.group(3)
        if field not in df.columns:
            raise ValueError(f"unknown field {field!r} in mapping for {target!r}")
        cols.append(F.col(field).alias(target))
    return df.select(*cols)


def sample_for_eval(df: DataFrame, id_col: str, percent: int, per_bucket: int | None = None,
                    bucket_col: str | None = None) -> DataFrame:
    """V8: deterministic `percent` sample by md5 bucket of the id, then at most
    `per_bucket` rows per time bucket (a sampling operator: the cap is the feature).

    The per-bucket position comes from a distributed rank, so a busy bucket is
    still spread over many tasks.
    """
    bucket = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast(
        "long") % 100
    s = df.where(bucket < percent)
    if per_bucket is None:
        return s
    ranked = rank_within(s, [bucket_col], [id_col])
    return ranked.where(F.col("_rank") < per_bucket).drop("_rank", "_n", "_part", "_mid")


def redact_score_properties(results: DataFrame, struct_col: str, fields: Sequence[str],
                            enabled: bool = True) -> DataFrame:
    """V9: null out score properties (e.g. reasons) when redaction is on."""
    if not enabled:
        return results
    c = F.col(struct_col)
    for f in fields:
        c = c.withField(f, F.lit(None))
    return results.withColumn(struct_col, c)


REVIEW_SCHEMA = ("score INT, feedback STRING, clarity INT, completeness INT, accuracy INT, "
                 "structure INT")


def review_routing(df: DataFrame, text_col: str) -> DataFrame:
    """Parse a review; score < 80 → edit, else approve; unparsable → approve."""
    parsed = F.from_json(F.col(text_col), REVIEW_SCHEMA)
    decision = F.when(parsed.isNotNull() & (parsed.score < REVIEW_APPROVE_SCORE), "edit").otherwise(
        "approve")
    return df.withColumn("review", parsed).withColumn("decision", decision)


def attack_prompts(df: DataFrame, text_col: str) -> DataFrame:
    """Baseline, reversed and base64 variants of every prompt."""
    variants = F.array(
        F.struct(F.lit("baseline").alias("strategy"), F.col(text_col).alias("prompt")),
        F.struct(F.lit("reversal").alias("strategy"), F.reverse(F.col(text_col)).alias("prompt")),
        F.struct(F.lit("base64").alias("strategy"),
                 F.base64(F.encode(F.col(text_col), "UTF-8")).alias("prompt")))
    return df.select("*", F.explode(variants).alias("_v")).select(
        "*", F.col("_v.strategy").alias("strategy"), F.col("_v.prompt").alias("prompt")).drop("_v")


def attack_success_rate(results: DataFrame, keys: Sequence[str] = ("strategy", "criterion")
                        ) -> DataFrame:
    """Attack success rate by strategy × criterion (cube adds the margins)."""
    return results.cube(*keys).agg(F.avg(F.col("attack_success").cast("double")).alias(
        "attack_success_rate"), F.count(F.lit(1)).alias("attempts"))


def pair_tool_calls(calls: DataFrame, outputs: DataFrame, known_functions: Sequence[str]
                    ) -> DataFrame:
    """Pair tool calls with outputs on call_id; unmatched → pending;
    unknown function → error."""
    j = calls.join(outputs, "call_id", "left")
    status = (F.when(~F.col("function").isin(*known_functions), "error")
              .when(F.col("output").isNull(), "pending").otherwise("done"))
    return j.withColumn("status", status)


def lookup_with_default(df: DataFrame, lookup: DataFrame, key: str, value: str,
                        default: str) -> DataFrame:
    """Broadcast lookup (a small reference table) with a default text."""
    return df.join(F.broadcast(lookup), key, "left").withColumn(
        value, F.coalesce(F.col(value), F.lit(default)))


def longest_words(sentences: Column) -> Column:
    """Longest whitespace word of a sentence; the first wins ties; '' if none."""
    w = F.split(F.regexp_replace(sentences, "^[ \\t\\n\\r]+|[ \\t\\n\\r]+$", ""), WS)
    lens = F.transform(w, lambda x: F.length(x))
    return F.element_at(w, F.array_position(lens, F.array_max(lens)).cast("int"))


def sum_map_values(m: Column) -> Column:
    """Sum of a record's integer values."""
    return F.aggregate(F.map_values(m), F.lit(0).cast("long"), lambda a, x: a + x)


def merge_maps(left: Column, right: Column) -> Column:
    """Right-wins merge (a key present on the right takes the right value)."""
    return F.map_zip_with(left, right, lambda k, a, b: F.when(
        F.map_contains_key(right, k), b).otherwise(a))


def celsius_mentions(text: Column) -> Column:
    """The text mentions a Celsius temperature."""
    return F.coalesce(text.contains("°C"), F.lit(False))


def convert_temperature(value: Column, signed: bool = False) -> Column:
    """°C ↔ °F. Faithful mode keeps only the digits (sign and point dropped);
    `signed=True` parses the number properly. Result has one decimal."""
    if signed:
        num = F.regexp_extract(value, "(-?[0-9]+(?:\\.[0-9]+)?)", 1).cast("double")
    else:
        num = F.regexp_replace(value, "[^0-9]", "").cast("double")
    is_c = value.contains("°C")
    conv = F.when(is_c, num * 9 / 5 + 32).otherwise((num - 32) * 5 / 9)
    unit = F.when(is_c, F.lit("°F")).otherwise(F.lit("°C"))
    return F.when(num.isNotNull(), F.concat(F.format_string("%.1f", conv), unit))


def b64(s: str) -> str:
    return base64.b64encode(s.encode("utf-8")).decode("ascii")
