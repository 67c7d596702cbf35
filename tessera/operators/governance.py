"""Text governance and extraction (G*, C1–C7) as column expressions.

Everything is a chained `regexp_replace` / `regexp_extract_all` projection, so
it runs inside whole-stage codegen over whole texts; blocklists are compiled to
one expression per item (no join), and severity policies are a small table.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.ordered import join_small

ELLIPSIS = "…"

# Redaction patterns (Java regex syntax), applied in this order.
HEX = "[0-9a-fA-F]"
ARM_SUBSCRIPTION = (f"(?i)(/subscriptions/)({HEX}{{4}}){HEX}{{4}}-{HEX}{{4}}-{HEX}{{4}}-{HEX}{{4}}-"
                    f"{HEX}{{8}}({HEX}{{4}})")
GUID = f"\\b({HEX}{{4}}){HEX}{{4}}-{HEX}{{4}}-{HEX}{{4}}-{HEX}{{4}}-{HEX}{{8}}({HEX}{{4}})\\b"
IPV4_DASHED = "\\b(\\d{1,3})-\\d{1,3}-\\d{1,3}-\\d{1,3}((?:-\\d{1,3})?)\\b"
IPV4 = "\\b(\\d{1,3})\\.\\d{1,3}\\.\\d{1,3}\\.\\d{1,3}\\b"
SAS_SIGNATURE = "(?i)(\\bsig=)[^&\\s\"']+"
REDACTED = f"{ELLIPSIS}REDACTED{ELLIPSIS}"

# The competitor-cloud blocklist items (name, pattern, is_regex).
DEFAULT_BLOCKLIST = (
    ("google", r"\bgoogle\b", True),
    ("gcp", r"\bgcp\b", True),
    ("google-cloud", r"\bgoogle\s+cloud(?:\s+platform)?\b", True),
    ("vertex-ai", r"\bvertex\s+ai\b", True),
    ("bigquery", r"\bbigquery\b", True),
    ("cloud-run", r"\bcloud\s+run\b", True),
    ("anthos", r"\banthos\b", True),
    ("aws", r"\baws\b", True),
    ("amazon-web-services", r"\bamazon\s+web\s+services\b", True),
    ("ec2", r"\bec2\b", True),
    ("s3", r"\bs3\b", True),
    ("lambda-aws", r"\baws\s+lambda\b", True),
    ("dynamodb", r"\bdynamodb\b", True),
    ("sagemaker", r"\bsagemaker\b", True),
    ("bedrock", r"\bbedrock\b", True),
)

# Content-safety categories, sources and severity order.
CATEGORIES = ("hate", "sexual", "violence", "self_harm")
SOURCES = ("prompt", "completion")
SEVERITIES = ("safe", "low", "medium", "high")

# Citation marker and link patterns.
INLINE_MARKER = "【[0-9]+:[0-9]+†[^】]*】"
HTML_LINK = '<a href="([^"]*)">([^<]*)</a>'
HEADING = "<h([1-6])[^>]*>(.*?)</h[1-6]>"
TAG = "<[^>]+>"
MD_IMAGE = "!?\\[[^\\]]*\\]\\((?!data:)[^)]*\\)"
HTML_IMAGE = "(?i)<img[^>]*>"
BROKEN_REFERENCE = "!?\\[([^\\]]*)\\]\\(((?!data:|http)[^)]*)\\)"
# A paragraph ends at its end tag or at the next block tag: HTML lets pages leave the end tag out.
PARAGRAPH = "(?i)<p(?:\\s[^>]*)?>"
PARAGRAPH_TEXT = ("(?is)^(.*?)(?:</?(?:p|div|article|section|main|aside|nav|header|footer|form|table|t[dhr]|ul|ol|li|dl|"
                  "blockquote|pre|h[1-6]|hr|body|html)(?:[\\s/][^>]*)?>|\\z)")


def mask_guid(value: Column, keep: int = 4) -> Column:
    """Keep `keep` chars each side; short values fully masked; null/'' unchanged."""
    n = F.length(value)
    return (F.when(value.isNull() | (n == 0), value)
            .when(n <= 2 * keep, F.repeat(F.lit(ELLIPSIS), n))
            .otherwise(F.concat(F.substring(value, 1, keep), F.lit(ELLIPSIS),
                                F.right(value, F.lit(keep)))))


def mask_ip(value: Column) -> Column:
    """A dotted IPv4 keeps its first octet; anything else is unchanged."""
    return F.when(value.rlike("^[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+$"),
                  F.concat(F.substring_index(value, ".", 1), F.lit(".x.x.x"))).otherwise(value)


def mask_ip_in_name(value: Column) -> Column:
    """Dashed IPv4 inside names keeps the first octet and the CIDR suffix."""
    return F.regexp_replace(value, IPV4_DASHED, "$1-x-x-x$2")


def mask_arm_id(value: Column) -> Column:
    """Mask the subscription GUID of a resource path."""
    return F.regexp_replace(value, ARM_SUBSCRIPTION, f"$1$2{ELLIPSIS}$3")


def mask_sas_token(value: Column) -> Column:
    """Strip a SAS signature value."""
    return F.regexp_replace(value, SAS_SIGNATURE, f"$1{REDACTED}")


# (rule name, pattern, replacement) in application order.
REDACTION_RULES = (
    ("arm_subscription", ARM_SUBSCRIPTION, f"$1$2{ELLIPSIS}$3"),
    ("guid", GUID, f"$1{ELLIPSIS}$2"),
    ("ipv4_dashed", IPV4_DASHED, "$1-x-x-x$2"),
    ("ipv4", IPV4, "$1.x.x.x"),
    ("sas_signature", SAS_SIGNATURE, f"$1{REDACTED}"),
)


def redact(text: Column) -> tuple[Column, dict[str, Column]]:
    """G1: apply all rules in order; return the redacted text and per-rule hit
    counts (each counted on the text as it is when the rule runs)."""
    hits = {}
    cur = text
    for name, pattern, repl in REDACTION_RULES:
        hits[name] = F.regexp_count(cur, F.lit(pattern)).cast("long")
        cur = F.regexp_replace(cur, pattern, repl)
    return cur, hits


def may_need_redaction(text: Column) -> Column:
    """Exact pre-filter: every redaction rule needs a '-', a digit or 'sig='
    (any case), so other texts can skip all regex passes."""
    return text.contains("-") | text.rlike("[0-9]") | text.rlike("(?i)sig=")


def redact_text(text: Column) -> Column:
    return redact(text)[0]


def redact_frame(df: DataFrame, text_col: str, out_col: str = "redacted") -> DataFrame:
    """G1 as a frame: one projection per rule, so each intermediate text is
    computed once and shared by its hit count and the next rule."""
    cur = text_col
    for i, (name, pattern, repl) in enumerate(REDACTION_RULES):
        nxt = f"_stage{i}"
        df = df.withColumn(name, F.regexp_count(F.col(cur), F.lit(pattern)).cast("long")).withColumn(
            nxt, F.regexp_replace(F.col(cur), pattern, repl))
        if cur != text_col:
            df = df.drop(cur)
        cur = nxt
    return df.withColumnRenamed(cur, out_col)


def blocklist_pattern(pattern: str, is_regex: bool) -> str:
    """Literal items match case-insensitively as whole words; regex items as given
    (case-insensitive)."""
    body = pattern if is_regex else f"\\b{re.escape(pattern)}\\b"
    return f"(?i){body}"


def blocklist_matches(text: Column, items: Sequence[tuple[str, str, bool]] = DEFAULT_BLOCKLIST
                      ) -> Column:
    """Sorted names of the items that match the text (empty when clean).

    Items are configuration (bounded); each becomes one `rlike` in the projection.
    """
    hits = F.array(*[F.when(text.rlike(blocklist_pattern(p, r)), F.lit(n)) for n, p, r in items])
    return F.array_sort(F.filter(hits, lambda x: x.isNotNull()))


def severity_rank(level: Column) -> Column:
    expr = None
    for i, s in enumerate(SEVERITIES):
        expr = F.when(F.lower(level) == s, i) if expr is None else expr.when(F.lower(level) == s, i)
    return expr


def apply_policy(scores: DataFrame, threshold: str = "medium") -> DataFrame:
    """Scores `(…, category, source, severity)` → `blocked` when the severity
    reaches the policy threshold (one threshold for all 4 × 2 cells)."""
    t = SEVERITIES.index(threshold.lower())
    return scores.withColumn("blocked", F.coalesce(severity_rank(F.col("severity")) >= t,
                                                   F.lit(False)))


def extract_links(html: Column) -> Column:
    """(url, title) of every anchor, in document order."""
    return F.arrays_zip(F.regexp_extract_all(html, F.lit(HTML_LINK), 1).alias("url"),
                        F.regexp_extract_all(html, F.lit(HTML_LINK), 2).alias("title"))


def inline_markers(text: Column) -> Column:
    """Inline citation markers such as 【53:6†source】."""
    return F.regexp_extract_all(text, F.lit(INLINE_MARKER), 0)


def unique_references(links: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """Unique URLs per key in first-seen order; empty titles fall back to the URL."""
    first = links.groupBy(key, "url").agg(F.min(pos).alias("first_pos"),
                                          F.min_by("title", F.col(pos)).alias("_t"))
    return first.withColumn("title", F.when(F.length(F.trim(F.col("_t"))) > 0, F.col("_t"))
                            .otherwise(F.col("url"))).drop("_t")


def search_query(url: Column) -> Column:
    """C4: the quoted `q="…"` of a request URL, else the whole URL."""
    q = F.regexp_extract(url, 'q="([^"]*)"', 1)
    return F.when(F.length(q) > 0, q).otherwise(url)


def display_url(url: Column, api_host: str, display_host: str) -> Column:
    """C4: swap the API host for the display host and encode spaces."""
    return F.replace(F.replace(url, F.lit(api_host), F.lit(display_host)), F.lit(" "),
                     F.lit("%20"))


def strip_broken_images(text: Column, keep_http: bool = False) -> Column:
    """Drop markdown images and links unless `data:` (or `http` when keep_http), and
    every HTML <img> tag (the lookahead after `[^>]*` never protects data: images)."""
    md = "!?\\[[^\\]]*\\]\\((?!data:)(?!http)[^)]*\\)" if keep_http else MD_IMAGE
    return F.regexp_replace(F.regexp_replace(text, md, ""), HTML_IMAGE, "")


def paragraphs(html: Column) -> Column:
    """Inner HTML of every paragraph, in page order; an array with one empty text where there is none."""
    cut = F.split(F.coalesce(html, F.lit("")), PARAGRAPH, -1)
    rest = F.transform(F.slice(cut, 2, F.greatest(F.size(cut) - 1, F.lit(0))),
                       lambda x: F.regexp_extract(x, PARAGRAPH_TEXT, 1))
    return F.when(F.size(rest) > 0, rest).otherwise(F.array(F.lit("")))


def headings(html: Column) -> Column:
    """C7 helper: heading tags of a page, in order."""
    return F.regexp_extract_all(html, F.lit(HEADING), 0)


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, TAG, "")


SECTION_FIELDS = "section_no int, level int, title string, path array<string>, body string"


def sections_of(text: str) -> list[tuple[int, int, str, list[str], str]]:
    """Sections of one markdown text: (number, level, title, title path, body). Text before the
    first heading is section 0 of level 0; a `#` line inside a fenced block is no heading."""
    out: list = [(0, 0, "", [], [])]
    stack: list[tuple[int, str]] = []
    fenced = False
    for line in text.split("\n"):
        hashes = len(line) - len(line.lstrip("#"))
        if line.startswith("```"):
            fenced = not fenced
        if fenced or not 1 <= hashes <= 6 or line[hashes:hashes + 1] != " ":
            out[-1][4].append(line)
            continue
        title = line[hashes:].strip(" #")
        while stack and stack[-1][0] >= hashes:
            stack.pop()
        stack.append((hashes, title))
        out.append((len(out), hashes, title, [t for _, t in stack], []))
    return [(n, level, title, path, "\n".join(body)) for n, level, title, path, body in out if n or body]


def markdown_sections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, section_no, level, title, path (titles of the enclosing headings and its own) and
    body of every section; every line of a text is a heading or in the body of one section.
    A null text has no section. One pass, no shuffle."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ddl = f"id {rows.schema['id'].dataType.simpleString()}, {SECTION_FIELDS}"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = [(i, *s) for i, t in zip(part.column("id").to_pylist(), part.column("text").to_pylist())
                         if t is not None for s in sections_of(t)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    return rows.mapInArrow(run, ddl).withColumnRenamed("id", id_col)


# Fixed value: an inline marker with its title, or a markdown link with title and address.
CITATION = r"\u3010(\d+:\d+)\u2020([^\u3011]*)\u3011|\[([^\]]+)\]\((https?://[^)\s]+)\)"


def text_citations(docs: DataFrame, files: DataFrame | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Every citation of a text with its span, in order: id, pos, kind (`file` for an inline
    marker, `url` for a link), marker, title, target, start_index and end_index (in
    characters), quote (the text of its line since the citation before), formatted.

    `files` (title, file_id) resolves the titles of markers; an unknown title has a null target.
    """
    body = F.col(text_col)
    cut = docs.select(F.col(id_col), F.split(body, CITATION, -1).alias("_between"),
                      F.regexp_extract_all(body, F.lit(CITATION), F.lit(0)).alias("_all"))
    # The places of the matches: the lengths of all that comes before them, summed within the row.
    step = F.transform(F.arrays_zip(F.transform("_between", F.length).alias("b"), F.transform("_all", F.length).alias("m")),
                       lambda x: F.struct(x["b"].cast("long").alias("b"), F.coalesce(x["m"], F.lit(0)).cast("long").alias("m")))
    rows = cut.where(F.size("_all") > 0).withColumn("_s", step).select(
        id_col, F.posexplode("_all").alias("pos", "marker"), "_between", "_s")
    start = F.aggregate(F.slice("_s", F.lit(1), F.col("pos")), F.lit(0).cast("long"), lambda a, x: a + x["b"] + x["m"]) + F.element_at("_s", F.col("pos") + 1)["b"]
    rows = rows.withColumn("start_index", start).withColumn("end_index", F.col("start_index") + F.length("marker"))
    part = lambda n: F.regexp_extract("marker", CITATION, n)
    before = F.element_at("_between", F.col("pos") + 1)
    rows = rows.select(
        id_col, "pos", F.when(part(4) != "", "url").otherwise("file").alias("kind"), "marker",
        F.when(part(4) != "", part(3)).otherwise(part(2)).alias("title"), F.when(part(4) != "", part(4)).alias("_url"),
        "start_index", "end_index", F.trim(F.substring_index(before, "\n", -1)).alias("quote"))
    if files is None:
        rows = rows.withColumn("target", F.col("_url"))
    else:
        known = files.select(F.col("title").alias("_title"), "file_id").dropDuplicates(["_title"])
        rows = rows.join(known, (F.col("kind") == "file") & (F.col("title") == F.col("_title")), "left").withColumn(
            "target", F.coalesce("_url", "file_id")).drop("_title", "file_id")
    shown = F.format_string(" [%s %s](%s) (%d-%d)", "quote", "title", F.coalesce("target", F.lit("")), "start_index", "end_index")
    return rows.drop("_url").withColumn("formatted", shown)


def apply_policy_cells(scores: DataFrame, thresholds: Mapping[tuple[str, str], str]) -> DataFrame:
    """G6 with a threshold for each cell of category and source. Cells outside the policy and
    unknown severities never block."""
    levels = F.create_map(*[F.lit(x) for (c, s), t in thresholds.items() for x in (f"{c}|{s}", SEVERITIES.index(t.lower()))])
    limit = F.try_element_at(levels, F.concat_ws("|", "category", "source"))
    return scores.withColumn("blocked", F.coalesce(severity_rank(F.col("severity")) >= limit, F.lit(False)))


def replace_broken_images(texts: DataFrame, images: DataFrame, key: str, text: str = "text") -> DataFrame:
    """C6, second variant: every markdown image or link whose target is neither `data:` nor `http`
    becomes the image whose file name is a part of the target (parts are cut at / ? # & =; of several
    parts the first that names an image counts, of images of one name the least uri), on a paragraph
    of its own with the same alternative text; without such an image it is dropped, and so is every
    HTML <img>. `images`: name, uri. `key` tells rows apart; null texts stay null.

    Only key, place and target parts of the references meet the images, by an equi-join.
    """
    t = F.col(text)
    refs = F.arrays_zip(F.regexp_extract_all(t, F.lit(BROKEN_REFERENCE), 1).alias("alt"),
                        F.regexp_extract_all(t, F.lit(BROKEN_REFERENCE), 2).alias("target"))
    marked = texts.withColumn("_refs", refs)
    parts = marked.select(key, F.posexplode("_refs").alias("_at", "_r")).select(
        key, "_at", "_r.alt", F.posexplode(F.split("_r.target", "[/?#&=]", -1)).alias("_part", "name"))
    uris = images.groupBy("name").agg(F.min("uri").alias("uri"))
    found = parts.join(uris, "name").groupBy(key, "_at").agg(
        F.min_by(F.concat(F.lit("\n\n!["), F.col("alt"), F.lit("]("), F.col("uri"), F.lit(")")), "_part").alias("_new"))
    by_key = found.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_at", "_new"))).alias("_found"))
    pieces = F.split(t, BROKEN_REFERENCE, -1)
    filled = F.array_join(F.transform(pieces, lambda p, i: F.concat(
        p, F.coalesce(F.try_element_at("_found", i), F.lit("")))), "")
    return join_small(marked, by_key, [key], "left").withColumn(
        text, F.regexp_replace(filled, HTML_IMAGE, "")).drop("_refs", "_found")
