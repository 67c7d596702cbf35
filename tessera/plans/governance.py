"""Governance and extraction queries (G*, C*) over documents, conversations, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import governance as G
from tessera.plans.registry import register
from tessera.sources.tables import IMAGE_NAMES, illustrated, image_files, table


def _duck_repl(r: str) -> str:
    return r.replace("$1", "\\1").replace("$2", "\\2").replace("$3", "\\3")


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _redaction_sql() -> str:
    stages = ["text"]
    hits = []
    for i, (name, pattern, repl) in enumerate(G.REDACTION_RULES):
        prev = stages[-1]
        hits.append(f"CAST(len(regexp_extract_all({prev}, {_sql_lit(pattern)})) AS BIGINT) AS {name}")
        stages.append(f"regexp_replace({prev}, {_sql_lit(pattern)}, {_sql_lit(_duck_repl(repl))}, 'g')")
    return f"""
SELECT * FROM (
  SELECT doc_id, {', '.join(hits)}, {stages[-1]} AS redacted FROM documents
) WHERE {' + '.join(n for n, _, _ in G.REDACTION_RULES)} > 0"""


@register("g1_redaction", _redaction_sql())
def g1_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-order redaction over whole documents with per-rule hit counts;
    documents with at least one hit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").where(
        G.may_need_redaction(F.col("text")))
    names = [n for n, _, _ in G.REDACTION_RULES]
    out = G.redact_frame(docs, "text").select("doc_id", *names, "redacted")
    total = None
    for n in names:
        total = F.col(n) if total is None else total + F.col(n)
    return out.where(total > 0)


def _blocklist_sql() -> str:
    cases = ", ".join(
        f"CASE WHEN regexp_matches(text, {_sql_lit(G.blocklist_pattern(p, r))}) "
        f"THEN {_sql_lit(n)} END" for n, p, r in G.DEFAULT_BLOCKLIST)
    return f"""
SELECT * FROM (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 'prompt' ELSE 'completion' END AS source,
         list_sort(list_filter([{cases}], lambda x: x IS NOT NULL)) AS blocked_items
  FROM conversations WHERE role IN ('user', 'assistant')
) WHERE len(blocked_items) > 0"""


@register("g5_blocklist", _blocklist_sql())
def g5_blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocklist over prompts (user turns) and completions (assistant turns)."""
    conv = table(spark, sf_dir, "conversations").where(F.col("role").isin("user", "assistant"))
    out = conv.select("conv_id", "turn",
                      F.when(F.col("role") == "user", "prompt").otherwise("completion").alias(
                          "source"),
                      G.blocklist_matches(F.col("text")).alias("blocked_items"))
    return out.where(F.size("blocked_items") > 0)


G6_SQL = """
WITH s AS (
  SELECT doc_id, 'hate' AS category, 'completion' AS source,
         CASE WHEN toxic = 1 THEN 'high' ELSE 'safe' END AS severity FROM labels
  UNION ALL
  SELECT doc_id, 'violence', 'completion',
         CASE WHEN quality = 0 THEN 'medium' ELSE 'safe' END FROM labels
)
SELECT doc_id, category, source, severity,
       CASE severity WHEN 'safe' THEN 0 WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 END
         >= 2 AS blocked
FROM s"""


@register("g6_severity_policy", G6_SQL)
def g6_severity_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity scores from `labels` against a Medium-threshold policy."""
    lab = table(spark, sf_dir, "labels")
    scores = lab.select("doc_id", F.lit("hate").alias("category"),
                        F.lit("completion").alias("source"),
                        F.when(F.col("toxic") == 1, "high").otherwise("safe").alias("severity")
                        ).unionByName(
        lab.select("doc_id", F.lit("violence").alias("category"),
                   F.lit("completion").alias("source"),
                   F.when(F.col("quality") == 0, "medium").otherwise("safe").alias("severity")))
    return G.apply_policy(scores, "medium")


C1_SQL = f"""
WITH l AS (
  SELECT page_id, regexp_extract_all(html, {_sql_lit(G.HTML_LINK)}, 1) AS u,
         regexp_extract_all(html, {_sql_lit(G.HTML_LINK)}, 2) AS t
  FROM pages
)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, u[i] AS url, t[i] AS title
FROM (SELECT *, unnest(range(1, len(u) + 1)) AS i FROM l)"""


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.posexplode(G.extract_links(F.col("html"))).alias("pos", "l")
                        ).select("page_id", "pos", F.col("l.url").alias("url"),
                                 F.col("l.title").alias("title"))


@register("c1_page_links", C1_SQL)
def c1_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL citations (url, title, position) from every page."""
    return page_links(spark, sf_dir)


C3_SQL = "WITH x AS (" + C1_SQL + """)
SELECT page_id, url, min(pos) AS first_pos,
       CASE WHEN length(trim(arg_min(title, pos))) > 0 THEN arg_min(title, pos) ELSE url END AS title
FROM x GROUP BY page_id, url"""


@register("c3_unique_references", C3_SQL)
def c3_unique_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.unique_references(page_links(spark, sf_dir), "page_id")


C4_SQL = """
SELECT page_id,
       CASE WHEN length(regexp_extract(url, 'q="([^"]*)"', 1)) > 0
            THEN regexp_extract(url, 'q="([^"]*)"', 1) ELSE url END AS search_query,
       replace(replace(url, '.example.com', '.example.org'), ' ', '%20') AS display_url
FROM pages"""


@register("c4_search_queries", C4_SQL)
def c4_search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", G.search_query(F.col("url")).alias("search_query"),
                        G.display_url(F.col("url"), ".example.com", ".example.org").alias(
                            "display_url"))


C5_SQL = """
SELECT event_type, CAST(count(*) AS BIGINT) AS events
FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY event_type"""


@register("c5_freshness_filter", C5_SQL)
def c5_freshness_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness 'Week' relative to the newest event."""
    from tessera.operators.retrieval import freshness_window
    ev = table(spark, sf_dir, "events")
    # One scalar travels to the driver; the filter then prunes the parquet scan.
    anchor = ev.agg(F.max("ts")).first()[0]
    lo, hi = freshness_window("Week", anchor)
    return ev.where((F.col("ts") > F.lit(lo)) & (F.col("ts") <= F.lit(hi))).groupBy(
        "event_type").agg(F.count(F.lit(1)).alias("events"))


C7_SQL = f"""
WITH h AS (SELECT page_id, regexp_extract_all(html, {_sql_lit(G.HEADING)}, 0) AS hs FROM pages),
x AS (SELECT page_id, unnest(range(1, len(hs) + 1)) AS i, hs FROM h)
SELECT page_id, CAST(i - 1 AS INTEGER) AS section_no,
       CAST(regexp_extract(hs[i], '<h([1-6])', 1) AS INTEGER) AS level,
       regexp_replace(hs[i], '<[^>]+>', '', 'g') AS title
FROM x"""


@register("c7_page_sections", C7_SQL)
def c7_page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading sections of every page (level, title) in order."""
    pages = table(spark, sf_dir, "pages")
    h = pages.select("page_id", F.posexplode(G.headings(F.col("html"))).alias("section_no", "tag"))
    return h.select("page_id", "section_no",
                    F.regexp_extract("tag", "<h([1-6])", 1).cast("int").alias("level"),
                    G.strip_tags(F.col("tag")).alias("title"))


# Every fifth line of a document is made a heading, of a level that its length gives.
C7_MARKDOWN_SQL = """
WITH l AS (
  SELECT doc_id, i, CASE WHEN (i - 1) % 5 = 2 AND length(ls[i]) > 0 THEN 1 + length(ls[i]) % 4 END AS level, ls[i] AS line
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))),
n AS (SELECT *, count(level) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section_no FROM l),
heads AS (SELECT doc_id, section_no, level, trim(line, ' #') AS title FROM n WHERE level IS NOT NULL),
paths AS (
  SELECT a.doc_id, a.section_no, list(b.title ORDER BY b.section_no) AS path
  FROM heads a JOIN heads b ON b.doc_id = a.doc_id AND b.section_no <= a.section_no
  WHERE b.section_no = a.section_no OR b.level < (SELECT min(m.level) FROM heads m
    WHERE m.doc_id = a.doc_id AND m.section_no > b.section_no AND m.section_no <= a.section_no)
  GROUP BY ALL),
bodies AS (SELECT doc_id, section_no, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (level IS NULL), '') AS body FROM n GROUP BY ALL)
SELECT b.doc_id, CAST(b.section_no AS INTEGER) AS section_no, CAST(coalesce(h.level, 0) AS INTEGER) AS level, coalesce(h.title, '') AS title,
       coalesce(array_to_string(p.path, ' > '), '') AS path, b.body
FROM bodies b LEFT JOIN heads h ON h.doc_id = b.doc_id AND h.section_no = b.section_no
LEFT JOIN paths p ON p.doc_id = b.doc_id AND p.section_no = b.section_no"""


@register("c7_markdown_sections", C7_MARKDOWN_SQL)
def c7_markdown_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of the documents as markdown: level, title path, body."""
    line = lambda x, i: F.when((i % 5 == 2) & (F.length(x) > 0), F.concat(
        F.lpad(F.lit(""), (1 + F.length(x) % 4).cast("int"), "#"), F.lit(" "), x)).otherwise(x)
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(F.split("text", "\n", -1), line), "\n").alias("text"))
    s = G.markdown_sections(docs)
    return s.select("doc_id", "section_no", "level", "title", F.array_join("path", " > ").alias("path"), "body")


# Each line of a document of two lines or more gets a marker (odd lines) or a link (even ones).
C1_TEXT_SQL = """
WITH l AS (
  SELECT doc_id, i, ls[i] AS line, len(ls) AS n,
         CASE WHEN i % 2 = 1 THEN '【' || i || ':' || (doc_id % 7) || '†part' || (i % 5) || '.md】' ELSE '[Source ' || i || '](https://example.com/d/' || doc_id || ')' END AS marker
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))
  WHERE len(ls) > 1),
p AS (SELECT *, coalesce(sum(length(line) + 1 + length(marker) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               + length(line) + 1 AS start_index FROM l)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, CASE WHEN i % 2 = 1 THEN 'file' ELSE 'url' END AS kind, marker,
       CASE WHEN i % 2 = 1 THEN 'part' || (i % 5) || '.md' ELSE 'Source ' || i END AS title,
       CASE WHEN i % 2 = 0 THEN 'https://example.com/d/' || doc_id WHEN i % 5 < 4 THEN 'file-' || (i % 5) END AS target,
       CAST(start_index AS BIGINT) AS start_index, CAST(start_index + length(marker) AS BIGINT) AS end_index, trim(line) AS quote
FROM p"""


@register("c1_text_citations", C1_TEXT_SQL)
def c1_text_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File and URL citations with spans and quotes, from markers and links put into the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n", -1).alias("w")).where(F.size("w") > 1)

    def marked(x, i):
        n = (i + 1).cast("string")
        file = F.concat(F.lit("【"), n, F.lit(":"), (F.col("doc_id") % 7).cast("string"), F.lit("†part"), ((i + 1) % 5).cast("string"), F.lit(".md】"))
        url = F.concat(F.lit("[Source "), n, F.lit("](https://example.com/d/"), F.col("doc_id").cast("string"), F.lit(")"))
        return F.concat(x, F.lit(" "), F.when((i + 1) % 2 == 1, file).otherwise(url))

    files = spark.range(4).select(F.concat(F.lit("part"), "id", F.lit(".md")).alias("title"), F.concat(F.lit("file-"), "id").alias("file_id"))
    c = G.text_citations(docs.select("doc_id", F.array_join(F.transform("w", marked), "\n").alias("text")), files)
    return c.select("doc_id", "pos", "kind", "marker", "title", "target", "start_index", "end_index", "quote")


K7_SQL = f"""
WITH p AS (
  SELECT page_id, CASE WHEN len(cut) > 1 THEN list_transform(cut[2:], lambda x:
                         regexp_extract(x, {_sql_lit(G.PARAGRAPH_TEXT)}, 1)) ELSE [''] END AS ps,
         regexp_extract_all(html, {_sql_lit(G.HTML_LINK)}, 1) AS u,
         regexp_extract_all(html, {_sql_lit(G.HTML_LINK)}, 2) AS t
  FROM (SELECT *, regexp_split_to_array(coalesce(html, ''), {_sql_lit(G.PARAGRAPH)}) AS cut FROM pages)
),
parts AS (SELECT page_id, i - 1 AS part_no, regexp_replace(ps[i], '<[^>]+>', '', 'g') AS text
          FROM (SELECT page_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM p)),
links AS (SELECT page_id, i - 1 AS pos, u[i] AS url, t[i] AS title
          FROM (SELECT page_id, u, t, unnest(range(1, len(u) + 1)) AS i FROM p)),
firsts AS (SELECT page_id, url, min(pos) AS pos, arg_min(title, pos) AS title
           FROM links GROUP BY page_id, url),
body AS (SELECT page_id, string_agg(text, chr(10) || chr(10) ORDER BY part_no) AS body
         FROM parts GROUP BY page_id),
refs AS (SELECT page_id, string_agg('- [' || coalesce(nullif(title, ''), url) || '](' || url || ')',
                                    chr(10) ORDER BY pos) AS refs
         FROM firsts GROUP BY page_id)
SELECT body.page_id AS message_id,
       CASE WHEN refs.refs IS NOT NULL
            THEN body.body || chr(10) || chr(10) || '## References' || chr(10) || refs.refs
            ELSE body.body END AS document
FROM body LEFT JOIN refs USING (page_id)"""


@register("k7_page_summaries", K7_SQL)
def k7_page_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary documents per page: paragraph texts joined by blank lines, then the
    page's unique references in first-seen order."""
    from tessera.sources.sinks import summary_documents
    pages = table(spark, sf_dir, "pages")
    parts = pages.select(F.col("page_id").alias("message_id"), F.posexplode(
        G.paragraphs(F.col("html"))).alias("part_no", "p"))
    links = G.extract_links(F.col("html"))
    refs = pages.select(F.col("page_id").alias("message_id"), links.alias("refs"))
    rows = parts.select("message_id", "part_no", G.strip_tags(F.col("p")).alias("text")).join(
        refs, "message_id").withColumn(
        "refs", F.when(F.col("part_no") == 0, F.col("refs")).otherwise(
            F.array().cast("array<struct<url:string,title:string>>")))
    return summary_documents(rows, "message_id")


C6_SQL = f"""
WITH im AS (SELECT 'fig-' || (p_partkey % {IMAGE_NAMES}) || '.png' AS name, min('data:image/png;base64,' || md5(CAST(p_partkey AS VARCHAR))) AS uri
            FROM part GROUP BY 1),
d AS (SELECT doc_id, text, 'fig-' || (doc_id % {2 * IMAGE_NAMES}) || '.png' AS name FROM documents)
SELECT doc_id, coalesce(chr(10) || chr(10) || '![chart](' || uri || ')', '') || ' ' || text || ' ' ||
       coalesce(chr(10) || chr(10) || '![see](' || uri || ')', '') || '  ![d](data:image/png;base64,AA) [w](https://example.org/' || name || ')' AS text
FROM d LEFT JOIN im USING (name)"""


@register("c6_replaced_images", C6_SQL)
def c6_replaced_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken references of every document replaced by the image of that file name, or dropped."""
    return G.replace_broken_images(illustrated(table(spark, sf_dir, "documents")),
                                   image_files(table(spark, sf_dir, "part")), "doc_id")


# A threshold for each cell; self-harm in completions has none.
POLICY = {("hate", "prompt"): "medium", ("hate", "completion"): "low", ("sexual", "prompt"): "high",
          ("sexual", "completion"): "medium", ("violence", "prompt"): "high", ("violence", "completion"): "high",
          ("self_harm", "prompt"): "low"}
GRID_SQL = f"""
WITH c AS (SELECT unnest({list(G.CATEGORIES)}) AS category, unnest(range(4)) AS i),
s AS (SELECT category, CASE role WHEN 'user' THEN 'prompt' ELSE 'completion' END AS source, (conv_id * 7 + turn * 3 + i * 5) % 5 AS n
      FROM conversations, c WHERE role IN ('user', 'assistant')),
p AS (SELECT * FROM (VALUES {", ".join(f"('{c}', '{s}', {G.SEVERITIES.index(t)})" for (c, s), t in POLICY.items())}) AS v(category, source, least_))
SELECT category, source, {list(G.SEVERITIES)}[n + 1] AS severity, coalesce(n <= 3 AND n >= least_, false) AS blocked, count(*) AS messages
FROM s LEFT JOIN p USING (category, source) GROUP BY ALL"""


@register("g6_policy_grid", GRID_SQL)
def g6_policy_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four categories in both sources against a threshold for each, over every message;
    one severity in five is not known."""
    conv = table(spark, sf_dir, "conversations").where(F.col("role").isin("user", "assistant"))
    number = [((F.col("conv_id") * 7 + F.col("turn") * 3 + i * 5) % 5).cast("int") for i in range(len(G.CATEGORIES))]
    levels = F.array(*[F.lit(s) for s in G.SEVERITIES])
    scores = conv.select(F.when(F.col("role") == "user", "prompt").otherwise("completion").alias("source"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("category"), F.get(levels, n).alias("severity")) for c, n in zip(G.CATEGORIES, number)])).alias("x"))
    blocked = G.apply_policy_cells(scores.select("source", "x.*"), POLICY)
    return blocked.groupBy("category", "source", "severity", "blocked").agg(F.count(F.lit(1)).alias("messages"))
