"""Registered queries for sources and talk-page parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from modlake.checks import inputs as I
from modlake.checks import sql as Q
from modlake.checks.registry import query
from modlake.plans import talk
from modlake.session import dealt
from modlake.sources import export, labelled, mediawiki

# Every document becomes a talk page: its lines are dressed up by position.
WIKI = r"""
pages0 AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
raw AS (SELECT doc_id, unnest(range(0, len(lines))) AS line_no, unnest(lines) AS t FROM pages0),
lines AS (SELECT doc_id, line_no, CASE (line_no + doc_id) % 10
   WHEN 0 THEN '== Topic ' || line_no || ' =='
   WHEN 1 THEN '{{quote}} ' || t
   WHEN 2 THEN repeat(':', (line_no % 4)::INT) || t || ' [[User:Ann|talk]] 14:30, ' || (line_no % 33) || ' May 2024 (UTC)'
   WHEN 3 THEN '  ' || t
   WHEN 4 THEN '* #' || t || ' [[User:Bob#top]] no stamp'
   WHEN 6 THEN '[[User: Eve ]] 09:05, 31 February 2023 (UTC)'
   WHEN 7 THEN '   '
   WHEN 8 THEN t || ' [[User:]] x'
   ELSE t END AS line FROM raw)"""
SPQ = Q.SP
_STRIP = rf"regexp_replace(line, '^[{SPQ}]+|[{SPQ}]+$', '', 'g')"
KINDS = rf"""{WIKI},
bare AS (SELECT *, {_STRIP} AS b FROM lines),
kinds AS (SELECT *, CASE
    WHEN starts_with(b, '==') AND ends_with(b, '==') THEN 'header'
    WHEN b = '' OR starts_with(b, '{{{{') OR starts_with(b, '|') OR starts_with(b, '<')
         OR starts_with(b, '}}}}') OR b IN (':', '::') THEN 'skip'
    WHEN regexp_matches(line, '\[\[User:([^\]|#]+)') THEN 'signature'
    ELSE 'buffer' END AS kind FROM bare),
sec AS (SELECT *, coalesce(last_value(CASE WHEN kind = 'header' THEN trim(b, '= ') END IGNORE NULLS)
    OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), '') AS section FROM kinds)"""
COMMENTS = rf"""{KINDS},
grp AS (SELECT *, coalesce(sum(CASE WHEN kind IN ('header', 'signature') THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g
    FROM sec WHERE kind <> 'skip'),
body AS (SELECT *, CASE kind WHEN 'buffer' THEN b WHEN 'signature' THEN
    regexp_replace(regexp_replace(substr(line, 1, strpos(line, '[[User:') - 1), '^[{SPQ}]+|[{SPQ}]+$', '', 'g'),
                   '^[:#* ]+', '') END AS part FROM grp),
merged AS (SELECT doc_id, g, min(line_no) AS first_line,
    string_agg(nullif(part, ''), chr(10) ORDER BY line_no) AS text,
    max(CASE WHEN kind = 'signature' THEN line END) AS signed,
    max(CASE WHEN kind = 'buffer' OR kind = 'signature' THEN section END) AS section
    FROM body GROUP BY doc_id, g),
comments AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY first_line) AS seq,
    CASE WHEN signed IS NULL THEN '' ELSE trim(regexp_extract(signed, '\[\[User:([^\]|#]+)', 1)) END AS author,
    strftime(try_cast(CASE regexp_extract(signed, ' (\w+) [0-9]{{4}} \(UTC\)', 1) WHEN 'May' THEN '2024-5-'
        WHEN 'February' THEN '2023-2-' END || regexp_extract(signed, '[0-9]{{2}}:[0-9]{{2}}, ([0-9]+) ', 1) || ' '
        || regexp_extract(signed, '([0-9]{{2}}:[0-9]{{2}}),', 1) || ':00' AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') AS ts,
    text, section,
    CASE WHEN signed IS NULL THEN 1 ELSE greatest(1, len(regexp_replace(
        regexp_extract(signed, '^[:#* \t]*'), '[ \t]', '', 'g'))) END AS level,
    coalesce(signed, '') AS raw_wikitext
    FROM merged WHERE text IS NOT NULL)"""


def talk_pages(spark, sf_dir):
    def dress(line, i):
        def glue(*parts):
            return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

        kind, n = (i + F.col("doc_id")) % 10, i.cast("string")
        return (
            F.when(kind == 0, glue("== Topic ", n, " =="))
            .when(kind == 1, glue("{{quote}} ", line))
            .when(kind == 2, glue(
                F.repeat(F.lit(":"), i % 4), line, " [[User:Ann|talk]] 14:30, ",
                (i % 33).cast("string"), " May 2024 (UTC)"))
            .when(kind == 3, glue("  ", line))
            .when(kind == 4, glue("* #", line, " [[User:Bob#top]] no stamp"))
            .when(kind == 6, F.lit("[[User: Eve ]] 09:05, 31 February 2023 (UTC)"))
            .when(kind == 7, F.lit("   "))
            .when(kind == 8, glue(line, " [[User:]] x"))
            .otherwise(line)
        )

    docs = dealt(I.table(spark, sf_dir, "documents"))
    lines = F.transform(F.split("text", "\n"), dress)
    return docs.select("doc_id", F.array_join(lines, "\n").alias("wikitext"))


@query("talk_line_kinds", f"WITH {KINDS} SELECT doc_id, line_no, kind FROM kinds")
def talk_line_kinds(spark, sf_dir):
    return talk.line_kinds(talk_pages(spark, sf_dir), "wikitext", "doc_id")


@query("talk_sections", f"WITH {KINDS} SELECT doc_id, line_no, section FROM sec")
def talk_sections(spark, sf_dir):
    return talk.line_sections(talk_pages(spark, sf_dir), "wikitext", "doc_id")


def _comments(spark, sf_dir, limit=None):
    return talk.wikitext_comments(talk_pages(spark, sf_dir), keep=["doc_id"], limit=limit)


@query("talk_comments", f"WITH {COMMENTS} SELECT * FROM comments")
def talk_comments(spark, sf_dir):
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    return _comments(spark, sf_dir).withColumn("ts", stamp).drop("timestamp")


@query("talk_comments_limited", f"""WITH {COMMENTS}
SELECT doc_id, seq, '' AS id, author, coalesce(ts, '') AS timestamp, text FROM comments WHERE seq <= 3""")
def talk_comments_limited(spark, sf_dir):
    return talk.comment_rows(_comments(spark, sf_dir, limit=3), ["doc_id"])


@query("export_csv_projection", f"""WITH {COMMENTS}
SELECT author, coalesce(ts, '') AS timestamp, section, level, substr(text, 1, 200) AS text FROM comments""")
def export_csv_projection(spark, sf_dir):
    return export.csv_projection(_comments(spark, sf_dir))


@query("export_text_blocks", f"""WITH {COMMENTS}
SELECT chr(10) || repeat('=', 70) || chr(10) || 'Author: ' || author || chr(10)
  || 'Timestamp: ' || coalesce(replace(ts, 'T', ' '), 'None') || chr(10) || 'Section: ' || section
  || chr(10) || 'Level: ' || level || chr(10) || repeat('─', 70) || chr(10) || text AS value FROM comments""")
def export_text_blocks(spark, sf_dir):
    return export.text_blocks(_comments(spark, sf_dir))


HTML = r"""
html AS (SELECT page_id, string_split(replace(replace(replace(html, '<p>', chr(10) || '<div id="c">'),
   '<li>', chr(10) || '<h3>'), '</li>', '</h3>'), chr(10)) AS lines FROM pages),
lines AS (SELECT page_id, unnest(range(0, len(lines))) AS line_no, unnest(lines) AS line FROM html)"""


@query("talk_comments_html", rf"""WITH {HTML},
sec AS (SELECT *, coalesce(last_value(CASE WHEN (contains(line, '<h2>') OR contains(line, '<h3>'))
   AND regexp_matches(line, '<h[23]>(.+?)</h[23]>') THEN trim(regexp_extract(line, '<h[23]>(.+?)</h[23]>', 1)) END
   IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), '') AS section FROM lines)
SELECT page_id, line_no, 'Unknown' AS author, regexp_extract(line, '>(.+?)<', 1) AS text, section,
       1 AS level, line AS raw_wikitext
FROM sec WHERE contains(line, '<div') AND contains(line, 'id=') AND regexp_matches(line, '>(.+?)<')""")
def talk_comments_html(spark, sf_dir):
    html = F.col("html")
    for old, new in (("<p>", '\n<div id="c">'), ("<li>", "\n<h3>"), ("</li>", "</h3>")):
        html = F.replace(html, F.lit(old), F.lit(new))
    pages = I.table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    return talk.html_comments(pages, "html", "page_id")


# --- landed API replies, written by Spark from the shared tables --------------

def _replies(spark, sf_dir):
    """One reply per document: slots form, old form, missing page, or no revisions."""
    kind, key = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    title = F.concat(F.lit("Talk:Doc "), key)

    def body(page_id, page):
        pages = F.create_map(page_id, page)
        return F.to_json(F.struct(F.struct(pages.alias("pages")).alias("query")))

    text = F.col("text").alias("*")
    slots = F.struct(title.alias("title"), F.array(F.struct(
        F.struct(F.struct(text).alias("main")).alias("slots"))).alias("revisions"))
    old = F.struct(title.alias("title"), F.array(F.struct(text)).alias("revisions"))
    empty = F.struct(title.alias("title"), F.array(F.struct(F.lit("").alias("*"))).alias("revisions"))
    gone = F.struct(title.alias("title"))
    return dealt(I.table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.when(kind == 0, body(key, slots)).when(kind == 1, body(key, old))
        .when(kind == 2, body(F.lit("-1"), old)).when(kind == 3, body(key, gone))
        .otherwise(body(key, empty)).alias("body"),
    )


@query("mediawiki_wikitext", """
SELECT doc_id::VARCHAR AS page_id, 'Talk:Doc ' || doc_id AS title, text AS wikitext
FROM (SELECT *, CASE doc_id % 5 WHEN 0 THEN 'slots' WHEN 1 THEN 'old' ELSE 'none' END AS form FROM documents)
WHERE form <> 'none'""")
def mediawiki_wikitext(spark, sf_dir):
    return mediawiki.wikitext(_replies(spark, sf_dir))


@query("mediawiki_metadata", """
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Doc ' || doc_id ELSE source END AS title,
       CASE doc_id % 3 WHEN 0 THEN text ELSE '' END AS summary,
       CASE doc_id % 3 WHEN 0 THEN 'https://en.wikipedia.org/wiki/' || doc_id ELSE '' END AS url
FROM documents""")
def mediawiki_metadata(spark, sf_dir):
    kind, key = F.col("doc_id") % 3, F.col("doc_id").cast("string")

    def body(pages):
        return F.to_json(F.struct(F.struct(pages.alias("pages")).alias("query")))

    full = F.create_map(key, F.struct(
        F.concat(F.lit("Doc "), key).alias("title"), F.col("text").alias("extract"),
        F.concat(F.lit("https://en.wikipedia.org/wiki/"), key).alias("fullurl")))
    bare = F.create_map(key, F.struct(F.lit(1).alias("ns")))
    replies = I.table(spark, sf_dir, "documents").select(
        "doc_id", "source",
        F.when(kind == 0, body(full)).when(kind == 1, body(bare))
        .otherwise(F.lit('{"query": {}}')).alias("body"),
    )
    return mediawiki.metadata(replies, "source", keep=("doc_id",))


@query("mediawiki_recent_changes", """
SELECT conv_id::VARCHAR AS page_id, 'T' || turn AS timestamp, role AS user, text AS comment,
       len(text)::BIGINT AS size FROM conversations""")
def mediawiki_recent_changes(spark, sf_dir):
    # One reply per turn; a reply with many revisions is covered by the tests.
    revision = F.struct(
        F.concat(F.lit("T"), F.col("turn").cast("string")).alias("timestamp"),
        F.col("role").alias("user"), F.col("text").alias("comment"),
        F.length("text").alias("size"),
    )
    pages = F.create_map(
        F.col("conv_id").cast("string"), F.struct(F.array(revision).alias("revisions"))
    )
    replies = I.table(spark, sf_dir, "conversations").select(
        F.to_json(F.struct(F.struct(pages.alias("pages")).alias("query"))).alias("body")
    )
    return mediawiki.recent_changes(replies)


@query("labelled_load_summary", """
SELECT count(*) AS total_rows, round(avg(toxic), 6) AS toxic_rate
FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL AND toxic IS NOT NULL""")
def labelled_load_summary(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("comment_text"))
    joined = docs.join(I.table(spark, sf_dir, "labels"), "doc_id", "left")
    summary = labelled.load_summary(labelled.clean_labelled(joined))
    return summary.withColumn("toxic_rate", F.round("toxic_rate", 6))
