"""Registered queries for scalar rules and the moderation store."""

from __future__ import annotations

from pyspark.sql import functions as F

from modlake.checks import inputs as I
from modlake.checks import sql as Q
from modlake.checks.registry import query
from modlake.functions import moderation as rules
from modlake.functions import text as X
from modlake.functions import urls as U
from modlake.functions.signature import MONTHS, signature_timestamp
from modlake.plans import moderation as M
from modlake.session import scratch_folder
from modlake.sources import commits
from modlake.sources.stored_json import INFERENCE_STATS, TOP_FEATURES, TREND

# --- scalar rules -----------------------------------------------------------

URLS = """
urls AS (SELECT page_id, CASE page_id % 8
    WHEN 0 THEN 'https://en.wikipedia.org/wiki/src' || (page_id % 25) || '%20a+b'
    WHEN 1 THEN 'HTTP://Wikipedia.org:80/wiki/Talk:Page_' || page_id || '?x=/y#z'
    WHEN 2 THEN 'https://en.wikipedia.org.example.com/wiki/Page_' || page_id
    WHEN 3 THEN 'ftp://en.wikipedia.org/wiki/Page_' || page_id
    WHEN 4 THEN 'https://en.wikipedia.org/w/index.php?title=/wiki/' || page_id
    WHEN 5 THEN 'Talk:Page ' || page_id
    WHEN 6 THEN replace(url, 'example', 'wiki/example')
    ELSE url END AS url FROM pages)"""
_SITE_SQL = r"""(regexp_matches(lower(url), '^https?://[^/?#]*')
    AND regexp_matches(regexp_extract(lower(url), '^https?://(?:[^/?#]*@)?([^/?#:]*)', 1), '(^|\.)wikipedia\.org$')
    AND contains(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/wiki/'))"""
_PATH_SQL = r"regexp_replace(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"


def urls(spark, sf_dir):
    page, kind = F.col("page_id").cast("string"), F.col("page_id") % 8
    wiki = "https://en.wikipedia.org/wiki/"
    return I.table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(kind == 0, F.concat(
            F.lit(wiki + "src"), (F.col("page_id") % 25).cast("string"), F.lit("%20a+b")))
        .when(kind == 1, F.concat(F.lit("HTTP://Wikipedia.org:80/wiki/Talk:Page_"), page, F.lit("?x=/y#z")))
        .when(kind == 2, F.concat(F.lit("https://en.wikipedia.org.example.com/wiki/Page_"), page))
        .when(kind == 3, F.concat(F.lit("ftp://en.wikipedia.org/wiki/Page_"), page))
        .when(kind == 4, F.concat(F.lit("https://en.wikipedia.org/w/index.php?title=/wiki/"), page))
        .when(kind == 5, F.concat(F.lit("Talk:Page "), page))
        .when(kind == 6, F.replace("url", F.lit("example"), F.lit("wiki/example")))
        .otherwise(F.col("url")).alias("url"),
    )


@query("wiki_url_filter", f"WITH {URLS} SELECT page_id, {_SITE_SQL} AS allowed FROM urls")
def wiki_url_filter(spark, sf_dir):
    return urls(spark, sf_dir).select("page_id", U.is_article_url(F.col("url")).alias("allowed"))


@query("wiki_title", f"""WITH {URLS}, p AS (SELECT *, {_PATH_SQL} AS path FROM urls)
SELECT page_id, CASE WHEN {_SITE_SQL} THEN
  nullif(url_decode(substr(path, strpos(path, '/wiki/') + 6)), '') END AS title FROM p""")
def wiki_title(spark, sf_dir):
    return urls(spark, sf_dir).select("page_id", U.article_title(F.col("url")).alias("title"))


@query("page_title_normalise", f"""WITH {URLS}, p AS (SELECT *, {_PATH_SQL} AS path FROM urls),
t AS (SELECT page_id, CASE
    WHEN NOT (starts_with(url, 'http://') OR starts_with(url, 'https://')) THEN url
    WHEN contains(path, '/wiki/') THEN url_decode(substr(path, strpos(path, '/wiki/') + 6)) END AS t
  FROM p)
SELECT page_id, CASE WHEN starts_with(t, 'Talk:') THEN substr(t, 6) ELSE t END AS title,
       CASE WHEN t IS NULL THEN 'URL must be an article URL containing /wiki/' END AS error FROM t""")
def page_title_normalise(spark, sf_dir):
    url = F.col("url")
    return urls(spark, sf_dir).select(
        "page_id", U.page_title(url).alias("title"), U.page_title_error(url).alias("error")
    )


@query("slugify", r"""SELECT conv_id, turn, array_to_string(list_filter(
  regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> ''), '-') AS slug
FROM conversations""")
def slugify(spark, sf_dir):
    return I.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", X.slugify(F.col("text")).alias("slug")
    )


@query("comment_id", f"""WITH {Q.COMMENTS}
SELECT doc_id, md5(timestamp || '-' || author || '-' || text) AS id FROM comments""")
def comment_id(spark, sf_dir):
    df = I.comments(spark, sf_dir)
    return df.select(
        "doc_id", rules.comment_id(F.col("timestamp"), F.col("author"), F.col("text")).alias("id")
    )


@query("moderation_decision", """
SELECT event_id, CASE WHEN t >= 0.75 THEN 'auto-ban' WHEN t >= 0.55 THEN 'manual-review' ELSE 'none' END
  AS decision, t >= 0.55 AS is_flagged
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0::DOUBLE
      ELSE round(value / (value + 5.0::DOUBLE), 2) END AS t FROM events)""")
def moderation_decision(spark, sf_dir):
    # Negative or huge values are fine here: the rule only compares.
    toxicity = F.when(F.col("event_type") != "error", F.round(F.col("value") / (F.col("value") + 5.0), 2))
    df = I.table(spark, sf_dir, "events").withColumn("t", toxicity)
    score = F.coalesce("t", F.lit(0.0))
    return df.select(
        "event_id", rules.decide(F.col("t"), 0.75, 0.55).alias("decision"),
        (score >= 0.55).alias("is_flagged"),
    )


@query("signature_timestamp", f"""
WITH s AS (SELECT conv_id, turn, conv_id % 26 AS h, (conv_id * 7 + turn * 11) % 34 AS d,
  CASE (conv_id + turn) % 13 WHEN 12 THEN 'Foo' ELSE
    list_extract({list(MONTHS)}, ((conv_id + turn) % 13 + 1)::INT) END AS m, 2000 + conv_id % 25 AS y
  FROM conversations)
SELECT conv_id, turn, CASE WHEN h < 24 THEN strftime(try_cast(
  y || '-' || CASE m WHEN 'Foo' THEN 1 ELSE list_position({list(MONTHS)}, m) END || '-' || d || ' '
  || h || ':' || (turn * 9) % 60 || ':00' AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') END AS ts FROM s""")
def signature(spark, sf_dir):
    conv, turn = F.col("conv_id"), F.col("turn")
    months = F.array(*[F.lit(m) for m in (*MONTHS, "Foo")])
    text = F.format_string(
        "%s [[User:x]] %02d:%02d, %d %s %d (UTC) end",
        F.col("text"), conv % 26, (turn * 9) % 60, (conv * 7 + turn * 11) % 34,
        F.get(months, ((conv + turn) % 13).cast("int")), 2000 + conv % 25,
    )
    ts = F.date_format(signature_timestamp(F.col("signed")), "yyyy-MM-dd'T'HH:mm:ss")
    return (
        I.table(spark, sf_dir, "conversations").withColumn("signed", text)
        .select("conv_id", "turn", ts.alias("ts"))
    )


@query("leet_normalise", """SELECT doc_id, regexp_replace(translate(lower(text),
 '@$501!37+', 'assoiiett'), '[^a-z]', '', 'g') AS plain FROM documents""")
def leet_normalise(spark, sf_dir):
    return I.table(spark, sf_dir, "documents").select("doc_id", X.leet(F.col("text")).alias("plain"))


@query("input_violations", """
WITH e AS (SELECT d.doc_id, d.doc_id % 260 - 20 AS lim, (d.doc_id % 3) * 600000 AS off,
  (d.doc_id % 13) / 10 AS a, (d.doc_id % 7) / 10 AS m,
  CASE d.doc_id % 4 WHEN 0 THEN 'flagged' WHEN 1 THEN 'banned' WHEN 2 THEN NULL ELSE 'none' END AS dec,
  CASE d.doc_id % 3 WHEN 0 THEN 'newest' WHEN 1 THEN NULL ELSE 'decision_asc' END AS so,
  CASE d.doc_id % 17 WHEN 0 THEN '  ' ELSE d.text END AS text FROM documents d)
SELECT doc_id, concat_ws(',',
  CASE WHEN lim < 1 OR lim > 200 THEN 'limit' END, CASE WHEN off > 1000000 THEN 'offset' END,
  CASE WHEN a > 1 THEN 'auto_threshold' END, CASE WHEN m > 1 THEN 'manual_threshold' END,
  CASE WHEN m > a THEN 'threshold_order' END, CASE WHEN dec = 'banned' THEN 'decision' END,
  CASE WHEN so = 'newest' THEN 'sort' END, CASE WHEN trim(text) = '' THEN 'missing_text' END,
  CASE WHEN len(text) > 10000 THEN 'text_too_long' END) AS violations FROM e""")
def input_violations(spark, sf_dir):
    i = F.col("doc_id")
    broken = rules.violations(
        limit=i % 260 - 20, offset=(i % 3) * 600000, auto=(i % 13) / 10, manual=(i % 7) / 10,
        decision=F.when(i % 4 == 0, "flagged").when(i % 4 == 1, "banned").when(i % 4 == 3, "none"),
        sort=F.when(i % 3 == 0, "newest").when(i % 3 == 2, "decision_asc"),
        text=F.when(i % 17 == 0, "  ").otherwise(F.col("text")),
    )
    df = I.table(spark, sf_dir, "documents")
    return df.select("doc_id", F.array_join(broken, ",").alias("violations"))


# --- scored comments and articles -------------------------------------------

_COMMENT = ("id", "article_id", "author", "timestamp", "toxicity", "decision", "is_flagged")
_COMMENT_SQL = ", ".join(_COMMENT)


@query("scored_comments", f"{Q.SCORED} SELECT {_COMMENT_SQL}, 'v1' AS model_version, '' AS explain_version FROM scored")
def scored_comments(spark, sf_dir):
    base = I.featured(spark, sf_dir, only=I.model_features())
    base = base.withColumn("toxicity", F.round(I.MODEL.probability(), 6))
    return M.moderate(base, I.AUTO, I.MANUAL, model_version="v1").select(
        *_COMMENT, "model_version", "explain_version"
    )


@query("article_rollup", f"""{Q.SCORED}
SELECT article_id, count(*) AS comments, count(*) FILTER (is_flagged) AS flagged_count,
  count(*) FILTER (inference_ms > 0) AS inference_count,
  coalesce(round(sum(inference_ms) FILTER (inference_ms > 0), 1), 0) AS total_ms,
  coalesce(round(avg(inference_ms) FILTER (inference_ms > 0), 1), 0) AS avg_ms,
  coalesce(round(min(inference_ms) FILTER (inference_ms > 0), 1), 0) AS min_ms,
  coalesce(round(max(inference_ms) FILTER (inference_ms > 0), 1), 0) AS max_ms
FROM scored GROUP BY article_id""")
def article_rollup(spark, sf_dir):
    return M.article_rollup(I.scored(spark, sf_dir))


@query("toxicity_trend", f"""{Q.SCORED}
SELECT article_id, doc_id, split_part(timestamp, 'T', 1) AS date,
  round(sum(toxicity::DECIMAL(18, 9)) OVER (PARTITION BY article_id ORDER BY doc_id
        ROWS UNBOUNDED PRECEDING), 3)::DOUBLE AS score, 0.55::DOUBLE AS threshold FROM scored""")
def toxicity_trend(spark, sf_dir):
    return M.toxicity_trend(I.scored(spark, sf_dir), "doc_id", I.MANUAL)


def _queue(key, order, *, limit=50, offset=0, decision=None, where="TRUE", sort="toxicity_desc"):
    @query(key, f"""{Q.SCORED} SELECT {_COMMENT_SQL} FROM scored
WHERE article_id = 'src7' AND {where} ORDER BY {order}, id LIMIT {limit} OFFSET {offset}""")
    def run(spark, sf_dir):
        return M.comment_page(
            I.scored(spark, sf_dir), "src7", limit=limit, offset=offset,
            decision=decision, sort=sort,
        ).select(*_COMMENT)


_queue("queue_by_toxicity", "toxicity DESC", limit=20)
_queue("queue_by_timestamp", "timestamp DESC", limit=20, sort="timestamp_desc")
_queue(
    "queue_by_decision",
    "CASE decision WHEN 'auto-ban' THEN 1 WHEN 'manual-ban' THEN 2 WHEN 'manual-review' THEN 3 ELSE 4 END",
    limit=15, sort="decision_asc",
)
_queue("queue_flagged", "toxicity ASC", limit=30, decision="flagged", where="is_flagged", sort="toxicity_asc")
_queue("queue_page", "toxicity DESC", limit=10, offset=10)
_queue(
    "queue_one_decision", "timestamp ASC", limit=30, decision="auto-ban",
    where="decision = 'auto-ban'", sort="timestamp_asc",
)


@query("queue_page_info", f"""{Q.SCORED}
SELECT count(*) AS total, greatest(1, ceil(count(*) / 10))::BIGINT AS pages, TRUE AS has_previous,
       20 < count(*) AS has_next FROM scored WHERE article_id = 'src7'""")
def queue_page_info(spark, sf_dir):
    return M.page_info(I.scored(spark, sf_dir), "src7", limit=10, offset=10)


ARTICLES = """
articles AS (SELECT source AS id, source AS title, 'https://en.wikipedia.org/wiki/' || source AS url,
  '' AS summary, strftime(TIMESTAMP '2024-01-01' + to_seconds(max(doc_id) * 4321), '%Y-%m-%dT%H:%M:%S')
  AS created_at, 0.75::DOUBLE AS auto_threshold, 0.55::DOUBLE AS manual_threshold, 'linear' AS model_name
  FROM documents GROUP BY source)"""


def articles(spark, sf_dir):
    stamp = F.timestamp_seconds(F.lit(1704067200) + F.max("doc_id") * 4321)
    docs = I.table(spark, sf_dir, "documents").groupBy(F.col("source").alias("id"))
    return docs.agg(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss").alias("created_at")).select(
        "id", F.col("id").alias("title"),
        F.concat(F.lit("https://en.wikipedia.org/wiki/"), "id").alias("url"),
        F.lit("").alias("summary"), "created_at", F.lit(I.AUTO).alias("auto_threshold"),
        F.lit(I.MANUAL).alias("manual_threshold"), F.lit("linear").alias("model_name"),
    )


@query("article_list", f"WITH {ARTICLES} SELECT * FROM articles ORDER BY created_at DESC")
def article_list(spark, sf_dir):
    return M.article_list(articles(spark, sf_dir))


@query("article_summary", f"WITH {ARTICLES} SELECT * FROM articles WHERE id = 'src7'")
def article_summary(spark, sf_dir):
    return M.article_summary(articles(spark, sf_dir), "src7")


@query("comment_detail", f"""{Q.SCORED}, {ARTICLES}
SELECT s.id, s.article_id, s.decision, s.toxicity, a.title, a.url, a.manual_threshold
FROM scored s JOIN articles a ON a.id = s.article_id""")
def comment_detail(spark, sf_dir):
    return M.comment_detail(articles(spark, sf_dir), I.scored(spark, sf_dir)).select(
        "id", "article_id", "decision", "toxicity", "title", "url", "manual_threshold"
    )


INCOMING = """
incoming AS (SELECT md5(conv_id || '-' || turn || '-' || text) AS id,
  'src' || ((conv_id % 7) * 5) AS article_id, round((turn + 1) / 9, 6) AS toxicity FROM conversations)"""


def incoming(spark, sf_dir):
    return I.table(spark, sf_dir, "conversations").select(
        F.md5(F.concat_ws("-", "conv_id", "turn", "text")).alias("id"),
        F.concat(F.lit("src"), ((F.col("conv_id") % 7) * 5).cast("string")).alias("article_id"),
        F.round((F.col("turn") + 1) / 9, 6).alias("toxicity"),
    )


@query("article_upsert", f"""{Q.SCORED}, {INCOMING}
SELECT id, article_id, toxicity FROM scored WHERE article_id NOT IN (SELECT article_id FROM incoming)
UNION ALL SELECT id, article_id, toxicity FROM incoming""")
def article_upsert(spark, sf_dir):
    batch = incoming(spark, sf_dir)
    heads = batch.select(F.col("article_id").alias("id")).distinct()
    stored = I.scored(spark, sf_dir).select("id", "article_id", "toxicity")
    _, comments = M.upsert(articles(spark, sf_dir), stored, heads, batch)
    return comments


@query("article_upsert_heads", f"""WITH {ARTICLES}, {INCOMING}
SELECT id, created_at FROM articles WHERE id NOT IN (SELECT article_id FROM incoming)
UNION ALL SELECT DISTINCT article_id, NULL FROM incoming""")
def article_upsert_heads(spark, sf_dir):
    batch = incoming(spark, sf_dir)
    heads = batch.select(F.col("article_id").alias("id")).distinct()
    new, _ = M.upsert(articles(spark, sf_dir), batch, heads, batch)
    return new.select("id", "created_at")


_BANNED = """
store AS (SELECT id, article_id, toxicity, is_flagged,
  CASE WHEN doc_id % 11 = 0 THEN 'manual-ban' ELSE decision END AS decision FROM scored),
again AS (SELECT id, article_id, toxicity,
  CASE WHEN decision = 'manual-ban' OR right(article_id, 1) NOT IN ('0','2','4','6','8') THEN decision
       WHEN toxicity >= 0.6 THEN 'auto-ban' WHEN toxicity >= 0.3 THEN 'manual-review' ELSE 'none' END AS decision,
  CASE WHEN decision = 'manual-ban' OR right(article_id, 1) NOT IN ('0','2','4','6','8') THEN is_flagged
       ELSE toxicity >= 0.3 END AS is_flagged FROM store)"""


def _reevaluated(spark, sf_dir):
    store = I.scored(spark, sf_dir).withColumn(
        "decision", F.when(F.col("doc_id") % 11 == 0, "manual-ban").otherwise(F.col("decision"))
    ).select("id", "article_id", "toxicity", "decision", "is_flagged")
    changed = articles(spark, sf_dir).filter(F.substring("id", -1, 1).isin("0", "2", "4", "6", "8"))
    thresholds = changed.select(
        F.col("id").alias("article_id"), F.lit(0.6).alias("auto_threshold"),
        F.lit(0.3).alias("manual_threshold"),
    )
    return M.reevaluate(store, thresholds)


@query("threshold_reevaluation", f"{Q.SCORED}, {_BANNED} SELECT * FROM again")
def threshold_reevaluation(spark, sf_dir):
    return _reevaluated(spark, sf_dir)


@query("threshold_reevaluation_counts", f"""{Q.SCORED}, {_BANNED}
SELECT article_id, count(*) FILTER (is_flagged OR decision = 'manual-ban') AS flagged_count
FROM again GROUP BY article_id""")
def threshold_reevaluation_counts(spark, sf_dir):
    return M.reevaluated_counts(_reevaluated(spark, sf_dir))


def _committed(spark, sf_dir):
    """A store of two commits: all articles, then new thresholds for the even ones."""
    folder = scratch_folder(spark, "commits")
    store = I.scored(spark, sf_dir).select(
        "id", "article_id", "toxicity", "is_flagged",
        F.when(F.col("doc_id") % 11 == 0, "manual-ban").otherwise(F.col("decision")).alias("decision"),
    )
    heads = articles(spark, sf_dir).withColumn("flagged_count", F.lit(-1).cast("bigint"))
    commits.write(heads, store, folder, 0)
    even = heads.filter(F.substring("id", -1, 1).isin("0", "2", "4", "6", "8"))
    commits.reevaluate(spark, folder, even.select(
        F.col("id").alias("article_id"), F.lit(0.6).alias("auto_threshold"), F.lit(0.3).alias("manual_threshold")), 1)
    return commits.read(spark, folder)


@query("committed_comments", f"{Q.SCORED}, {_BANNED} SELECT * FROM again")
def committed_comments(spark, sf_dir):
    return _committed(spark, sf_dir)[1].select("id", "article_id", "toxicity", "decision", "is_flagged")


@query("committed_articles", f"""{Q.SCORED}, {_BANNED}, {ARTICLES}
SELECT a.id, a.title, CASE WHEN changed THEN 0.6::DOUBLE ELSE auto_threshold END AS auto_threshold,
  CASE WHEN changed THEN 0.3::DOUBLE ELSE manual_threshold END AS manual_threshold,
  CASE WHEN changed THEN (SELECT count(*) FROM again g WHERE g.article_id = a.id
    AND (g.is_flagged OR g.decision = 'manual-ban')) ELSE -1 END AS flagged_count
FROM (SELECT *, right(id, 1) IN ('0','2','4','6','8') AS changed FROM articles) a""")
def committed_articles(spark, sf_dir):
    return _committed(spark, sf_dir)[0].select("id", "title", "auto_threshold", "manual_threshold", "flagged_count")


@query("decision_override", f"""{Q.SCORED}
SELECT id, is_flagged, CASE WHEN l.quality = 0 THEN 'manual-ban' ELSE decision END AS decision
FROM scored s LEFT JOIN labels l ON l.doc_id = s.doc_id""")
def decision_override(spark, sf_dir):
    comments = I.scored(spark, sf_dir)
    low = I.table(spark, sf_dir, "labels").filter("quality = 0").select("doc_id")
    ids = I.comments(spark, sf_dir).join(low, "doc_id").select(
        rules.comment_id(F.col("timestamp"), F.col("author"), F.col("text")).alias("id"),
        F.lit("manual-ban").alias("decision"),
    )
    return M.override_decisions(comments.select("id", "decision", "is_flagged"), ids)


@query("stale_explanations", f"""{Q.SCORED}
SELECT id FROM (SELECT id,
  CASE doc_id % 4 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE 1 END AS n_top,
  CASE doc_id % 4 WHEN 2 THEN 'v0' ELSE 'v1' END AS version FROM scored)
WHERE coalesce(n_top, 0) = 0 OR version <> 'v1'""")
def stale_explanations(spark, sf_dir):
    kind = F.col("doc_id") % 4
    one = F.array(F.struct(F.lit("char_count").alias("feature"), F.lit(1.0).alias("value")))
    df = I.scored(spark, sf_dir).withColumns({
        "top_features": F.when(kind == 0, F.slice(one, 1, 0)).when(kind != 1, one),
        "explain_version": F.when(kind == 2, "v0").otherwise("v1"),
    })
    return M.stale_explanations(df, "v1").select("id")


# Stored JSON texts, whole and damaged in eight ways by document number.
_TOP_SQL = """CASE doc_id % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '[{"feature":"char_count","va'
  WHEN 3 THEN '{"feature":"char_count"}' WHEN 4 THEN '[{"feature":"char_count","shap":0.5}, null, 7]'
  WHEN 5 THEN '[{"feature":"char_count","value":"many","shap":0.25}] x'
  WHEN 6 THEN '[{"feature":"char_count","value":"many","shap":0.25,"more":[1]}]'
  ELSE '[{"feature":"char_count","value":' || length(text) || ',"shap":0.5},{"feature":"word_count","value":1,"shap":-0.5}]' END"""


def _stored(spark, sf_dir, *more):
    return I.scored(spark, sf_dir).select("id", "doc_id", "text", *more, F.expr(_TOP_SQL).alias("top_features_json"))


@query("stored_top_features", f"""{Q.SCORED}
SELECT id, doc_id % 8 IN (2, 3, 5) AS unreadable,
  CASE doc_id % 8 WHEN 4 THEN 1 WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END AS features,
  CASE WHEN doc_id % 8 IN (4, 6, 7) THEN 'char_count' END AS feature,
  CASE WHEN doc_id % 8 = 7 THEN length(text)::DOUBLE END AS value,
  CASE doc_id % 8 WHEN 4 THEN 0.5::DOUBLE WHEN 6 THEN 0.25 WHEN 7 THEN 0.5 END AS shap FROM scored""")
def stored_top_features(spark, sf_dir):
    text = F.col("top_features_json")
    df = _stored(spark, sf_dir).withColumns({"top": TOP_FEATURES.decode(text), "unreadable": TOP_FEATURES.unreadable(text)})
    first = F.get("top", F.lit(0))
    return df.select("id", "unreadable", F.size("top").alias("features"), *[first[c].alias(c) for c in ("feature", "value", "shap")])


# The stored columns of an article as JSON text, damaged for some articles by the last character of the id.
_ARTICLE_SQL = {
    "trend": """CASE right(article_id, 1) WHEN '0' THEN NULL WHEN '1' THEN '{"dates":["' WHEN '2' THEN '[]'
      WHEN '3' THEN '{"dates":"2024-01-01","scores":[0.5],"threshold":0.55}'
      ELSE '{"dates":["' || min(left(timestamp, 10)) || '","' || max(left(timestamp, 10)) || '"],"scores":[0.25,' ||
        count(*) || '],"threshold":0.55,"more":{}}' END""",
    "stats": """CASE right(article_id, 1) WHEN '0' THEN '' WHEN '1' THEN '{"count":' || count(*) || '}'
      WHEN '2' THEN '{"count":"some","avg_ms":1.5}' ELSE '{"count":' || count(*) || ',"total_ms":7,"avg_ms":0.5,"min_ms":0.25,"max_ms":' || count(*) || '}' END""",
}


@query("stored_article_columns", f"""{Q.SCORED}, heads AS (SELECT article_id, right(article_id, 1) AS k, count(*) AS n,
  min(left(timestamp, 10)) AS a, max(left(timestamp, 10)) AS b FROM scored GROUP BY article_id)
SELECT article_id, k IN ('1', '2') AS bad_trend, CASE WHEN k IN ('0', '1', '2', '3') THEN 0 ELSE 2 END AS dates,
  CASE WHEN k NOT IN ('0', '1', '2', '3') THEN a END AS first_date, CASE WHEN k NOT IN ('0', '1', '2', '3') THEN b END AS last_date,
  CASE WHEN k IN ('0', '1', '2') THEN NULL WHEN k = '3' THEN 0.5 ELSE n END::DOUBLE AS last_score,
  CASE WHEN k NOT IN ('0', '1', '2') THEN 0.55::DOUBLE END AS threshold,
  CASE WHEN k IN ('0', '2') THEN 0 ELSE n END AS inference_count,
  CASE WHEN k = '2' THEN 1.5 WHEN k IN ('0', '1') THEN 0 ELSE 0.5 END::DOUBLE AS avg_ms,
  CASE WHEN k IN ('0', '1', '2') THEN 0 ELSE n END::DOUBLE AS max_ms FROM heads""")
def stored_article_columns(spark, sf_dir):
    texts = I.scored(spark, sf_dir).groupBy("article_id").agg(*[F.expr(sql).alias(name) for name, sql in _ARTICLE_SQL.items()])
    df = texts.select(
        "article_id", TREND.unreadable(F.col("trend")).alias("bad_trend"),
        TREND.decode(F.col("trend")).alias("trend"), INFERENCE_STATS.decode(F.col("stats")).alias("stats"),
    )
    return df.select(
        "article_id", "bad_trend", F.size("trend.dates").alias("dates"), F.get("trend.dates", F.lit(0)).alias("first_date"),
        F.get("trend.dates", F.lit(1)).alias("last_date"), F.try_element_at("trend.scores", F.lit(-1)).alias("last_score"),
        "trend.threshold", F.col("stats.count").alias("inference_count"), "stats.avg_ms", "stats.max_ms",
    )


@query("explanation_write_back", f"""{Q.SCORED}
SELECT id, CASE WHEN doc_id % 8 IN (4, 6, 7) AND doc_id % 3 > 0 THEN 'v1' WHEN doc_id % 5 > 0 THEN 'v1'
    WHEN doc_id % 3 = 0 THEN 'v0' ELSE 'v1' END AS explain_version,
  CASE WHEN doc_id % 8 IN (4, 6, 7) AND doc_id % 3 > 0
         THEN CASE doc_id % 8 WHEN 4 THEN '[{{"feature":"char_count","shap":0.5}}]' WHEN 6 THEN '[{{"feature":"char_count","shap":0.25}}]'
           ELSE '[{{"feature":"char_count","value":' || length(text) || '.0,"shap":0.5}},{{"feature":"word_count","value":1.0,"shap":-0.5}}]' END
       WHEN doc_id % 5 > 0 THEN '[{{"feature":"exclamation_count","value":' || doc_id % 9 || '.0,"shap":0.125}}]'
       ELSE CASE doc_id % 8 WHEN 4 THEN '[{{"feature":"char_count","shap":0.5}}]' WHEN 6 THEN '[{{"feature":"char_count","shap":0.25}}]'
           WHEN 7 THEN '[{{"feature":"char_count","value":' || length(text) || '.0,"shap":0.5}},{{"feature":"word_count","value":1.0,"shap":-0.5}}]'
           ELSE '[]' END END AS top_features_json FROM scored""")
def explanation_write_back(spark, sf_dir):
    # Decode, pick the stale rows, explain them (every fifth gets nothing), write back as text.
    version = F.when(F.col("doc_id") % 3 == 0, "v0").otherwise("v1")
    df = _stored(spark, sf_dir).withColumns({
        "top_features": TOP_FEATURES.decode(F.col("top_features_json")), "explain_version": version})
    fresh = F.concat(F.lit('[{"feature":"exclamation_count","value":'), (F.col("doc_id") % 9).cast("string"), F.lit(',"shap":0.125}]'))
    explained = M.stale_explanations(df, "v1").select(
        "id", TOP_FEATURES.decode(F.when(F.col("doc_id") % 5 > 0, fresh)).alias("top_features"))
    out = M.with_explanations(df.select("id", "top_features", "explain_version"), explained, "v1")
    return out.select("id", "explain_version", TOP_FEATURES.encode(F.col("top_features")).alias("top_features_json"))


_PAIRS = [(0.3, 0.6), (0.55, 0.75), (0.8, 0.4)]


@query("threshold_sweep", f"{Q.SCORED} " + " UNION ALL ".join(
    f"SELECT {min(p)}::DOUBLE AS manual_threshold, {max(p)}::DOUBLE AS auto_threshold,"
    f" round(count(*) FILTER (toxicity < {min(p)}) / count(*), 6) AS safe,"
    f" round(count(*) FILTER (toxicity >= {min(p)} AND toxicity < {max(p)}) / count(*), 6) AS review,"
    f" round(count(*) FILTER (toxicity >= {max(p)}) / count(*), 6) AS ban FROM scored"
    for p in _PAIRS))
def threshold_sweep(spark, sf_dir):
    df = M.threshold_sweep(I.scored(spark, sf_dir), _PAIRS)
    return df.withColumns({c: F.round(c, 6) for c in ("safe", "review", "ban")})


_RESULTS = f"""{URLS}, asked AS (
  SELECT page_id, CASE WHEN page_id % 9 = 0 THEN '' ELSE replace(url, '%20a+b', '') END AS url,
         CASE WHEN page_id % 10 = 0 THEN 0.9 ELSE 0.5 END AS m FROM urls),
p AS (SELECT *, {_PATH_SQL} AS path FROM asked),
res AS (SELECT page_id, CASE WHEN url = '' THEN 'Missing url'
    WHEN NOT {_SITE_SQL} THEN 'URL must be a Wikipedia article'
    WHEN m > 0.75 THEN 'manual_threshold must be <= auto_threshold'
    WHEN substr(path, strpos(path, '/wiki/') + 6) NOT IN (SELECT source FROM documents)
      THEN 'Failed to fetch article metadata' END AS reason FROM p)"""


def _results(spark, sf_dir):
    asked = urls(spark, sf_dir).select(
        "page_id",
        F.when(F.col("page_id") % 9 == 0, "").otherwise(
            F.replace("url", F.lit("%20a+b"), F.lit(""))).alias("url"),
        F.when(F.col("page_id") % 10 == 0, 0.9).otherwise(0.5).alias("manual_threshold"),
        F.lit(0.75).alias("auto_threshold"),
    )
    return M.ingest_results(asked, articles(spark, sf_dir))


@query("ingest_results", f"""WITH {_RESULTS}
SELECT page_id, CASE WHEN reason IS NULL THEN 'success' ELSE 'failed' END AS status, reason FROM res""")
def ingest_results(spark, sf_dir):
    return _results(spark, sf_dir).select("page_id", "status", "reason")


@query("ingest_summary", f"""WITH {_RESULTS}
SELECT count(*) FILTER (reason IS NULL) AS success_count,
       count(*) FILTER (reason IS NOT NULL) AS fail_count FROM res""")
def ingest_summary(spark, sf_dir):
    return M.ingest_summary(_results(spark, sf_dir))
