"""The moderation store as table-to-table jobs.

Tables: ``articles`` (one row per article) and ``comments`` (one row per
comment, key ``id``).  Every job takes tables and returns tables; writing is in
``modlake.sources.store``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlake.functions import moderation as rules
from modlake.functions.urls import article_title, is_article_url
from modlake.operators.prefix import running_totals

TREND_CHUNK = 100_000


def moderate(
    scored: DataFrame,
    auto: float = rules.DEFAULT_AUTO,
    manual: float = rules.DEFAULT_MANUAL,
    *,
    model_version: str = "unknown",
    explain_version: str = "",
) -> DataFrame:
    """Scored comments as store rows.

    Needs ``timestamp`` (ISO text or ""), ``author``, ``text`` and ``toxicity``;
    the id uses the author as parsed, the stored author defaults to "unsigned".
    """
    rules.check_thresholds(auto, manual)
    author = F.coalesce(F.col("author"), F.lit(""))
    toxicity = F.coalesce(F.col("toxicity").cast("double"), F.lit(0.0))
    return scored.withColumns({
        "id": rules.comment_id(F.col("timestamp"), F.col("author"), F.col("text")),
        "author": F.when(author == "", "unsigned").otherwise(author),
        "timestamp": F.coalesce(F.col("timestamp"), F.lit("")),
        "toxicity": toxicity,
        "decision": rules.decide(toxicity, auto, manual),
        "is_flagged": toxicity >= manual,
        "model_version": F.lit(model_version),
        "explain_version": F.lit(explain_version),
    })


def article_rollup(comments: DataFrame) -> DataFrame:
    """Flag counts and inference statistics per article."""
    timed = F.when(F.col("inference_ms") > 0, F.col("inference_ms"))

    def one_place(value: Column) -> Column:
        return F.coalesce(F.round(value, 1), F.lit(0.0))

    return comments.groupBy("article_id").agg(
        F.count("*").alias("comments"),
        F.count_if("is_flagged").alias("flagged_count"),
        F.count(timed).alias("inference_count"),
        one_place(F.sum(timed)).alias("total_ms"),
        one_place(F.avg(timed)).alias("avg_ms"),
        one_place(F.min(timed)).alias("min_ms"),
        one_place(F.max(timed)).alias("max_ms"),
    )


def toxicity_trend(
    comments: DataFrame, seq: str, threshold: float = rules.DEFAULT_MANUAL
) -> DataFrame:
    """Running toxicity of each article, one row per comment.

    ``seq`` is the comment's integer position.  Articles are summed in position
    chunks, so one huge article is many tasks.  Scores are added as exact
    decimals: the result does not depend on how the rows were split.
    """
    exact = comments.select(
        "article_id", seq,
        F.split_part("timestamp", F.lit("T"), F.lit(1)).alias("date"),
        F.coalesce("toxicity", F.lit(0.0)).cast("decimal(18,9)").alias("_tox"),
        F.floor(F.col(seq) / TREND_CHUNK).alias("_chunk"),
    )
    run = running_totals(
        exact, {"_run": "_tox"}, keys=["article_id"], chunk="_chunk", order=[F.col(seq)]
    )
    return run.select(
        "article_id", seq, "date", F.round("_run", 3).cast("double").alias("score"),
        F.lit(threshold).alias("threshold"),
    )


def _matching(comments: DataFrame, article_id: str, decision: str | None) -> DataFrame:
    found = comments.filter(F.col("article_id") == article_id)
    if decision == "flagged":
        return found.filter("is_flagged")
    return found.filter(F.col("decision") == decision) if decision else found


def _order(sort: str | None) -> list[Column]:
    orders = {
        "toxicity_desc": F.desc("toxicity"),
        "toxicity_asc": F.asc("toxicity"),
        "timestamp_desc": F.desc("timestamp"),
        "timestamp_asc": F.asc("timestamp"),
        "decision_asc": rules.severity(F.col("decision")).asc(),
    }
    # Ties go by id, so that pages never overlap.
    return [orders.get(sort or "toxicity_desc", orders["toxicity_desc"]), F.col("id")]


def comment_page(
    comments: DataFrame, article_id: str, *, limit: int = 50, offset: int = 0,
    decision: str | None = None, sort: str | None = "toxicity_desc",
) -> DataFrame:
    """One page of an article's queue (a bounded top-k, not a full sort)."""
    rules.check_page(limit, offset, decision, sort)
    found = _matching(comments, article_id, decision).orderBy(*_order(sort))
    return found.offset(offset).limit(limit) if offset else found.limit(limit)


def page_info(
    comments: DataFrame, article_id: str, *, limit: int = 50, offset: int = 0,
    decision: str | None = None,
) -> DataFrame:
    """Total rows, page count and whether there is a page before and after."""
    rules.check_page(limit, offset, decision, None)
    total = _matching(comments, article_id, decision).agg(F.count("*").alias("total"))
    pages = F.greatest(F.lit(1), F.ceil(F.col("total") / limit)).cast("long")
    return total.select(
        "total", pages.alias("pages"), F.lit(offset > 0).alias("has_previous"),
        (F.lit(offset + limit) < F.col("total")).alias("has_next"),
    )


def article_list(articles: DataFrame) -> DataFrame:
    return articles.orderBy(F.desc("created_at"), "id")


def article_summary(articles: DataFrame, article_id: str) -> DataFrame:
    return articles.filter(F.col("id") == article_id)


def comment_detail(articles: DataFrame, comments: DataFrame) -> DataFrame:
    """Comments with their article; a comment without an article has no detail."""
    heads = articles.select(
        F.col("id").alias("article_id"), "title", "url", "summary",
        "auto_threshold", "manual_threshold", "model_name",
    )
    return comments.join(heads, "article_id")


def duplicate_ids(comments: DataFrame) -> DataFrame:
    """Comment ids that occur more than once in a batch."""
    return comments.groupBy("id").agg(F.count("*").alias("copies")).filter("copies > 1")


def upsert(
    articles: DataFrame, comments: DataFrame, new_articles: DataFrame, new_comments: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Replace whole articles: their row and all of their comments.

    A batch that repeats a comment id is refused, as a primary key would.
    """
    repeated = duplicate_ids(new_comments).limit(5).collect()
    if repeated:
        raise ValueError(f"duplicate comment ids: {[r['id'] for r in repeated]}")
    incoming = new_articles.select("id")
    kept_articles = articles.join(incoming, "id", "left_anti")
    kept_comments = comments.join(
        incoming.withColumnRenamed("id", "article_id"), "article_id", "left_anti"
    )
    return (
        kept_articles.unionByName(new_articles, allowMissingColumns=True),
        kept_comments.unionByName(new_comments, allowMissingColumns=True),
    )


def _one_per_key(changes: DataFrame, key: str, order: str | None) -> DataFrame:
    """One change per key: the last by ``order``; without an order, changes that differ are refused."""
    values = [c for c in changes.columns if c not in (key, order)]
    whole = F.struct(*values)
    if order is None:
        several = F.raise_error(F.concat(F.lit(f"several changes for {key} "), F.first(key).cast("string")))
        one = F.when(F.min(whole).eqNullSafe(F.max(whole)), F.max(whole)).otherwise(several)
    else:
        one = F.max_by(whole, F.struct(order, whole))
    return changes.groupBy(key).agg(one.alias("_change")).select(key, "_change.*")


def reevaluate(comments: DataFrame, thresholds: DataFrame, order: str | None = None) -> DataFrame:
    """New thresholds ``(article_id, auto_threshold, manual_threshold)`` applied.

    Moderator bans keep decision and flag; articles without new thresholds stay.
    Of several changes the last by ``order`` holds; without it they are refused.
    """
    known = ["article_id", "auto_threshold", "manual_threshold"] + ([order] if order else [])
    new = _one_per_key(thresholds.select(*known), "article_id", order).select(
        "article_id", F.col("auto_threshold").alias("_auto"),
        F.col("manual_threshold").alias("_manual"),
    )
    change = F.col("_auto").isNotNull() & (F.col("decision") != "manual-ban")
    return (
        comments.join(new, "article_id", "left")
        .withColumns({
            "decision": F.when(
                change, rules.decide(F.col("toxicity"), F.col("_auto"), F.col("_manual"))
            ).otherwise(F.col("decision")),
            "is_flagged": F.when(change, F.col("toxicity") >= F.col("_manual")).otherwise(
                F.col("is_flagged")
            ),
        })
        .drop("_auto", "_manual")
    )


def reevaluated_counts(comments: DataFrame) -> DataFrame:
    """Flagged comments per article after re-evaluation; moderator bans count."""
    counted = F.col("is_flagged") | (F.col("decision") == "manual-ban")
    return comments.groupBy("article_id").agg(F.count_if(counted).alias("flagged_count"))


def with_thresholds(articles: DataFrame, thresholds: DataFrame, order: str | None = None) -> DataFrame:
    """The article rows that ``thresholds`` names, with their new thresholds."""
    known = ["article_id", "auto_threshold", "manual_threshold"] + ([order] if order else [])
    new = _one_per_key(thresholds.select(*known), "article_id", order).withColumnRenamed("article_id", "id")
    rest = articles.drop("auto_threshold", "manual_threshold")
    return rest.join(new.select("id", "auto_threshold", "manual_threshold"), "id")


def with_flagged_counts(articles: DataFrame, comments: DataFrame) -> DataFrame:
    """Article rows with the flagged comments among ``comments``; 0 where there is none."""
    counts = reevaluated_counts(comments).select(F.col("article_id").alias("id"), F.col("flagged_count").alias("_flagged"))
    joined = articles.drop("flagged_count").join(counts, "id", "left")
    return joined.withColumn("flagged_count", F.coalesce("_flagged", F.lit(0))).drop("_flagged")


def override_decisions(comments: DataFrame, overrides: DataFrame, order: str | None = None) -> DataFrame:
    """Moderator decisions ``(id, decision)``; the flag stays as it was.

    Of several decisions the last by ``order`` holds; without it they are refused.
    """
    known = ["id", "decision"] + ([order] if order else [])
    new = _one_per_key(overrides.select(*known), "id", order).select("id", F.col("decision").alias("_new"))
    return (
        comments.join(new, "id", "left")
        .withColumn("decision", F.coalesce("_new", "decision"))
        .drop("_new")
    )


def stale_explanations(comments: DataFrame, version: str) -> DataFrame:
    """Comments without an explanation, or with one of another version."""
    empty = F.coalesce(F.size("top_features") == 0, F.lit(True))
    other = F.coalesce(F.col("explain_version") != version, F.lit(True))
    return comments.filter(empty | other)


def with_explanations(
    comments: DataFrame, explained: DataFrame, version: str, order: str | None = None
) -> DataFrame:
    """Write back ``(id, top_features)``; an empty explanation changes nothing.

    Of several explanations the last by ``order`` holds; without it they are refused.
    """
    known = ["id", "top_features"] + ([order] if order else [])
    filled = explained.filter(F.size("top_features") > 0).select(*known)
    new = _one_per_key(filled, "id", order).select("id", F.col("top_features").alias("_top"))
    return (
        comments.join(new, "id", "left")
        .withColumns({
            "explain_version": F.when(F.col("_top").isNotNull(), version).otherwise(
                F.col("explain_version")
            ),
            "top_features": F.coalesce("_top", "top_features"),
        })
        .drop("_top")
    )


def threshold_sweep(
    comments: DataFrame, pairs: Sequence[tuple[float, float]], score: str = "toxicity"
) -> DataFrame:
    """Share of safe / review / ban comments per ``(manual, auto)`` pair, in one scan."""
    value = F.coalesce(F.col(score), F.lit(0.0))
    total = F.count("*")

    def share(condition: Column) -> Column:
        return F.try_divide(F.count_if(condition).cast("double"), total)

    rows = []
    for manual, auto in pairs:
        low, high = min(manual, auto), max(manual, auto)
        rows.append(F.struct(
            F.lit(low).alias("manual_threshold"), F.lit(high).alias("auto_threshold"),
            share(value < low).alias("safe"),
            share((value >= low) & (value < high)).alias("review"),
            share(value >= high).alias("ban"),
        ))
    return comments.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def ingest_results(requests: DataFrame, articles: DataFrame) -> DataFrame:
    """Per requested URL: done or failed, and why.

    ``requests`` has ``url``, ``auto_threshold`` and ``manual_threshold``;
    an article counts as ingested when its title is in ``articles``.
    """
    url = F.trim(F.coalesce("url", F.lit("")))
    problem = (
        F.when(url == "", "Missing url")
        .when(~is_article_url(url), "URL must be a Wikipedia article")
        .when(
            F.col("manual_threshold") > F.col("auto_threshold"),
            "manual_threshold must be <= auto_threshold",
        )
    )
    asked = requests.withColumns({"problem": problem, "title": article_title(url)})
    known = articles.select(F.col("title"), F.lit(True).alias("found")).distinct()
    joined = asked.join(known, "title", "left")
    reason = F.coalesce(
        "problem", F.when(F.col("found").isNull(), "Failed to fetch article metadata")
    )
    return joined.select(
        *requests.columns,
        F.when(reason.isNull(), "success").otherwise("failed").alias("status"),
        reason.alias("reason"),
    )


def ingest_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("status") == "success").alias("success_count"),
        F.count_if(F.col("status") == "failed").alias("fail_count"),
    )
