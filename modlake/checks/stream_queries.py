"""Registered queries for sentiment, word counts, the store and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from modlake.checks import inputs as I
from modlake.checks import sql as Q
from modlake.checks.registry import query
from modlake.functions.lexicons import PROFANITY
from modlake.functions.sentiment import SEED_LEXICON
from modlake.functions.text import WORD
from modlake.plans.features import category_of, dense_features
from modlake.session import scratch_folder
from modlake.sources import store
from modlake.streaming import jobs

SENTIMENT = ("vader_compound", "vader_neg", "vader_pos")


@query("sentiment_scores")
def sentiment_scores(spark, sf_dir):
    return dense_features(I.comments(spark, sf_dir), "text", keep=["doc_id"], only=SENTIMENT)


@query("sentiment_derived")
def sentiment_derived(spark, sf_dir):
    names = ("vader_compound", "vader_is_negative", "vader_intensity", "vader_pos_minus_neg")
    return dense_features(I.comments(spark, sf_dir), "text", keep=["doc_id"], only=names)


_VALUES = ", ".join(f"('{t}', {v}::DOUBLE)" for t, v in SEED_LEXICON.items())


@query("sentiment_lexicon_sum", rf"""WITH {Q.COMMENTS}, lex(term, valence) AS (VALUES {_VALUES}),
tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[{Q.W}]+')) AS term FROM comments)
SELECT doc_id, count(*) AS hits, round(sum(valence), 6) AS valence FROM tok JOIN lex USING (term) GROUP BY doc_id""")
def sentiment_lexicon_sum(spark, sf_dir):
    lexicon = spark.createDataFrame(list(SEED_LEXICON.items()), "term string, valence double")
    tokens = I.comments(spark, sf_dir).select(
        "doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"[{WORD}]+"), F.lit(0))).alias("term")
    )
    return tokens.join(lexicon, "term").groupBy("doc_id").agg(
        F.count("*").alias("hits"), F.round(F.sum("valence"), 6).alias("valence")
    )


@query("top_lexicon_words", rf"""WITH {Q.COMMENTS},
tok AS (SELECT unnest(regexp_extract_all(lower(text), '[{Q.W}]+')) AS word FROM comments)
SELECT word, count(*) AS n FROM tok WHERE word IN {Q.quoted(PROFANITY)} GROUP BY word
ORDER BY n DESC, word LIMIT 10""")
def top_lexicon_words(spark, sf_dir):
    tokens = I.comments(spark, sf_dir).select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"[{WORD}]+"), F.lit(0))).alias("word")
    )
    counts = tokens.filter(F.col("word").isin(list(PROFANITY))).groupBy("word").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(10)


_USED = " UNION ALL ".join(f"SELECT '{f}' AS feature, count(*) FILTER ({f} > 0) AS used FROM feats" for f in Q.PLAIN)


@query("feature_catalogue", f"{Q.FEATS} SELECT *, CASE WHEN feature LIKE 'identity%' THEN 'identity' ELSE 'other' END AS kind FROM ({_USED})")
def feature_catalogue(spark, sf_dir):
    """Catalogue entry of each feature with the comments that use it."""
    df = I.featured(spark, sf_dir)
    rows = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.count_if(F.col(f) > 0).alias("used")) for f in Q.PLAIN
    ])
    kind = F.when(category_of(F.col("feature")) == "identity", "identity").otherwise("other")
    return df.agg(rows.alias("r")).select(F.inline("r")).withColumn("kind", kind)


@query("schema_evolution", f"""{Q.SCORED}
SELECT id, article_id, toxicity, 'unsigned' AS author, FALSE AS is_flagged, '' AS model_version FROM scored""")
def schema_evolution(spark, sf_dir):
    folder = scratch_folder(spark, "store")
    old = I.scored(spark, sf_dir).select("id", "article_id", "toxicity")
    store.write_batch(old, folder, 0)
    return store.read_current(spark, folder).select(
        "id", "article_id", "toxicity", "author", "is_flagged", "model_version"
    )


def _stream(spark, sf_dir, name):
    """A table as a stream, be it one file or a folder of files (only a pattern may name either)."""
    schema = I.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


@query("stream_scored", f"{Q.SCORED} SELECT id, article_id, toxicity, decision, is_flagged FROM scored")
def stream_scored(spark, sf_dir):
    folder = scratch_folder(spark, "stream")
    docs = _stream(spark, sf_dir, "documents")
    comments = I.comment_columns(docs)
    jobs.start_ingest(
        comments, I.MODEL, f"{folder}/store", f"{folder}/state", I.AUTO, I.MANUAL
    ).awaitTermination()
    return store.read_current(spark, f"{folder}/store").select(
        "id", "article_id", "toxicity", "decision", "is_flagged"
    )


@query("stream_dedup", "SELECT DISTINCT event_id FROM events")
def stream_dedup(spark, sf_dir):
    """Every event arrives twice; one of each is kept."""
    events = _stream(spark, sf_dir, "events").select(
        "event_id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")
    )
    kept = jobs.drop_repeats(events, "ts", "event_id")
    return jobs.run_to_table(kept, scratch_folder(spark, "dedup")).select("event_id")


_TREND = """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type AS article_id, count(*) AS comments,
       round(sum(value), 4) AS toxicity FROM events GROUP BY ALL"""


def _trend_rows(trend):
    return trend.withColumns({
        "day": F.date_format("day", "yyyy-MM-dd"), "toxicity": F.round("toxicity", 4),
    })


@query("stream_trend", _TREND)
def stream_trend(spark, sf_dir):
    events = _stream(spark, sf_dir, "events")
    trend = jobs.daily_trend(events, "ts", "event_type", "value")
    return _trend_rows(jobs.run_updates_to_table(trend, ["day", "article_id"], scratch_folder(spark, "trend")))


@query("daily_trend", _TREND)
def daily_trend(spark, sf_dir):
    return _trend_rows(jobs.daily_trend(I.table(spark, sf_dir, "events"), "ts", "event_type", "value"))
