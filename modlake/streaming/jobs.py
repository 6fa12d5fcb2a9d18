"""Arriving comments: scoring, repeat removal, daily trend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from modlake.operators.linear import LinearModel
from modlake.plans.features import dense_features
from modlake.plans.moderation import moderate
from modlake.sources.store import write_batch

#: Batch numbers that one ingest may use.
MAX_MICRO_BATCHES = 1_000_000_000


def score_comments(
    comments: DataFrame, model: LinearModel, auto: float, manual: float, version: str = "v1"
) -> DataFrame:
    """Features, score and decision; the same code for a batch and a stream."""
    features = dense_features(comments, "text", keep=comments.columns, only=tuple(model.terms))
    scored = features.withColumn("toxicity", F.round(model.probability(), 6))
    return moderate(scored, auto, manual, model_version=version).drop(*model.terms)


def start_ingest(
    comments: DataFrame, model: LinearModel, store: str, checkpoint: str,
    auto: float, manual: float, snapshot: int = 0,
) -> StreamingQuery:
    """Score a stream into one snapshot of the store; a replayed micro-batch replaces itself.

    Ingests into one store need numbers of their own: micro-batches count from 0 in each.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, store, snapshot * MAX_MICRO_BATCHES + batch_id, snapshot)

    return (
        score_comments(comments, model, auto, manual).writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _timed(comments: DataFrame, ts: str) -> DataFrame:
    """Watermarks need an instant; wall-clock values are read in the session zone (UTC)."""
    return comments.withColumn(ts, F.col(ts).cast("timestamp"))


def drop_repeats(comments: DataFrame, ts: str, key: str, delay: str = "1 hour") -> DataFrame:
    """Keep the first row of each key; keys are remembered for ``delay``."""
    return _timed(comments, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def daily_trend(comments: DataFrame, ts: str, article: str, score: str, delay: str = "1 hour") -> DataFrame:
    """Comments and summed toxicity per article and day; later rows are dropped."""
    return (
        _timed(comments, ts).withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day").alias("day"), F.col(article).alias("article_id"))
        .agg(F.count("*").alias("comments"), F.sum(score).alias("toxicity"))
        .select(F.col("day.start").alias("day"), "article_id", "comments", "toxicity")
    )


def run_updates_to_table(stream: DataFrame, keys: list[str], folder: str) -> DataFrame:
    """Run an aggregating stream and return its newest row per key, windows still open included.

    Every micro-batch writes a folder of its own, which a replay overwrites.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(save).outputMode("update")
        .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    values = [c for c in stream.columns if c not in keys]
    schema = StructType([*stream.schema.fields, StructField("batch", LongType())])
    kept = stream.sparkSession.read.schema(schema).parquet(f"{folder}/out")
    newest = kept.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_last"))
    return newest.select(*keys, "_last.*")


def run_to_table(stream: DataFrame, folder: str) -> DataFrame:
    """Run an append stream over what is there and return what it wrote."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")
