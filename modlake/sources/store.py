"""The moderation store on Parquet.

Every write is a new batch folder, so nothing is read and overwritten at once and
a repeated batch replaces itself.  A batch belongs to a snapshot (its own, unless one is
given): the current state of an article is its newest snapshot, and in it the newest row of
each comment.  A stream writes all its micro-batches into one snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Columns added over time, with the value old files get (fixed names).
COMMENT_DEFAULTS = {
    "author": "unsigned", "is_flagged": False, "model_version": "", "explain_version": "",
    "inference_ms": 0.0,
}
ARTICLE_DEFAULTS = {"inference_stats": "{}"}
BUCKETS = 64
SPLITS = 8


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Add missing columns and fill gaps in old rows."""
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in defaults.items()
    })


def write_batch(comments: DataFrame, root: str, batch: int, snapshot: int | None = None) -> None:
    """Write one batch; writing the same batch again replaces it.

    Files are grouped by a bucket of the article id, and each bucket is dealt
    over several tasks so that one huge article is not one file.
    """
    bucket = F.pmod(F.xxhash64("article_id"), F.lit(BUCKETS))
    deal = F.pmod(F.xxhash64("id"), F.lit(SPLITS))
    (
        comments.withColumn("bucket", bucket)
        .withColumn("snapshot", F.lit(batch if snapshot is None else snapshot).cast("bigint"))
        .repartition("bucket", deal)
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{root}/batch={batch}")
    )


def read_all(spark: SparkSession, root: str) -> DataFrame:
    raw = spark.read.option("mergeSchema", True).option("basePath", root).parquet(root)
    own = F.col("batch").cast("bigint")
    old = raw.withColumn("snapshot", F.coalesce("snapshot", own) if "snapshot" in raw.columns else own)
    return with_defaults(old, COMMENT_DEFAULTS)


def _newest_rows(rows: DataFrame) -> DataFrame:
    """The newest row of each comment."""
    last = F.max("batch").over(Window.partitionBy("article_id", "id"))
    return rows.withColumn("_last", last).filter("batch = _last").drop("_last", "batch", "bucket", "snapshot")


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """Comments of each article's newest snapshot."""
    rows = read_all(spark, root)
    newest = rows.groupBy("article_id").agg(F.max("snapshot").alias("snapshot"))
    return _newest_rows(rows.join(newest, ["article_id", "snapshot"], "left_semi"))


def read_article(spark: SparkSession, root: str, article_id: str) -> DataFrame:
    """One article; the bucket test prunes the folders that are read."""
    wanted = F.pmod(F.xxhash64(F.lit(article_id)), F.lit(BUCKETS))
    rows = read_all(spark, root).filter(
        (F.col("bucket") == wanted) & (F.col("article_id") == article_id)
    )
    newest = rows.agg(F.max("snapshot")).scalar()
    return _newest_rows(rows.filter(F.col("snapshot") == newest))


def write_report(sections: dict[str, DataFrame], root: str) -> None:
    """One Parquet folder per report section."""
    for name, section in sections.items():
        section.write.mode("overwrite").parquet(f"{root}/{name}")
