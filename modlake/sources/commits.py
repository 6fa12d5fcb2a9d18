"""Article rows and their comments changed together: data first, a commit row last.

``write`` puts both tables' rows into folders of their own and then writes one commit row that
names them.  Readers start from the commit rows, so a batch whose writer died is never read,
and an article row never meets comments of another commit.  A commit replaces the articles
it holds, with all their comments; the state of an article is its newest commit.

Commit rows are few and small: one per commit, folded by ``compact``, which rewrites the live
rows under a new commit that replaces the ones before it.  Numbers are chosen by the
writer; a number can be used once, and two writers that raced for one are found out on reading.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modlake.plans import moderation

ROW = "number bigint, token string, replaces_below bigint"


def _commits(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Number and folder of the live commits, oldest first."""
    rows = spark.read.schema(ROW).option("recursiveFileLookup", True).parquet(f"{root}/commits").collect()
    numbers = [r["number"] for r in rows]
    if len(set(numbers)) < len(numbers):
        raise ValueError("two writers used the same commit number")
    floor = max((r["replaces_below"] for r in rows), default=0)
    return sorted((r["number"], f"commit={r['number']}/token={r['token']}") for r in rows if r["number"] >= floor)


def write(
    articles: DataFrame, comments: DataFrame, root: str, number: int, *, replaces_below: int = 0, files: int | None = None
) -> None:
    """One commit of whole articles: their rows (``id``) and all their comments (``article_id``).

    ``files`` deals the comments over that many files, by comment id, so that a huge article is
    not one file; without it Spark's own partitions are written.
    """
    spark, token = articles.sparkSession, uuid.uuid4().hex
    folder = f"commit={number}/token={token}"
    articles.write.parquet(f"{root}/articles/{folder}")
    dealt = comments.repartition(files, "id") if files else comments
    dealt.write.parquet(f"{root}/comments/{folder}")
    row = spark.range(1).select(
        F.lit(number).cast("bigint").alias("number"), F.lit(token).alias("token"),
        F.lit(replaces_below).cast("bigint").alias("replaces_below"),
    )
    row.coalesce(1).write.mode("errorifexists").parquet(f"{root}/commits/number={number}")


def read(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Articles and comments as of the newest commit of each article.

    The commits are listed now: later ones do not change what these tables hold.
    """
    live = _commits(spark, root)
    if not live:
        raise ValueError(f"no commit in {root}")

    def rows(table: str) -> DataFrame:
        folders = [f"{root}/{table}/{folder}" for _, folder in live]
        found = spark.read.option("mergeSchema", True).option("basePath", f"{root}/{table}").parquet(*folders).drop("token")
        return found.withColumn("commit", F.col("commit").cast("bigint"))

    heads = rows("articles")
    if len(live) == 1:
        return heads.drop("commit"), rows("comments").drop("commit")
    newest = heads.groupBy("id").agg(F.max("commit").alias("commit"))
    held = newest.withColumnRenamed("id", "article_id")
    return (
        heads.join(newest, ["id", "commit"], "left_semi").drop("commit"),
        rows("comments").join(held, ["article_id", "commit"], "left_semi").drop("commit"),
    )


def next_number(spark: SparkSession, root: str) -> int:
    return max((n for n, _ in _commits(spark, root)), default=-1) + 1


def reevaluate(spark: SparkSession, root: str, thresholds: DataFrame, number: int, order: str | None = None) -> None:
    """New thresholds as one commit: comments, the article's thresholds and its flagged count.

    ``thresholds`` has ``article_id, auto_threshold, manual_threshold``.  Only the changed articles
    are written; unknown articles are ignored, and one without comments counts 0.
    """
    articles, comments = read(spark, root)
    known = thresholds.join(articles.select(F.col("id").alias("article_id")), "article_id", "left_semi")
    own = comments.join(known.select("article_id"), "article_id", "left_semi")
    judged = moderation.reevaluate(own, known, order)
    heads = moderation.with_thresholds(articles, known, order)
    write(moderation.with_flagged_counts(heads, judged), judged, root, number)


def compact(spark: SparkSession, root: str, number: int, *, comments_per_file: int = 1_000_000) -> None:
    """The live rows as one commit that replaces all commits before it, in files of about one size."""
    articles, comments = read(spark, root)
    files = max(1, -(-comments.count() // comments_per_file))
    write(articles, comments, root, number, replaces_below=number, files=files)
