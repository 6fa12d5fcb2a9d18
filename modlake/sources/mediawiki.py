"""Landed MediaWiki API replies as tables.

Each input row is one reply body (JSON text).  A batch reply may hold many
pages; every page becomes a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STR = T.StringType()
_MAIN = T.StructType([T.StructField("*", _STR)])
_REVISION = T.StructType([
    T.StructField("slots", T.StructType([T.StructField("main", _MAIN)])),
    T.StructField("*", _STR),
    T.StructField("timestamp", _STR),
    T.StructField("user", _STR),
    T.StructField("comment", _STR),
    T.StructField("size", T.LongType()),
])
_PAGE = T.StructType([
    T.StructField("title", _STR),
    T.StructField("extract", _STR),
    T.StructField("fullurl", _STR),
    T.StructField("revisions", T.ArrayType(_REVISION)),
])
REPLY = T.StructType([
    T.StructField("query", T.StructType([
        T.StructField("pages", T.MapType(_STR, _PAGE)),
    ])),
])


def _pages(body: str) -> Column:
    return F.from_json(F.col(body), REPLY)["query"]["pages"]


def wikitext(replies: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(page_id, title, wikitext)`` of existing pages with content."""
    pages = replies.select(*keep, F.explode(_pages(body)).alias("page_id", "page"))
    first = F.get(F.col("page.revisions"), F.lit(0))
    content = F.when(
        first["slots"].isNotNull(), first["slots"]["main"].getField("*")
    ).otherwise(first.getField("*"))
    return (
        pages.filter(~F.col("page_id").startswith("-"))
        .select(*keep, "page_id", F.col("page.title").alias("title"), content.alias("wikitext"))
        .filter(F.col("wikitext") != "")
    )


def metadata(replies: DataFrame, requested: str, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(title, summary, url)``; the requested title where a reply has none."""
    pages = replies.select(*keep, requested, F.explode_outer(_pages(body)).alias("page_id", "page"))
    blank = F.lit("")
    return pages.select(
        *keep,
        F.coalesce("page.title", requested).alias("title"),
        F.coalesce("page.extract", blank).alias("summary"),
        F.coalesce("page.fullurl", blank).alias("url"),
    )


def recent_changes(replies: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(page_id, timestamp, user, comment, size)`` of every revision."""
    pages = replies.select(*keep, F.explode(_pages(body)).alias("page_id", "page"))
    rows = pages.select(*keep, "page_id", F.explode("page.revisions").alias("r"))
    return rows.select(*keep, "page_id", "r.timestamp", "r.user", "r.comment", "r.size")
