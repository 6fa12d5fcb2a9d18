"""Comments as JSON, CSV or text blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ISO = "yyyy-MM-dd'T'HH:mm:ss"
_COLUMNS = ("author", "timestamp", "section", "level", "text")
CSV_TEXT = 200
RULE = 70


def json_projection(comments: DataFrame) -> DataFrame:
    stamp = F.date_format("timestamp", _ISO).alias("timestamp")
    return comments.select("author", stamp, "text", "section", "level")


def csv_projection(comments: DataFrame) -> DataFrame:
    """Fixed column order; the text column is a preview by definition."""
    return comments.select(
        "author", F.coalesce(F.date_format("timestamp", _ISO), F.lit("")).alias("timestamp"),
        "section", "level", F.substring("text", 1, CSV_TEXT).alias("text"),
    )


def text_blocks(comments: DataFrame) -> DataFrame:
    stamp = F.coalesce(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit("None"))
    return comments.select(
        F.concat_ws(
            "\n",
            F.lit("\n" + "=" * RULE),
            F.concat(F.lit("Author: "), "author"),
            F.concat(F.lit("Timestamp: "), stamp),
            F.concat(F.lit("Section: "), "section"),
            F.concat(F.lit("Level: "), F.col("level").cast("string")),
            F.lit("─" * RULE),
            "text",
        ).alias("value")
    )


def write_comments(comments: DataFrame, path: str, output_format: str = "json") -> None:
    """Write to ``path``; every task writes its own part."""
    if output_format == "json":
        json_projection(comments).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    elif output_format == "csv":
        csv_projection(comments).write.mode("overwrite").option("header", True).option(
            "escape", '"'
        ).csv(path)
    elif output_format == "txt":
        text_blocks(comments).write.mode("overwrite").text(path)
    else:
        raise ValueError("output_format must be 'json', 'csv' or 'txt'")
