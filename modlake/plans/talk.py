"""Talk pages into comments.

A page is one row and stays one row until its comments are exploded: lines are
tagged, the tagged text is split at headers and then after signatures, and each
piece is one comment.  The plan is narrow - no window, no shuffle - and the work
on a page is bounded by the page's own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modlake.functions.signature import signature_timestamp
from modlake.functions.text import SPACE

USER = "[[User:"
USER_NAME = r"\[\[User:([^\]|#]+)"
COMMENT_COLUMNS = ("seq", "author", "timestamp", "text", "section", "level", "raw_wikitext")


def stripped(value: Column) -> Column:
    return F.regexp_replace(value, f"^[{SPACE}]+|[{SPACE}]+$", "")


def _is_header(bare: Column) -> Column:
    return bare.startswith("==") & bare.endswith("==")


def _is_skipped(bare: Column) -> Column:
    openers = [bare.startswith(s) for s in ("{{", "|", "<", "}}")]
    skip = (bare == "") | bare.isin(":", "::")
    for opener in openers:
        skip = skip | opener
    return skip


def _is_signature(line: Column) -> Column:
    return line.contains(USER) & line.rlike(USER_NAME)


def header_text(bare: Column) -> Column:
    return F.regexp_replace(bare, "^[= ]+|[= ]+$", "")


def line_kind(line: Column) -> Column:
    """header, skip, signature or buffer - tested in this order."""
    bare = stripped(line)
    return (
        F.when(_is_header(bare), "header")
        .when(_is_skipped(bare), "skip")
        .when(_is_signature(line), "signature")
        .otherwise("buffer")
    )


def _signed_body(line: Column) -> Column:
    before = stripped(F.substring_index(line, USER, 1))
    return F.regexp_replace(before, "^[:#* ]+", "")


def _level(line: Column) -> Column:
    prefix = F.regexp_extract(line, r"^[:#* \t]*", 0)
    marks = F.length(F.regexp_replace(prefix, r"[ \t]", ""))
    return F.greatest(marks, F.lit(1))


def _tagged(wikitext: Column, section: str) -> Column:
    """Kept lines behind one tag letter; a letter opens every line, so tags at a
    line start cannot be confused with page text."""

    def tag(line: Column) -> Column:
        bare = stripped(line)
        return (
            F.when(_is_header(bare), F.concat(F.lit("H"), header_text(bare)))
            .when(_is_skipped(bare), F.lit(None).cast("string"))
            .when(_is_signature(line), F.concat(F.lit("S"), line, F.lit("\nE")))
            .otherwise(F.concat(F.lit("B"), bare))
        )

    kept = F.array_compact(F.transform(F.split(wikitext, "\n"), tag))
    return F.concat(F.lit(f"\nH{section}\n"), F.array_join(kept, "\n"))


def _pieces(tagged: Column) -> Column:
    """``(section, piece)``: buffered lines with the signature that closes them."""
    blocks = F.split(tagged, "\nH")
    sections = F.transform(
        F.slice(blocks, F.lit(2), F.size(blocks)),
        lambda b: F.struct(
            F.substring_index(b, "\n", 1).alias("section"),
            F.split(
                F.substr(b, F.length(F.substring_index(b, "\n", 1)) + 1), "\nE"
            ).alias("parts"),
        ),
    )
    return F.flatten(
        F.transform(
            sections,
            lambda s: F.transform(
                s["parts"],
                lambda p: F.struct(
                    s["section"].alias("section"),
                    F.filter(F.split(p, "\n"), lambda x: x != "").alias("lines"),
                ),
            ),
        )
    )


def _split_signature(piece: Column) -> Column:
    last = F.try_element_at(piece["lines"], F.lit(-1))
    body = F.filter(piece["lines"], lambda x: x.startswith("B"))
    return F.struct(
        piece["section"].alias("section"),
        F.array_join(F.transform(body, lambda x: F.substr(x, F.lit(2))), "\n").alias("buffered"),
        F.when(last.startswith("S"), F.substr(last, F.lit(2))).alias("signed"),
    )


def _comment(piece: Column) -> Column:
    line = piece["signed"]
    body = _signed_body(F.coalesce(line, F.lit("")))
    signed = line.isNotNull()
    blank = F.lit("")
    return F.struct(
        F.when(signed, stripped(F.regexp_extract(line, USER_NAME, 1))).otherwise(blank).alias("author"),
        F.when(signed, signature_timestamp(line)).alias("timestamp"),
        F.concat_ws(
            "\n", F.nullif(piece["buffered"], blank), F.nullif(body, blank)
        ).alias("text"),
        piece["section"].alias("section"),
        F.when(signed, _level(line)).otherwise(F.lit(1)).alias("level"),
        F.coalesce(line, blank).alias("raw_wikitext"),
    )


def wikitext_comments(
    pages: DataFrame, text_col: str = "wikitext", *, keep: list[str],
    section: str = "", limit: int | None = None,
) -> DataFrame:
    """One row per comment with its position ``seq`` on the page (from 1).

    ``limit`` keeps the first comments of each page; 0 or None keeps all.
    """
    staged = pages.select(*keep, _tagged(F.col(text_col), section).alias("_tagged"))
    staged = staged.select(*keep, _pieces(F.col("_tagged")).alias("_pieces"))
    staged = staged.select(*keep, F.transform("_pieces", _split_signature).alias("_pieces"))
    found = F.filter(F.transform("_pieces", _comment), lambda c: c["text"] != "")
    if limit:
        found = F.slice(found, 1, limit)
    rows = staged.select(*keep, F.posexplode(found).alias("_pos", "_c"))
    return rows.select(*keep, (F.col("_pos") + 1).alias("seq"), "_c.*")


def comment_rows(comments: DataFrame, keep: list[str]) -> DataFrame:
    """The form scoring takes: empty id, ISO time stamp or "", author, text."""
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    return comments.select(
        *keep, "seq", F.lit("").alias("id"), "author",
        F.coalesce(iso, F.lit("")).alias("timestamp"), "text",
    )


def page_lines(pages: DataFrame, text_col: str, key: str, section: Column) -> DataFrame:
    """Lines of each page with the section they stand in.

    ``section`` is an expression over ``line``, NULL where no section starts.  The
    window runs inside one page, whose lines come out of one cell.
    """
    lines = pages.select(key, F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    so_far = (
        Window.partitionBy(key).orderBy("line_no")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return lines.withColumn("_section", section).withColumn(
        "section", F.coalesce(F.last("_section", ignorenulls=True).over(so_far), F.lit(""))
    ).drop("_section")


def line_kinds(pages: DataFrame, text_col: str, key: str) -> DataFrame:
    lines = pages.select(key, F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    return lines.select(key, "line_no", line_kind(F.col("line")).alias("kind"))


def line_sections(pages: DataFrame, text_col: str, key: str) -> DataFrame:
    bare = stripped(F.col("line"))
    opened = F.when(_is_header(bare), header_text(bare))
    return page_lines(pages, text_col, key, opened).select(key, "line_no", "section")


def html_comments(pages: DataFrame, text_col: str, key: str) -> DataFrame:
    """Line-wise reading of rendered pages: ``<div id=..>`` lines under h2/h3."""
    line = F.col("line")
    heading = r"(?d)<h[23]>(.+?)</h[23]>"
    has_heading = (line.contains("<h2>") | line.contains("<h3>")) & line.rlike(heading)
    opened = F.when(has_heading, stripped(F.regexp_extract(line, heading, 1)))
    text = F.regexp_extract(line, r"(?d)>(.+?)<", 1)
    rows = page_lines(pages, text_col, key, opened).filter(
        line.contains("<div") & line.contains("id=") & line.rlike(r"(?d)>(.+?)<")
    )
    return rows.select(
        key, "line_no", F.lit("Unknown").alias("author"), text.alias("text"), "section",
        F.lit(1).alias("level"), line.alias("raw_wikitext"),
    )
