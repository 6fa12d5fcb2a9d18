"""Article URLs and titles as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SITE = r"(?i)^https?://(?:[^/?#]*@)?(?:[^/?#:@]*\.)?wikipedia\.org(?::[^/?#@]*)?(?:[/?#]|$)"


def _clean(url: Column) -> Column:
    """Drop what URL parsers ignore: leading controls, inner tabs and line ends."""
    return F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")


def _path(url: Column) -> Column:
    path = F.regexp_extract(_clean(url), r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*$", "")


def is_article_url(url: Column) -> Column:
    """http(s), an allowed host, and ``/wiki/`` in the path."""
    ok = _clean(url).rlike(_SITE) & _path(url).contains("/wiki/")
    return F.coalesce(ok, F.lit(False))


def percent_decoded(value: Column) -> Column:
    """Undo %XX escapes; a plus sign stays a plus sign."""
    return F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


def _after_wiki(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^.*?/wiki/(.*)$", 1)


def article_title(url: Column) -> Column:
    """Decoded part after the first ``/wiki/``; NULL when not an article URL."""
    raw = _after_wiki(_path(url))
    return F.when(is_article_url(url) & (raw != ""), percent_decoded(raw))


def page_title(page_or_url: Column) -> Column:
    """Title of a page name or URL without its ``Talk:`` prefix; NULL if invalid."""
    is_url = page_or_url.startswith("http://") | page_or_url.startswith("https://")
    path = _path(page_or_url)
    title = F.when(~is_url, page_or_url).when(
        path.contains("/wiki/"), percent_decoded(_after_wiki(path))
    )
    return F.regexp_replace(title, "^Talk:", "")


def page_title_error(page_or_url: Column) -> Column:
    return F.when(
        page_title(page_or_url).isNull(), "URL must be an article URL containing /wiki/"
    )
