"""How a valence lexicon reaches the rows: a dict as literals, a table by a join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlake.functions import sentiment as S


def valence_lookup(
    df: DataFrame, text_col: str, lexicon: dict[str, float] | DataFrame
) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Return ``(df, token -> valence)``.

    A dict travels inside the plan and also serves streams.  A ``(term, valence)`` table, which may be
    large, is joined, and never read while the plan is built; Spark broadcasts it only if it is small.
    In both, entries without a term or valence are no entries; of a term's repeats the largest valence holds.
    """
    if isinstance(lexicon, DataFrame):
        entries = lexicon.dropna(subset=["term", "valence"]).groupBy("term").agg(F.max("valence").alias("valence"))
        return _joined(df, text_col, entries)
    return df, S.literal_lookup({t: v for t, v in lexicon.items() if t is not None and v is not None})


def _joined(
    df: DataFrame, text_col: str, lexicon: DataFrame
) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Attach to each row a map of its own known tokens.

    The text's distinct tokens are joined to the lexicon and gathered back by a
    hash of the text, so copies of one text are looked up once.  A map is never
    larger than the text it belongs to.
    """
    keyed = df.withColumn("_key", F.sha2(F.col(text_col), 256))
    tokens = (
        keyed.select("_key", text_col)
        .groupBy("_key")
        .agg(F.any_value(text_col).alias(text_col))
        .select(
            "_key",
            F.explode(
                F.array_distinct(
                    F.transform(S.sentiment_tokens(F.col(text_col)), F.lower)
                )
            ).alias("term"),
        )
    )
    known = (
        tokens.join(lexicon.select("term", "valence"), "term")
        .groupBy("_key")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("term", F.col("valence").cast("double")))
            ).alias("_known")
        )
    )
    return keyed.join(known, "_key", "left").drop("_key"), S.map_lookup(F.col("_known"))
