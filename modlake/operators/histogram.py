"""Equal-width histograms of many columns at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edge(i: Column, low: Column, high: Column, bins: int) -> Column:
    """The i-th of ``bins + 1`` equally spaced edges; the last is exactly ``high``."""
    step = (high - low) / F.lit(float(bins))
    return F.when(i >= bins, high).otherwise(low + i * step)


def bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Half-open bins, the last one closed; NULL outside the range.

    The division can be off by one at an edge, so its result is checked against
    the edges themselves.
    """
    guess = F.floor((value - low) / (high - low) * F.lit(float(bins))).cast("int")
    guess = F.least(F.greatest(guess, F.lit(0)), F.lit(bins - 1))
    moved = (
        F.when(value < edge(guess, low, high, bins), guess - 1)
        .when((guess < bins - 1) & (value >= edge(guess + 1, low, high, bins)), guess + 1)
        .otherwise(guess)
    )
    return F.when((value >= low) & (value <= high), moved)


def all_bins(groups: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """Every bin number of every group, so that empty bins show up as zero."""
    return groups.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
