"""One-pass statistics of many columns, returned as one row per column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Stat = Callable[[Column], Column]


def column_stats(
    df: DataFrame, features, stats: dict[str, Stat], by: tuple[str, ...] = ()
) -> DataFrame:
    """``(by..., feature, stat...)``: every statistic of every column in one scan.

    All aggregates share one pass and combine before the shuffle; what is
    shuffled is one row per task and group.
    """
    rows = F.array(*[
        F.struct(
            F.lit(f).alias("feature"),
            *[stat(F.col(f).cast("double")).alias(name) for name, stat in stats.items()],
        )
        for f in features
    ])
    return df.groupBy(*by).agg(rows.alias("_rows")).select(*by, F.inline("_rows"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation; NULL when either side is constant."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def long_form(df: DataFrame, features, keep: list[str]) -> DataFrame:
    """``(keep..., feature, value)`` with values as DOUBLE."""
    cast = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])
    return cast.unpivot(list(keep), list(features), "feature", "value")


def _pair_sums(width: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    rows, cols = np.triu_indices(width)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, width, width))
        for batch in batches:
            raw = batch.to_numpy(dtype=float)
            seen = ~np.isnan(raw)
            mask, x = seen.astype(float), np.where(seen, raw, 0.0)
            square = x * x
            total += np.stack([
                mask.T @ mask, x.T @ mask, mask.T @ x, square.T @ mask, mask.T @ square, x.T @ x,
            ])
        picked = total[:, rows, cols]
        yield pd.DataFrame({
            "i": rows, "j": cols,
            **{name: picked[k] for k, name in enumerate(("n", "sx", "sy", "sxx", "syy", "sxy"))},
        })

    return add_up


def correlation_matrix(df: DataFrame, features) -> DataFrame:
    """``(feature_a, feature_b, correlation)`` for all ordered pairs, pairwise complete.

    Each task reduces its rows to one block of moment sums with matrix products
    and emits a fixed number of rows, whatever its input; Spark adds those up.
    Columns are shifted by their minimum first, which keeps the sums small and
    makes a constant column exactly zero.
    """
    features = list(features)
    number = {f: F.col(f).cast("double") for f in features}
    low = df.agg(
        F.struct(*[F.min(number[f]).alias(f) for f in features]).alias("low")
    ).scalar()
    shifted = df.select(*[(number[f] - low[f]).alias(f) for f in features])
    names = F.array(*[F.lit(f) for f in features])
    sums = (
        shifted.mapInPandas(
            _pair_sums(len(features)),
            "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double",
        )
        .groupBy("i", "j")
        .agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    )
    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    var_x = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), F.col("n"))
    var_y = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), F.col("n"))
    spread_xy = F.when((var_x > 0) & (var_y > 0), F.sqrt(var_x) * F.sqrt(var_y))
    pairs = sums.select(
        F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"),
        (cov / spread_xy).alias("r"), (F.col("i") == F.col("j")).alias("same"),
    )
    return pairs.select(
        F.inline(
            F.when(F.col("same"), F.array(F.struct("a", "b", "r"))).otherwise(
                F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
            )
        ).alias("feature_a", "feature_b", "correlation")
    )
