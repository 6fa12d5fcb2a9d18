"""Running totals and order statistics that never put a whole group in one task.

A plain ``sum() OVER (PARTITION BY g ORDER BY v)`` sorts every row of ``g`` in one
task.  Here a group is cut into ordered chunks; rows are windowed inside
``(group, chunk)``, the few chunk totals are accumulated per group, and each
chunk's starting total is joined back on ``(group, chunk)`` - the partitioning
the window already has, so the join moves no big side again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled values for each chunk of a group, of which the cut points are taken.
PER_CHUNK = 32
DRAWS = 1 << 30


def running_totals(
    df: DataFrame,
    sums: dict[str, str],
    *,
    keys: list[str],
    chunk: str,
    order: list[Column],
) -> DataFrame:
    """Add, per output name, the total of a column up to and including the row.

    ``chunk`` must grow with ``order`` inside a group.
    """
    inside = (
        Window.partitionBy(*keys, chunk)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = df.withColumns({out: F.sum(src).over(inside) for out, src in sums.items()})

    per_chunk = df.groupBy(*keys, chunk).agg(
        *[F.sum(src).alias(f"_t_{out}") for out, src in sums.items()]
    )
    # One row per chunk: bounded by the chunk count, not by the data.
    before = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy(chunk)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = per_chunk.select(
        *keys, chunk, *[F.sum(f"_t_{out}").over(before).alias(f"_s_{out}") for out in sums]
    )
    joined = local.join(starts, [*keys, chunk], "left")
    zero = F.lit(0)
    return joined.withColumns(
        {out: F.col(out) + F.coalesce(F.col(f"_s_{out}"), zero) for out in sums}
    ).drop(*[f"_s_{out}" for out in sums])


def _cuts(sample: Column, chunks: int) -> Column:
    ordered = F.array_sort(sample)
    return F.array_distinct(
        F.transform(
            F.sequence(F.lit(1), F.lit(chunks - 1)),
            lambda i: F.get(ordered, F.floor(i * F.size(ordered) / F.lit(chunks)).cast("int")),
        )
    )


def with_chunks(
    df: DataFrame, value: str, *, keys: list[str], chunks: int | None = None
) -> DataFrame:
    """Add ``_chunk``: value ranges holding about equally many rows per group.

    A group has as many chunks as the session has shuffle partitions.  Cut points come
    from about ``PER_CHUNK`` rows per chunk, those whose row hash is below a limit set by
    the group's size: no group is sorted for it, and the choice depends on the data only,
    so every evaluation of the plan, also after an executor is lost, sees the same chunks.
    Hashing the whole row keeps the sample's input identical to the main branch's, so one
    shuffle serves both.  ``keys`` must be few (names of columns or models); their cuts are
    broadcast.
    """
    if chunks is None:
        chunks = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    step = math.isqrt(chunks)
    draw = F.pmod(F.xxhash64(*df.columns), F.lit(DRAWS))
    below = F.lit(float(PER_CHUNK * chunks * DRAWS)) / F.col("_rows")
    # The sizes read the value too (max): without it the pruned plan would be another one
    # and could not share the main branch's shuffle.
    sized = [F.count("*").alias("_rows"), F.max(F.xxhash64(*df.columns)).alias("_any")]
    cuts = _cuts(F.collect_list(value), chunks).alias("_cuts")
    every = F.filter("_cuts", lambda c, i: i % step == 0).alias("_every")
    if keys:
        # A left join adds no IS NOT NULL test, so all branches keep the same input
        # plan and Spark runs their common shuffle once.
        sizes = df.groupBy(*keys).agg(*sized)
        picked = df.join(F.broadcast(sizes), keys, "left").filter((draw < below) & F.col("_any").isNotNull())
        found = picked.groupBy(*keys).agg(cuts).select(*keys, "_cuts", every)
        placed = df.join(F.broadcast(found), keys, "left")
    else:
        size = df.agg(F.struct(*sized).alias("s")).scalar()
        picked = df.withColumn("_s", size).select(*df.columns, "_s._rows").filter(draw < below)
        both = picked.agg(cuts).select(F.struct("_cuts", every).alias("c")).scalar()
        placed = df.withColumn("_c", both).select(*df.columns, "_c._cuts", "_c._every")
    return _locate(placed, value, step)


def _locate(df: DataFrame, value: str, step: int) -> DataFrame:
    """Number of cuts at or below the value: first among every ``step``-th, then inside."""
    def reached(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda c: c <= F.col(value)))

    block = df.withColumn("_start", F.greatest(reached(F.col("_every")) - 1, F.lit(0)) * step)
    inside = reached(F.slice("_cuts", F.col("_start") + 1, F.lit(step)))
    # Never NULL: a nullable join key would make the optimizer push an IS NOT NULL
    # test, and with it the computation of ``value``, below the aggregation.
    chunk = F.coalesce(F.col("_start") + inside, F.lit(0))
    return block.withColumn("_chunk", chunk).drop("_cuts", "_every", "_start")


def present(value: str) -> Column:
    return F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct non-missing values with their counts (combined before the shuffle)."""
    return df.filter(present(value)).groupBy(*keys, value).agg(F.count("*").alias("n"))


def exact_quantiles(
    counts: DataFrame, probs: dict[str, float], *, keys: list[str], value: str = "value"
) -> DataFrame:
    """Exact linear-interpolated quantiles per group of a ``value_counts`` table."""
    ranked = running_totals(
        with_chunks(counts, value, keys=keys), {"_cum": "n"},
        keys=keys, chunk="_chunk", order=[F.col(value)],
    )
    if keys:
        totals = counts.groupBy(*keys).agg(F.sum("n").alias("_n"))
        ranked = ranked.join(F.broadcast(totals), keys, "left")
    else:
        ranked = ranked.withColumn("_n", counts.agg(F.sum("n").alias("_n")).scalar())

    def at(rank: Column) -> Column:
        here = (F.col("_cum") - F.col("n") <= rank) & (rank < F.col("_cum"))
        return F.max(F.when(here, F.col(value)))

    picks = []
    for name, p in probs.items():
        place = F.lit(p) * (F.col("_n") - 1)
        picks += [
            at(F.floor(place)).alias(f"_lo_{name}"),
            at(F.ceil(place)).alias(f"_hi_{name}"),
            F.max(place - F.floor(place)).alias(f"_f_{name}"),
        ]
    found = ranked.groupBy(*keys).agg(*picks)
    return found.select(
        *keys,
        *[
            (
                F.col(f"_lo_{name}")
                + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_f_{name}")
            ).alias(name)
            for name in probs
        ],
    )
