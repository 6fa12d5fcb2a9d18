"""Importances and per-comment explanations."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modlake.operators.metrics import ranking_metrics
from modlake.operators.prefix import running_totals

#: Adds ``y_score`` to a table with the feature columns.
Scorer = Callable[[DataFrame], DataFrame]
#: Scores of a matrix with one row per case and one column per feature.
MatrixScorer = Callable[[np.ndarray], np.ndarray]


def coefficient_ranking(coefficients: DataFrame, top: int | None = None) -> DataFrame:
    """``(feature, coef, abs_coef)`` by magnitude; ties by name."""
    ranked = coefficients.select("feature", "coef", F.abs("coef").alias("abs_coef")).orderBy(
        F.desc("abs_coef"), "feature"
    )
    return ranked.limit(top) if top else ranked


def zero_coefficients(coefficients: DataFrame) -> DataFrame:
    return coefficients.agg(
        F.count_if(F.col("coef") == 0).alias("zeroed"), F.count("*").alias("total")
    )


def top_features(attributions: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Per row the ``k`` strongest attributions, strongest first, with ranks.

    ``attributions`` holds one row per key and feature, so a group is as wide as
    the feature list.
    """
    strongest = F.slice(
        F.sort_array(
            F.collect_list(F.struct(
                F.abs("attribution").alias("size"), "feature", "value", "attribution"
            )),
            asc=False,
        ), 1, k,
    )
    rows = attributions.groupBy(key).agg(strongest.alias("t")).select(
        key, F.posexplode("t").alias("pos", "r"), F.get("t", F.lit(0))["size"].alias("_max")
    )
    return rows.select(
        key, (F.col("pos") + 1).alias("rank"), "r.feature", "r.value", "r.attribution",
        F.coalesce(F.try_divide(F.col("r.size") * 100, "_max"), F.lit(0.0)).alias("pct_of_max"),
    )


def top_feature_array(entries: Column, k: int = 10) -> Column:
    """The same as an array column, from an array of attribution structs (no shuffle)."""
    ordered = F.array_sort(
        entries,
        lambda a, b: F.when(F.abs(a["attribution"]) > F.abs(b["attribution"]), -1)
        .when(F.abs(a["attribution"]) < F.abs(b["attribution"]), 1)
        .when(a["feature"] < b["feature"], -1)
        .when(a["feature"] > b["feature"], 1)
        .otherwise(0),
    )
    return F.slice(ordered, 1, k)


def global_attribution(attributions: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature."""
    return attributions.groupBy("feature").agg(
        F.avg(F.abs("attribution")).alias("mean_abs_attribution")
    )


def hashed_sample(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """``size`` rows chosen by a hash of the key: the same on every run."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(size)


# --- permutation importance -------------------------------------------------

def dense_index(df: DataFrame, key: str, seed: int = 42, chunks: int = 1024) -> DataFrame:
    """Add ``_idx``: 0, 1, 2, ... in an order given by a hash of the key.

    Ranked in hash chunks, so no task sorts the whole table.
    """
    h = F.xxhash64(F.col(key), F.lit(seed))
    hashed = df.withColumns({"_h": h, "_one": F.lit(1), "_c": F.pmod(h, F.lit(chunks))})
    ranked = running_totals(
        hashed, {"_idx": "_one"}, keys=[], chunk="_c", order=[F.col("_h"), F.col(key)]
    )
    return ranked.withColumn("_idx", F.col("_idx") - 1).drop("_h", "_one", "_c")


def _multipliers(n: int, repeats: int, seed: int) -> list[tuple[int, int]]:
    """Per repeat a pair (a, b) with a coprime to n: i -> a*i + b mod n permutes 0..n-1."""
    rng = np.random.default_rng(seed)
    pairs: list[tuple[int, int]] = []
    bound = min(n, 2**31)
    while len(pairs) < repeats:
        a, b = (int(v) for v in rng.integers(1, max(bound, 2), size=2))
        if np.gcd(a, n) == 1:
            pairs.append((a, b % n))
    return pairs


def permutation_importance(
    df: DataFrame, scorer: Scorer, features: list[str], key: str,
    *, repeats: int = 10, seed: int = 42,
) -> DataFrame:
    """Mean and deviation of the ROC AUC lost when one feature is shuffled.

    Rows get a dense index in hash order; a repeat pairs each row with the donor
    at ``a*i + b mod n``.  That is a permutation by construction and costs one
    equi-join for all features and repeats together.  ``scorer`` adds
    ``y_score`` to a table with the feature columns.
    """
    indexed = dense_index(df.select(key, "y_true", *features), key, seed)
    n = df.count()
    pairs = _multipliers(n, repeats, seed)
    plan = F.array(*[
        F.struct(F.lit(r).alias("repeat"), F.lit(a).cast("decimal(20,0)").alias("a"), F.lit(b).alias("b"))
        for r, (a, b) in enumerate(pairs)
    ])
    # Decimal product: a*i can exceed 64 bits on large tables.
    donor = F.pmod(F.col("a") * F.col("_idx").cast("decimal(18,0)") + F.col("b"), F.lit(n).cast("decimal(20,0)"))
    asked = indexed.select("*", F.inline(plan)).withColumn("_donor", donor.cast("long"))
    donors = indexed.select(
        F.col("_idx").alias("_donor"), F.struct(*features).alias("_from")
    )
    shuffled = asked.join(donors, "_donor")
    variants = F.array(*[
        F.struct(
            F.lit(f).alias("feature"),
            *[(F.col("_from")[g] if g == f else F.col(g)).alias(g) for g in features],
        )
        for f in features
    ])
    rows = shuffled.select("y_true", "repeat", F.inline(variants))
    lost = ranking_metrics(scorer(rows), ["feature", "repeat"]).select("feature", "roc_auc")
    base = ranking_metrics(scorer(df)).select("roc_auc").scalar()
    drops = lost.withColumn("_drop", base - F.col("roc_auc"))
    return drops.groupBy("feature").agg(
        F.avg("_drop").alias("importance"), F.stddev_pop("_drop").alias("std")
    )


def _one_block_at_a_time(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Rows of one ``_block`` after the other from rows sorted by it, at most ``most`` at once."""
    held, size = [], 0
    for batch in batches:
        edges = np.flatnonzero(np.diff(batch["_block"].to_numpy())) + 1
        for part in np.split(np.arange(len(batch)), edges):
            rows = batch.iloc[part]
            if held and len(rows) and held[0]["_block"].iloc[0] != rows["_block"].iloc[0]:
                yield pd.concat(held)
                held, size = [], 0
            while size + len(rows) >= most:
                yield pd.concat([*held, rows.iloc[: most - size]])
                rows, held, size = rows.iloc[most - size :], [], 0
            if len(rows):
                held.append(rows)
                size += len(rows)
    if held:
        yield pd.concat(held)


def block_order(seed: int, repeat: int, block: int, size: int) -> np.ndarray:
    """The permutation of one repeat inside one block."""
    return np.random.default_rng([seed, repeat, block]).permutation(size)


def block_permutation_importance(
    df: DataFrame, score: MatrixScorer, features: list[str], key: str,
    *, repeats: int = 10, seed: int = 42, block: int = 1 << 14, bins: int = 1 << 14,
) -> DataFrame:
    """Mean and deviation of the ROC AUC lost when one feature is shuffled, in one shuffle of the rows.

    Rows are dealt by a hash of the key into blocks of about ``block`` rows, which are random
    subsets; a repeat permutes a feature inside each block.  A task scores every variant of its
    blocks as matrices and keeps, per variant, counts of positives and negatives in ``bins`` equal
    ranges of the score (0 to 1), so what leaves a task does not grow with its rows.

    ``error`` bounds what ties inside a range can change in any of the feature's differences.
    Rows without label or score count nowhere; with one class only all values are null.
    """
    blocks = max(1, df.count() // block)
    dealt = df.select(
        F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(blocks)).cast("int").alias("_block"),
        F.xxhash64(F.col(key), F.lit(seed + 1)).alias("_order"), F.col(key).alias("_key"),
        F.col("y_true").cast("int").alias("_true"), *[F.col(f).cast("double").alias(f) for f in features],
    )
    ordered = dealt.repartition("_block").sortWithinPartitions("_block", "_order", "_key", "_true", *features).drop("_key")

    def counted(y: np.ndarray, s: np.ndarray) -> np.ndarray:
        known = np.isfinite(s) & np.isfinite(y)
        at = np.clip((s[known] * bins).astype(np.int64), 0, bins - 1)
        return np.bincount(at + bins * (y[known] > 0), minlength=2 * bins)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((1 + repeats * len(features), 2 * bins), np.int64)
        for rows in _one_block_at_a_time(batches, 4 * block):
            x = rows[features].to_numpy(dtype=float, na_value=np.nan)
            y = rows["_true"].to_numpy(dtype=float, na_value=np.nan)
            counts[0] += counted(y, score(x))
            for repeat in range(repeats):
                order = block_order(seed, repeat, int(rows["_block"].iloc[0]), len(rows))
                for f in range(len(features)):
                    own = x[:, f].copy()
                    x[:, f] = own[order]
                    counts[1 + repeat * len(features) + f] += counted(y, score(x))
                    x[:, f] = own
        for variant, found in enumerate(counts):
            negative, positive = found[:bins], found[bins:]
            at = np.flatnonzero(negative + positive)
            yield pd.DataFrame({"variant": variant, "bin": at, "neg": negative[at], "pos": positive[at]})

    parts = ordered.mapInPandas(work, "variant int, bin int, neg bigint, pos bigint")
    sums = parts.groupBy("variant", "bin").agg(F.sum("neg").cast("double").alias("neg"), F.sum("pos").cast("double").alias("pos"))
    below = F.sum("neg").over(Window.partitionBy("variant").orderBy("bin")) - F.col("neg")  # at most ``bins`` rows
    pairs = F.sum("pos") * F.sum("neg")
    curves = sums.withColumn("below", below).groupBy("variant").agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)), pairs).alias("auc"),
        F.try_divide(F.sum(F.col("pos") * F.col("neg")) / 2, pairs).alias("tied"),
    )
    # One row with one entry per variant.
    together = curves.agg(
        F.max(F.when(F.col("variant") == 0, F.struct("auc", "tied"))).alias("base"),
        F.collect_list(F.struct("variant", "auc", "tied")).alias("all"),
    )
    names = F.array(*[F.lit(f) for f in features])
    drops = together.select("base", F.inline("all")).filter("variant > 0").select(
        F.get(names, F.pmod(F.col("variant") - 1, F.lit(len(features)))).alias("feature"),
        (F.col("base.auc") - F.col("auc")).alias("_drop"), (F.col("base.tied") + F.col("tied")).alias("_tied"),
    )
    return drops.groupBy("feature").agg(
        F.avg("_drop").alias("importance"), F.stddev_pop("_drop").alias("std"), F.max("_tied").alias("error")
    )


# --- attribution of any model -----------------------------------------------

def coalitions(width: int, samples: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Feature subsets and their kernel weights.

    All subsets when they fit in ``samples``; otherwise sizes are drawn by kernel
    weight and every draw is paired with its complement.
    """
    from math import comb

    sizes = np.arange(1, width)
    mass = (width - 1) / (sizes * (width - sizes))
    if 2**width - 2 <= samples:
        masks = np.array([[(m >> j) & 1 for j in range(width)] for m in range(1, 2**width - 1)])
        total = masks.sum(axis=1)
        weight = np.array([(width - 1) / (comb(width, s) * s * (width - s)) for s in total])
        return masks, weight
    rng = np.random.default_rng(seed)
    masks = np.zeros((samples, width), dtype=int)
    for row in range(0, samples - 1, 2):
        size = rng.choice(sizes, p=mass / mass.sum())
        masks[row, rng.permutation(width)[:size]] = 1
        masks[row + 1] = 1 - masks[row]
    masks = masks[: samples - samples % 2]
    return masks, np.ones(len(masks))


def _reference(background: DataFrame, features: list[str], key: str, size: int, seed: int) -> list[list[float]]:
    """A fixed, small number of reference rows."""
    rows = hashed_sample(background.select(key, *features), key, size, seed).collect()
    return [[float(r[f]) for f in features] for r in rows]


def batch_attribution(
    rows: DataFrame, background: DataFrame, score: MatrixScorer, features: list[str], key: str,
    *, background_size: int = 30, samples: int = 100, seed: int = 42, at_once: int = 1 << 16,
) -> DataFrame:
    """``kernel_attribution`` of a matrix scorer in one narrow pass: nothing is shuffled or exploded.

    Each batch is scored per feature subset against all reference rows, ``at_once`` cases at a
    time.  Rows with a missing feature get null attributions; every input row gives one row per feature.
    """
    width = len(features)
    masks, weights = coalitions(width, samples, seed)
    reference = np.array(_reference(background, features, key, background_size, seed)).reshape(-1, width)
    subsets = np.vstack([np.ones(width, int), np.zeros(width, int), masks]).astype(bool)
    design, solve = _solver(masks, weights)
    step = max(1, at_once // max(1, len(reference)))

    def explained(x: np.ndarray) -> np.ndarray:
        ys = np.empty((len(x), len(subsets)))
        for j, own in enumerate(subsets):
            mixed = np.where(own, x[:, None, :], reference[None, :, :]).reshape(-1, width)
            ys[:, j] = score(mixed).reshape(len(x), -1).mean(axis=1)
        return solve(design, ys)

    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), step):
                part = batch.iloc[a : a + step]
                x = part[[f"_{i}" for i in range(width)]].to_numpy(dtype=float, na_value=np.nan)
                phi = explained(x)
                phi[np.isnan(x).any(axis=1)] = np.nan
                yield pd.DataFrame({
                    key: part["_key"].repeat(width).to_numpy(), "feature": np.tile(np.array(features, dtype=object), len(part)),
                    "value": x.ravel(), "attribution": phi.ravel(),
                })

    asked = rows.select(F.col(key).alias("_key"), *[F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(features)])
    schema = T.StructType([
        T.StructField(key, rows.schema[key].dataType), T.StructField("feature", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("attribution", T.DoubleType()),
    ])
    return asked.mapInPandas(attribute, schema).withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in ("value", "attribution")})


def kernel_attribution(
    rows: DataFrame, background: DataFrame, scorer: Scorer, features: list[str], key: str,
    *, background_size: int = 30, samples: int = 100, seed: int = 42,
) -> DataFrame:
    """Sampled Shapley values of any scorer: ``(key, feature, value, attribution)``.

    Each row is scored once per feature subset and background row (both fixed in
    number), averaged over the background, and a small weighted least-squares
    problem is solved per row.  Attributions add up to score minus base score.
    """
    width = len(features)
    masks, weights = coalitions(width, samples, seed)
    reference = _reference(background, features, key, background_size, seed)
    subset_rows = F.array(*[
        F.struct(F.lit(i).alias("subset"), F.array(*[F.lit(bool(b)) for b in mask]).alias("mask"))
        for i, mask in enumerate([np.ones(width), np.zeros(width), *masks])
    ])
    reference_rows = F.array(*[F.array(*[F.lit(v) for v in r]) for r in reference])
    spread_out = rows.select(key, *features, F.inline(subset_rows)).select(
        "*", F.explode(reference_rows).alias("_bg")
    )
    mixed = spread_out.select(
        F.col(key), "subset",
        *[
            F.when(F.col("mask")[j], F.col(f).cast("double")).otherwise(F.col("_bg")[j]).alias(f)
            for j, f in enumerate(features)
        ],
    )
    means = scorer(mixed).groupBy(key, "subset").agg(F.avg("y_score").alias("y"))
    per_row = means.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("subset", "y"))), lambda s: s["y"]
        ).alias("ys")
    )
    design, solve = _solver(masks, weights)

    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ys = np.stack(batch["ys"].to_numpy()) if len(batch) else np.zeros((0, len(masks) + 2))
            phi = solve(design, ys)
            yield pd.DataFrame({
                key: np.repeat(batch[key].to_numpy(), width),
                "feature": np.tile(np.array(features, dtype=object), len(batch)),
                "attribution": phi.ravel(),
            })

    key_type = dict(rows.dtypes)[key]
    found = per_row.mapInPandas(attribute, f"{key} {key_type}, feature string, attribution double")
    values = rows.select(key, F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features
    ])))
    return values.join(found, [key, "feature"])


def _solver(masks: np.ndarray, weights: np.ndarray):
    """Weighted least squares under "attributions add up to full minus base"."""
    z = masks.astype(float)
    reduced = z[:, :-1] - z[:, -1:]
    gram = reduced.T @ (reduced * weights[:, None])
    design = np.linalg.pinv(gram) @ (reduced * weights[:, None]).T

    def solve(operator: np.ndarray, ys: np.ndarray) -> np.ndarray:
        full, base, inner = ys[:, 0], ys[:, 1], ys[:, 2:]
        gap = full - base
        target = inner - base[:, None] - gap[:, None] * z[:, -1][None, :]
        head = target @ operator.T
        return np.column_stack([head, gap - head.sum(axis=1)])

    return design, solve
