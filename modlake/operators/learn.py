"""Split, scaling, training, tuning and voting.

Fitting runs on Spark ML (block-wise tree aggregation); what comes back to the
driver is a few numbers per feature.  Linear models come back as ``LinearModel``,
so scoring them is a plain projection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modlake.operators.columns import column_stats
from modlake.operators.iterative import Descent, blocks, l1_descent, squared_hinge
from modlake.operators.linear import LinearModel
from modlake.operators.metrics import basic_metrics, classification_report, f1_threshold, ranking_metrics
from modlake.operators.prefix import running_totals
from modlake.session import scratch_folder

BUCKETS = 1_000_000
MAX_DEPTH = 30  # Spark's limit; stands for no limit given


# --- split and weights --------------------------------------------------------

def _labelled(df: DataFrame, label: str) -> DataFrame:
    """Refuse rows without a label when they are read, so that none vanishes in a join."""
    missing = F.raise_error(F.lit(f"a row has no {label}"))
    return df.withColumn(label, F.coalesce(F.col(label), missing))


def stratified_split(
    df: DataFrame, key: str, label: str, train_share: float = 0.8, seed: int = 42
) -> DataFrame:
    """Add ``split`` with the same train share in every class.

    Rows fall into hash buckets; per class the buckets are filled up to the
    share.  The choice depends on key and seed only, so re-runs agree.  Only
    bucket counts (bounded) are ranked.
    """
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(BUCKETS))
    placed = _labelled(df, label).withColumn("_b", bucket)
    counts = (
        placed.groupBy(label, "_b").agg(F.count("*").alias("_n"))
        .withColumn("_c", F.floor(F.col("_b") / 4096))
    )
    ranked = running_totals(counts, {"_cum": "_n"}, keys=[label], chunk="_c", order=[F.col("_b")])
    sizes = counts.groupBy(label).agg(F.sum("_n").alias("_total"))
    cut = (
        ranked.join(F.broadcast(sizes), label)
        .filter(F.col("_cum") >= F.ceil(F.col("_total") * F.lit(train_share)))
        .groupBy(label).agg(F.min("_b").alias("_cut"))
    )
    part = F.when(F.col("_b") <= F.col("_cut"), "train").otherwise("test")
    return placed.join(F.broadcast(cut), label).withColumn("split", part).drop("_b", "_cut")


def folded(df: DataFrame, key: str, folds: int = 3, seed: int = 42, label: str | None = None) -> DataFrame:
    """Add ``fold`` (0..folds-1).  With ``label``, fold sizes differ by one at most in every class.

    Rows of a class are ranked by a digest of key and seed, and dealt out in turn.  The ranks come from counts
    of hash buckets (bounded) and places inside a bucket, so no class is sorted in one task.
    """
    if label is None:
        return df.withColumn("fold", F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(folds)).cast("int"))
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed + 1))))
    bucket = F.conv(F.substring(digest, 1, 5), 16, 10).cast("int")  # 2 ** 20 buckets, in the order of digests
    placed = _labelled(df, label).withColumn("_h", digest).withColumn("_b", bucket)
    counts = placed.groupBy(label, "_b").agg(F.count("*").alias("_n")).withColumn("_c", F.floor(F.col("_b") / 4096))
    before = running_totals(counts, {"_cum": "_n"}, keys=[label], chunk="_c", order=[F.col("_b")]).select(
        label, "_b", (F.col("_cum") - F.col("_n")).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", F.col(key))) - 1
    ranked = placed.withColumn("_i", inside).join(before, [label, "_b"])
    fold = F.pmod(F.col("_before") + F.col("_i"), F.lit(folds)).cast("int")
    return ranked.withColumn("fold", fold).select(*df.columns, "fold")


def written_folds(df: DataFrame, key: str, folds: int = 3, seed: int = 42, label: str | None = None) -> DataFrame:
    """``folded`` as a table of the shared folder: dealt out once, however many fits read it."""
    data, spark = folded(df, key, folds, seed, label), df.sparkSession
    folder = scratch_folder(spark, "folds")
    data.write.mode("overwrite").parquet(folder)
    return spark.read.schema(data.schema).parquet(folder)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights ``n / (classes * class size)``."""
    counts = df.groupBy(label).agg(F.count("*").alias("rows"))
    total = counts.agg(F.struct(F.sum("rows").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    return counts.select(label, "rows", (total["n"] / (total["k"] * F.col("rows"))).alias("weight"))


def with_balanced_weight(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight``; the weight table has one row per class."""
    rows = _labelled(df, label)
    weights = class_weights(rows, label).select(label, "weight")
    return rows.join(F.broadcast(weights), label)


# --- scaling ------------------------------------------------------------------

def scale_params(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, mean, std)``: population deviation, 1 for constant columns."""
    stats = column_stats(df, features, {"mean": F.avg, "std": F.stddev_pop})
    return stats.withColumn("std", F.when(F.col("std") > 0, F.col("std")).otherwise(F.lit(1.0)))


def scaled_columns(train: DataFrame, features: Sequence[str]) -> dict[str, Column]:
    """Scaled version of each feature, with parameters of ``train``, still lazy."""
    params = train.agg(*[
        F.struct(
            *[F.avg(F.col(f).cast("double")).alias(f"m_{f}") for f in features],
            *[F.stddev_pop(F.col(f).cast("double")).alias(f"s_{f}") for f in features],
        ).alias("p")
    ]).scalar()

    def one(f: str) -> Column:
        std = F.when(params[f"s_{f}"] > 0, params[f"s_{f}"]).otherwise(F.lit(1.0))
        return (F.col(f) - params[f"m_{f}"]) / std

    return {f: one(f) for f in features}


def fitted_scaler(train: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    return {
        r["feature"]: (float(r["mean"]), float(r["std"]))
        for r in scale_params(train, features).collect()
    }


def apply_scaler(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({f: (F.col(f) - F.lit(m)) / F.lit(s) for f, (m, s) in scaler.items()})


# --- training -----------------------------------------------------------------

@dataclass(frozen=True)
class Fitted:
    """A trained scorer: ``score`` adds ``y_score`` (and says if it is a probability)."""

    score: Callable[[DataFrame], DataFrame]
    importance: dict[str, float]
    is_probability: bool = True
    linear: LinearModel | None = None


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="_x").transform(df)


def _checked(df: DataFrame, label: str) -> int:
    """Row count, after making sure that both classes are there."""
    found = {r[label]: r["count"] for r in df.groupBy(label).count().limit(3).collect()}
    if set(found) != {0, 1}:
        raise ValueError(f"labels must be 0 and 1 and both occur, got {sorted(found, key=str)}")
    return sum(found.values())


def _linear(model, features, scaler, threshold) -> Fitted:
    coefs = [float(c) for c in model.coefficients]
    terms = {f: (*scaler[f], c) for f, c in zip(features, coefs)}
    linear = LinearModel(float(model.intercept), terms, threshold)
    return Fitted(
        lambda df: df.withColumn("y_score", linear.probability()),
        dict(zip(features, coefs)), True, linear,
    )


def train_l1_logistic(
    df: DataFrame, features: Sequence[str], label: str, alpha: float = 0.01,
    *, weight: str | None = None, threshold: float = 0.5, max_iter: int = 2000, tol: float = 1e-8,
) -> Fitted:
    """L1 logistic regression on scaled features, intercept unpenalised."""
    _checked(df, label)
    scaler = fitted_scaler(df, features)
    fit = LogisticRegression(
        featuresCol="_x", labelCol=label, elasticNetParam=1.0, regParam=alpha,
        standardization=False, maxIter=max_iter, tol=tol, **({"weightCol": weight} if weight else {}),
    ).fit(_assembled(apply_scaler(df, scaler), features))
    return _linear(fit, features, scaler, threshold)


def train_l2_logistic(
    df: DataFrame, features: Sequence[str], label: str, c: float = 1.0,
    *, threshold: float = 0.5, max_iter: int = 1000, tol: float = 1e-8,
) -> Fitted:
    """L2 logistic regression with balanced classes; ``c`` as inverse strength."""
    n = _checked(df, label)
    scaler = fitted_scaler(df, features)
    data = _assembled(apply_scaler(with_balanced_weight(df, label), scaler), features)
    # Balanced weights add up to n.
    fit = LogisticRegression(
        featuresCol="_x", labelCol=label, weightCol="weight", elasticNetParam=0.0,
        regParam=1.0 / (c * n), standardization=False, maxIter=max_iter, tol=tol,
    ).fit(data)
    return _linear(fit, features, scaler, threshold)


def train_l1_steps(
    df: DataFrame, features: Sequence[str], label: str, alpha: float = 0.01, *, learning_rate: float = 0.1,
    tol: float = 1e-4, max_iter: int = 2000, weight: str | None = None, threshold: float = 0.5,
) -> tuple[Fitted, Descent]:
    """L1 logistic regression by proximal-gradient steps on scaled features, with a learning rate and a stop rule.

    The number of steps, the last change and whether it fell below ``tol`` come back with the model.
    """
    _checked(df, label)
    scaler = fitted_scaler(df, features)
    packed = blocks(apply_scaler(df, scaler), features, label, weight, scratch_folder(df.sparkSession, "l1"))
    end = l1_descent(packed, len(features), alpha=alpha, rate=learning_rate, tol=tol, max_iter=max_iter)
    linear = _as_linear(end, features, scaler, threshold)
    return Fitted(
        lambda rows: rows.withColumn("y_score", linear.probability()), dict(zip(features, end.coef.tolist())), True, linear
    ), end


def train_linear_svm(
    df: DataFrame, features: Sequence[str], label: str, c: float = 1.0, *, max_iter: int = 50, tol: float = 1e-9
) -> Fitted:
    """Linear SVM (squared hinge, penalised intercept) with balanced classes; scores are margins, not probabilities."""
    _checked(df, label)
    scaler = fitted_scaler(df, features)
    data = apply_scaler(with_balanced_weight(df, label), scaler)
    packed = blocks(data, features, label, "weight", scratch_folder(df.sparkSession, "svm"))
    end = squared_hinge(packed, len(features), c=c, max_iter=max_iter, tol=tol)
    linear = _as_linear(end, features, scaler, 0.0)
    return Fitted(
        lambda rows: rows.withColumn("y_score", linear.logit()), dict(zip(features, end.coef.tolist())), False, linear
    )


def _as_linear(end: Descent, features: Sequence[str], scaler: dict, threshold: float) -> LinearModel:
    return LinearModel(end.intercept, {f: (*scaler[f], float(v)) for f, v in zip(features, end.coef)}, threshold)


def svm_gradient(df: DataFrame, model: LinearModel, label: str, c: float = 1.0) -> DataFrame:
    """Gradient of the squared-hinge objective at a model, by weight of rows; zero at its minimum.  One aggregate."""
    rows = with_balanced_weight(df, label)
    side = 2 * F.col(label).cast("double") - 1
    pull = -2 * F.lit(float(c)) * F.col("weight") * side * F.greatest(F.lit(0.0), 1 - side * model.logit())
    total = F.sum("weight")

    def row(name: str, coef: float, x: Column) -> Column:
        return F.struct(F.lit(name).alias("feature"), ((F.lit(coef) + F.sum(pull * x)) / total).alias("gradient"), F.count("*").alias("rows"))

    found = [row("(intercept)", model.intercept, F.lit(1.0))]
    found += [row(f, coef, model.scaled(f)) for f, (_, _, coef) in model.terms.items()]
    return rows.agg(F.array(*found).alias("r")).select(F.inline("r"))


def train_random_forest(
    df: DataFrame, features: Sequence[str], label: str, *, trees: int = 100,
    max_depth: int | None = None, min_split: int = 2, seed: int = 42,
) -> Fitted:
    """Random forest with balanced classes and sqrt(p) features per split.

    A node is split only if both halves keep at least ``min_split // 2`` rows,
    the nearest Spark has to a minimum size of the node itself.
    """
    if max_depth is not None and not 0 <= max_depth <= MAX_DEPTH:
        raise ValueError(f"max_depth must be from 0 to {MAX_DEPTH}, or None")
    _checked(df, label)
    scaler = fitted_scaler(df, features)
    data = _assembled(apply_scaler(with_balanced_weight(df, label), scaler), features)
    fit = RandomForestClassifier(
        featuresCol="_x", labelCol=label, weightCol="weight", numTrees=trees,
        maxDepth=MAX_DEPTH if max_depth is None else max_depth, minInstancesPerNode=max(1, min_split // 2),
        featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=False,
    ).fit(data)

    def score(rows: DataFrame) -> DataFrame:
        scaled = [((F.col(f) - m) / s).alias(f) for f, (m, s) in scaler.items()]
        vector = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep")
        kept = rows.withColumn("_row", F.struct(*rows.columns)).select("_row", *scaled)
        out = fit.transform(vector.transform(kept))
        return out.select("_row.*", F.get(vector_to_array("probability"), F.lit(1)).alias("y_score"))

    return Fitted(score, dict(zip(features, map(float, fit.featureImportances.toArray()))))


def prior_baseline(df: DataFrame, train: DataFrame, label: str, seed: int = 42) -> DataFrame:
    """Predict each class as often as it occurs in ``train``, by a seeded draw."""
    prior = train.agg(F.avg(F.col(label).cast("double"))).scalar()
    return df.withColumns({
        "y_score": F.lit(1.0) * prior, "y_pred": (F.rand(seed) < prior).cast("int"),
    })


def l1_gradient_step(
    df: DataFrame, model: LinearModel, label: str, alpha: float, rate: float, weight: str | None = None
) -> DataFrame:
    """One proximal-gradient step of L1 logistic regression, as one aggregate.

    Rows: one per feature and one for the intercept, with gradient, old and new
    coefficient and the change.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    residual = w * (model.probability() - F.col(label))
    total = F.sum(w)

    def soft(v: Column) -> Column:
        return F.signum(v) * F.greatest(F.abs(v) - F.lit(alpha * rate), F.lit(0.0))

    def row(name: str, gradient: Column, old: float, shrink: bool):
        moved = F.lit(old) - F.lit(rate) * gradient
        new = soft(moved) if shrink else moved
        return F.struct(
            F.lit(name).alias("feature"), gradient.alias("gradient"),
            F.lit(old).alias("coef"), new.alias("new_coef"), F.abs(new - F.lit(old)).alias("delta"),
        )

    rows = [row("(intercept)", F.sum(residual) / total, model.intercept, False)]
    for f, (_, _, coef) in model.terms.items():
        rows.append(row(f, F.sum(residual * model.scaled(f)) / total, coef, True))
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


# --- tuning -------------------------------------------------------------------

Trainer = Callable[..., Fitted]


def grid_search(
    df: DataFrame, features: Sequence[str], label: str, key: str, trainer: Trainer,
    grid: dict[str, Sequence], *, folds: int = 3, seed: int = 42, parallel: int = 4,
) -> DataFrame:
    """Average precision of every parameter set on every fold, with ranks.

    Each fit and each evaluation is a distributed job; the driver only keeps one
    number per cell.
    """
    data = written_folds(df, key, folds, seed, label)
    names = list(grid)
    cells = list(product(*grid.values()))

    def run(cell_fold):
        values, fold = cell_fold
        model = trainer(data.filter(F.col("fold") != fold), features, label, **dict(zip(names, values)))
        held = data.filter(F.col("fold") == fold).withColumnRenamed(label, "y_true")
        return ranking_metrics(model.score(held)).first()["average_precision"]

    spark = df.sparkSession
    with ThreadPool(parallel) as pool:
        scores = pool.map(
            inheritable_thread_target(spark)(run), [(c, f) for c in cells for f in range(folds)]
        )
    per_cell = [
        [s if s is not None else 0.0 for s in scores[i * folds:(i + 1) * folds]]
        for i in range(len(cells))
    ]
    means = [float(np.mean(s)) for s in per_cell]
    rows = [
        (
            *[None if v is None else str(v) for v in cell], *map(float, per_cell[i]), means[i],
            float(np.std(per_cell[i])), 1 + sum(round(m, 12) > round(means[i], 12) for m in means),
        )
        for i, cell in enumerate(cells)
    ]
    schema = ", ".join(
        [f"param_{n} string" for n in names] + [f"split{f}_test_score double" for f in range(folds)]
        + ["mean_test_score double", "std_test_score double", "rank_test_score int"]
    )
    return spark.createDataFrame(rows, schema)


def out_of_fold_scores(
    df: DataFrame, features: Sequence[str], label: str, key: str, trainer: Trainer,
    *, folds: int = 3, seed: int = 42, **params,
) -> DataFrame:
    """``(key, y_true, y_score)``: each row scored by a model that has not seen it."""
    data = written_folds(df, key, folds, seed, label)
    parts = []
    for fold in range(folds):
        model = trainer(data.filter(F.col("fold") != fold), features, label, **params)
        held = data.filter(F.col("fold") == fold).withColumnRenamed(label, "y_true")
        parts.append(model.score(held).select(key, "y_true", "y_score"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def tuned_threshold(oof: DataFrame) -> float:
    return float(f1_threshold(oof).first()["threshold"])


def feature_ablation(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: str,
    *, tops: Sequence[int] = (5, 10), folds: int = 5, **forest,
) -> DataFrame:
    """Forests on the most important features against the full forest.

    Each threshold is tuned on the last of ``folds`` parts of the training rows.
    Class weights are applied once.
    """
    full = train_random_forest(train, features, label, **forest)
    ranked = sorted(features, key=lambda f: (-full.importance[f], f))
    spark, rows = train.sparkSession, []
    data = written_folds(train, key, folds, label=label)
    seen, held = data.filter(F.col("fold") != folds - 1), data.filter(F.col("fold") == folds - 1)
    for name, chosen in [("all", list(features))] + [(f"top_{k}", ranked[:k]) for k in tops]:
        model = full if name == "all" else train_random_forest(train, chosen, label, **forest)
        probe = train_random_forest(seen, chosen, label, **forest)
        cut = tuned_threshold(probe.score(held.withColumnRenamed(label, "y_true")))
        scored = model.score(test.withColumnRenamed(label, "y_true")).withColumn(
            "y_pred", (F.col("y_score") >= cut).cast("int")
        )
        ranking = ranking_metrics(scored).first()
        macro = classification_report(scored).filter("class = 'macro avg'").first()["f1"]
        rows.append((
            name, len(chosen), ",".join(chosen), ranking["average_precision"],
            ranking["roc_auc"], float(macro), cut,
        ))
    return spark.createDataFrame(
        rows, "model string, n_features int, features string, pr_auc double, roc_auc double,"
        " macro_f1 double, threshold double",
    )


# --- combining and serving ----------------------------------------------------

def soft_vote(members: Sequence[DataFrame], key: str) -> DataFrame:
    """Mean probability of the members; label 1 only above 0.5.

    A row missing in a member is voted on by the others.
    """
    if not members:
        raise ValueError("soft vote needs at least one member")
    votes = members[0].select(key, "probability")
    for member in members[1:]:
        votes = votes.unionByName(member.select(key, "probability"))
    mean = votes.groupBy(key).agg(F.avg("probability").alias("probability"))
    return mean.withColumn("label", (F.col("probability") > 0.5).cast("int"))


def score_contract(
    scored: DataFrame, keys: list[str], *, explain_version: str = "",
    probability: str = "probability", label: str = "label",
) -> DataFrame:
    """``label, probability, top_features, explain_version, inference_ms, error``.

    A row that could not be scored gets label 0, probability 0 and no features.
    """
    has_top = "top_features" in scored.columns
    empty = F.array().cast("array<struct<feature:string,value:double,attribution:double>>")
    top = F.coalesce(F.col("top_features"), empty) if has_top else empty
    p = F.col(probability)
    failed = (p.isNull() | F.isnan(p)) & F.col(label).isNull()
    ms = F.col("inference_ms") if "inference_ms" in scored.columns else F.lit(0.0)
    return scored.select(
        *keys,
        F.when(failed, 0).otherwise(F.coalesce(F.col(label), F.lit(0))).cast("int").alias("label"),
        F.when(failed | p.isNull() | F.isnan(p), 0.0).otherwise(p).alias("probability"),
        F.when(failed, empty).otherwise(top).alias("top_features"),
        F.when(failed, "").otherwise(F.lit(explain_version)).alias("explain_version"),
        F.when(failed, 0.0).otherwise(F.round(ms, 2)).alias("inference_ms"),
        F.when(failed, "no score").alias("error"),
    )


def evaluate(preds: DataFrame, model_id: str, model_name: str, version: str) -> DataFrame:
    """One report row: rounded metrics, 2x2 matrix."""
    ranking = ranking_metrics(preds).select(
        F.struct(F.col("roc_auc"), F.col("average_precision").alias("pr_auc")).alias("r")
    ).scalar()
    counts = preds.agg(*[
        F.count_if((F.col("y_true") == y) & (F.col("y_pred") == p)).alias(n)
        for n, y, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    ]).select(F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("m")).scalar()
    return basic_metrics(preds).select(
        F.lit(model_id).alias("model_id"), F.lit(model_name).alias("model_name"),
        F.lit(version).alias("version"),
        *[F.round(c, 4).alias(c) for c in ("accuracy", "precision", "recall", "f1")],
        F.round(ranking["roc_auc"], 4).alias("roc_auc"),
        F.round(ranking["pr_auc"], 4).alias("pr_auc"),
        counts.alias("confusion_matrix"),
    )
