"""Classification metrics and curves from ``y_true, y_pred, y_score`` tables.

Curves first count rows per distinct score (combined before the shuffle), so ties
are one point and the running sums run over distinct scores in range chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modlake.operators import prefix
from modlake.operators.histogram import bin_index, edge


def _when(y: int, p: int) -> Column:
    return F.count_if((F.col("y_true") == y) & (F.col("y_pred") == p))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))


def outcome_counts(preds: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return preds.groupBy(*(keys or [])).agg(
        _when(0, 0).alias("tn"), _when(0, 1).alias("fp"),
        _when(1, 0).alias("fn"), _when(1, 1).alias("tp"),
    )


def basic_metrics(preds: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1; 0 where a ratio is 0/0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return outcome_counts(preds, keys).select(
        *(keys or []),
        _ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(preds: DataFrame) -> DataFrame:
    """``(y_true, y_pred, count, row_pct)``; percentages of each actual class."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def cell(y, p, n, row):
        return F.struct(
            F.lit(y).alias("y_true"), F.lit(p).alias("y_pred"), n.alias("count"),
            (_ratio(n, row) * 100).alias("row_pct"),
        )

    cells = F.array(
        cell(0, 0, tn, tn + fp), cell(0, 1, fp, tn + fp),
        cell(1, 0, fn, fn + tp), cell(1, 1, tp, fn + tp),
    )
    return outcome_counts(preds).select(F.inline(cells))


def classification_report(preds: DataFrame) -> DataFrame:
    """Per class and as macro / weighted average."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    names = ("precision", "recall", "f1")

    def one(hit, wrong, missed):
        return (
            _ratio(hit, hit + wrong), _ratio(hit, hit + missed),
            _ratio(2 * hit, 2 * hit + wrong + missed),
        )

    zero, one_ = one(tn, fn, fp), one(tp, fp, fn)
    n0, n1 = tn + fp, fn + tp

    def row(label, values, support):
        return F.struct(
            F.lit(label).alias("class"),
            *[v.alias(n) for v, n in zip(values, names)], support.alias("support"),
        )

    macro = [(a + b) / 2 for a, b in zip(zero, one_)]
    weighted = [_ratio(a * n0 + b * n1, n0 + n1) for a, b in zip(zero, one_)]
    rows = F.array(
        row("0", zero, n0), row("1", one_, n1),
        row("macro avg", macro, n0 + n1), row("weighted avg", weighted, n0 + n1),
    )
    return outcome_counts(preds).select(F.inline(rows))


# --- curves -----------------------------------------------------------------

def score_counts(preds: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``(keys..., y_score, pos, neg)`` per distinct score.

    Rows without a score drop out after the aggregation: a filter on the score
    before it would compute every score twice.
    """
    scored = F.col("y_score").isNotNull()
    counts = preds.groupBy(*(keys or []), "y_score").agg(
        F.count_if(scored & (F.col("y_true") == 1)).alias("pos"),
        F.count_if(scored & (F.col("y_true") == 0)).alias("neg"),
    )
    return counts.filter(F.col("pos") + F.col("neg") > 0)


def _ranked(counts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts so far per distinct score, highest score first.

    ``keys`` must be few (models, features), see ``prefix.with_chunks``.
    """
    keys = keys or []
    negated = counts.withColumn("_neg_score", -F.col("y_score"))
    return prefix.running_totals(
        prefix.with_chunks(negated, "_neg_score", keys=keys), {"tp": "pos", "fp": "neg"},
        keys=keys, chunk="_chunk", order=[F.col("_neg_score")],
    ).withColumnRenamed("y_score", "threshold")


def ranking_metrics(preds: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """ROC AUC, trapezoid PR AUC and average precision; NULL with one class.

    The previous curve point is the running count minus the row's own count, so
    no row needs its neighbour.
    """
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    before_tp, before = tp - pos, tp - pos + fp - neg
    precision = tp / (tp + fp)
    previous = F.when(before > 0, F.try_divide(before_tp, before)).otherwise(F.lit(1.0))
    sums = _ranked(score_counts(preds, keys), keys).groupBy(*(keys or [])).agg(
        F.sum(neg * (tp - pos / 2)).alias("_area"),
        F.sum(pos * (precision + previous) / 2).alias("_pr"),
        F.sum(pos * precision).alias("_ap"),
        F.sum(pos).alias("_p"), F.sum(neg).alias("_n"),
    )
    return sums.select(
        *(keys or []),
        F.try_divide("_area", F.col("_p") * F.col("_n")).alias("roc_auc"),
        F.try_divide("_pr", "_p").alias("pr_auc"),
        F.try_divide("_ap", "_p").alias("average_precision"),
    )


def _class_totals(counts: DataFrame) -> Column:
    return counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t")).scalar()


def roc_curve(preds: DataFrame, drop_collinear: bool = False) -> DataFrame:
    """``(threshold, fpr, tpr)`` from (0, 0) - threshold +infinity - to (1, 1).

    ``drop_collinear`` leaves out points on a straight line between their
    neighbours, as plotting libraries do.
    """
    counts = score_counts(preds)
    points = _ranked(counts)
    if drop_collinear:
        points = _corners(points)
    total = _class_totals(counts)
    curve = points.select(
        "threshold",
        F.try_divide(F.col("fp").cast("double"), total["n"]).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), total["p"]).alias("tpr"),
    )
    start = preds.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(curve)


def _corners(points: DataFrame) -> DataFrame:
    """The first and last point, and points whose next step differs from their own."""
    order = Window.partitionBy("_chunk").orderBy("_neg_score")
    step = F.struct("pos", "neg")
    inside = points.withColumn("_next", F.lead(step).over(order))
    heads = points.groupBy("_chunk").agg(F.min_by(step, "_neg_score").alias("_head"))
    # One row per chunk.
    chained = Window.partitionBy(F.lit(0)).orderBy("_chunk")
    following = heads.select("_chunk", F.lead("_head").over(chained).alias("_after"))
    joined = inside.join(following, "_chunk").withColumn("_next", F.coalesce("_next", "_after"))
    same = (F.col("_next.pos") == F.col("pos")) & (F.col("_next.neg") == F.col("neg"))
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    return joined.filter(F.coalesce(~same, F.lit(True)) | first)


def pr_curve(preds: DataFrame) -> DataFrame:
    """``(threshold, precision, recall)``, closed by precision 1 at recall 0."""
    counts = score_counts(preds)
    total = _class_totals(counts)
    tp, fp = F.col("tp").cast("double"), F.col("fp")
    curve = _ranked(counts).select(
        "threshold", (tp / (tp + fp)).alias("precision"),
        F.coalesce(F.try_divide(tp, total["p"]), F.lit(1.0)).alias("recall"),
    )
    end = preds.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(end)


def f1_threshold(preds: DataFrame) -> DataFrame:
    """Score cut with the best F1; the lowest one among equals."""
    counts = score_counts(preds)
    total = _class_totals(counts)["p"]
    tp, fp = F.col("tp").cast("double"), F.col("fp")
    precision, recall = tp / (tp + fp), F.try_divide(tp, total)
    f1 = 2 * precision * recall / (precision + recall + F.lit(1e-9))
    # Spark ML scores count as non-deterministic, so the total must not stand
    # inside the aggregate function.
    best = _ranked(counts).withColumn("_f1", F.round(f1, 12)).agg(
        F.max(F.struct(F.col("_f1").alias("f1"), (-F.col("threshold")).alias("t"))).alias("b")
    )
    return best.select((-F.col("b.t")).alias("threshold"), F.col("b.f1").alias("f1"))


def calibration(preds: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score and positive share per quantile bin; empty for non-probabilities."""
    counts = score_counts(preds).select("y_score", (F.col("pos") + F.col("neg")).alias("n"), "pos")
    probs = {f"e{i}": i / bins for i in range(1, bins)}
    edges = prefix.exact_quantiles(
        counts.withColumnRenamed("y_score", "value").select("value", "n"), probs, keys=[]
    ).select(F.array(*probs).alias("e")).scalar()
    span = counts.agg(F.struct(F.min("y_score").alias("lo"), F.max("y_score").alias("hi")).alias("s")).scalar()
    below = F.size(F.filter("_edges", lambda e: e < F.col("y_score")))
    placed = counts.withColumns({"_edges": edges, "_ok": (span["lo"] >= 0) & (span["hi"] <= 1)})
    binned = placed.filter("_ok").groupBy(below.alias("bin"))
    n = F.sum("n")
    return binned.agg(
        n.alias("count"), (F.sum("pos") / n).alias("fraction_positive"),
        (F.sum(F.col("y_score") * F.col("n")) / n).alias("mean_score"),
    )


# --- errors -----------------------------------------------------------------

def score_or_fallback(*columns: str) -> Column:
    """Probability, else decision value, else the prediction itself."""
    return F.coalesce(*[F.col(c).cast("double") for c in columns])


def outcome() -> Column:
    y, p = F.col("y_true"), F.col("y_pred")
    return (
        F.when((y == 1) & (p == 1), "TP").when((y == 0) & (p == 0), "TN")
        .when((y == 0) & (p == 1), "FP").when((y == 1) & (p == 0), "FN")
    )


def worst_errors(preds: DataFrame, kind: str, key: str, limit: int = 20) -> DataFrame:
    """The most confident false positives (FP) or negatives (FN)."""
    if kind not in ("FP", "FN"):
        raise ValueError("kind must be FP or FN")
    order = F.desc("y_score") if kind == "FP" else F.asc("y_score")
    return preds.filter(outcome() == kind).orderBy(order, key).limit(limit)


def error_patterns(preds: DataFrame, scaled: dict[str, Column], top: list[str]) -> DataFrame:
    """Mean (scaled) value of correct, FP and FN rows for the ``top`` features."""
    result = outcome()

    def mean(f, *kinds):
        return F.avg(F.when(result.isin(*kinds), scaled[f]))

    rows = F.array(*[
        F.struct(
            F.lit(f).alias("feature"), mean(f, "TP", "TN").alias("correct"),
            mean(f, "FP").alias("false_positive"), mean(f, "FN").alias("false_negative"),
        )
        for f in top
    ])
    return preds.agg(rows.alias("r")).select(F.inline("r")).withColumns({
        "fp_vs_correct": F.col("false_positive") - F.col("correct"),
        "fn_vs_correct": F.col("false_negative") - F.col("correct"),
    })


def score_histogram(preds: DataFrame, bins: int = 29) -> DataFrame:
    """Rows per outcome in equal score bins over the whole range, zeros included."""
    # Join keys are never NULL: an IS NOT NULL test on them would be pushed below the
    # counts, which could then not serve the range and the bins by one shuffle.
    counts = preds.groupBy(F.coalesce(outcome(), F.lit("")).alias("outcome"), "y_score").agg(F.count("*").alias("n"))
    # The sum keeps the counts in the subquery's plan, so that it shares their shuffle.
    span = counts.agg(F.struct(
        F.min("y_score").alias("lo"), F.max("y_score").alias("hi"), F.sum("n").alias("n")
    ).alias("s")).scalar()
    low, high = span["lo"], span["hi"]
    place = F.when(low == high, F.lit(bins - 1)).otherwise(
        bin_index(F.col("y_score"), low, high, bins)
    )
    counted = counts.groupBy("outcome", F.coalesce(place, F.lit(-1)).alias("bin")).agg(F.sum("n").alias("count"))
    grid = preds.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(o) for o in ("FP", "TN", "FN", "TP")])).alias("outcome")
    ).select("outcome", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(F.broadcast(counted), ["outcome", "bin"], "left").select(
        "outcome", "bin", edge(F.col("bin"), low, high, bins).alias("left_edge"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


# --- comparing models -------------------------------------------------------

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


def model_metrics(preds: DataFrame, keys: list[str]) -> DataFrame:
    """All metrics per model at four places; ``pr_auc`` is average precision here."""
    ranking = ranking_metrics(preds, keys).select(
        *keys, "roc_auc", F.col("average_precision").alias("pr_auc")
    )
    joined = basic_metrics(preds, keys).join(ranking, keys, "left")
    return joined.select(*keys, *[F.round(m, 4).alias(m) for m in METRICS])


def model_comparison(metrics: DataFrame, names: tuple[str, ...] = METRICS) -> DataFrame:
    """Flag the best value of each metric; a missing value competes as 0."""
    best = metrics.agg(
        F.struct(*[F.max(F.coalesce(m, F.lit(0.0))).alias(m) for m in names]).alias("b")
    ).scalar()
    return metrics.withColumns({
        f"{m}_is_best": F.coalesce(F.abs(F.col(m) - best[m]) < 1e-5, F.lit(False)) for m in names
    })


def model_lookup(models: DataFrame, model_id: str | None = None, position: str = "position") -> DataFrame:
    """The model with this id; the first one when no id is given."""
    if model_id:
        return models.filter(F.col("model_id") == model_id)
    return models.orderBy(position).limit(1)


def best_hyperparams(results: DataFrame) -> DataFrame:
    """Parameters of the rank-1 tuning row, one per line, with its CV score.

    ``param_`` and ``clf__`` prefixes go; blanks become NULL; 10.0 reads 10.
    """
    params = [c for c in results.columns if c.startswith("param_")]
    text = {
        c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in params
    }
    shown = F.array(*[
        F.struct(
            F.lit(c.removeprefix("param_").replace("clf__", "")).alias("parameter"),
            F.regexp_replace(text[c], r"^(-?\d+)\.0+$", "$1").alias("value"),
        )
        for c in params
    ])
    best = results.filter(F.col("rank_test_score") == 1).orderBy(*params).limit(1)
    return best.select(
        F.round("mean_test_score", 4).alias("val_pr_auc_mean"),
        F.round("std_test_score", 6).alias("val_pr_auc_std"), F.inline(shown),
    )
