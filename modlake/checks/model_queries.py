"""Registered queries for evaluation, training and explanation."""

from __future__ import annotations

from pyspark.sql import functions as F

from modlake.checks import inputs as I
from modlake.checks import sql as Q
from modlake.checks.registry import query
from modlake.operators import explain as X
from modlake.operators import learn as L
from modlake.operators import metrics as E
from modlake.operators.linear import long_attributions

MODEL_FEATURES = list(I.MODEL.terms)


def rounded(df, places, *names):
    return df.withColumns({n: F.round(n, places) for n in names})


def pair(name, tail, run):
    """The same query over scored comments and over order lines."""
    for key, head, source in (
        (name, Q.PREDICTED, I.predictions), (f"{name}_lines", Q.LINE_PREDS, I.line_predictions),
    ):
        sep = "," if tail.lstrip()[:6].lower() != "select" else ""

        def fn(spark, sf_dir, source=source):
            return run(source(spark, sf_dir))

        query(key, f"{head}{sep} {tail}")(fn)


_C = """c AS (SELECT count(*) FILTER (y_true = 0 AND y_pred = 0) AS tn,
  count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp, count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn,
  count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp FROM preds)"""

pair("metrics_basic", f"""{_C}
SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""",
     lambda p: rounded(E.basic_metrics(p), 6, "accuracy", "precision", "recall", "f1"))

pair("confusion_matrix", f"""{_C}
SELECT 0 AS y_true, 0 AS y_pred, tn AS count, round(tn * 100 / (tn + fp), 6) AS row_pct FROM c
UNION ALL SELECT 0, 1, fp, round(fp * 100 / (tn + fp), 6) FROM c
UNION ALL SELECT 1, 0, fn, round(fn * 100 / (fn + tp), 6) FROM c
UNION ALL SELECT 1, 1, tp, round(tp * 100 / (fn + tp), 6) FROM c""",
     lambda p: rounded(E.confusion_matrix(p), 6, "row_pct"))

pair("classification_report", f"""{_C},
k AS (SELECT '0' AS class, tn / nullif(tn + fn, 0) AS p, tn / nullif(tn + fp, 0) AS r,
             2 * tn / nullif(2 * tn + fn + fp, 0) AS f, tn + fp AS n FROM c
      UNION ALL SELECT '1', tp / nullif(tp + fp, 0), tp / nullif(tp + fn, 0),
             2 * tp / nullif(2 * tp + fp + fn, 0), tp + fn FROM c),
z AS (SELECT class, coalesce(p, 0) AS p, coalesce(r, 0) AS r, coalesce(f, 0) AS f, n FROM k)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, n::BIGINT AS support FROM z
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(n)::BIGINT FROM z
UNION ALL SELECT 'weighted avg', round(sum(p * n) / sum(n), 6), round(sum(r * n) / sum(n), 6),
                 round(sum(f * n) / sum(n), 6), sum(n)::BIGINT FROM z""",
     lambda p: rounded(E.classification_report(p), 6, "precision", "recall", "f1"))

_CURVE = """g AS (SELECT y_score AS s, sum(y_true) AS pos, count(*) - sum(y_true) AS neg
      FROM preds GROUP BY y_score),
cum AS (SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp FROM g),
tot AS (SELECT sum(pos) AS p, sum(neg) AS n FROM g),
pts AS (SELECT s, pos, neg, fp / n AS fpr, tp / p AS tpr, tp / (tp + fp) AS prec,
        coalesce(lag(fp / n) OVER (ORDER BY s DESC), 0) AS fpr0,
        coalesce(lag(tp / p) OVER (ORDER BY s DESC), 0) AS tpr0,
        coalesce(lag(tp / (tp + fp)) OVER (ORDER BY s DESC), 1) AS prec0 FROM cum, tot)"""

pair("roc_curve", f"""{_CURVE}
SELECT 1e300::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT s, round(fpr, 6), round(tpr, 6) FROM pts""",
     lambda p: rounded(E.roc_curve(p), 6, "fpr", "tpr").withColumn(
         "threshold", F.least("threshold", F.lit(1e300))))

pair("roc_curve_corners", f"""{_CURVE},
near AS (SELECT *, lag(pos) OVER w AS before, lead(pos) OVER w AS pos1, lead(neg) OVER w AS neg1
         FROM pts WINDOW w AS (ORDER BY s DESC))
SELECT 1e300::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT s, round(fpr, 6), round(tpr, 6) FROM near
WHERE before IS NULL OR pos1 IS NULL OR pos <> pos1 OR neg <> neg1""",
     lambda p: rounded(E.roc_curve(p, drop_collinear=True), 6, "fpr", "tpr").withColumn(
         "threshold", F.least("threshold", F.lit(1e300))))

pair("roc_auc", f"{_CURVE} SELECT round(sum((fpr - fpr0) * (tpr + tpr0) / 2), 6) AS roc_auc FROM pts",
     lambda p: rounded(E.ranking_metrics(p), 6, "roc_auc").select("roc_auc"))

pair("pr_curve", f"""{_CURVE}
SELECT s AS threshold, round(prec, 6) AS precision, round(tpr, 6) AS recall FROM pts
UNION ALL SELECT NULL, 1.0, 0.0""",
     lambda p: rounded(E.pr_curve(p), 6, "precision", "recall"))

pair("pr_auc", f"{_CURVE} SELECT round(sum((tpr - tpr0) * (prec + prec0) / 2), 6) AS pr_auc FROM pts",
     lambda p: rounded(E.ranking_metrics(p), 6, "pr_auc").select("pr_auc"))

pair("average_precision", f"{_CURVE} SELECT round(sum((tpr - tpr0) * prec), 6) AS average_precision FROM pts",
     lambda p: rounded(E.ranking_metrics(p), 6, "average_precision").select("average_precision"))

pair("f1_threshold", f"""{_CURVE},
f AS (SELECT s, round(2 * prec * tpr / (prec + tpr + 1e-9), 12) AS f1 FROM pts)
SELECT s AS threshold, round(f1, 6) AS f1 FROM f ORDER BY f.f1 DESC, s LIMIT 1""",
     lambda p: rounded(E.f1_threshold(p), 6, "f1"))

_QS = ", ".join(str(i / 10) for i in range(1, 10))
pair("calibration", f"""edges AS (SELECT quantile_cont(y_score, [{_QS}]) AS e FROM preds),
b AS (SELECT len(list_filter(e, lambda x: x < y_score)) AS bin, y_true, y_score FROM preds, edges)
SELECT bin::INT AS bin, count(*) AS count, round(avg(y_true), 6) AS fraction_positive,
       round(avg(y_score), 6) AS mean_score FROM b
WHERE (SELECT min(y_score) >= 0 AND max(y_score) <= 1 FROM preds) GROUP BY bin""",
     lambda p: rounded(E.calibration(p), 6, "fraction_positive", "mean_score"))

_OUT = """CASE WHEN y_true = 1 AND y_pred = 1 THEN 'TP' WHEN y_true = 0 AND y_pred = 0 THEN 'TN'
  WHEN y_true = 0 THEN 'FP' ELSE 'FN' END"""
pair("error_score_histogram", f"""lim AS (SELECT min(y_score) AS low, max(y_score) AS high FROM preds),
grid AS (SELECT outcome, bin, low + bin * ((high - low) / 29) AS l,
   CASE WHEN bin = 28 THEN high ELSE low + (bin + 1) * ((high - low) / 29) END AS r
   FROM lim, (VALUES ('TP'), ('TN'), ('FP'), ('FN')) o(outcome), range(0, 29) b(bin)),
t AS (SELECT {_OUT} AS outcome, y_score FROM preds)
SELECT g.outcome, g.bin::INT AS bin, round(any_value(l), 6) AS left_edge, count(t.y_score) AS count
FROM grid g LEFT JOIN t ON t.outcome = g.outcome AND y_score >= l AND (y_score < r OR (bin = 28 AND y_score <= r))
GROUP BY g.outcome, g.bin""",
     lambda p: rounded(E.score_histogram(p), 6, "left_edge"))


@query("false_positives", f"""{Q.PREDICTED} SELECT doc_id, y_score FROM preds
WHERE y_true = 0 AND y_pred = 1 ORDER BY y_score DESC, doc_id LIMIT 20""")
def false_positives(spark, sf_dir):
    return E.worst_errors(I.predictions(spark, sf_dir), "FP", "doc_id").select("doc_id", "y_score")


@query("false_negatives", f"""{Q.PREDICTED} SELECT doc_id, y_score FROM preds
WHERE y_true = 1 AND y_pred = 0 ORDER BY y_score, doc_id LIMIT 20""")
def false_negatives(spark, sf_dir):
    return E.worst_errors(I.predictions(spark, sf_dir), "FN", "doc_id").select("doc_id", "y_score")


def _judged(spark, sf_dir):
    df = I.labelled(spark, sf_dir, only=I.model_features())
    score = F.round(I.MODEL.probability(), 6)
    return df.withColumns({
        "y_true": F.col("toxic"), "y_score": score, "y_pred": (score >= 0.5).cast("int"),
    })


_STD = {f: f"(({f} - ({m})) / ({s}))" for f, (m, s, _) in I.MODEL.terms.items()}


@query("error_patterns", f"""{Q.PREDICTED}, j AS (SELECT f.*, p.y_true, p.y_pred FROM feats f JOIN preds p USING (doc_id))
""" + " UNION ALL ".join(f"""SELECT '{f}' AS feature, round(avg({e}) FILTER (y_true = y_pred), 6) AS correct,
  round(avg({e}) FILTER (y_true < y_pred), 6) AS false_positive,
  round(avg({e}) FILTER (y_true > y_pred), 6) AS false_negative,
  round(avg({e}) FILTER (y_true < y_pred) - avg({e}) FILTER (y_true = y_pred), 6) AS fp_vs_correct,
  round(avg({e}) FILTER (y_true > y_pred) - avg({e}) FILTER (y_true = y_pred), 6) AS fn_vs_correct FROM j"""
                         for f, e in _STD.items()))
def error_patterns(spark, sf_dir):
    df = E.error_patterns(
        _judged(spark, sf_dir), {f: I.MODEL.scaled(f) for f in MODEL_FEATURES}, MODEL_FEATURES
    )
    return rounded(df, 6, *df.columns[1:])


# --- several models -----------------------------------------------------------

# Two fixed scorers over the same comments: the linear one and a length rule.
_MODELS_SQL = f"""{Q.PREDICTED}, pair AS (
  SELECT 'linear' AS model_id, y_true, y_pred, y_score FROM preds
  UNION ALL SELECT 'profanity', toxic, CASE WHEN profanity_count >= 1 THEN 1 ELSE 0 END,
         round(profanity_count / (profanity_count + 1), 6) FROM feats)"""


def _two_models(spark, sf_dir):
    df = _judged(spark, sf_dir).select("y_true", "y_pred", "y_score", "profanity_count")
    n = F.col("profanity_count")
    each = F.array(
        F.struct(F.lit("linear").alias("model_id"), F.col("y_pred").alias("p"), F.col("y_score").alias("s")),
        F.struct(F.lit("profanity").alias("model_id"), (n >= 1).cast("int").alias("p"),
                 F.round(n / (n + 1), 6).alias("s")),
    )
    return df.select("y_true", F.inline(each)).toDF("y_true", "model_id", "y_pred", "y_score")


_COMPARED = """,
g AS (SELECT model_id, y_score AS s, sum(y_true) AS pos, count(*) - sum(y_true) AS neg FROM pair GROUP BY ALL),
cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER v AS p, sum(neg) OVER v AS n
  FROM g WINDOW w AS (PARTITION BY model_id ORDER BY s DESC), v AS (PARTITION BY model_id)),
rank AS (SELECT model_id, round(sum(neg * (tp - pos / 2) / (p * n)), 4) AS roc_auc,
  round(sum(pos / p * tp / (tp + fp)), 4) AS pr_auc FROM cum GROUP BY model_id),
c AS (SELECT model_id, count(*) FILTER (y_true = 0 AND y_pred = 0) AS tn,
  count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp, count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn,
  count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp FROM pair GROUP BY model_id),
m AS (SELECT model_id, round((tp + tn) / (tp + tn + fp + fn), 4) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1, roc_auc, pr_auc
  FROM c JOIN rank USING (model_id))"""


@query("model_comparison", f"{_MODELS_SQL}{_COMPARED} SELECT *, " + ", ".join(
    f"abs({k} - max({k}) OVER ()) < 1e-5 AS {k}_is_best" for k in E.METRICS) + " FROM m")
def model_comparison(spark, sf_dir):
    return E.model_comparison(E.model_metrics(_two_models(spark, sf_dir), ["model_id"]))


@query("model_lookup", f"{_MODELS_SQL}{_COMPARED} SELECT model_id, accuracy, roc_auc FROM m WHERE model_id = 'profanity'")
def model_lookup(spark, sf_dir):
    metrics = E.model_metrics(_two_models(spark, sf_dir), ["model_id"])
    return E.model_lookup(metrics, "profanity").select("model_id", "accuracy", "roc_auc")


@query("model_report", f"""{_MODELS_SQL}{_COMPARED}
SELECT 'linear' AS model_id, 'Fixed linear scorer' AS model_name, 'v1' AS version, accuracy, precision,
  recall, f1, roc_auc, pr_auc, tn, m2.fp, fn, m2.tp FROM m JOIN c m2 USING (model_id) WHERE model_id = 'linear'""")
def model_report(spark, sf_dir):
    report = L.evaluate(I.predictions(spark, sf_dir), "linear", "Fixed linear scorer", "v1")
    cells = {n: F.col("confusion_matrix")[y][p] for n, y, p in
             (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))}
    return report.withColumns(cells).drop("confusion_matrix")


# --- scaling, weights, scoring --------------------------------------------------

@query("scale_params", f"{Q.LABELLED} " + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(avg({f}), 6) AS mean, round(CASE WHEN stddev_pop({f}) > 0"
    f" THEN stddev_pop({f}) ELSE 1 END, 6) AS std FROM feats" for f in Q.PLAIN))
def scale_params(spark, sf_dir):
    return rounded(L.scale_params(I.labelled(spark, sf_dir), Q.PLAIN), 6, "mean", "std")


@query("scaled_features", f"{Q.LABELLED}, p AS MATERIALIZED (SELECT doc_id, {', '.join(MODEL_FEATURES)} FROM feats)"
       " SELECT doc_id, " + ", ".join(
    f"round(({f} - avg({f}) OVER ()) / CASE WHEN stddev_pop({f}) OVER () > 0 THEN stddev_pop({f}) OVER () ELSE 1 END, 6)"
    f" AS {f}" for f in MODEL_FEATURES) + " FROM p")
def scaled_features(spark, sf_dir):
    df = I.labelled(spark, sf_dir, only=I.model_features())
    scaled = L.scaled_columns(df, MODEL_FEATURES)
    return df.select("doc_id", *[F.round(scaled[f], 6).alias(f) for f in MODEL_FEATURES])


@query("class_weights", """
SELECT toxic, count(*) AS rows, round((SELECT count(*) FROM labels) / (2 * count(*)), 6) AS weight
FROM labels GROUP BY toxic""")
def class_weights(spark, sf_dir):
    return rounded(L.class_weights(I.table(spark, sf_dir, "labels"), "toxic"), 6, "weight")


@query("score_linear", f"""{Q.FEATS}, s AS (SELECT doc_id, 1 / (1 + exp(-({Q.logit()}))) AS p FROM feats)
SELECT doc_id, round(p, 6) AS probability, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS label FROM s""")
def score_linear(spark, sf_dir):
    df = I.MODEL.score(I.featured(spark, sf_dir, only=I.model_features()))
    return df.select("doc_id", F.round("probability", 6).alias("probability"), "label")


@query("soft_vote", f"""{Q.FEATS}, v AS (
  SELECT doc_id, round(1 / (1 + exp(-({Q.logit()}))), 6) AS p FROM feats
  UNION ALL SELECT doc_id, round(profanity_count / (profanity_count + 1), 6) FROM feats
  UNION ALL SELECT doc_id, CASE WHEN quality = 0 THEN 0.9::DOUBLE ELSE 0.1::DOUBLE END FROM labels)
SELECT doc_id, round(avg(p), 9) AS probability, CASE WHEN avg(p) > 0.5 THEN 1 ELSE 0 END AS label
FROM v GROUP BY doc_id""")
def soft_vote(spark, sf_dir):
    df = I.featured(spark, sf_dir, only=I.model_features())
    n = F.col("profanity_count")
    members = [
        df.select("doc_id", F.round(I.MODEL.probability(), 6).alias("probability")),
        df.select("doc_id", F.round(n / (n + 1), 6).alias("probability")),
        I.table(spark, sf_dir, "labels").select(
            "doc_id", F.when(F.col("quality") == 0, 0.9).otherwise(0.1).alias("probability")),
    ]
    return rounded(L.soft_vote(members, "doc_id"), 9, "probability")


@query("score_contract", """
SELECT doc_id, coalesce(toxic, 0) AS label,
       CASE WHEN toxic IS NULL THEN 0.0::DOUBLE ELSE 0.25::DOUBLE + toxic / 2 END AS probability,
       CASE WHEN toxic IS NULL THEN '' ELSE 'v1' END AS explain_version, 0.0::DOUBLE AS inference_ms,
       CASE WHEN toxic IS NULL THEN 'no score' END AS error
FROM documents LEFT JOIN labels USING (doc_id)""")
def score_contract(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents").select("doc_id")
    df = docs.join(I.table(spark, sf_dir, "labels"), "doc_id", "left").select(
        "doc_id", F.col("toxic").alias("label"), (F.col("toxic") / 2 + 0.25).alias("probability")
    )
    return L.score_contract(df, ["doc_id"], explain_version="v1").drop("top_features")


@query("l1_gradient_step", f"""{Q.LABELLED}, r AS (
  SELECT *, 1 / (1 + exp(-({Q.logit()}))) - toxic AS res FROM feats), g AS (
  SELECT '(intercept)' AS feature, avg(res) AS gradient, ({I.MODEL.intercept})::DOUBLE AS coef FROM r UNION ALL
  """ + " UNION ALL ".join(
    f"SELECT '{f}', avg(res * {_STD[f]}), ({c})::DOUBLE FROM r" for f, (_, _, c) in I.MODEL.terms.items()) + """),
n AS (SELECT *, CASE feature WHEN '(intercept)' THEN coef - 0.1 * gradient
  ELSE sign(coef - 0.1 * gradient) * greatest(abs(coef - 0.1 * gradient) - 0.002, 0) END AS new_coef FROM g)
SELECT feature, round(gradient, 6) AS gradient, coef, round(new_coef, 6) AS new_coef,
       round(abs(new_coef - coef), 6) AS delta FROM n""")
def l1_gradient_step(spark, sf_dir):
    df = I.labelled(spark, sf_dir, only=I.model_features())
    step = L.l1_gradient_step(df, I.MODEL, "toxic", alpha=0.02, rate=0.1)
    return rounded(step, 6, "gradient", "new_coef", "delta")


# --- training (no SQL twin: iterative) -------------------------------------------

def _coefficients(spark, fitted):
    rows = [("(intercept)", fitted.linear.intercept)] + list(fitted.importance.items())
    return spark.createDataFrame([(f, round(c, 6)) for f, c in rows], "feature string, coef double")


def _training(spark, sf_dir):
    return I.written(I.labelled(spark, sf_dir, only=I.model_features()), "train")


@query("split_stratified")
def split_stratified(spark, sf_dir):
    split = L.stratified_split(I.table(spark, sf_dir, "labels"), "doc_id", "toxic")
    return split.groupBy("toxic", "split").agg(F.count("*").alias("rows"))


@query("baseline_predict")
def baseline_predict(spark, sf_dir):
    labels = I.table(spark, sf_dir, "labels")
    split = L.stratified_split(labels, "doc_id", "toxic")
    out = L.prior_baseline(
        split.filter("split = 'test'"), split.filter("split = 'train'"), "toxic"
    )
    return out.select("doc_id", F.col("toxic").alias("y_true"), "y_pred", "y_score")


@query("train_l1_logistic")
def train_l1_logistic(spark, sf_dir):
    return _coefficients(spark, L.train_l1_logistic(_training(spark, sf_dir), MODEL_FEATURES, "toxic"))


@query("train_l2_logistic")
def train_l2_logistic(spark, sf_dir):
    return _coefficients(spark, L.train_l2_logistic(_training(spark, sf_dir), MODEL_FEATURES, "toxic"))


@query("train_linear_svm")
def train_linear_svm(spark, sf_dir):
    return _coefficients(spark, L.train_linear_svm(_training(spark, sf_dir), MODEL_FEATURES, "toxic"))


@query("svm_stationarity", f"""{Q.LABELLED}
SELECT f AS feature, 0.0::DOUBLE AS gradient, (SELECT count(*) FROM feats) AS rows
FROM unnest({["(intercept)", *MODEL_FEATURES]}) AS t(f)""")
def svm_stationarity(spark, sf_dir):
    # The gradient of the objective at the trained model, by column expressions: zero at the minimum.
    df = _training(spark, sf_dir)
    model = L.train_linear_svm(df, MODEL_FEATURES, "toxic").linear
    return L.svm_gradient(df, model, "toxic").withColumn("gradient", F.round("gradient", 6) + F.lit(0.0))


_L1_STEPS, _L1_ALPHA, _L1_RATE = 6, 0.02, 0.1


def _l1_sql():
    """The same steps, unrolled: each CTE holds the coefficients after one more step."""
    names = MODEL_FEATURES
    scaled = ", ".join(f"({f} - avg({f}) OVER ()) / coalesce(nullif(stddev_pop({f}) OVER (), 0), 1) AS x_{f}" for f in names)
    parts = [f"s AS MATERIALIZED (SELECT toxic, {scaled} FROM feats)",
             f"w0 AS (SELECT 0.0::DOUBLE AS b, {', '.join(f'0.0::DOUBLE AS c_{f}' for f in names)})"]
    logit = " + ".join(["b", *[f"c_{f} * x_{f}" for f in names]])
    for k in range(1, _L1_STEPS + 1):
        moved = [f"min(c_{f}) - {_L1_RATE} * avg(r * x_{f}) AS c_{f}" for f in names]
        soft = [f"sign(c_{f}) * greatest(abs(c_{f}) - {_L1_ALPHA * _L1_RATE!r}, 0) AS c_{f}" for f in names]
        parts.append(
            f"w{k} AS MATERIALIZED (SELECT b, {', '.join(soft)} FROM (SELECT min(b) - {_L1_RATE} * avg(r) AS b, {', '.join(moved)} "
            f"FROM (SELECT *, 1 / (1 + exp(-({logit}))) - toxic AS r FROM s, w{k - 1})))"
        )
    rows = [f"SELECT '(intercept)' AS feature, round(b, 9) + 0.0 AS coef FROM w{_L1_STEPS}"]
    rows += [f"SELECT '{f}', round(c_{f}, 9) + 0.0 FROM w{_L1_STEPS}" for f in names]
    return f"{Q.LABELLED}, " + ", ".join(parts) + " " + " UNION ALL ".join(rows)


@query("l1_descent", _l1_sql())
def l1_descent(spark, sf_dir):
    model, _ = L.train_l1_steps(
        _training(spark, sf_dir), MODEL_FEATURES, "toxic", _L1_ALPHA, learning_rate=_L1_RATE, max_iter=_L1_STEPS
    )
    rows = [("(intercept)", model.linear.intercept), *model.importance.items()]
    return spark.createDataFrame([(f, round(c, 9) + 0.0) for f, c in rows], "feature string, coef double")


@query("stratified_folds", """SELECT toxic, doc_id,
  CAST((row_number() OVER (PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR) || ':43'), doc_id) - 1) % 3 AS INTEGER) AS fold
FROM labels""")
def stratified_folds(spark, sf_dir):
    return L.folded(I.table(spark, sf_dir, "labels").select("toxic", "doc_id"), "doc_id", 3, 42, "toxic")


@query("train_random_forest")
def train_random_forest(spark, sf_dir):
    df = _training(spark, sf_dir)
    model = L.train_random_forest(df, MODEL_FEATURES, "toxic", trees=20, max_depth=8)
    scored = model.score(df.withColumnRenamed("toxic", "y_true"))
    return scored.select("doc_id", "y_true", F.round("y_score", 6).alias("y_score"))


def _grid(spark, sf_dir):
    return L.grid_search(
        _training(spark, sf_dir), MODEL_FEATURES, "toxic", "doc_id", L.train_l2_logistic,
        {"c": (0.01, 0.1, 1.0, 10.0)},
    )


@query("grid_search_results")
def grid_search_results(spark, sf_dir):
    return _grid(spark, sf_dir)


@query("best_hyperparams")
def best_hyperparams(spark, sf_dir):
    return E.best_hyperparams(_grid(spark, sf_dir))


@query("feature_ablation")
def feature_ablation(spark, sf_dir):
    df = _training(spark, sf_dir)
    split = I.written(L.stratified_split(df, "doc_id", "toxic"), "split")
    return L.feature_ablation(
        split.filter("split = 'train'"), split.filter("split = 'test'"), MODEL_FEATURES, "toxic",
        "doc_id", tops=(3,), trees=10, max_depth=5,
    )


# --- explanation ----------------------------------------------------------------

@query("coef_ranking", f"""{Q.LABELLED}, w AS ({" UNION ALL ".join(
    f"SELECT '{f}' AS feature, ({c}) * stddev_pop({f}) / {s} AS coef FROM feats"
    for f, (_, s, c) in I.MODEL.terms.items())})
SELECT feature, round(coef, 6) AS coef, round(abs(coef), 6) AS abs_coef FROM w""")
def coef_ranking(spark, sf_dir):
    # Coefficients per standard deviation of the labelled comments.
    df = I.labelled(spark, sf_dir, only=I.model_features())
    table = L.scale_params(df, MODEL_FEATURES).withColumnRenamed("std", "spread").drop("mean")
    own = df.agg(F.array(*[
        F.struct(F.lit(f).alias("feature"), (F.lit(c / s) * F.stddev_pop(f)).alias("coef"))
        for f, (_, s, c) in I.MODEL.terms.items()]).alias("r")).select(F.inline("r"))
    return rounded(X.coefficient_ranking(own.join(table, "feature")), 6, "coef", "abs_coef")


def _attributions(spark, sf_dir):
    df = I.written(I.featured(spark, sf_dir, only=I.model_features()).select("doc_id", *MODEL_FEATURES), "attributions")
    mean = df.agg(F.struct(*[F.avg(I.MODEL.scaled(f)).alias(f) for f in MODEL_FEATURES]).alias("m")).scalar()
    return long_attributions(df, I.MODEL, {f: mean[f] for f in MODEL_FEATURES}, ["doc_id"])


_ATTR = f"""{Q.FEATS}, mean AS MATERIALIZED (SELECT {", ".join(f"avg({e}) AS m_{f}" for f, e in _STD.items())} FROM feats),
kept AS MATERIALIZED (SELECT doc_id, {", ".join(MODEL_FEATURES)} FROM feats),
attr AS ({" UNION ALL ".join(
    f"SELECT doc_id, '{f}' AS feature, {f}::DOUBLE AS value, ({c}) * ({_STD[f]} - m_{f}) AS a FROM kept, mean"
    for f, (_, _, c) in I.MODEL.terms.items())})"""


@query("linear_attribution", f"{_ATTR} SELECT doc_id, feature, round(value, 6) AS value, round(a, 6) AS attribution FROM attr")
def linear_attribution(spark, sf_dir):
    return rounded(_attributions(spark, sf_dir), 6, "value", "attribution")


@query("global_attribution", f"{_ATTR} SELECT feature, round(avg(abs(a)), 9) AS mean_abs_attribution FROM attr GROUP BY feature")
def global_attribution(spark, sf_dir):
    return rounded(X.global_attribution(_attributions(spark, sf_dir)), 9, "mean_abs_attribution")


@query("top_features", f"""{_ATTR}, x AS (SELECT * REPLACE (round(a, 9) AS a), round(abs(a), 9) AS size FROM attr),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY size DESC, feature DESC) AS rank,
      max(size) OVER (PARTITION BY doc_id) AS top FROM x)
SELECT doc_id, rank, feature, round(value, 6) AS value, a AS attribution,
       round(size * 100 / top, 4) AS pct_of_max FROM r WHERE rank <= 3""")
def top_features(spark, sf_dir):
    attr = _attributions(spark, sf_dir).withColumn("attribution", F.round("attribution", 9))
    df = X.top_features(attr, "doc_id", 3)
    return rounded(rounded(df, 6, "value"), 4, "pct_of_max")


@query("permutation_importance")
def permutation_importance(spark, sf_dir):
    df = I.written(_judged(spark, sf_dir).select("doc_id", "y_true", *MODEL_FEATURES), "judged")
    out = X.block_permutation_importance(df, I.MODEL.matrix_probability, MODEL_FEATURES, "doc_id")
    return rounded(out.drop("error"), 6, "importance", "std")


@query("kernel_attribution")
def kernel_attribution(spark, sf_dir):
    # Every labelled row is explained, against the method's bounded background.
    df = _training(spark, sf_dir)
    out = X.batch_attribution(df, df, I.MODEL.matrix_probability, MODEL_FEATURES, "doc_id")
    return rounded(out, 6, "value", "attribution")
