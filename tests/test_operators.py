import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from modlake.operators import explain as X
from modlake.operators import learn as L
from modlake.operators import metrics as E
from modlake.operators import prefix
from modlake.operators import profile as P
from modlake.operators.columns import correlation_matrix
from modlake.operators.linear import LinearModel


def test_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(size=3000), np.full(2000, 0.5)])
    df = spark.createDataFrame([("a", float(v)) for v in values], "feature string, value double")
    counts = prefix.value_counts(df, ["feature"], "value")
    got = prefix.exact_quantiles(counts, {"a": 0.01, "b": 0.5, "c": 0.993}, keys=["feature"]).first()
    assert [got["a"], got["b"], got["c"]] == pytest.approx(list(np.quantile(values, [0.01, 0.5, 0.993])))


def test_running_totals_over_chunks(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("k"), "id",
        F.floor(F.col("id") / 37).alias("c"), F.lit(1).alias("one"))
    out = prefix.running_totals(df, {"t": "one"}, keys=["k"], chunk="c", order=[F.col("id")])
    hot = [r["t"] for r in out.filter("k = 'hot'").orderBy("id").collect()]
    assert hot == list(range(1, len(hot) + 1))


@pytest.mark.parametrize("chunks", [2, 5, 40])
def test_chunk_count_changes_no_quantile(spark, chunks):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(k, float(v)) for k in "ab" for v in rng.exponential(size=700)], "k string, value double")
    counts = prefix.value_counts(df, ["k"], "value")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(chunks))
    try:
        assert prefix.with_chunks(counts, "value", keys=["k"]).select("_chunk").distinct().count() <= chunks
        got = {r["k"]: r["q"] for r in prefix.exact_quantiles(counts, {"q": 0.37}, keys=["k"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for k in "ab":
        own = [r["value"] for r in df.filter(F.col("k") == k).collect()]
        assert got[k] == pytest.approx(np.quantile(own, 0.37))


@pytest.mark.parametrize("work", [
    lambda df: E.score_histogram(df), lambda df: E.calibration(df), lambda df: E.roc_curve(df),
    lambda df: E.ranking_metrics(df), lambda df: E.f1_threshold(df),
])
def test_order_statistics_scan_once(spark, tmp_path, work):
    spark.range(3000).select(
        (F.col("id") % 3 == 0).cast("int").alias("y_true"), (F.col("id") % 2).cast("int").alias("y_pred"),
        F.sqrt("id").alias("x"), (F.col("id") % 997 / 997).alias("y_score"),
    ).write.parquet(f"{tmp_path}/t")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan is final before it runs
    try:
        plan = work(spark.read.parquet(f"{tmp_path}/t"))._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1


def test_class_histograms_without_values_inside(spark):
    df = spark.createDataFrame([(0, 0.0, None), (1, 100.0, None), (1, None, None)], "y int, v double, w double")
    rows = P.class_histograms(df, "y", ["v", "w"], bins=4).collect()
    assert [(r["feature"], r["non_toxic"], r["toxic"]) for r in rows] == [("v", 0.0, 0.0)] * 4


def scores(spark, y, s, p=None):
    rows = [(i, a, int((b or 0) >= 0.5) if p is None else p[i], b) for i, (a, b) in enumerate(zip(y, s))]
    return spark.createDataFrame(rows, "id int, y_true int, y_pred int, y_score double")


def test_curves_by_hand(spark):
    preds = scores(spark, [1, 0, 1, 1, 0, 0], [0.9, 0.9, 0.8, 0.3, 0.3, None])
    got = E.ranking_metrics(preds).first()
    # points (fp, tp): (1, 1), (1, 2), (2, 3) of n = 2, p = 3
    assert got["roc_auc"] == pytest.approx((0.5 + 2.5) / 6)
    assert got["average_precision"] == pytest.approx((1 / 2 + 2 / 3 + 3 / 5) / 3)
    assert got["pr_auc"] == pytest.approx(((1 + .5) / 2 + (.5 + 2 / 3) / 2 + (2 / 3 + .6) / 2) / 3)
    assert E.roc_curve(preds).count() == 4
    best = E.f1_threshold(preds).first()
    assert best["threshold"] == 0.3


def test_single_class_and_no_positives(spark):
    one = E.ranking_metrics(scores(spark, [0, 0], [0.1, 0.9])).first()
    assert one["roc_auc"] is None and one["average_precision"] is None
    basic = E.basic_metrics(scores(spark, [0, 0], [0.1, 0.2])).first()
    assert (basic["accuracy"], basic["precision"], basic["recall"], basic["f1"]) == (1.0, 0.0, 0.0, 0.0)
    assert E.calibration(scores(spark, [0, 1], [-0.5, 0.9])).count() == 0


def test_correlation_with_gaps_and_constants(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 7.0, 5.0), (4.0, 7.5, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 3, 4], [2, 7, 7.5])[0, 1])
    assert got["a", "c"] is None and got["b", "a"] == got["a", "b"]


def test_split_keeps_class_shares(spark):
    df = spark.range(5000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    out = L.stratified_split(df, "id", "y").groupBy("y", "split").count().collect()
    counts = {(r["y"], r["split"]): r["count"] for r in out}
    assert counts == {(0, "train"): 3600, (0, "test"): 900, (1, "train"): 400, (1, "test"): 100}


def logistic_data(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1]))) > rng.random(400)).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, toxic int"), x, y


def test_l1_reaches_the_proximal_optimum(spark):
    df, x, y = logistic_data(spark)
    z = (x - x.mean(0)) / x.std(0)
    beta, b0 = np.zeros(3), 0.0
    for _ in range(5000):
        r = 1 / (1 + np.exp(-(z @ beta + b0))) - y
        step = beta - 0.5 * z.T @ r / len(y)
        beta, b0 = np.sign(step) * np.maximum(np.abs(step) - 0.5 * 0.05, 0), b0 - 0.5 * r.mean()
    fit = L.train_l1_logistic(df, ["a", "b", "c"], "toxic", alpha=0.05)
    assert list(fit.importance.values()) == pytest.approx(list(beta), abs=2e-3)
    step = L.l1_gradient_step(df, fit.linear, "toxic", 0.05, 0.5).agg(F.max("delta")).first()[0]
    assert step < 1e-3
    with pytest.raises(ValueError):
        L.train_l1_logistic(df.withColumn("toxic", F.lit(0)), ["a"], "toxic")


def test_grid_search_and_best_parameters(spark):
    df, _, _ = logistic_data(spark)
    df = df.persist()
    table = L.grid_search(df, ["a", "b"], "toxic", "id", L.train_l2_logistic, {"c": (0.01, 10.0)}, folds=2)
    assert table.count() == 2 and table.filter("rank_test_score = 1").count() >= 1
    best = E.best_hyperparams(table).first()
    assert best["parameter"] == "c" and best["value"] in ("10", "0.01")
    df.unpersist()


def test_shapley_values_of_an_additive_model(spark):
    model = LinearModel(0.3, {"a": (0.0, 1.0, 2.0), "b": (0.0, 1.0, -1.0), "c": (0.0, 1.0, 0.5)})
    df, _, _ = logistic_data(spark)
    rows = df.filter("id < 5")
    out = X.kernel_attribution(
        rows, df, lambda d: d.withColumn("y_score", model.logit()), ["a", "b", "c"], "id",
        background_size=20)
    ref = X.hashed_sample(df, "id", 20)
    means = ref.agg(*[F.avg(f).alias(f) for f in "abc"]).first()
    coef = {"a": 2.0, "b": -1.0, "c": 0.5}
    for r in out.collect():
        assert r["attribution"] == pytest.approx(coef[r["feature"]] * (r["value"] - means[r["feature"]]), abs=1e-6)


def test_attribution_by_batches(spark):
    model = LinearModel(0.3, {"a": (0.5, 2.0, 2.0), "b": (0.0, 1.0, -1.0), "c": (0.0, 1.0, 0.5)})
    df, _, _ = logistic_data(spark)
    rows = df.filter("id < 40").withColumn("c", F.when(F.col("id") != 7, F.col("c")))

    def both(score, columns):
        new = X.batch_attribution(rows, df.filter("id < 300"), score, list("abc"), "id", background_size=20, at_once=100)
        old = X.kernel_attribution(
            rows.na.drop(), df.filter("id < 300"), lambda d: d.withColumn("y_score", columns), list("abc"), "id", background_size=20)
        assert "Exchange" not in new._jdf.queryExecution().executedPlan().toString()
        return new.collect(), {(r.id, r.feature): r for r in old.collect()}

    for score, columns in (
        (model.matrix_probability, model.probability()), (lambda x: x[:, 0] * x[:, 1], F.col("a") * F.col("b")),
    ):
        new, old = both(score, columns)
        assert len(new) == 40 * 3 and len(old) == 39 * 3
        for r in new:
            if r.id == 7:
                assert r.attribution is None and (r.value is None) == (r.feature == "c")
            else:
                assert (r.value, r.attribution) == pytest.approx((old[r.id, r.feature].value, old[r.id, r.feature].attribution))
    none = X.batch_attribution(df.limit(0), df, model.matrix_probability, list("abc"), "id")
    assert none.count() == 0 and none.columns == ["id", "feature", "value", "attribution"]


def plain_auc(y, s):
    gap = s[y == 1][:, None] - s[y == 0][None, :]
    return (gap > 0).mean() + (gap == 0).mean() / 2


def test_importance_by_blocks_against_brute_force(spark):
    model = LinearModel(0.1, {"a": (0.0, 1.0, 2.0), "b": (0.0, 1.0, -1.0), "c": (0.0, 1.0, 0.0)})
    df, x, y = logistic_data(spark)
    df = df.withColumn("y_true", F.col("toxic"))
    size, blocks = 64, 400 // 64
    order = df.select(
        "id", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(blocks)).alias("block"), F.xxhash64("id", F.lit(6)).alias("at")
    ).orderBy("block", "at").collect()
    base = plain_auc(y, model.matrix_probability(x))
    want = {}
    for f in range(3):
        drops = []
        for repeat in range(4):
            moved = x.copy()
            for k in range(blocks):
                at = np.array([r.id for r in order if r.block == k])
                moved[at, f] = x[at[X.block_order(5, repeat, k, len(at))], f]
            drops.append(base - plain_auc(y, model.matrix_probability(moved)))
        want["abc"[f]] = np.mean(drops), np.std(drops)
    ask = dict(repeats=4, seed=5, block=size, bins=1 << 14)
    got = {r.feature: r for r in X.block_permutation_importance(
        df, model.matrix_probability, list("abc"), "id", **ask).collect()}
    for f, (mean, std) in want.items():
        assert abs(got[f].importance - mean) <= got[f].error + 1e-12 and got[f].error < 1e-3
        assert got[f]["std"] == pytest.approx(std, abs=2e-3)
    unlabelled = df.withColumn("y_true", F.when(F.col("id") >= 100, F.col("y_true")))
    assert X.block_permutation_importance(unlabelled, model.matrix_probability, list("abc"), "id", **ask).count() == 3
    assert got["c"].importance == 0 and got["a"].importance > got["b"].importance > 0
    one = X.block_permutation_importance(df.withColumn("y_true", F.lit(1)), model.matrix_probability, list("abc"), "id", **ask)
    assert [r.importance for r in one.collect()] == [None] * 3
    assert X.block_permutation_importance(df.limit(0), model.matrix_probability, list("abc"), "id", **ask).filter("importance is not null").count() == 0


def test_dense_index_is_a_permutation(spark):
    out = X.dense_index(spark.range(777), "id", chunks=16)
    assert sorted(r["_idx"] for r in out.collect()) == list(range(777))


def test_soft_vote_ties_go_to_zero(spark):
    a = spark.createDataFrame([(1, 0.4), (2, 0.9)], "id int, probability double")
    b = spark.createDataFrame([(1, 0.6), (2, 0.2)], "id int, probability double")
    got = {r["id"]: r["label"] for r in L.soft_vote([a, b], "id").collect()}
    assert got == {1: 0, 2: 1}
    with pytest.raises(ValueError):
        L.soft_vote([], "id")


def test_types_come_from_the_values(spark):
    rows = [("1", "1.5", "true", "x", None, 1, 2.0, "1"), ("-2", "1e3", "False", "7", "", None, None, "true"),
            ("+3", " .5", "true", "", None, 3, 1.0, "2")]
    df = spark.createDataFrame(rows, "`a.b` string, c string, d string, e string, f string, g int, h double, i string")
    got = {r["dtype"]: r["columns"] for r in P.dtype_counts(df).collect()}
    # f is missing throughout, g is whole numbers with one missing, i mixes a number and a boolean
    assert got == {"int64": 1, "float64": 4, "bool": 1, "object": 2}
    assert {r["dtype"]: r["columns"] for r in P.dtype_counts(df.limit(0)).collect()} == {"object": 8}


def test_grid_search_deals_folds_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = [(i, i % 2, float((i * 7) % 11 + i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, y int, x double").repartition(2).mapInArrow(seen, "id long, y int, x double")
    out = L.grid_search(df, ["x"], "y", "id", L.train_l2_logistic, {"c": (0.1, 1.0)}, parallel=1)
    assert out.count() == 2 and reads.value <= 2 * len(rows)  # once for bucket counts, once for the rows
