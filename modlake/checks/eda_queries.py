"""Registered queries for profiling reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from modlake.checks import inputs as I
from modlake.checks import sql as Q
from modlake.checks.registry import query
from modlake.operators import profile as P
from modlake.operators.columns import correlation_matrix
from modlake.plans.features import BINARY_FEATURES, CATALOGUE, IDENTITY_FLAGS, category_of

FEATURES = list(I.PLAIN_FEATURES)
BINARY = [f for f in FEATURES if f in BINARY_FEATURES]
SHAPE = ["char_count", "word_count", "exclamation_count", "uppercase_ratio", "unique_word_ratio"]
LINE = list(I.LINE_MEASURES)


def unpivoted(source: str, label: str, features) -> str:
    casts = ", ".join(f"{f}::DOUBLE AS {f}" for f in features)
    return (
        f"long AS MATERIALIZED (SELECT label, feature, value FROM (SELECT {label} AS label, {casts}"
        f" FROM {source}) UNPIVOT (value FOR feature IN ({', '.join(features)})))"
    )


LONG = f"{Q.LABELLED}, {unpivoted('feats', 'toxic', FEATURES)}"
LINE_LONG = f"{Q.LINES}, {unpivoted('lines', 'label', LINE)}"

CORR = (
    "CASE WHEN stddev_pop(value) = 0 OR stddev_pop(label) = 0 THEN NULL"
    " ELSE covar_pop(value, label) / (stddev_pop(value) * stddev_pop(label)) END"
)
EFFECT = f"""eff AS (
  SELECT feature, m1, m0, corr,
         CASE WHEN v1 + v0 = 0 THEN 0.0::DOUBLE
              ELSE (m1 - m0) / sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2)) END AS d
  FROM (SELECT feature, {CORR} AS corr,
               avg(value) FILTER (label = 1) AS m1, avg(value) FILTER (label = 0) AS m0,
               var_samp(value) FILTER (label = 1) AS v1, var_samp(value) FILTER (label = 0) AS v0,
               count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 0) AS n0
        FROM long GROUP BY feature))"""
CATEGORY = "CASE " + " ".join(
    f"WHEN feature IN {Q.quoted(names)} THEN '{c}'" for c, names in CATALOGUE.items()
) + " END"


def r6(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def centred(df):
    return df.withColumn("bin_center", F.round("bin_center", 10))


def labelled(spark, sf_dir, only=I.PLAIN_FEATURES):
    return I.labelled(spark, sf_dir, only=tuple(only))


def measured(spark, sf_dir, only=I.PLAIN_FEATURES):
    """The same as a written table, for reports that read it more than once."""
    return I.written(labelled(spark, sf_dir, only), "features")


# --- table quality ----------------------------------------------------------

@query("eda_missing", """
WITH t AS (SELECT d.doc_id, d.lang, l.quality, l.toxic,
                  CASE WHEN d.n_chars % 7 = 0 THEN NULL ELSE d.n_chars END AS n_chars
           FROM documents d LEFT JOIN labels l USING (doc_id)),
m AS (SELECT 'quality' AS "column", count(*) - count(quality) AS c, count(*) AS n FROM t
      UNION ALL SELECT 'toxic', count(*) - count(toxic), count(*) FROM t
      UNION ALL SELECT 'n_chars', count(*) - count(n_chars), count(*) FROM t
      UNION ALL SELECT 'lang', count(*) - count(lang), count(*) FROM t
      UNION ALL SELECT 'doc_id', count(*) - count(doc_id), count(*) FROM t)
SELECT "column", c AS missing_count, round(c * 100.0::DOUBLE / n, 6) AS missing_pct FROM m WHERE c > 0""")
def eda_missing(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.when(F.col("n_chars") % 7 != 0, F.col("n_chars")).alias("n_chars")
    )
    df = docs.join(I.table(spark, sf_dir, "labels"), "doc_id", "left")
    return r6(P.missing_report(df), "missing_pct")


@query("eda_duplicates", """
SELECT sum(n)::BIGINT AS total_rows, sum(n - 1)::BIGINT AS duplicate_rows
FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source, n_chars)""")
def eda_duplicates(spark, sf_dir):
    return P.duplicate_rows(I.table(spark, sf_dir, "documents").drop("doc_id"))


_TYPED = ("doc_id", "text", "lang", "source", "n_chars", "toxic", "quality")


def _dtype_sql() -> str:
    number = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|[+-]?[iI]nf(inity)?"
    values = " UNION ALL ".join(f"SELECT '{c}' AS c, trim(CAST({c} AS VARCHAR), ' ') AS v FROM t" for c in _TYPED)
    return f"""WITH t AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)), vs AS ({values}),
k AS (SELECT c, CASE WHEN v IS NULL OR v = '' OR lower(v) = 'nan' THEN 'hole' WHEN lower(v) IN ('true', 'false') THEN 'flag'
  WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN 'whole' WHEN regexp_full_match(v, '{number}') THEN 'fraction'
  ELSE 'text' END AS kind FROM vs),
f AS (SELECT c, list_sort(list(DISTINCT kind)) AS kinds FROM k GROUP BY c)
SELECT CASE WHEN kinds = ['whole'] THEN 'int64' WHEN kinds = ['flag'] THEN 'bool'
  WHEN list_contains(kinds, 'text') OR list_contains(kinds, 'flag') THEN 'object' ELSE 'float64' END AS dtype,
  count(*) AS columns FROM f GROUP BY 1"""


@query("eda_dtypes", _dtype_sql())
def eda_dtypes(spark, sf_dir):
    docs, labels = (I.table(spark, sf_dir, t) for t in ("documents", "labels"))
    return P.dtype_counts(docs.join(labels, "doc_id", "left").select(*_TYPED))


@query("eda_label_distribution", """
SELECT toxic AS label, count(*) AS count,
       round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents), 2) AS pct
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY toxic""")
def eda_label_distribution(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents").select("doc_id")
    return P.label_distribution(docs.join(I.table(spark, sf_dir, "labels"), "doc_id", "left"), "toxic")


@query("eda_imbalance", """
SELECT round(greatest(a, b) / least(a, b), 6) AS majority_minority_ratio,
       round(b / a, 6) AS negative_positive_ratio
FROM (SELECT count(*) FILTER (toxic = 1) AS a, count(*) FILTER (toxic = 0) AS b FROM labels)""")
def eda_imbalance(spark, sf_dir):
    return r6(
        P.imbalance(I.table(spark, sf_dir, "labels"), "toxic"),
        "majority_minority_ratio", "negative_positive_ratio",
    )


@query("eda_overview", """
WITH t AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT count(*) AS total_rows, count(*) FILTER (toxic = 1) AS toxic_count,
       count(*) FILTER (toxic = 0) AS nontoxic_count,
       round(count(*) FILTER (toxic = 1) / count(*), 4) AS toxic_rate,
       round(1 - count(*) FILTER (toxic = 1) / count(*), 4) AS nontoxic_rate,
       round(count(*) FILTER (toxic = 0) / count(*) FILTER (toxic = 1), 2) AS imbalance_ratio,
       (2 * count(*) FILTER (toxic IS NULL))::BIGINT AS missing_values, 7 AS total_features
FROM t""")
def eda_overview(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents")
    return P.overview(docs.join(I.table(spark, sf_dir, "labels"), "doc_id", "left"), "toxic")


@query("eda_split_report", """
WITH t AS (SELECT toxic, CASE WHEN doc_id % 5 < 4 THEN 'train' ELSE 'test' END AS part FROM labels)
SELECT count(*) FILTER (part = 'train') AS train_rows,
       round(avg(toxic) FILTER (part = 'train'), 6) AS train_rate,
       count(*) FILTER (part = 'test') AS test_rows,
       round(avg(toxic) FILTER (part = 'test'), 6) AS test_rate,
       round(abs(avg(toxic) FILTER (part = 'train') - avg(toxic) FILTER (part = 'test')), 6)
         AS absolute_rate_gap
FROM t""")
def eda_split_report(spark, sf_dir):
    part = F.when(F.col("doc_id") % 5 < 4, "train").otherwise("test")
    df = I.table(spark, sf_dir, "labels").withColumn("split", part)
    return r6(P.split_report(df, "toxic"), "train_rate", "test_rate", "absolute_rate_gap")


# --- features against the label ---------------------------------------------

def _occurrence_sql(long: str) -> str:
    return f"""{long}
SELECT feature, count(*) FILTER (value <> 0) AS non_zero_count,
       round(count(*) FILTER (value <> 0) * 100.0::DOUBLE / count(*), 2) AS non_zero_pct,
       count(*) FILTER (value <> 0 AND label = 0) AS non_zero_count_non_toxic,
       count(*) FILTER (value <> 0 AND label = 1) AS non_zero_count_toxic,
       round(count(*) FILTER (value <> 0 AND label = 0) * 100.0::DOUBLE
             / greatest(count(*) FILTER (label = 0), 1), 2) AS non_zero_pct_non_toxic,
       round(count(*) FILTER (value <> 0 AND label = 1) * 100.0::DOUBLE
             / greatest(count(*) FILTER (label = 1), 1), 2) AS non_zero_pct_toxic
FROM long GROUP BY feature"""


@query("eda_occurrence", _occurrence_sql(LONG))
def eda_occurrence(spark, sf_dir):
    return P.occurrence(labelled(spark, sf_dir), "toxic", FEATURES)


@query("eda_label_correlation",
       f"{LONG} SELECT feature, round({CORR}, 6) AS correlation FROM long GROUP BY feature")
def eda_label_correlation(spark, sf_dir):
    return r6(P.label_correlation(labelled(spark, sf_dir), "toxic", FEATURES), "correlation")


@query("eda_label_correlation_lines",
       f"{LINE_LONG} SELECT feature, round({CORR}, 6) AS correlation FROM long GROUP BY feature")
def eda_label_correlation_lines(spark, sf_dir):
    return r6(P.label_correlation(I.order_lines(spark, sf_dir), "label", LINE), "correlation")


_MEANS = """SELECT feature, round(avg(value) FILTER (label = 0), 6) AS non_toxic,
       round(avg(value) FILTER (label = 1), 6) AS toxic,
       round(avg(value) FILTER (label = 1) - avg(value) FILTER (label = 0), 6)
         AS toxic_minus_non_toxic
FROM long"""


@query("eda_class_means", f"{LONG} {_MEANS} GROUP BY feature")
def eda_class_means(spark, sf_dir):
    return r6(
        P.class_means(labelled(spark, sf_dir), "toxic", FEATURES),
        "non_toxic", "toxic", "toxic_minus_non_toxic",
    )


@query("eda_feature_search", f"{LONG} {_MEANS} WHERE feature LIKE '%count%' GROUP BY feature")
def eda_feature_search(spark, sf_dir):
    report = P.class_means(labelled(spark, sf_dir), "toxic", FEATURES)
    return r6(P.search(report, "Count", "diff"), "non_toxic", "toxic", "toxic_minus_non_toxic")


def _matrix_sql(source: str, features) -> str:
    rows = []
    for a in features:
        for b in features:
            var = f"stddev_pop({a}::DOUBLE) * stddev_pop({b}::DOUBLE)"
            rows.append(
                f"SELECT '{a}' AS feature_a, '{b}' AS feature_b,"
                f" round(CASE WHEN stddev_pop({a}::DOUBLE) = 0 OR stddev_pop({b}::DOUBLE) = 0 THEN NULL"
                f" ELSE covar_pop({a}::DOUBLE, {b}::DOUBLE) / ({var}) END, 4) AS correlation FROM {source}"
            )
    return " UNION ALL ".join(rows)


_KEPT = Q.LABELLED + f", kept AS MATERIALIZED (SELECT toxic, {', '.join(FEATURES)} FROM feats)"


@query("eda_correlation_matrix", f"{_KEPT} {_matrix_sql('kept', FEATURES)}")
def eda_correlation_matrix(spark, sf_dir):
    df = correlation_matrix(measured(spark, sf_dir), FEATURES)
    return df.withColumn("correlation", F.round("correlation", 4))


@query("eda_correlation_matrix_lines", f"{Q.LINES} {_matrix_sql('lines', LINE)}")
def eda_correlation_matrix_lines(spark, sf_dir):
    df = correlation_matrix(I.order_lines(spark, sf_dir), LINE)
    return df.withColumn("correlation", F.round("correlation", 4))


@query("eda_top_correlations", f"""{_KEPT},
{unpivoted('kept', 'toxic', FEATURES)},
best AS (SELECT feature FROM (SELECT feature, {CORR} AS c FROM long GROUP BY feature)
         ORDER BY round(abs(c), 12) DESC NULLS LAST, feature LIMIT 12
         ), names AS (SELECT feature FROM best UNION ALL SELECT 'toxic'),
mat AS ({_matrix_sql('kept', [*FEATURES, 'toxic'])})
SELECT feature_a, feature_b, correlation FROM mat
WHERE feature_a IN (SELECT feature FROM names) AND feature_b IN (SELECT feature FROM names)""")
def eda_top_correlations(spark, sf_dir):
    df = P.top_correlations(measured(spark, sf_dir), "toxic", FEATURES)
    return df.withColumn("correlation", F.round("correlation", 4))


@query("eda_effect_size", f"{LONG}, {EFFECT} SELECT feature, round(d, 6) AS effect_size FROM eff")
def eda_effect_size(spark, sf_dir):
    df = P.effect_size(labelled(spark, sf_dir), "toxic", FEATURES)
    return df.select("feature", F.round("effect_size", 6).alias("effect_size"))


@query("eda_category_summary", f"""{LONG}, {EFFECT}
SELECT {CATEGORY} AS category, feature, round(m1, 6) AS toxic_mean, round(m0, 6) AS nontoxic_mean,
       round(d, 4) AS effect_size FROM eff""")
def eda_category_summary(spark, sf_dir):
    return P.category_summary(
        labelled(spark, sf_dir), "toxic", FEATURES, category_of(F.col("feature"))
    )


_TOP = """SELECT row_number() OVER (ORDER BY abs(round(d, 4)) DESC, feature) AS rank, feature AS name,
       {cat} AS category, round(d, 4) AS effect_size, round(corr, 4) AS correlation,
       round(m1, 6) AS toxic_mean, round(m0, 6) AS nontoxic_mean,
       round(q1, 6) AS toxic_median, round(q0, 6) AS nontoxic_median
FROM eff JOIN (SELECT feature, median(value) FILTER (label = 1) AS q1,
                      median(value) FILTER (label = 0) AS q0 FROM long GROUP BY feature)
     USING (feature) QUALIFY rank <= 15"""


@query("eda_top_features", f"{LONG}, {EFFECT} {_TOP.format(cat=CATEGORY)}")
def eda_top_features(spark, sf_dir):
    return P.top_features(measured(spark, sf_dir), "toxic", FEATURES, category_of(F.col("feature")))


@query("eda_top_features_lines", f"{LINE_LONG}, {EFFECT} {_TOP.format(cat='NULL::VARCHAR')}")
def eda_top_features_lines(spark, sf_dir):
    return P.top_features(
        I.order_lines(spark, sf_dir), "label", LINE, F.lit(None).cast("string")
    )


# --- distributions ----------------------------------------------------------

def _class_hist_sql(long: str, binary) -> str:
    flag = f"feature IN {Q.quoted(binary)}" if binary else "FALSE"
    return f"""{long},
lim0 AS (SELECT feature, {flag} AS is_binary, quantile_cont(value, 0.01) AS a,
                quantile_cont(value, 0.99) AS b FROM long GROUP BY feature),
lim AS (SELECT feature, is_binary, CASE WHEN is_binary THEN 2 ELSE 30 END AS bins,
               CASE WHEN is_binary THEN -0.5 ELSE a END::DOUBLE AS low,
               CASE WHEN is_binary THEN 1.5 WHEN b <= a THEN a + 1.0 ELSE b END::DOUBLE AS high
        FROM lim0),
grid AS (SELECT *, low + bin * ((high - low) / bins) AS l,
                CASE WHEN bin = bins - 1 THEN high ELSE low + (bin + 1) * ((high - low) / bins) END AS r
         FROM (SELECT *, unnest(range(0, bins)) AS bin FROM lim)),
size AS (SELECT count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1 FROM long
         WHERE feature = (SELECT min(feature) FROM long))
SELECT g.feature, g.bin, round(any_value(l), 6) AS left_edge,
       round(count(*) FILTER (label = 0) * 100.0::DOUBLE / (SELECT n0 FROM size), 4) AS non_toxic,
       round(count(*) FILTER (label = 1) * 100.0::DOUBLE / (SELECT n1 FROM size), 4) AS toxic,
       any_value(is_binary) AS is_binary
FROM grid g LEFT JOIN long v ON v.feature = g.feature AND v.value >= g.l
     AND (v.value < g.r OR (g.bin = g.bins - 1 AND v.value <= g.r))
GROUP BY g.feature, g.bin"""


@query("eda_class_histograms", _class_hist_sql(LONG, BINARY))
def eda_class_histograms(spark, sf_dir):
    return P.class_histograms(measured(spark, sf_dir), "toxic", FEATURES, BINARY)


@query("eda_class_histograms_lines", _class_hist_sql(LINE_LONG, []))
def eda_class_histograms_lines(spark, sf_dir):
    return P.class_histograms(I.order_lines(spark, sf_dir), "label", LINE)


def _hist40_sql(long: str) -> str:
    return f"""{long},
lim AS (SELECT label, feature,
               CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS low,
               CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS high
        FROM long GROUP BY label, feature),
grid AS (SELECT *, low + bin * ((high - low) / 40) AS l,
                CASE WHEN bin = 39 THEN high ELSE low + (bin + 1) * ((high - low) / 40) END AS r
         FROM (SELECT *, unnest(range(0, 40)) AS bin FROM lim))
SELECT g.feature, g.label, g.bin, round(any_value((l + r) / 2), 10) AS bin_center,
       count(v.value) AS count
FROM grid g LEFT JOIN long v ON v.feature = g.feature AND v.label = g.label AND v.value >= g.l
     AND (v.value < g.r OR (g.bin = 39 AND v.value <= g.r))
GROUP BY g.feature, g.label, g.bin"""


@query("eda_histograms40", _hist40_sql(LONG))
def eda_histograms40(spark, sf_dir):
    return centred(P.feature_histograms(measured(spark, sf_dir), "toxic", FEATURES))


@query("eda_histograms40_lines", _hist40_sql(LINE_LONG))
def eda_histograms40_lines(spark, sf_dir):
    return centred(P.feature_histograms(I.order_lines(spark, sf_dir), "label", LINE))


_SUMMARY = """SELECT feature, label, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean,
       median(value) AS median, round(stddev_samp(value), 6) AS std FROM long GROUP BY feature, label"""


@query("eda_class_summary", f"{LONG} {_SUMMARY}")
def eda_class_summary(spark, sf_dir):
    return r6(P.class_summary(measured(spark, sf_dir), "toxic", FEATURES), "mean", "std")


_WORDY = ["profanity_count", "slang_count", "obfuscated_profanity_count"]


@query("eda_profanity_slang", f"""{LONG}
SELECT feature, count(*) FILTER (value > 0) AS comments, round(avg(value), 4) AS mean_count,
       max(value)::BIGINT AS max_count FROM long WHERE feature IN {Q.quoted(_WORDY)} GROUP BY feature""")
def eda_profanity_slang(spark, sf_dir):
    return P.word_list_summary(labelled(spark, sf_dir, _WORDY), _WORDY)


def _only(names) -> str:
    return f"{Q.LABELLED}, {unpivoted('feats', 'toxic', names)}"


@query("eda_profanity_slang_histograms", _hist40_sql(_only(_WORDY[:2])))
def eda_profanity_slang_histograms(spark, sf_dir):
    df = labelled(spark, sf_dir, _WORDY[:2])
    return centred(P.feature_histograms(df, "toxic", _WORDY[:2]))


@query("eda_text_shape", _hist40_sql(_only(SHAPE)))
def eda_text_shape(spark, sf_dir):
    return centred(P.feature_histograms(measured(spark, sf_dir, SHAPE), "toxic", SHAPE))


# --- identity ---------------------------------------------------------------

_FLAGS = list(IDENTITY_FLAGS)


@query("eda_identity", f"""{LONG}
SELECT replace(feature, 'identity_', '') AS category, count(*) FILTER (value = 1) AS mention_count,
       round(count(*) FILTER (value = 1) * 100.0::DOUBLE / count(*), 2) AS mention_pct,
       count(*) FILTER (value = 1 AND label = 1) AS toxic_with_mention,
       round(avg(label) FILTER (value = 1), 4) AS toxicity_rate,
       round(avg(label), 4) AS baseline_toxicity_rate,
       round(avg(label) FILTER (value = 1) / avg(label), 2) AS relative_risk
FROM long WHERE feature IN {Q.quoted(_FLAGS)} GROUP BY feature HAVING mention_count > 0""")
def eda_identity(spark, sf_dir):
    return P.identity_analysis(labelled(spark, sf_dir, _FLAGS), "toxic", _FLAGS)


_RISK = f"""{Q.LABELLED}, withhate AS MATERIALIZED (
  SELECT f.*, 1 - l.quality AS hate FROM feats f JOIN labels l USING (doc_id)),
long AS (SELECT toxic AS label, hate, feature, value FROM (SELECT toxic, hate,
         {', '.join(_FLAGS)} FROM withhate) UNPIVOT (value FOR feature IN ({', '.join(_FLAGS)})))"""


@query("eda_identity_risk", f"""{_RISK},
r AS (SELECT feature AS key, count(*) FILTER (value = 1) AS count,
       round(count(*) FILTER (value = 1) * 100.0::DOUBLE / count(*), 2) AS pct_of_dataset,
       round(avg(label) FILTER (value = 1), 4) AS toxic_rate,
       round(avg(label) FILTER (value = 1) / avg(label), 3) AS relative_risk,
       round(avg(hate) FILTER (value = 1), 4) AS identity_hate_rate
FROM long GROUP BY feature)
SELECT *, CASE WHEN relative_risk >= 2.5 THEN 'High' WHEN relative_risk >= 1.25 THEN 'Elevated'
               WHEN relative_risk <= 0.75 THEN 'Low' ELSE 'Baseline' END AS tier
FROM r WHERE count > 0""")
def eda_identity_risk(spark, sf_dir):
    # The tables have no second label; low quality stands in for it.
    quality = I.table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("hate"))
    df = labelled(spark, sf_dir, _FLAGS).join(quality, "doc_id")
    return P.identity_risk(df, "toxic", _FLAGS, "hate")


@query("eda_identity_overview", f"""{Q.LABELLED}, t AS (
  SELECT f.toxic, identity_mention_count AS m, 1 - l.quality AS hate
  FROM feats f JOIN labels l USING (doc_id))
SELECT round(avg(toxic), 4) AS baseline_toxic_rate, count(*) AS total_comments,
       count(*) FILTER (m > 0) AS any_identity_mention_count,
       round(count(*) FILTER (m > 0) * 100.0::DOUBLE / count(*), 2) AS any_identity_mention_pct,
       round(avg(toxic) FILTER (m > 0), 4) AS any_identity_mention_toxic_rate,
       sum(hate)::BIGINT AS identity_hate_total,
       round(sum(hate) / count(*), 5) AS identity_hate_rate FROM t""")
def eda_identity_overview(spark, sf_dir):
    quality = I.table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("hate"))
    df = labelled(spark, sf_dir, ["identity_mention_count"]).join(quality, "doc_id")
    return P.identity_overview(df, "toxic", hate="hate")


# --- readiness and describe ---------------------------------------------------

@query("eda_readiness", f"""{LONG},
best AS (SELECT feature, {CORR} AS c FROM long GROUP BY feature),
top AS (SELECT feature, c FROM best ORDER BY round(abs(c), 12) DESC NULLS LAST, feature LIMIT 10)
SELECT TRUE AS split_disjoint, TRUE AS train_has_engineered_features,
       (SELECT greatest(a, b) / least(a, b) > 1.5 FROM (SELECT count(*) FILTER (toxic = 1) AS a,
               count(*) FILTER (toxic = 0) AS b FROM feats)) AS target_imbalance_detected,
       {len(FEATURES)} AS candidate_features_count,
       (SELECT string_agg(feature, ',' ORDER BY round(abs(c), 12) DESC, feature) FROM top)
         AS top_candidate_features""")
def eda_readiness(spark, sf_dir):
    part = F.when(F.col("doc_id") % 5 < 4, "train").otherwise("test")
    df = labelled(spark, sf_dir).withColumn("split", part)
    return P.readiness(df, "toxic", FEATURES, key="doc_id")


def _describe_sql(long: str) -> str:
    return f"""{long} SELECT feature, count(value) AS count, round(avg(value), 8) AS mean,
round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max,
round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
round(quantile_cont(value, 0.75), 6) AS q75 FROM long GROUP BY feature"""


@query("eda_describe", _describe_sql(LONG))
def eda_describe(spark, sf_dir):
    df = P.describe(measured(spark, sf_dir), FEATURES)
    return r6(df.withColumn("mean", F.round("mean", 8)), "std", "q25", "q50", "q75")


@query("eda_describe_lines", _describe_sql(LINE_LONG))
def eda_describe_lines(spark, sf_dir):
    df = P.describe(I.order_lines(spark, sf_dir), LINE)
    return r6(df.withColumn("mean", F.round("mean", 8)), "std", "q25", "q50", "q75")
