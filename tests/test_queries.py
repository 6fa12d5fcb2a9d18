"""Registered queries against their SQL twins on the smallest tables.

A broad selection runs by default; MODLAKE_ALL=1 runs every query that has SQL.
"""

import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
CHOSEN = (
    "eda_class_means", "eda_class_histograms_lines", "eda_top_features_lines", "roc_auc_lines",
    "calibration_lines", "talk_comments", "toxicity_trend", "article_upsert", "ingest_results",
    "threshold_reevaluation", "top_features", "model_comparison", "stream_scored",
    "committed_articles", "stored_top_features", "stored_article_columns", "explanation_write_back",
)
NAMES = sorted(entry_module.oracle_sql()) if os.environ.get("MODLAKE_ALL") else CHOSEN


def tidy(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return "nan" if math.isnan(float(value)) else round(float(value), 6) + 0.0
    return str(value)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    names = sorted(df.columns)
    result = duck.execute(entry_module.oracle_sql()[name])
    found = [d[0] for d in result.description]
    assert sorted(found) == names
    at = [found.index(n) for n in names]
    want = sorted((tuple(tidy(r[i]) for i in at) for r in result.fetchall()), key=repr)
    got = sorted((tuple(tidy(r[n]) for n in names) for r in df.collect()), key=repr)
    assert got == want


def test_entry_is_registered(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_registry_needs_no_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) > 140 and len(e.oracle_sql()) > 130"
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


@pytest.mark.parametrize("name, source", [("stream_scored", "documents"), ("stream_dedup", "events"), ("stream_trend", "events")])
def test_streams_read_tables_of_many_files(spark, tmp_path, name, source):
    df = spark.range(40).withColumnRenamed("id", "doc_id").selectExpr(
        "doc_id", "concat('idiot number ', doc_id) as text", "'en' as lang", "concat('s', doc_id % 3) as source",
        "doc_id as event_id", "timestamp_seconds(1704067200 + doc_id) as ts", "'click' as event_type", "1.5D as value",
    )
    for folder, parts in (("one", 1), ("many", 3)):
        df.repartition(parts).write.parquet(str(tmp_path / folder / f"{source}.parquet"))
    (file,) = (tmp_path / "one" / f"{source}.parquet").glob("*.parquet")
    (tmp_path / "file").mkdir()
    os.link(file, tmp_path / "file" / f"{source}.parquet")
    run = entry_module.queries()[name]
    want, got = (sorted(map(repr, run(spark, str(tmp_path / f)).collect())) for f in ("file", "many"))
    assert got == want and want


@pytest.mark.parametrize("name", ["linear_attribution", "top_features", "eda_class_summary", "eda_top_features", "eda_correlation_matrix"])
def test_reports_compute_features_once(spark, name):
    plan = entry_module.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan
