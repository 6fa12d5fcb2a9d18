import json

import pytest
from pyspark.sql import functions as F

from modlake.functions import moderation as rules
from modlake.plans import moderation as M
from modlake.plans import talk
from modlake.sources import commits, export, labelled, mediawiki, store
from modlake.sources import stored_json as J


def parse(spark, text):
    df = spark.createDataFrame([(1, text)], "id int, wikitext string")
    rows = talk.wikitext_comments(df, keep=["id"]).orderBy("seq").collect()
    return [(r["author"], str(r["timestamp"] or ""), r["text"], r["section"], r["level"]) for r in rows]


STAMP = "14:30, 5 May 2024 (UTC)"


@pytest.mark.parametrize("text, want", [
    ("Hi [[User:Ann|A]] " + STAMP, [("Ann", "2024-05-05 14:30:00", "Hi", "", 1)]),
    ("one\n two \n::*x [[User:Bob]]", [("Bob", "", "one\ntwo\nx", "", 3)]),
    ("loose\n== T ==\nend", [("", "", "loose", "", 1), ("", "", "end", "T", 1)]),
    ("[[User:Ann]] " + STAMP, []),
    ("kept\n[[User: Ann #x]]", [("Ann", "", "kept", "", 1)]),
    ("{{t}}\n| a\n<div>\n}}\n:\n::\n\n", []),
    ("a [[User:]] b", [("", "", "a [[User:]] b", "", 1)]),
    ("x [[User:A]] 14:30, 5 Foo 2024 (UTC)", [("A", "2024-01-05 14:30:00", "x", "", 1)]),
    ("x [[User:A]] 14:30, 32 May 2024 (UTC)", [("A", "", "x", "", 1)]),
    ("==\nq", [("", "", "q", "", 1)]),
    ("l\r\n== S ==\r\nm\r", [("", "", "l", "", 1), ("", "", "m", "S", 1)]),
    ("", []),
])
def test_talk_pages(spark, text, want):
    assert parse(spark, text) == want


def test_long_page(spark):
    assert len(parse(spark, "line\n" * 20000 + "x [[User:A]]")) == 1


def test_replies(spark):
    def reply(pages):
        return (json.dumps({"query": {"pages": pages}}),)

    rows = [
        reply({"1": {"title": "A", "revisions": [{"slots": {"main": {"*": "new"}}}]},
               "2": {"title": "B", "revisions": [{"*": "old"}]}}),
        reply({"-1": {"title": "C", "revisions": [{"*": "x"}]}}), reply({"3": {"title": "D"}}),
        reply({"4": {"revisions": [{"*": ""}]}}), reply({"5": {"revisions": [{"slots": {}, "*": "y"}]}}),
        ("not json",), ("{}",),
    ]
    df = spark.createDataFrame(rows, "body string")
    got = {(r["page_id"], r["wikitext"]) for r in mediawiki.wikitext(df).collect()}
    assert got == {("1", "new"), ("2", "old")}


def comments(spark):
    return spark.createDataFrame(
        [("a", "x", 0.9, "none", False), ("b", "x", 0.2, "manual-ban", False), ("c", "y", 0.55, "none", True)],
        "id string, article_id string, toxicity double, decision string, is_flagged boolean")


def test_decisions(spark):
    df = spark.createDataFrame([(0.75,), (0.7499,), (0.55,), (0.5499,), (None,)], "t double")
    got = [r[0] for r in df.select(rules.decide(F.col("t"), 0.75, 0.55)).collect()]
    assert got == ["auto-ban", "manual-review", "manual-review", "none", "none"]
    with pytest.raises(ValueError):
        rules.check_thresholds(0.5, 0.6)
    with pytest.raises(ValueError):
        rules.check_page(0, 0, None, None)


def test_reevaluation_spares_moderator_bans(spark):
    new = spark.createDataFrame([("x", 0.8, 0.1)], "article_id string, auto_threshold double, manual_threshold double")
    out = M.reevaluate(comments(spark), new)
    got = {r["id"]: (r["decision"], r["is_flagged"]) for r in out.collect()}
    assert got == {"a": ("auto-ban", True), "b": ("manual-ban", False), "c": ("none", True)}
    counts = {r["article_id"]: r["flagged_count"] for r in M.reevaluated_counts(out).collect()}
    assert counts == {"x": 2, "y": 1}


def test_upsert_refuses_repeated_ids(spark):
    heads = spark.createDataFrame([("x",)], "id string")
    twice = comments(spark).union(comments(spark))
    with pytest.raises(ValueError):
        M.upsert(heads, comments(spark), heads, twice)


def test_store_batches(spark, tmp_path):
    root = str(tmp_path / "store")
    store.write_batch(comments(spark), root, 0)
    newer = comments(spark).filter("id = 'a'").withColumn("toxicity", F.lit(0.1))
    store.write_batch(newer, root, 1)
    store.write_batch(newer, root, 1)
    got = {(r["id"], r["toxicity"]) for r in store.read_current(spark, root).collect()}
    assert got == {("a", 0.1), ("c", 0.55)}
    assert [r["id"] for r in store.read_article(spark, root, "y").collect()] == ["c"]


def test_csv_round_trip(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,comment_text,toxic,severe_toxic,obscene,threat,insult,identity_hate\n'
                    '1,"a ""b""\nc",1,0,0,0,0,0\n2,,0,0,0,0,0,0\n3,x,,0,0,0,0,0\n')
    rows = labelled.read_labelled(spark, str(path)).collect()
    assert [(r["comment_text"], r["toxic"]) for r in rows] == [('a "b"\nc', 1)]
    df = spark.createDataFrame([("A", None, "t" * 300, "S", 1)], "author string, timestamp timestamp_ntz, text string, section string, level int")
    for kind in ("json", "csv", "txt"):
        export.write_comments(df, str(tmp_path / kind), kind)
    assert len(export.csv_projection(df).first()["text"]) == 200


def stored_rows(spark, first, last):
    return spark.range(first, last).selectExpr(
        "cast(id as string) as id", "cast(id % 3 as string) as article_id", "0.5D as toxicity", "'pending' as decision"
    )


def test_replay_with_fewer_rows_replaces_the_batch(spark, tmp_path):
    root = str(tmp_path / "replay")
    store.write_batch(stored_rows(spark, 0, 300), root, 0)
    store.write_batch(stored_rows(spark, 0, 30), root, 0)
    assert store.read_current(spark, root).count() == 30


def test_micro_batches_of_one_snapshot_add_up(spark, tmp_path):
    root = str(tmp_path / "micro")
    store.write_batch(stored_rows(spark, 0, 100), root, 0, snapshot=0)
    store.write_batch(stored_rows(spark, 90, 200), root, 1, snapshot=0)
    assert store.read_current(spark, root).count() == 200
    assert store.read_article(spark, root, "1").count() == 67
    store.write_batch(stored_rows(spark, 0, 3), root, 2, snapshot=2)
    assert store.read_current(spark, root).count() == 3


def test_rows_without_a_label_are_refused(spark):
    from modlake.operators.learn import stratified_split, with_balanced_weight

    rows = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "id long, y int")
    for made in (stratified_split(rows, "id", "y"), with_balanced_weight(rows, "y")):
        with pytest.raises(Exception, match="no y"):
            made.collect()


def test_repeated_changes_do_not_multiply_rows(spark):
    rows = spark.createDataFrame([("a", "safe", False), ("b", "safe", False)], "id string, decision string, is_flagged boolean")
    twice = spark.createDataFrame([("a", "ban", 1), ("a", "review", 2), ("a", "ban", 0)], "id string, decision string, at int")
    got = M.override_decisions(rows, twice, order="at").collect()
    assert sorted((r["id"], r["decision"]) for r in got) == [("a", "review"), ("b", "safe")]
    same = twice.filter("decision = 'ban'")
    assert M.override_decisions(rows, same).filter("decision = 'ban'").count() == 1
    with pytest.raises(Exception, match="several changes for id"):
        M.override_decisions(rows, twice).collect()


def test_json_columns(spark):
    none = []
    cases = [
        (None, none, False), ("", none, False), (" ", none, False), ("{", none, True), ("[]", none, False), ("{}", none, True),
        ('[{"feature":"a","value":1,"shap":0.5}]', [("a", 1.0, 0.5)], False), ("null", none, True), ("[],[]", none, True),
        ('[{"feature":"a","value":"x"},null,3]', [("a", None, None)], False), ('[{"feature":"a"}] x', none, True),
        ('[{"value":2}]', [("", 2.0, None)], False),
    ]
    df = spark.createDataFrame([(n, c[0]) for n, c in enumerate(cases)], "n int, t string")
    decoded = df.select("n", J.TOP_FEATURES.decode(F.col("t")).alias("d"), J.TOP_FEATURES.unreadable(F.col("t")).alias("u"))
    again = decoded.withColumn("again", J.TOP_FEATURES.decode(J.TOP_FEATURES.encode(F.col("d"))))
    for r in again.collect():
        assert ([tuple(e) for e in r.d], r.u) == cases[r.n][1:] and r.again == r.d
    whole = spark.createDataFrame([('{"dates":["a"],"scores":[1,null],"threshold":0.5,"x":1}',), ('{"dates":3} {',), ("7",)], "t string")
    got = [r[0] for r in whole.select(J.TREND.decode(F.col("t"))).collect()]
    assert [tuple(r) for r in got] == [(["a"], [1.0, None], 0.5), ([], [], None), ([], [], None)]
    stats = whole.limit(0).unionByName(spark.createDataFrame([('{"count":2,"avg_ms":"1.5"}',)], "t string"))
    assert tuple(stats.select(J.INFERENCE_STATS.decode(F.col("t"))).first()[0]) == (2, 0.0, 1.5, 0.0, 0.0)


def test_articles_and_comments_change_together(spark, tmp_path):
    root = str(tmp_path / "commits")
    heads = spark.createDataFrame(
        [("x", 0.75, 0.55, 0), ("y", 0.75, 0.55, 1), ("z", 0.75, 0.55, 0)],
        "id string, auto_threshold double, manual_threshold double, flagged_count bigint")
    commits.write(heads, comments(spark), root, 0)
    before = commits.read(spark, root)
    new = spark.createDataFrame(
        [("x", 0.8, 0.1), ("z", 0.5, 0.4), ("unknown", 0.5, 0.4)], "article_id string, auto_threshold double, manual_threshold double")
    commits.reevaluate(spark, root, new, commits.next_number(spark, root))

    def state():
        articles, rows = commits.read(spark, root)
        return (
            {r.id: (r.auto_threshold, r.manual_threshold, r.flagged_count) for r in articles.collect()},
            {r.id: (r.article_id, r.decision, r.is_flagged) for r in rows.collect()}, articles.count(), rows.count(),
        )

    want = (
        {"x": (0.8, 0.1, 2), "y": (0.75, 0.55, 1), "z": (0.5, 0.4, 0)},
        {"a": ("x", "auto-ban", True), "b": ("x", "manual-ban", False), "c": ("y", "none", True)}, 3, 3,
    )
    assert state() == want
    assert {r.id: r.flagged_count for r in before[0].collect()} == {"x": 0, "y": 1, "z": 0}  # a reader keeps its commits
    # A writer that dies before its commit row, in either table, is never read.
    heads.limit(1).write.parquet(f"{root}/articles/commit=7/token=lost")
    comments(spark).write.parquet(f"{root}/comments/commit=7/token=lost")
    (tmp_path / "commits" / "commits" / "number=7" / "_temporary").mkdir(parents=True)
    assert state() == want
    # An article may lose all its comments.
    commits.write(heads.filter("id = 'y'"), comments(spark).limit(0), root, 2)
    want = (want[0], {k: v for k, v in want[1].items() if k != "c"}, 3, 2)
    assert state() == want
    commits.compact(spark, root, 3, comments_per_file=1)
    assert state() == want and commits.next_number(spark, root) == 4
    with pytest.raises(Exception, match="exist"):
        commits.write(heads, comments(spark), root, 3)
    assert state() == want
