import pytest

from modlake.functions import sentiment as S
from modlake.plans.features import dense_features

NAMES = ("vader_compound", "vader_neg", "vader_pos")


def scores(spark, texts, lexicon=None):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, comment_text string")
    rows = dense_features(df, keep=["id"], only=NAMES, sentiment=lexicon).orderBy("id").collect()
    return [r["vader_compound"] for r in rows], rows


def compound(total):
    return round(total / (total * total + 15) ** 0.5, 4)


CASES = [
    ("", 0.0), ("good", 1.9), ("GOOD", 1.9), ("this is GOOD", 1.9 + 0.733), ("not good", 1.9 * -0.74),
    ("very good", 1.9 + 0.293), ("very bad", -2.5 - 0.293), ("slightly good", 1.9 - 0.293),
    ("really really good", 1.9 + 0.293 + 0.293 * 0.95), ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
    ("good!!!", 1.9 + 3 * 0.292), ("good!!!!!!", 1.9 + 4 * 0.292), ("good??", 1.9 + 2 * 0.18),
    ("never so good", (1.9 + 0.293) * 1.25), ("least good", 1.9 * -0.74), ("at least good", 1.9),
    ("(good)", 1.9), ("isn't good", 1.9 * -0.74), ("no good", 1.9 * -0.74), ("plain words only", 0.0),
]


def test_rules(spark):
    got, _ = scores(spark, [t for t, _ in CASES])
    assert got == pytest.approx([compound(v) for _, v in CASES], abs=1e-4)


def test_shares(spark):
    _, rows = scores(spark, ["good day"])
    assert rows[0]["vader_pos"] == pytest.approx(round(2.9 / 3.9, 3))
    assert rows[0]["vader_neg"] == 0.0


def test_table_gives_the_same_as_a_dict(spark):
    texts = [t for t, _ in CASES]
    want, _ = scores(spark, texts)
    entries = [*S.SEED_LEXICON.items(), ("good", -3.0), ("good", None), (None, 1.0)]
    got, _ = scores(spark, texts, spark.createDataFrame(entries, "term string, valence double"))
    assert got == want
    assert scores(spark, texts, {**S.SEED_LEXICON, "plain": None})[0] == want


def test_empty_lexicon_scores_nothing(spark):
    none = spark.createDataFrame([], "term string, valence double")
    for lexicon in ({}, none):
        assert scores(spark, ["good", "bad!", None], lexicon)[0] == [0.0, 0.0, 0.0]
