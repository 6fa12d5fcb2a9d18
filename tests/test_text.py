"""Features against a plain-Python statement of each rule."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from modlake.functions import lexicons as L
from modlake.functions import text as X
from modlake.plans.features import FEATURES, DenseFeatures, dense_features

CASES = [
    "", "   ", "\t\n", "Hello World", "You are an IDIOT!!", "idiot's idiot_ 'idiot' idiot",
    "youtube you're YOU u ur", "sh1t $hit a$$hole idi0t", "999.1.1.1 256.1.1.1 10.0.0.1 1.2.3.4.5",
    "I A1 !! OK ÉCOLE straße STRAßE", "lgbtq+ x lgbtq+y LGBTQ", "native  american\nAfrican American",
    "a\x1cb\x85c\u2003d", "soooo coool ... AAAb", "http://x.y www.z HTTPS://Q http:// www.",
    "can't can’t don't no' x'no a'b'no not never", "One. Two! Three? ... \n .", "kys KYS stfu_ wtf",
    "men\u00e9 caf\u00e9men bi-bi bisexual \u0130ndian \u017fikh", "\U0001f600 ok \U0001f600!!", "x''idiot idiot''7 7'idiot",
]


def _terms(terms):
    return "|".join(r"\s+".join(map(re.escape, t.split())) for t in terms)


def plain(text):
    words, low = text.split(), text.lower()
    sents = [s for s in re.split(r"[.!?]+", text) if s.strip()]
    octet = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
    leet = str.maketrans(L.LEET_FROM, L.LEET_TO)

    def keep(s):
        return re.sub("[^a-z]", "", s)

    second = len(re.findall(rf"\b(?:{_terms(L.SECOND_PERSON)})\b", text, re.I))
    url = len(re.findall(r"https?://\S+|www\.\S+", text, re.I))
    ip = len(re.findall(rf"\b(?:{octet}\.){{3}}{octet}\b", text))
    out = {
        "char_count": len(text), "word_count": len(words), "exclamation_count": text.count("!"),
        "uppercase_ratio": sum(w.isupper() and len(w) > 1 for w in words) / len(words) if words else 0.0,
        "unique_word_ratio": len(set(words)) / len(words) if words else 0.0,
        "elongated_token_count": sum(bool(re.search(r"(.)\1{2,}", w, re.I)) for w in words),
        "consecutive_punct_count": len(re.findall(r"[^\w\s]{2,}", text)),
        "url_count": url, "ip_count": ip, "has_url_or_ip": int(url + ip > 0),
        "has_second_person": int(second > 0), "second_person_count": second,
        "second_person_density": round(second / max(len(words), 1), 6),
        "profanity_count": sum(t in L.PROFANITY for t in re.findall(r"\b[a-zA-Z']+\b", low)),
        "obfuscated_profanity_count": sum(
            keep(w.lower().translate(leet)) in L.PROFANITY and keep(w.lower()) not in L.PROFANITY
            for w in words),
        "slang_count": sum(t in L.SLANG for t in re.findall(r"\b\w+\b", low)),
        "negation_count": sum(t in L.NEGATION for t in re.findall(r"\b\w+(?:'\w+)?\b", low)),
        "sentence_count": len(sents),
        "avg_sentence_length": sum(len(s.split()) for s in sents) / len(sents) if sents else 0.0,
        "identity_mention_count": len(re.findall(rf"\b(?:{_terms(L.DEFAULT.identity_terms())})\b", text, re.I)),
    }
    for name, terms in L.DEFAULT.identity.items():
        out[f"identity_{name}"] = int(bool(re.search(rf"\b(?:{_terms(terms)})\b", text, re.I)))
    return out


def test_literal_cases(spark):
    rows = [(i, t) for i, t in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, comment_text string")
    for row in dense_features(df, keep=["id"]).collect():
        want = plain(CASES[row["id"]])
        got = {k: row[k] for k in want}
        assert got == pytest.approx(want), CASES[row["id"]]


def test_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in dense_features(docs, "text", keep=["doc_id"]).collect():
        want = plain(texts[row["doc_id"]])
        assert {k: row[k] for k in want} == pytest.approx(want)


def test_nulls_names_and_transformer(spark):
    df = spark.createDataFrame([(1, None), (2, "you idiot")], "id int, comment_text string")
    out = dense_features(df)
    assert out.columns == list(FEATURES) and len(FEATURES) == 32
    assert all(v is not None for row in out.collect() for v in row)
    kept = DenseFeatures().transform(df)
    assert kept.columns == ["id", "comment_text", *FEATURES]
    assert DenseFeatures(keepInput=False).transform(df).columns == list(FEATURES)


def test_upper_words(spark):
    texts = ["AB a Ab aB A", "ÀÉ 12 A1 1A !A! -- X", "ǅA AǅB ẞẞ ªA", "\tNO YES\x1cOK.\n", "", "ΣΑΣ σΑ Ⅷ Ⅷx Ⓐ1"]
    df = spark.createDataFrame(enumerate(texts), "i int, t string").select(
        "i", X.upper_word_count(F.col("t")).alias("n"), X.upper_word_count(F.col("t"), shortest=1).alias("m"))
    cased = [[w for w in re.split(r"[ \t\n\x1c ]+", t) if any(unicodedata.category(c) == "Lu" or c in "ⅧⒶ" for c in w)
              and not any(unicodedata.category(c) in ("Ll", "Lt") or c == "ª" for c in w)] for t in texts]
    got = {r.i: (r.n, r.m) for r in df.collect()}
    assert got == {i: (sum(len(w) > 1 for w in ws), len(ws)) for i, ws in enumerate(cased)}


def test_upper_words_are_one_search(spark):
    plan = spark.range(1).select(X.upper_word_count(F.col("id").cast("string")).alias("n"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_count") == 1
