"""SQL building blocks for the twins of the registered queries."""

from __future__ import annotations

from modlake.checks.inputs import AUTO, LOWER, MANUAL, MODEL, PLAIN_FEATURES
from modlake.functions.lexicons import DEFAULT, LEET_FROM, LEET_TO

SP = r"\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\p{Z}"
W = r"\p{L}\p{N}_"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"


def quoted(terms) -> str:
    return "(" + ", ".join("'" + t.replace("'", "''") + "'" for t in terms) + ")"


def _alternation(terms) -> str:
    parts = []
    for term in terms:
        words = [w.replace("+", r"\+").replace("-", r"\-") for w in term.split()]
        parts.append(rf"[{SP}]+".join(words))
    return "|".join(parts)


COMMENTS = f"""
comments AS (
  SELECT doc_id, source AS article_id,
         CASE WHEN doc_id % 6 = 0 THEN '' ELSE 'user' || (doc_id % 7) END AS author,
         strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id * 4321), '%Y-%m-%dT%H:%M:%S') AS timestamp,
         CASE doc_id % 5
           WHEN 0 THEN text
           WHEN 1 THEN translate(text, '{LOWER}', '{LOWER.upper()}')
           WHEN 2 THEN text || ' you''re www.example.com !!!'
           WHEN 3 THEN replace(text, 'idiot', '1d10t')
           ELSE text || ' I can''t. No! soooo KYS, black women: not so good idea'
         END AS text
  FROM documents)"""


def features_from(source: str) -> str:
    """CTEs ``parts`` and ``feats``: the plain features of ``source``."""
    flags = ",\n".join(
        f"CASE WHEN regexp_matches(plain, '\\b(?:{_alternation(t)})\\b') THEN 1 ELSE 0 END"
        f" AS identity_{c}"
        for c, t in DEFAULT.identity.items()
    )
    everyone = _alternation(DEFAULT.identity_terms())
    profanity = quoted(DEFAULT.profanity)
    return rf"""
parts AS (
  SELECT *, lower(text) AS low,
         list_filter(regexp_split_to_array(text, '[{SP}]+'), lambda w: w <> '') AS words,
         regexp_replace(lower(text), '[\x{{c0}}-\x{{24f}}\x{{370}}-\x{{1fff}}]', 'z', 'g') AS plain,
         list_filter(regexp_split_to_array(text, '[.!?]+'),
                     lambda s: regexp_matches(s, '[^{SP}]')) AS sents
  FROM {source}),
feats0 AS (
  SELECT *,
    len(text)::BIGINT AS char_count,
    len(words)::BIGINT AS word_count,
    (len(text) - len(replace(text, '!', '')))::BIGINT AS exclamation_count,
    len(list_filter(words, lambda w: len(w) > 1 AND regexp_matches(w, '\p{{Lu}}')
        AND NOT regexp_matches(w, '[\p{{Ll}}\p{{Lt}}]'))) AS n_upper,
    len(list_distinct(words)) AS n_distinct,
    len(list_filter(words, lambda w: len(list_filter(range(1, len(w) - 1),
        lambda i: lower(w)[i] = lower(w)[i + 1] AND lower(w)[i] = lower(w)[i + 2])) > 0))::BIGINT
      AS elongated_token_count,
    len(regexp_extract_all(text, '[^{W}{SP}]{{2,}}'))::BIGINT AS consecutive_punct_count,
    len(regexp_extract_all(low, '(?:https?://|www\.)[^{SP}]+'))::BIGINT AS url_count,
    len(regexp_extract_all(plain, '\b(?:{OCTET}\.){{3}}{OCTET}\b'))::BIGINT AS ip_count,
    len(list_filter(regexp_extract_all(low, '[{W}]+'),
        lambda t: t IN {quoted([t for t in DEFAULT.second_person if "'" not in t])}))::BIGINT
      AS second_person_count,
    len(list_filter(regexp_extract_all(low, '[{W}'']+'),
        lambda t: trim(t, '''') IN {profanity}))::BIGINT AS profanity_count,
    len(list_filter(words, lambda w:
        regexp_replace(translate(lower(w), '{LEET_FROM}', '{LEET_TO}'), '[^a-z]', '', 'g') IN {profanity}
        AND regexp_replace(lower(w), '[^a-z]', '', 'g') NOT IN {profanity}))::BIGINT
      AS obfuscated_profanity_count,
    len(list_filter(regexp_extract_all(low, '[{W}]+'), lambda t: t IN {quoted(DEFAULT.slang)}))::BIGINT
      AS slang_count,
    len(list_filter(regexp_extract_all(low, '[{W}]+(?:''[{W}]+)?'),
        lambda t: t IN {quoted(DEFAULT.negation)}))::BIGINT AS negation_count,
    len(sents)::BIGINT AS sentence_count,
    list_sum(list_transform(sents, lambda s:
        len(list_filter(regexp_split_to_array(s, '[{SP}]+'), lambda w: w <> '')))) AS n_sent_words,
    len(regexp_extract_all(plain, '\b(?:{everyone})\b'))::BIGINT AS identity_mention_count,
    {flags}
  FROM parts),
feats AS (
  SELECT *,
    CASE WHEN second_person_count > 0 THEN 1 ELSE 0 END AS has_second_person,
    round(second_person_count / greatest(word_count, 1), 6) AS second_person_density,
    CASE WHEN word_count = 0 THEN 0.0::DOUBLE ELSE n_upper / word_count END AS uppercase_ratio,
    CASE WHEN word_count = 0 THEN 0.0::DOUBLE ELSE n_distinct / word_count END AS unique_word_ratio,
    CASE WHEN url_count + ip_count > 0 THEN 1 ELSE 0 END AS has_url_or_ip,
    CASE WHEN sentence_count = 0 THEN 0.0::DOUBLE ELSE n_sent_words / sentence_count END
      AS avg_sentence_length
  FROM feats0)"""


FEATS = f"WITH {COMMENTS}, {features_from('comments')}"
LABELLED = (
    f"WITH {COMMENTS}, joined AS (SELECT c.*, l.toxic FROM comments c JOIN labels l USING (doc_id)),"
    f" {features_from('joined')}"
)


def logit() -> str:
    parts = [f"({MODEL.intercept})"]
    parts += [f"({c}) * (({f} - ({m})) / ({s}))" for f, (m, s, c) in MODEL.terms.items()]
    return " + ".join(parts)


SCORED = FEATS + f""",
toxic AS (SELECT *, round(1 / (1 + exp(-({logit()}))), 6) AS toxicity FROM feats),
scored AS (
  SELECT doc_id, md5(timestamp || '-' || author || '-' || text) AS id, article_id,
         CASE WHEN author = '' THEN 'unsigned' ELSE author END AS author, timestamp, text, toxicity,
         CASE WHEN toxicity >= {AUTO} THEN 'auto-ban' WHEN toxicity >= {MANUAL} THEN 'manual-review'
              ELSE 'none' END AS decision,
         toxicity >= {MANUAL} AS is_flagged,
         CASE WHEN doc_id % 3 = 0 THEN 0.0::DOUBLE ELSE (doc_id % 50) * 0.5::DOUBLE + 1.25::DOUBLE END
           AS inference_ms
  FROM toxic)"""

PREDICTED = LABELLED + f""",
preds AS (
  SELECT doc_id, toxic AS y_true, CASE WHEN s >= 0.5 THEN 1 ELSE 0 END AS y_pred, s AS y_score
  FROM (SELECT *, round(1 / (1 + exp(-({logit()}))), 6) AS s FROM feats))"""

LINES = """WITH lines AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_quantity, l_extendedprice,
         l_discount, l_tax, l_linenumber::DOUBLE AS l_linenumber FROM lineitem)"""
LINE_PREDS = """WITH preds AS (
  SELECT y_true, y_score, CASE WHEN y_score >= 0.5 THEN 1 ELSE 0 END AS y_pred
  FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y_true,
               round((l_extendedprice % 1000) / 2000 + l_discount * 4, 6) AS y_score
        FROM lineitem))"""

PLAIN = list(PLAIN_FEATURES)


def long_form(source: str, features, keep=("label",)) -> str:
    """UNION ALL of (keep..., feature, value) rows for every feature."""
    return " UNION ALL ".join(
        f"SELECT {', '.join(keep)}, '{f}' AS feature, {f}::DOUBLE AS value FROM {source}"
        for f in features
    )
