"""Lexicon-and-rule sentiment, after the published VADER method.

The valence lexicon is an input (``term -> valence``).  A lexicon of ordinary
size is turned into hash-set lookups and the whole score is one narrow
projection: no explode, no join, no shuffle.  A larger one is joined instead
(see ``modlake.operators.sentiment``); both ways share the rules below.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from modlake.functions.text import SPACE, is_upper, words

# --- fixed values of the published method -----------------------------------
BOOST = 0.293
CAPS = 0.733
FLIP = -0.74
NORM_ALPHA = 15.0
NEGATIVE_CUT = -0.05

BOOSTERS_UP = (
    "absolutely", "amazingly", "awfully", "completely", "considerable",
    "considerably", "decidedly", "deeply", "effing", "enormous", "enormously",
    "entirely", "especially", "exceptional", "exceptionally", "extreme",
    "extremely", "fabulously", "flipping", "flippin", "frackin", "fracking",
    "fricking", "frickin", "frigging", "friggin", "fully", "fuckin",
    "fucking", "fuggin", "fugging", "greatly", "hella", "highly", "hugely",
    "incredible", "incredibly", "intensely", "major", "majorly", "more",
    "most", "particularly", "purely", "quite", "really", "remarkably", "so",
    "substantially", "thoroughly", "total", "totally", "tremendous",
    "tremendously", "uber", "unbelievably", "unusually", "utter", "utterly",
    "very",
)
BOOSTERS_DOWN = (
    "almost", "barely", "hardly", "just enough", "kind of", "kinda", "kindof",
    "kind-of", "less", "little", "marginal", "marginally", "occasional",
    "occasionally", "partly", "scarce", "scarcely", "slight", "slightly",
    "somewhat", "sort of", "sorta", "sortof", "sort-of",
)
NEGATORS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt",
    "ain't", "aren't", "can't", "couldn't", "daren't", "didn't", "doesn't",
    "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt",
    "neither", "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't",
    "mustn't", "neednt", "needn't", "never", "none", "nope", "nor", "not",
    "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt",
    "werent", "oughtn't", "shan't", "shouldn't", "uh-uh", "wasn't",
    "weren't", "without", "wont", "wouldnt", "won't", "wouldn't", "rarely",
    "seldom", "despite",
)
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5,
    "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5,
    "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
}
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# A small self-chosen lexicon for tests and checks; real runs pass their own.
SEED_LEXICON = {
    "good": 1.9, "great": 3.1, "nice": 1.8, "love": 3.2, "thanks": 1.9,
    "happy": 2.7, "best": 3.2, "fine": 0.8, "helpful": 1.8, "kind": 2.4,
    "bad": -2.5, "awful": -2.0, "hate": -2.7, "worst": -3.1, "sad": -2.1,
    "angry": -2.3, "idiot": -2.3, "stupid": -2.4, "trash": -1.9,
    "moron": -2.2, "loser": -2.4, "die": -2.9, "shit": -2.6, "no": -1.2,
    "ugly": -2.3, "heart": 2.4, "threat": -2.4, "liar": -2.3,
}


_PUNCT_CLASS = re.escape(PUNCTUATION)
_CORE = f"[^{_PUNCT_CLASS}{SPACE}][^{SPACE}]+[^{_PUNCT_CLASS}{SPACE}]"


def sentiment_tokens(text: Column) -> Column:
    """Words without surrounding punctuation, unless that leaves <= 2 chars."""
    bare = F.regexp_replace(
        text,
        f"(?<![^{SPACE}])[{_PUNCT_CLASS}]*+({_CORE})[{_PUNCT_CLASS}]*+(?![^{SPACE}])",
        "$1",
    )
    return words(bare)


def literal_lookup(lexicon: dict[str, float]) -> Callable[[Column], Column]:
    """token -> valence (NULL when unknown) by hash-set membership.

    Terms are grouped by valence, so a hit costs at most one probe per distinct
    valence and a miss exactly one probe.
    """
    by_valence: dict[float, list[str]] = {}
    for term, valence in lexicon.items():
        by_valence.setdefault(float(valence), []).append(term)
    known = sorted(lexicon)

    def look(token: Column) -> Column:
        pick = None
        for valence, terms in sorted(by_valence.items()):
            hit = token.isin(sorted(terms))
            value = F.lit(valence)
            pick = F.when(hit, value) if pick is None else pick.when(hit, value)
        return F.lit(None).cast("double") if pick is None else F.when(token.isin(known), pick)

    return look


def map_lookup(valences: Column) -> Callable[[Column], Column]:
    """token -> valence from a per-row map of that row's own known tokens."""
    return lambda token: F.try_element_at(valences, token)


def _boost_of(lowered: Column) -> Column:
    return (
        F.when(lowered.isin(list(BOOSTERS_UP)), F.lit(BOOST))
        .when(lowered.isin(list(BOOSTERS_DOWN)), F.lit(-BOOST))
        .otherwise(F.lit(0.0))
    )


def _idiom_value(phrase: Column) -> Column:
    pick = None
    for idiom, value in IDIOMS.items():
        hit = phrase == idiom
        pick = F.when(hit, F.lit(value)) if pick is None else pick.when(hit, F.lit(value))
    return pick


def hit_valences(tokens: Column, lows: Column, vals: Column, mixed_caps: Column) -> Column:
    """``(position, rule-adjusted valence)`` of every lexicon token.

    The rules look up to three words back, and only from lexicon tokens, so
    everything about a neighbour is worked out on demand.
    """
    last = F.size(lows) - 1

    def around(i: Column):
        def low(k):
            return F.coalesce(F.get(lows, i - k), F.lit(""))

        def loud(k):
            return mixed_caps & is_upper(F.coalesce(F.get(tokens, i - k), F.lit("")))

        def unknown(k):
            return F.get(vals, i - k).isNull()

        return low, loud, unknown

    def adjusted(i: Column) -> Column:
        low, loud, unknown = around(i)
        own = F.get(vals, i)
        lone_no = (low(0) == "no") & (i < last) & ~unknown(-1)
        after_no = (
            (low(1) == "no")
            | (low(2) == "no")
            | ((low(3) == "no") & low(1).isin("or", "nor"))
        )
        start = F.when(after_no, own * FLIP).when(lone_no, F.lit(0.0)).otherwise(own)
        value = _let(
            start,
            lambda v: F.when(loud(0), F.when(v > 0, v + CAPS).otherwise(v - CAPS)).otherwise(v),
        )
        for back, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
            value = _step(value, back, damp, low, loud, unknown, i, last)
        least = (low(1) == "least") & unknown(1) & ~low(2).isin("at", "very")
        return _let(value, lambda v: F.when(least, v * FLIP).otherwise(v))

    def silent(i: Column) -> Column:
        word, following = F.get(lows, i), F.coalesce(F.get(lows, i + 1), F.lit(""))
        return (_boost_of(word) != 0.0) | ((word == "kind") & (following == "of"))

    known = F.filter(
        F.transform(vals, lambda v, i: F.when(v.isNotNull(), i)), lambda i: i.isNotNull()
    )
    return F.transform(
        F.filter(known, lambda i: ~silent(i)),
        lambda i: F.struct(i.alias("pos"), adjusted(i).alias("val")),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _step(value, back, damp, low, loud, unknown, i, last):
    """Effect of the word ``back`` places before a lexicon token."""
    boost = _boost_of(low(back))
    negator = low(back).isin(list(NEGATORS)) | low(back).contains("n't")

    def apply(v: Column) -> Column:
        def weigh(b: Column) -> Column:
            signed = F.when(v < 0, -b).otherwise(b)
            shouted = F.when(v > 0, signed + CAPS).otherwise(signed - CAPS)
            return F.when((b != 0.0) & loud(back), shouted).otherwise(signed)

        return v + _let(boost, weigh) * damp

    def negate(v: Column) -> Column:
        flipped = F.when(negator, v * FLIP).otherwise(v)
        so_this = low(1).isin("so", "this")
        if back == 1:
            return flipped
        if back == 2:
            raised = (low(2) == "never") & so_this
            doubt = (low(2) == "without") & (low(1) == "doubt")
        else:
            raised = ((low(3) == "never") & low(2).isin("so", "this")) | so_this
            doubt = (low(3) == "without") & ((low(2) == "doubt") | (low(1) == "doubt"))
        return F.when(raised, v * 1.25).when(doubt, v).otherwise(flipped)

    def full(v: Column) -> Column:
        out = _let(apply(v), negate)
        if back == 3:
            out = _let(out, lambda w: _idioms(w, low, i, last))
        return out

    live = (i >= back) & unknown(back)
    return _let(value, lambda v: F.when(live, full(v)).otherwise(v))


def _idioms(value, low, i, last):
    def phrase(*backs):
        return F.concat_ws(" ", *[low(k) for k in backs])

    backward = [phrase(1, 0), phrase(2, 1, 0), phrase(2, 1), phrase(3, 2, 1), phrase(3, 2)]
    out = F.coalesce(*[_idiom_value(p) for p in backward], value)
    out = F.when(i < last, F.coalesce(_idiom_value(phrase(0, -1)), out)).otherwise(out)
    out = F.when(
        i + 1 < last, F.coalesce(_idiom_value(phrase(0, -1, -2)), out)
    ).otherwise(out)
    return out + sum(_boost_of(phrase(*b)) for b in ((3, 2, 1), (3, 2), (2, 1)))


def weigh_around_but(lows: Column, hits: Column) -> Column:
    """Halve what comes before the first "but", raise what follows it by half."""
    first_but = F.array_position(lows, "but") - 1
    return F.transform(
        hits,
        lambda h: F.when((first_but >= 0) & (h["pos"] < first_but), h["val"] * 0.5)
        .when((first_but >= 0) & (h["pos"] > first_but), h["val"] * 1.5)
        .otherwise(h["val"]),
    )


def punctuation_emphasis(text: Column) -> Column:
    bangs = F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))
    marks = F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))
    from_marks = (
        F.when(marks <= 1, F.lit(0.0)).when(marks <= 3, marks * 0.18).otherwise(F.lit(0.96))
    )
    return F.least(bangs, F.lit(4)) * 0.292 + from_marks


def array_total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
