"""Column expressions for text: tokens, counts and ratios.

Everything here is a built-in Spark expression, so a feature run is one narrow
projection.  Character classes are spelled out instead of using ``\\w``/``\\s``
because those differ between regex dialects (and between JDK versions).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from modlake.functions import lexicons

# Unicode white space as a text splitter sees it, including \x1c-\x1f.  Listed
# one by one up to \xa0 (a bit-set test); \p{Z} covers the rest.
SPACE = r" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\p{Z}"
WORD = r"\p{L}\p{N}_"
STARTS = f"(?<![{WORD}])"
ENDS = f"(?![{WORD}])"
EDGE = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"

OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def words(text: Column) -> Column:
    """White-space separated words as an array."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def folded(text: Column) -> Column:
    """Lower case for caseless matching.

    The three letters whose caseless partner is an ASCII letter but whose lower
    case is not are replaced first.
    """
    for letter, plain in (("\u0130", "i"), ("\u0131", "i"), ("\u017f", "s")):
        text = F.replace(text, F.lit(letter), F.lit(plain))
    return F.lower(text)


def term_alternation(terms) -> str:
    """Alternation over ``terms`` that keeps the first-listed-wins order.

    Terms are grouped by first character.  Terms with different first
    characters can never match at the same place, so grouping changes no result
    but lets the matcher skip a whole group on one comparison.  Spaces inside a
    term stand for any run of white space.
    """
    groups: dict[str, list[str]] = {}
    for term in terms:
        body = rf"[{SPACE}]+".join(re.escape(part) for part in term.split())
        head, tail = body[0], body[1:]
        groups.setdefault(head, []).append(tail)
    return "|".join(
        f"{head}(?:{'|'.join(tails)})" for head, tails in groups.items()
    )


def term_pattern(terms) -> str:
    """Whole-word pattern for a list of terms, to be run on folded text."""
    word_ended = all(t[-1].isalnum() or t[-1] == "_" for t in terms)
    end = ENDS if word_ended else EDGE
    return f"{STARTS}(?:{term_alternation(terms)}){end}"


def leet(token: Column) -> Column:
    """Undo look-alike spelling: map stand-ins to letters, keep only a-z."""
    mapped = F.translate(F.lower(token), lexicons.LEET_FROM, lexicons.LEET_TO)
    return F.regexp_replace(mapped, "[^a-z]", "")


def letters_only(token: Column) -> Column:
    return F.regexp_replace(F.lower(token), "[^a-z]", "")


def is_upper(token: Column) -> Column:
    """At least one cased character and no lower- or title-case one."""
    return token.rlike(r"\p{IsUppercase}") & ~token.rlike(r"[\p{IsLowercase}\p{Lt}]")


def profanity_count(lowered: Column, profanity) -> Column:
    """Listed words standing alone between word boundaries.

    A token is letters and inner apostrophes, so ``idiot's`` is another word;
    apostrophes around a word are quotes and do not matter.
    """
    listed = term_alternation(profanity)
    return count_matches(lowered, f"(?<![{WORD}'])'*(?:{listed})'*(?![{WORD}'])")


def slang_count(lowered: Column, slang) -> Column:
    return count_matches(lowered, term_pattern(slang))


def contraction_tokens(lowered: Column) -> Column:
    """Words, each with at most one ``'suffix``."""
    return F.regexp_extract_all(
        lowered, F.lit(f"[{WORD}]++(?:'[{WORD}]++)?"), F.lit(0)
    )


def count_in(tokens: Column, terms) -> Column:
    """How many tokens are in ``terms`` (a hash-set lookup per token)."""
    listed = sorted(set(terms))
    return F.size(F.filter(tokens, lambda t: t.isin(listed))).cast("long")


def obfuscated_count(text: Column, profanity) -> Column:
    """Words that are profanity only after undoing look-alike spelling.

    Only words holding at least one stand-in character can qualify, so only
    those are taken out of the text and checked.
    """
    listed = sorted(set(profanity))
    odd = re.escape(lexicons.LEET_FROM)
    candidates = F.regexp_extract_all(
        text,
        F.lit(f"(?<![^{SPACE}])[^{SPACE}{odd}]*+[{odd}][^{SPACE}]*+"),
        F.lit(0),
    )
    return F.size(
        F.filter(
            candidates,
            lambda w: leet(w).isin(listed) & ~letters_only(w).isin(listed),
        )
    ).cast("long")


def upper_word_count(text: Column, shortest: int = 2) -> Column:
    """Words of at least ``shortest`` characters with an upper-case letter and no lower- or title-case one."""
    rest = rf"[^{SPACE}\p{{IsLowercase}}\p{{Lt}}"
    return count_matches(
        text,
        rf"(?<![^{SPACE}]){rest}\p{{IsUppercase}}]*+\p{{IsUppercase}}{rest}]*+(?![^{SPACE}])"
        rf"(?<=[^{SPACE}]{{{shortest}}})",
    )


def elongated_count(text: Column) -> Column:
    """Words with one character three or more times in a row.

    The match runs from the repetition to the end of its word, so a word is
    counted once.
    """
    return count_matches(text, rf"(?iu)([^{SPACE}])\1{{2,}}[^{SPACE}]*+")


def punctuation_runs(text: Column) -> Column:
    return count_matches(text, f"[^{WORD}{SPACE}]{{2,}}")


def url_count(folded_text: Column) -> Column:
    return count_matches(folded_text, rf"(?:https?://|www\.)[^{SPACE}]++")


def ip_count(text: Column) -> Column:
    return count_matches(text, rf"(?<![{WORD}])(?:{OCTET}\.){{3}}{OCTET}(?![{WORD}])")


def exclamations(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))).cast("long")


def sentence_count(text: Column) -> Column:
    """Stretches between runs of ``.!?`` that hold a non-space character."""
    return count_matches(text, rf"[^.!?{SPACE}][^.!?]*+")


def sentence_words(text: Column) -> Column:
    """Words counted inside sentences (``.!?`` also end a word)."""
    return count_matches(text, rf"[^.!?{SPACE}]++")


def slugify(title: Column) -> Column:
    """Lower-case letters and digits, everything else folded into one dash."""
    dashed = F.regexp_replace(F.lower(title), r"[^\p{L}\p{N}]+", "-")
    return F.trim(dashed, F.lit("-"))
