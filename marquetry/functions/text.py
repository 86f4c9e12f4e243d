"""Cleaning, counting and judging annotation sentences, and cleaning lists of query words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that count as white space, for regular expressions of Java and RE2 (a fixed value).
WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: A word: letters, digits, underscores, quotes and hyphens, with one of the first three at least.
WORD = r"['-]*[\p{L}\p{N}_][\p{L}\p{N}_'-]*"
#: Phrases that an annotation must not hold, in the order in which they are looked for (fixed values).
FORBIDDEN = [
    "reference image",
    "reference crop",
    "bounding box",
    "segmentation mask",
    "sim-to-real",
    "simulation video",
    "real video",
    "input frame",
]
MAX_WORDS, MAX_CHARACTERS = 56, 560
_EDGE = " ,.;:"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def clean_text(c: Column) -> Column:
    """NUL becomes a space, runs of white space one space, and the ends are trimmed."""
    return F.trim(F.regexp_replace(F.translate(c, "\0", " "), f"{WHITE}+", " "))


def normalize_prompt(c: Column) -> Column:
    """Cleaned, and ended by a full stop unless it ends a sentence already or is empty."""
    ended = lambda x: F.when((x == "") | F.substring(x, -1, 1).isin(".", "!", "?"), x).otherwise(F.concat(x, F.lit(".")))
    return _let(clean_text(c), ended)


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD))


def sentence_count(c: Column) -> Column:
    """Runs of terminal marks before white space or the end."""
    return F.regexp_count(c, F.lit(rf"[.!?]+(?={WHITE}|\z)"))


def casefold(c: Column) -> Column:
    return F.translate(F.lower(c), "ſ", "s")


def prompt_reason(normalized: Column) -> Column:
    """The first rule that a normalised sentence breaks; null if none."""
    return _let(normalized, _first_broken)


def _first_broken(text: Column) -> Column:
    phrases = F.filter(F.array(*map(F.lit, FORBIDDEN)), lambda p: F.contains(casefold(text), p))
    return (
        F.when(text == "", "empty")
        .when(F.length(text) > MAX_CHARACTERS, "characters")
        .when(word_count(text) > MAX_WORDS, "words")
        .when(sentence_count(text) != 1, "sentences")
        .otherwise(F.concat(F.lit("forbidden: "), F.try_element_at(phrases, F.lit(1))))
    )


def clean_query(c: Column) -> Column:
    """A detector query: white space collapsed, marks and spaces at its ends dropped."""
    return F.btrim(F.regexp_replace(c, f"{WHITE}+", " "), F.lit(_EDGE))


def unfenced(c: Column) -> Column:
    """The JSON inside a model's answer, without a Markdown fence around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), r"^```(?:json)?\s*", ""), r"\s*```$", ""))
