"""Text measures of phrases and descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
WORD = r"[A-Za-z0-9]+(?:[-'][A-Za-z0-9]+)?"
GENERIC_TERMS = ["event", "update", "issue", "problem", "alert", "incident", "thing", "something", "state"]
GENERIC_RELATIONS = ["related", "causes", "a causes b", "triggered", "leads to"]
PENALTIES = {"short": 0.12, "duplicate": 0.18, "generic": 0.10, "weak": 0.12, "description": 0.10}
ISSUES = {
    "short": "event mapping contains short phrases",
    "duplicate": "event mapping contains duplicate phrases",
    "generic": "event mapping contains generic phrases",
    "weak": "relation explanations are too short or generic",
    "description": "scenario description is too short",
}


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD))


def normalise(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")


def count_where(xs: Column, test) -> Column:
    return F.size(F.filter(xs, test))


def duplicates(xs: Column) -> Column:
    kept = F.filter(F.transform(xs, normalise), lambda x: x != "")
    return F.size(kept) - F.size(F.array_distinct(kept))


def is_generic_phrase(c: Column) -> Column:
    words = F.transform(F.regexp_extract_all(c, F.lit("([A-Za-z]+)"), 1), F.lower)
    return (F.size(words) > 0) & (F.size(F.array_except(words, F.array(*map(F.lit, GENERIC_TERMS)))) == 0)


def is_weak_relation(c: Column) -> Column:
    return (word_count(c) < 5) | normalise(c).isin(*GENERIC_RELATIONS)


def has_any(text: Column, aliases: list[str]) -> Column:
    return F.exists(F.array(*map(F.lit, aliases)), lambda a: F.contains(F.lower(text), a))
