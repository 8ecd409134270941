"""Lists kept as text, and free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the 32 letters kept in a description (the letter io is dropped), as a regex class.
CYRILLIC = "а-я"
LATIN = "a-z"


def int_list(text: Column) -> Column:
    """Array of numbers from text such as ``[3, 7]``."""
    return F.from_json(text, "array<bigint>")


def raw_list(text: Column) -> Column:
    """Elements between the brackets as they stand, blanks kept; null for an empty list."""
    inner = F.substring(text, F.lit(2), F.length(text) - 2)
    return F.when(inner != "", F.split(inner, ","))


def clean_text(text: Column, alphabet: str = CYRILLIC) -> Column:
    """Lower case, then only the letters of ``alphabet`` and blanks; null gives ''."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"[^ {alphabet}]", "")


def ids_text(ids: Column) -> Column:
    """Ids joined by a blank; null gives ''."""
    return F.coalesce(F.array_join(ids, " "), F.lit(""))


def without(ids: Column, *others: Column) -> Column:
    """Ids that occur in none of ``others``; a null list counts as empty."""
    empty = F.array().cast("array<bigint>")
    out = ids
    for other in others:
        out = F.array_except(out, F.coalesce(other, empty))
    return out
