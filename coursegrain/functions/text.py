"""Text clean-up, parsing and small text features."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of yes and no, compared after trim and lower.
TRUE_TOKENS = ("y", "yes", "true", "t", "1")
FALSE_TOKENS = ("n", "no", "false", "f", "0")


def tidy_spaces(value: Column, collapse: bool = True) -> Column:
    """Trim spaces; first turn every whitespace run into one space if asked."""
    return F.trim(F.regexp_replace(value, r"\s+", " ") if collapse else value)


def truth_value(
    value: Column,
    true_values: Iterable[str] | None = None,
    false_values: Iterable[str] | None = None,
) -> Column:
    """True, False, or NULL for text that is neither. True spellings win."""
    word = F.lower(F.trim(value))
    yes = [*TRUE_TOKENS, *(t.lower() for t in true_values or ())]
    no = [*FALSE_TOKENS, *(t.lower() for t in false_values or ())]
    return F.when(word.isin(yes), True).when(word.isin(no), False)


def parse_number(value: Column, output_type: str = "double") -> Column:
    """Keep digits, signs and dots, then cast; NULL if that is no number."""
    return F.regexp_replace(value, r"[^0-9+\-.]", "").try_cast(output_type)


def leading_word(*sources: Column, default: str = "UNKNOWN") -> Column:
    """Upper-cased run of three or more letters that opens the first source
    having one; ``default`` if none has."""
    runs = [
        F.nullif(F.regexp_extract(s, r"^([A-Za-z]{3,})", 1), F.lit("")) for s in sources
    ]
    return F.upper(F.coalesce(*runs, F.lit(default)))


def token_count(value: Column) -> Column:
    """Whitespace-separated tokens; NULL and blank text have none."""
    tokens = F.split(F.coalesce(value, F.lit("")), r"\s+")
    return F.size(F.array_remove(tokens, ""))


def has_keyword(value: Column, keyword: str) -> Column:
    """Case-insensitive containment; False for NULL."""
    return F.coalesce(F.contains(F.lower(value), F.lit(keyword.lower())), F.lit(False))


def title_label(value: Column) -> Column:
    return F.initcap(F.replace(value, F.lit("_"), F.lit(" ")))
