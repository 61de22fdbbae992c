"""Text expressions. All of them are plain ``Column -> Column`` functions."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubline.fixed import NULL_TOKENS

# Every code point a text strip removes, not only the space that trim() knows.
_CODE_POINTS = [chr(c) for c in range(sys.maxunicode + 1)]
WHITESPACE = "".join(c for c in _CODE_POINTS if c.isspace())

# Code points that fold to another one, and those that fold to several.
_FOLDED = {c: c.casefold() for c in _CODE_POINTS if c.casefold() != c and len(c.casefold()) == 1}
_EXPANDED = {c: c.casefold() for c in _CODE_POINTS if len(c.casefold()) > 1}
del _CODE_POINTS


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def null_tokens(text: Column, tokens: list[str] | None = None) -> Column:
    """NULL where the whole cell is one of the tokens that mean "no value"."""
    return F.when(~text.isin(NULL_TOKENS if tokens is None else tokens), text)


def clean_cell(text: Column) -> Column:
    """Newlines to spaces, strip, and the literal ``nan`` to NULL."""
    return F.nullif(strip(F.translate(text, "\n", " ")), F.lit("nan"))


def fold_case(text: Column) -> Column:
    """Full case folding (``ß`` becomes ``ss``), which lower() alone is not."""
    folded = F.translate(text, "".join(_FOLDED), "".join(_FOLDED.values()))
    expanded = F.array_join(
        F.transform(
            F.split(folded, "", -1),
            lambda char: F.coalesce(F.element_at(_expansions(), char), char),
        ),
        "",
    )
    return (
        F.when(~text.rlike(r"[^\x00-\x7F]"), F.lower(text))
        .when(folded.rlike(f"[{''.join(_EXPANDED)}]"), expanded)
        .otherwise(folded)
    )


def _expansions() -> Column:
    entries = ";".join(f"{char}={folded}" for char, folded in _EXPANDED.items())
    return F.str_to_map(F.lit(entries), F.lit(";"), F.lit("="))


def token_key(text: Column) -> Column:
    """Case-folded tokens in sorted order, joined by one space."""
    spaced = F.translate(fold_case(text), WHITESPACE, " " * len(WHITESPACE))
    tokens = F.filter(F.split(spaced, " ", -1), lambda token: token != "")
    return F.array_join(F.array_sort(tokens), " ")
