"""Whitespace, case and null rules for text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The whitespace the text rule folds.
_RUNS = r"[ \t\n\f\r]+"
_FOLDABLE = r"[\t\n\f\r]|  "

# Spellings the all-text CSV scan reads as NULL.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)


def fold_text(c: Column) -> Column:
    """Whitespace runs become one space, edges go, empty becomes NULL.

    Most values hold nothing to fold; a search decides whether they are rewritten.
    """
    folded = F.when(c.rlike(_FOLDABLE), F.regexp_replace(c, _RUNS, " ")).otherwise(c)
    return F.nullif(F.trim(folded), F.lit(""))


def fold_upper(c: Column) -> Column:
    return F.upper(fold_text(c))


def null_tokens_to_null(c: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Read null spellings as NULL; pass ``("",)`` to keep words such as ``NA``."""
    return F.when(~c.isin(*tokens), c)
