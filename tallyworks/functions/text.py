"""Tokenising expressions.

Two tokenisers are kept apart. ``words`` cuts at anything that is not an ASCII
letter, digit, underscore or apostrophe. ``raw_tokens`` cuts at white space and
keeps each token's slot, so that distances between words can be measured.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyworks.functions.records import ColumnOrName, as_column


def words(line: ColumnOrName, case_sensitive: bool = False) -> Column:
    """Array of words; may hold empty strings at the ends."""
    line = as_column(line)
    return F.split(line if case_sensitive else F.lower(line), r"[^\w']+")


def raw_tokens(line: ColumnOrName) -> Column:
    """Array of white-space separated tokens; a leading blank gives an empty first token."""
    return F.split(as_column(line), r"\s+")


def letters_only(token: ColumnOrName) -> Column:
    """Strip everything but ASCII letters, then lowercase."""
    return F.lower(F.regexp_replace(as_column(token), "[^a-zA-Z]", ""))


def letter_slots(line: ColumnOrName) -> Column:
    """``letters_only`` of every raw token, one array slot per token.

    Cleaning the whole line at once costs one regex pass per line instead of
    one per token. White space is first brought down to single blanks, where it
    is not that already, and the split is on the single blank, so a token
    without letters keeps its (empty) slot.
    """
    line = as_column(line)
    odd_space = line.contains("  ")
    for blank in "\t\n\x0b\f\r":
        odd_space = odd_space | line.contains(blank)
    squeezed = F.when(odd_space, F.regexp_replace(line, r"\s+", " ")).otherwise(line)
    return F.split(F.lower(F.regexp_replace(squeezed, "[^a-zA-Z ]", "")), " ")


def letter_digit_tokens(line: ColumnOrName) -> Column:
    """Lowercased tokens with everything but ASCII letters and digits stripped; order kept, empties possible."""
    # Alnum, ASCII only, is one table look-up; Java tests the same class spelled as ranges fifteen times as slowly.
    return F.split(F.regexp_replace(F.lower(as_column(line)), r"[^\p{Alnum}\s]", ""), r"\s+")


def inverse_document_frequency(n_docs: Column, df: Column, mode: str = "integer") -> Column:
    """``ln(N / (df + 1))``.

    ``integer`` truncates the quotient before the logarithm (so every term found
    in more than half of the documents gets 0); ``real`` divides exactly. A
    truncated quotient of 0 gives minus infinity, as floating point logarithms do.
    """
    if mode == "real":
        return F.ln(n_docs.cast("double") / (df + F.lit(1)))
    if mode != "integer":
        raise ValueError(f"idf mode must be 'integer' or 'real', not {mode!r}")
    quotient = F.floor(n_docs.cast("double") / (df + F.lit(1)))
    return F.when(quotient == 0, F.lit(float("-inf"))).otherwise(F.ln(quotient.cast("double")))
