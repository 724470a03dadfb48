"""The one tokeniser used by indexing, search and evaluation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a regular expression calls blank.
BLANKS = " \t\n\r\f\v"
TOKEN_BREAK = r"[^\p{L}\p{N}]++"


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in reading order."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda t: t != "")


def token_line(text: Column) -> Column:
    """The same tokens as one string, a blank between each two, perhaps one at the ends."""
    return F.array_join(F.split(F.lower(text), TOKEN_BREAK), " ")


def words(text: Column) -> Column:
    """Runs of non-blank characters, unchanged."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def distinct_tokens(text: Column) -> Column:
    return F.array_distinct(tokens(text))


def adjacent_pairs(toks: Column) -> Column:
    """Distinct `a b` pairs of neighbouring tokens."""
    shifted = F.slice(toks, F.lit(2), F.greatest(F.size(toks) - 1, F.lit(0)))
    firsts = F.slice(toks, F.lit(1), F.greatest(F.size(toks) - 1, F.lit(0)))
    return F.array_distinct(F.zip_with(firsts, shifted, lambda a, b: F.concat_ws(" ", a, b)))


def padded(items: Column) -> Column:
    """Each item between blanks, ready to be looked up in a padded `token_line`."""
    return F.transform(items, lambda t: F.concat(F.lit(" "), t, F.lit(" ")))
