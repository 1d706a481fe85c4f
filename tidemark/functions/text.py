"""Text expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Applied in this order, each match becomes one space.
CLEANING_PATTERNS = [
    r"<[^>]+>",
    r"http\S+",
    r"&\w+;",
    r"\s+",
]

# Fixed value: a word is a run of two or more letters, digits or underscores.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Fixed value: the punctuation removed before a text becomes an id sequence.
SEQUENCE_PUNCTUATION = r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~']"""


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(text: Column | str) -> Column:
    """Markup, links and named entities out, white space collapsed, lower case; NULL gives ''."""
    start = F.coalesce(_column(text), F.lit(""))
    spaced = reduce(lambda value, pattern: F.regexp_replace(value, pattern, " "), CLEANING_PATTERNS, start)
    return F.lower(F.trim(spaced))


def words(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_column(text)), F.lit(WORD_PATTERN), F.lit(0))


def unigrams_and_bigrams(tokens: Column) -> Column:
    pairs = F.when(
        F.size(tokens) > 1,
        F.zip_with(
            F.slice(tokens, 1, F.size(tokens) - 1),
            F.slice(tokens, 2, F.size(tokens) - 1),
            lambda left, right: F.concat_ws(" ", left, right),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(tokens, pairs)


def sequence_tokens(text: Column | str) -> Column:
    """Lower case, punctuation stripped, split on white space, without empty tokens."""
    bare = F.regexp_replace(F.lower(_column(text)), SEQUENCE_PUNCTUATION, "")
    return F.array_remove(F.split(bare, r"\s+"), "")
