"""Text normalisation, hashing, slugs and input validation.

All rules run as built-in Spark expressions. Unicode normalisation (NFKC for
dedup keys, NFKD accent stripping for word features) has no Spark built-in, so
it is one Arrow-batched pandas UDF that only receives non-ASCII rows; ASCII
rows are unchanged by both forms and skip the Python hop.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import config

# Python's Unicode whitespace, written for Java regex (Java's \s alone is ASCII).
WHITESPACE_JAVA = (
    "[\\s\\x1c-\\x1f\\u0085\\u00a0\\u1680\\u2000-\\u200a"
    "\\u2028\\u2029\\u202f\\u205f\\u3000]+"
)
#: The same set as code points, in order.
WHITESPACE_POINTS = (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                     0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
NON_ASCII = r"[^\x00-\x7F]"


@F.pandas_udf(StringType())
def _nfkc_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(StringType())
def _strip_accents_udf(texts: pd.Series) -> pd.Series:
    def strip(t):
        if t is None:
            return None
        decomposed = unicodedata.normalize("NFKD", t)
        return "".join(ch for ch in decomposed if not unicodedata.combining(ch))

    return texts.map(strip)


def nfkc(text: Column) -> Column:
    """NFKC normal form. The condition sits on the UDF input, so ASCII rows
    reach Python as nulls only."""
    return F.coalesce(_nfkc_udf(F.when(text.rlike(NON_ASCII), text)), text)


def strip_accents(text: Column) -> Column:
    """NFKD, then drop combining marks (the 'unicode' accent rule)."""
    return F.coalesce(_strip_accents_udf(F.when(text.rlike(NON_ASCII), text)), text)


def collapse_whitespace(text: Column) -> Column:
    """Runs of Unicode whitespace -> one space, then strip."""
    return F.trim(F.regexp_replace(text, WHITESPACE_JAVA, " "))


def normalize_text(text: Column) -> Column:
    """NFKC -> collapse whitespace -> strip -> lower (B1)."""
    return F.lower(collapse_whitespace(nfkc(text)))


def narrative_hash(text: Column) -> Column:
    """SHA-256 hex of the normalised text (B2)."""
    return F.sha2(normalize_text(text), 256)


def slug(value: Column) -> Column:
    """Lowercase, runs of non [a-z0-9] -> '-', strip '-' (B3)."""
    return F.trim(F.regexp_replace(F.lower(value), "[^a-z0-9]+", "-"), F.lit("-"))


def input_status(text: Column, min_chars: int = config.MIN_INPUT_CHARS,
                 max_chars: int = config.MAX_INPUT_CHARS) -> Column:
    """ok / not_text / too_short / too_long, never raising."""
    n = F.char_length(collapse_whitespace(text))
    return (
        F.when(text.isNull(), F.lit("not_text"))
        .when(n < min_chars, F.lit("too_short"))
        .when(n > max_chars, F.lit("too_long"))
        .otherwise(F.lit("ok"))
    )
