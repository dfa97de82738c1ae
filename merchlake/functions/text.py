"""Text and calendar expressions shared by several operators."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchlake.model import MISSING_TOKENS

# Every character Python's str.strip() removes, from tab and blank to the ideographic space.
WHITESPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())

MOMENT_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Fixed value: the shape of a moment, with four-digit years from 0001 on.
_MOMENT_PATTERN = r"^(?!0000)\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
_LONGEST_TOKEN = max(map(len, MISSING_TOKENS))
_TOKEN_LIST = ", ".join(f"'{token}'" for token in MISSING_TOKENS)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def missing_as_null(name: str) -> Column:
    """A text column with NULL for the missing-value tokens.

    The length is compared first, being cheaper. Written as SQL text, the expression reaches
    the JVM in one call instead of one per token.
    """
    return F.expr(
        f"IF(octet_length(`{name}`) <= {_LONGEST_TOKEN} AND `{name}` IN ({_TOKEN_LIST}), NULL, `{name}`)"
    )


def is_moment(text: Column) -> Column:
    """True for a real calendar moment written as YYYY-MM-DD HH:MM:SS; never NULL.

    Only text of that shape is parsed, as a failed parse costs several times a good one.
    """
    parsed = text.rlike(_MOMENT_PATTERN) & text.try_cast("timestamp").isNotNull()
    return F.coalesce(parsed, F.lit(False))


def standard_moment(moment: Column) -> Column:
    """Any timestamp or timestamp text as YYYY-MM-DD HH:MM:SS; unreadable text raises."""
    return F.date_format(moment.cast("timestamp"), MOMENT_FORMAT)


def elapsed_days(earlier: Column, later: Column) -> Column:
    """Whole days of 24 hours between two moments, rounded down."""
    return F.floor((F.unix_seconds(later) - F.unix_seconds(earlier)) / 86400).cast("int")


def date_key(date: Column) -> Column:
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def rating_category(rating: Column) -> Column:
    return F.when(rating >= 4, "Positive").when(rating == 3, "Neutral").otherwise("Negative")
