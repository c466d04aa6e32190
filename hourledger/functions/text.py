"""Text functions on columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes. SQL TRIM removes spaces only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(column: Column) -> Column:
    """Both-sided trim of every kind of white space, not of blanks only."""
    return F.btrim(column, F.lit(WHITESPACE))


def email_key(column: Column) -> Column:
    """Case-insensitive join key of an email. Not trimmed: the std layer already is."""
    return F.lower(column)


def is_company_email(column: Column, domain: str) -> Column:
    """True for ``<word characters, dots, dashes>@<domain>`` after strip and lower."""
    pattern = rf"(?U)^[\w.\-]+@{re.escape(domain.lower())}$"
    return F.lower(strip(column)).rlike(pattern)


def missing_keywords(text: Column, keywords: list[str] | tuple[str, ...]) -> Column:
    """Array of the keywords that do not occur in the lower-cased text, in their given order."""
    wanted = F.array(*[F.lit(keyword) for keyword in keywords])
    lowered = F.lower(text)
    return F.filter(wanted, lambda keyword: ~F.contains(lowered, keyword))


def one_line(text: Column) -> Column:
    """Newlines replaced by blanks, for one record per line of CSV."""
    return F.replace(text, F.lit("\n"), F.lit(" "))


def without_breaks(column: Column) -> Column:
    """Each run of line breaks as one space, so that a record stays on one line."""
    return F.regexp_replace(column, r"[\r\n]+", " ")
