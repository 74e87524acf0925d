"""Tolerant dates."""

import re

from pyspark.sql import functions as F

from ..constants import DATE_IN_NAME, RELEASE_DATE_FORMATS


def _shape(fmt):
    """Regex that any text of the format matches, built from its letter runs."""
    def run(match):
        text = match.group()
        if not text.isalpha():
            return re.escape(text)
        if text[0] in "MLE" and len(text) >= 3:
            return r"\p{L}+\.?"
        return rf"\d{{{len(text)}}}" if len(text) > 1 else r"\d{1,2}"

    return "^" + re.sub(r"([A-Za-z])\1*|[^A-Za-z]", run, fmt) + "$"


def parse_date(col, formats=RELEASE_DATE_FORMATS):
    """First format that reads the text wins; null if none does.

    The shape is tested first, because a failed parse costs far more than a failed match.
    """
    return F.coalesce(*[F.when(col.rlike(_shape(fmt)), F.try_to_date(col, fmt)) for fmt in formats])


def date_in_text(col, pattern=DATE_IN_NAME):
    """The first date found in a text such as a file name, or null."""
    return F.regexp_extract(col, pattern, 1).try_cast("date")
