"""Delimited text as tokens."""

import re

from pyspark.sql import functions as F

from ..constants import DEFAULT_GENRE, GENRE_PRIORITY, UNKNOWN_PRIORITY
from .text import WS_INNER, strip_ws


def quoted(sep):
    return re.escape(sep)


def token_list(col, sep=",", drop_blank=False, lower=False):
    """Array of trimmed tokens; null stays null."""
    tokens = F.transform(F.split(col, quoted(sep)), lambda t: strip_ws(F.lower(t) if lower else t))
    return F.filter(tokens, lambda t: t != "") if drop_blank else tokens


def count_tokens(col, sep=","):
    """Number of tokens that are not blank; null counts 0. ``sep`` is one character."""
    if len(sep) != 1:
        raise ValueError("sep must be one character")
    stop = quoted(sep)
    found = F.regexp_count(col, F.lit(f"(?U)[^{stop}{WS_INNER}][^{stop}]*"))
    return F.coalesce(found, F.lit(0)).cast("long")


def pick_by_priority(col, priorities=GENRE_PRIORITY, sep=",", unknown=UNKNOWN_PRIORITY,
                     default=DEFAULT_GENRE):
    """The token with the lowest priority, ties by name, inside one row: no explode, no shuffle."""
    pairs = [F.lit(x) for item in priorities.items() for x in item]
    lookup = F.create_map(*pairs)
    ranked = F.transform(
        token_list(col, sep, drop_blank=True, lower=True),
        lambda t: F.struct(F.coalesce(F.try_element_at(lookup, t), F.lit(unknown)).alias("p"), t.alias("t")),
    )
    return F.coalesce(F.array_min(ranked)["t"], F.lit(default))
