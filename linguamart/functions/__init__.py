"""Column functions: every one takes and returns columns and stays inside the JVM."""

from .dates import date_in_text, parse_date
from .keys import surrogate_key
from .numbers import add_counts, clean_price, clip_low, count_or_zero, guarded_ratio, to_long, whole_number
from .text import (
    clean_language, first_nonempty, has_audio_mark, is_footnote, replace_codes, squeeze_ws,
    strip_audio_mark, strip_footnote, strip_ws, tidy_language,
)
from .tokens import count_tokens, pick_by_priority, quoted, token_list

__all__ = [
    "add_counts", "clean_language", "clean_price", "clip_low", "count_or_zero", "count_tokens",
    "date_in_text", "first_nonempty", "guarded_ratio", "has_audio_mark", "is_footnote", "parse_date",
    "pick_by_priority", "quoted", "replace_codes", "squeeze_ws", "strip_audio_mark", "strip_footnote",
    "strip_ws", "surrogate_key", "tidy_language", "to_long", "token_list", "whole_number",
]
