"""Text cleaning for delimited and HTML language lists."""

from pyspark.sql import functions as F

from ..constants import AUDIO_FOOTNOTE, AUDIO_MARK, LANGUAGE_CODES, WHITESPACE

# The same set as WHITESPACE, in the form a regex engine tests fastest.
WS_INNER = r"\s\x1c-\x1f"
WS_CLASS = f"[{WS_INNER}]"

# Marks go first, then whatever other tag or star is left.
_MARKS = rf"(?U)<br{WS_CLASS}*/?>|<strong>\*</strong>"
_TAGS_AND_STARS = r"<[^>]+>|\*"
# Words with one plain space between them: nothing to trim or squeeze.
_PLAIN_WORDS = r"\A[!-~]++(?: [!-~]++)*+\z"
_FOOTNOTE = f"(?i){AUDIO_FOOTNOTE}"
_FOOTNOTE_WITH_MARK = rf"(?iU)(?:<br{WS_CLASS}*/?>)?{WS_CLASS}*<strong>\*</strong>{WS_CLASS}*{AUDIO_FOOTNOTE}"


def strip_ws(col):
    """Trim all white space of Unicode; the built-in trim knows only the plain space."""
    return F.btrim(col, F.lit(WHITESPACE))


def squeeze_ws(col):
    return F.regexp_replace(col, f"(?U){WS_CLASS}+", " ")


def replace_codes(col, codes=LANGUAGE_CODES):
    for code, name in codes.items():
        col = F.replace(col, F.lit(code), F.lit(name))
    return col


def has_audio_mark(col, strict=False):
    """True where the token is starred; ``strict`` asks for the bold star. Null counts as no."""
    mark = "<strong>*</strong>" if strict else "*"
    return F.coalesce(col.contains(mark), F.lit(False))


def strip_audio_mark(col):
    """Only the bold star goes, then the white space around."""
    return strip_ws(F.replace(col, F.lit("<strong>*</strong>"), F.lit("")))


def strip_footnote(col):
    """Drop the starred footnote from a whole list, so it cannot mark the last language."""
    return F.regexp_replace(col, _FOOTNOTE_WITH_MARK, "")


def clean_language(col):
    """HTML token to plain name."""
    plain = F.regexp_replace(F.regexp_replace(col, _MARKS, " "), _TAGS_AND_STARS, " ")
    full = strip_ws(squeeze_ws(F.regexp_replace(plain, _FOOTNOTE, "")))
    # Nearly all names have no mark but the bold star. Without any other tag, and too short for the footnote, stars and
    # white space are all that has to go; a literal is found at a fraction of the cost of a pattern, and so is a plain space.
    bare = F.replace(col, F.lit(AUDIO_MARK), F.lit(" "))
    name = F.trim(F.replace(bare, F.lit("*"), F.lit(" ")))
    return (
        F.when(bare.contains("<") | (F.length(bare) >= len(AUDIO_FOOTNOTE)), full)
        .when(name.rlike(_PLAIN_WORDS), name).otherwise(strip_ws(squeeze_ws(name)))
    )


def tidy_language(col):
    """Second pass on a cleaned name: left-over tags and footnote go without a space."""
    # Hardly any name still has them, and testing for them is cheaper than replacing.
    plain = F.when(col.contains("<"), F.regexp_replace(col, r"<[^>]+>", "")).otherwise(col)
    noted = F.lower(plain).contains(AUDIO_FOOTNOTE)
    return strip_ws(F.when(noted, F.regexp_replace(plain, _FOOTNOTE, "")).otherwise(plain))


def is_footnote(col):
    return F.lower(col) == AUDIO_FOOTNOTE


def first_nonempty(*cols):
    """First column that is neither null nor empty; the last one is taken as it is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols[:-1]], cols[-1])
