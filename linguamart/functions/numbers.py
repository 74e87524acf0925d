"""Numbers out of text, guards against null and zero."""

from pyspark.sql import functions as F


def clean_price(col, decimal=".", keep_parentheses=False):
    """Price text to double: other characters dropped, unreadable or missing becomes 0.

    ``keep_parentheses`` leaves brackets in, so a bracketed amount is unreadable and becomes 0.
    """
    kept = r"\p{Nd}\-" + (r"\(\)" if keep_parentheses else "")
    digits = F.regexp_replace(col, f"[^{kept}{decimal}]", "")
    if decimal != ".":
        digits = F.replace(digits, F.lit(decimal), F.lit("."))
    return F.coalesce(digits.try_cast("double"), F.lit(0.0))


def clip_low(col, low=0):
    """Values under ``low`` become ``low``; null stays null."""
    return F.when(col < low, F.lit(low)).otherwise(col)


def count_or_zero(col):
    return F.coalesce(col, F.lit(0))


def add_counts(*cols):
    """Sum in which a missing part counts as 0."""
    total = count_or_zero(cols[0])
    for col in cols[1:]:
        total = total + count_or_zero(col)
    return total


def guarded_ratio(part, whole, digits=4):
    """part / whole rounded, null where whole is 0."""
    return F.when(whole != 0, F.round(part.cast("double") / whole, digits))


def to_long(col):
    """Integer or null."""
    return col.try_cast("long")


def whole_number(col, safe=True):
    """Text to long, also where a reader has written the number as a fraction such as 5.0.

    Unreadable text, and a number that no long can hold, is null if ``safe`` and stops the job otherwise.
    """
    number = F.round(col.try_cast("double") if safe else col.cast("double"))
    return F.coalesce(col.try_cast("long"), number.try_cast("long") if safe else number.cast("long"))
