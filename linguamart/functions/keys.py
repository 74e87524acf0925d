"""Surrogate keys."""

from pyspark.sql import functions as F


def surrogate_key(*parts, sep="|"):
    """md5 in hex over the parts; null if any part is null."""
    texts = []
    for i, part in enumerate(parts):
        if i:
            texts.append(F.lit(sep))
        texts.append(part.cast("string"))
    return F.md5(F.concat(*texts))
