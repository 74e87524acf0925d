"""Delimited text to rows."""

from pyspark.sql import functions as F

from ..constants import DEFAULT_GENRE, UNKNOWN_PRIORITY
from ..functions import clean_language, has_audio_mark, is_footnote, quoted, strip_audio_mark, strip_footnote, strip_ws


def explode_tokens(df, col, out=None, sep=",", keep_null=False, drop_blank=False, keep_row=False):
    """One row per trimmed token.

    ``keep_null`` keeps a row whose text is null; ``drop_blank`` removes empty tokens;
    ``keep_row`` leaves one null token where none survive.
    """
    tokens = F.split(F.col(col), quoted(sep), -1)
    if drop_blank:
        tokens = F.filter(tokens, lambda t: strip_ws(t) != "")
    burst = F.explode_outer if keep_null or keep_row else F.explode
    rest = [c for c in df.columns if c not in (col, out or col)]
    return df.select(*rest, burst(tokens).alias("__token")).select(
        *rest, strip_ws(F.col("__token")).alias(out or col)
    )


def normalize_languages(df, keys, col="languages", strict_mark=False, ignore_footnote=False, dedupe=True):
    """Rows (keys, language, audio) from HTML language lists.

    ``strict_mark`` with ``dedupe=False`` is the notebook form: only the bold star counts, nothing
    but that mark is cleaned, repeated names stay, and a title without a list keeps one null row.
    """
    text = strip_footnote(F.col(col)) if ignore_footnote else F.col(col)

    def entry(raw):
        name = strip_audio_mark(raw) if strict_mark else clean_language(raw)
        return F.struct(name.alias("language"), has_audio_mark(raw, strict_mark).alias("audio"))

    # Names are cleaned and filtered inside the array: each token once, before it becomes a row.
    entries = F.transform(F.split(text, ",", -1), entry)
    if not dedupe:
        return df.select(*keys, F.inline_outer(entries))
    named = F.filter(entries, lambda e: (e["language"] != "") & ~is_footnote(e["language"]))
    return (
        df.select(*keys, F.inline(named))
        .groupBy(*keys, "language")
        .agg(F.bool_or("audio").alias("audio"))
    )


def primary_by_join(df, keys, col, seed, out="primary_genre", default=DEFAULT_GENRE, unknown=UNKNOWN_PRIORITY):
    """Token of lowest priority per key by joining a seed table (genre, priority).

    The form for seeds too large for ``pick_by_priority``; the aggregate combines before it shuffles.
    """
    lookup = seed.select(
        F.lower(strip_ws(F.col("genre").cast("string"))).alias("__token"),
        F.col("priority").cast("long").alias("__priority"),
    )
    tokens = explode_tokens(df.select(*keys, col), col, "__token", drop_blank=True, keep_row=True)
    tokens = tokens.withColumn("__token", F.lower("__token"))
    ranked = tokens.join(lookup, "__token", "left")
    best = F.min(
        F.when(
            F.col("__token").isNotNull(),
            F.struct(F.coalesce("__priority", F.lit(unknown).cast("long")).alias("p"), F.col("__token").alias("t")),
        )
    )
    return ranked.groupBy(*keys).agg(F.coalesce(best["t"], F.lit(default)).alias(out))
