"""Projections and filters."""

from pyspark.sql import functions as F


def backfill_columns(df, schema):
    """Expected columns that are absent come in as typed nulls; order follows ``schema``, extras last."""
    have = set(df.columns)
    expected = [
        F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    names = set(schema.fieldNames())
    return df.select(*expected, *[c for c in df.columns if c not in names])


def drop_columns(df, *names):
    """Absent names are ignored."""
    return df.drop(*names)


def cast_columns(df, types, safe=()):
    """Casts in one projection. A bad value stops the job, except in ``safe`` columns: null there."""
    def one(name):
        if name not in types:
            return F.col(name)
        col = F.col(name)
        return (col.try_cast(types[name]) if name in safe else col.cast(types[name])).alias(name)

    return df.select(*[one(c) for c in df.columns])


def require_keys(df, *names):
    for name in names:
        df = df.where(F.col(name).isNotNull())
    return df


def flag_missing(df, col, out):
    return df.withColumn(out, F.col(col).isNull())


def fill_defaults(df, defaults):
    """``defaults`` maps a column to the value or column that replaces its nulls."""
    def one(name):
        if name not in defaults:
            return F.col(name)
        value = defaults[name]
        value = value if hasattr(value, "isNull") else F.lit(value)
        return F.coalesce(F.col(name), value).alias(name)

    return df.select(*[one(c) for c in df.columns])


def clip_columns(df, names, low=0):
    """Negative counters to ``low``; null stays null; absent names are ignored."""
    from ..functions import clip_low

    return df.withColumns({c: clip_low(F.col(c), low) for c in names if c in df.columns})


def recode(col, mapping):
    """Value by map, null where the map has none."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), col)


def exclude_value(df, col, value, ignore_case=False, drop_empty=False):
    """Rows whose ``col`` is ``value`` go. With ``ignore_case`` or ``drop_empty``, nulls go too."""
    c = F.col(col)
    if not ignore_case and not drop_empty:
        return df.where(~c.eqNullSafe(value))
    if drop_empty:
        df = df.where(c != "")
    return df.where(F.lower(c) != value.lower()) if ignore_case else df.where(c != value)


def preview(df, n=5):
    return df.limit(n)
