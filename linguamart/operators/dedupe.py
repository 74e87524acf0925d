"""One row per key.

All of them filter a ``row_number`` to 1, which Spark plans as a group limit before the shuffle:
each map task sends at most one row per key, so a key with a third of all rows costs the same as
any other.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

_RANK = "__rank"
SCAN_ORDER = "__scan_order"


def with_scan_order(df):
    """Add the place of each row in its files. Use directly on a file scan."""
    return df.withColumn(
        SCAN_ORDER,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def best_per_key(df, keys, order):
    """The first row of each key by ``order``, which should leave no ties."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(spec)).where(F.col(_RANK) == 1).drop(_RANK)


def first_in_file(df, keys, best=None):
    """First row of each key in file order, or the one with the highest ``best`` and then file order.

    ``df`` carries the column of ``with_scan_order``.
    """
    order = [F.col(SCAN_ORDER)] if best is None else [F.desc_nulls_last(best), F.col(SCAN_ORDER)]
    return best_per_key(df, keys, order).drop(SCAN_ORDER)


def latest_per_key(df, keys, *order):
    """Newest row of each non-null key: every order column descending, nulls last."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return best_per_key(df, keys, [F.desc_nulls_last(c) for c in order])


def top_n_distinct(df, keys, order, n):
    """First ``n`` distinct keys in a total order."""
    return best_per_key(df, keys, order).orderBy(*order).limit(n)
