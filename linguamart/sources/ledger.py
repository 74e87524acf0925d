"""Which date each table was last processed for: a compare-and-set on numbered commits, one series per table."""

import datetime as dt
from urllib.parse import quote, unquote

from ..schemas import LEDGER
from .commits import LostRace, commit, newest

ANY = object()


def _day(value):
    return value if value is None or isinstance(value, dt.date) else dt.date.fromisoformat(value)


def _current(spark, ledger, table):
    version, entry = newest(spark, f"{ledger}/{quote(table, safe='')}")
    return version, _day(entry["day"]) if entry else None


def mark_processed(spark, ledger, table, day, expected=ANY, back=False):
    """Record ``day`` for ``table`` and return the day the ledger then holds. Call after the data is written.

    The ledger never goes back: an older day than the recorded one changes nothing, unless ``back`` is set. A run that
    has read the ledger before may name what it found as ``expected`` (None: no entry): if the entry is another one by
    now, LostRace is raised and nothing changes. Without it, a writer that comes second looks again and decides anew.
    """
    day, folder = _day(day), f"{ledger}/{quote(table, safe='')}"
    while True:
        version, current = _current(spark, ledger, table)
        if expected is not ANY and current != _day(expected):
            raise LostRace(f"{table} is at {current}, not at {expected}")
        if current is not None and (current == day or current > day and not back):
            return current
        try:
            commit(spark, folder, version + 1, {"table": table, "day": str(day)})
            return day
        except LostRace:
            if expected is not ANY:
                raise


def last_processed(spark, ledger, table):
    """Last recorded date, or None."""
    return _current(spark, ledger, table)[1]


def read_ledger(spark, ledger):
    """(processed_date, table_name) of every table in the ledger."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [unquote(status.getPath().getName()) for status in fs.listStatus(path)] if fs.exists(path) else []
    return spark.createDataFrame([(last_processed(spark, ledger, name), name) for name in sorted(names)], LEDGER)
