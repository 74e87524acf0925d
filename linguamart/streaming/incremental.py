"""Daily loads into a table partitioned by day, each switched in by one commit.

A load writes its days to a folder of its own, ``load=<id>/snapshot_date=<day>``, which no reader looks into yet. Then one
commit file, put in place by a rename, says which load each day comes from now and which columns the table has. A
reader takes the newest commit, so it sees all of a load or nothing of it, data and columns alike, and a load that is
lost on the way leaves the table as it was. The days a table holds stand in the commit, so the high-water mark costs no
scan; adding or removing a column rewrites nothing.
"""

import datetime as dt
import json
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..constants import EPOCH_DAY
from ..session import drop_stage, stage
from ..sources.commits import LostRace, commit, forget_before, newest
from ..sources.files import DAY, day_folders
from ..sources.sinks import write_days

KEYS = ("appid", DAY)
LOAD = "load"
_COMMITS = "_commits"


def table_state(spark, target, day_col=DAY):
    """What the newest commit says: version, fields, the load of each day (by its text), and notes of writers.

    A folder laid out by day that has no commit is taken as it is: its days have no load, and its columns are those of its newest day.
    """
    version, content = newest(spark, f"{target}/{_COMMITS}")
    if content is not None:
        return {"version": version, "fields": StructType.fromJson(json.loads(content["fields"])).fields, "days": content["days"], "notes": content["notes"]}
    days = {str(d): None for d in day_folders(spark, target, day_col)}
    fields = []
    if days:
        schema = spark.read.option("basePath", target).parquet(f"{target}/{day_col}={max(days)}").schema
        fields = [StructField(f.name, f.dataType, True, {"name": f.name, "live": True, "was": "", "place": i}) for i, f in enumerate(schema.fields)]
    return {"version": 0, "fields": fields, "days": days, "notes": {}}


def table_days(spark, target, day_col=DAY):
    """Sorted days of the table."""
    return sorted(dt.date.fromisoformat(d) for d in table_state(spark, target, day_col)["days"])


def high_water(spark, target, day_col=DAY):
    """Newest day in the table, or a day before all others."""
    days = table_days(spark, target, day_col)
    return days[-1] if days else dt.date.fromisoformat(EPOCH_DAY)


def _sync_columns(df, known):
    """Rename the columns of ``df`` to what they are stored as; returns it with the fields that the table then has.

    A column that is added again after its removal, or comes with another type, is stored under a name of its own, so
    that what older days hold under its first name is not taken for it. Of another type, it is cast where it is older.
    """
    taken, now = {f.name for f in known} | {LOAD}, []
    live = {f.metadata["name"]: f for f in known if f.metadata["live"]}
    for place, field in enumerate(df.schema.fields):
        old = live.get(field.name)
        if old is not None and old.dataType == field.dataType:
            stored, was = old.name, old.metadata["was"]
        else:
            names = (field.name if not k else f"{field.name}__{k}" for k in range(len(taken) + 1))
            stored, was = next(n for n in names if n not in taken), old.name if old is not None else ""
        now.append(StructField(stored, field.dataType, True, {"name": field.name, "live": True, "was": was, "place": place}))
    names = {f.name for f in now}
    gone = [StructField(f.name, f.dataType, True, {**f.metadata, "live": False}) for f in known if f.name not in names]
    return df.select(*[F.col(f"`{f.metadata['name']}`").alias(f.name) for f in now]), now + gone


def _folder(target, load):
    return f"{target}/{LOAD}={load}" if load else target


def _scan(spark, target, state, schema, day_col):
    """The table's files: one scan of all days of loads, beside one of the days that have none."""
    parts = []
    for has_load in (True, False):
        paths = [f"{_folder(target, load)}/{day_col}={day}" for day, load in sorted(state["days"].items()) if bool(load) == has_load]
        if paths:
            parts.append(spark.read.schema(schema).option("basePath", target).parquet(*paths).select(*[F.col(f"`{f.name}`") for f in schema]))
    return parts[0].union(parts[1]) if len(parts) > 1 else parts[0] if parts else spark.createDataFrame([], schema)


def read_table(spark, target, day_col=DAY, state=None):
    """The table with the columns of its last load; older days show null in newer columns."""
    state = state or table_state(spark, target, day_col)
    fields = state["fields"]
    data = _scan(spark, target, state, StructType([StructField(f.name, f.dataType) for f in fields]), day_col)
    kinds = {f.name: f for f in fields}

    def value(field):
        forms, was = [F.col(f"`{field.name}`")], field.metadata["was"]
        while was in kinds:
            forms.append(F.col(f"`{was}`").try_cast(field.dataType))
            was = kinds[was].metadata["was"]
        return F.coalesce(*forms) if len(forms) > 1 else forms[0]

    live = sorted((f for f in fields if f.metadata["live"]), key=lambda f: f.metadata["place"])
    return data.select(*[value(f).alias(f.metadata["name"]) for f in live])


def write_load(df, target, state, day_col=DAY, id_col="appid", notes=None, before_commit=None):
    """Write the days of ``df`` as a load of its own, then switch to it; ``state`` is the table that the load builds on.

    If another writer has been first, the load is switched in on top of that one, as long as it has left these days and the columns
    as they were; otherwise the load is dropped and LostRace raised. ``before_commit`` is called with the id of the load
    once its days are written.
    """
    spark = df.sparkSession
    renamed, fields = _sync_columns(df, state["fields"])
    load = f"v{state['version'] + 1:08d}-{uuid.uuid4().hex[:12]}"
    write_days(renamed, _folder(target, load), day_col, id_col)
    if before_commit:
        before_commit(load)
    written = {str(d): load for d in day_folders(spark, _folder(target, load), day_col)}
    now = state
    while True:
        content = {"fields": StructType(fields).json(), "days": {**now["days"], **written}, "notes": {**now["notes"], **(notes(load) if notes else {})}}
        try:
            return commit(spark, f"{target}/{_COMMITS}", now["version"] + 1, content)
        except LostRace:
            now = table_state(spark, target, day_col)
            if now["fields"] != state["fields"] or any(now["days"].get(d) != state["days"].get(d) for d in written) or now["notes"] != state["notes"]:
                drop_stage(spark, _folder(target, load))
                raise


def load_new_days(df, target, day_col=DAY, id_col="appid", notes=None):
    """Load only days later than the newest one in the table. The first load takes every day.

    A day already there is not changed, and a day older than the newest is left out.
    """
    state = table_state(df.sparkSession, target, day_col)
    mark = max(state["days"], default=EPOCH_DAY)
    write_load(df.where(F.col(day_col) > F.lit(dt.date.fromisoformat(mark))), target, state, day_col, id_col, notes)


def replace_days(df, target, dates, day_col=DAY, id_col="appid", notes=None):
    """Rebuild the listed days and touch no other: rerun and backfill. Repeating it changes nothing."""
    days = [d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in dates]
    write_load(df.where(F.col(day_col).isin(days)), target, table_state(df.sparkSession, target, day_col), day_col, id_col, notes)


def merge_rows(df, target, keys=KEYS, day_col=DAY, id_col="appid", notes=None):
    """Update rows whose key exists, add the others, keep the rest of each touched day. Null keys are equal to each other.

    New rows are written to the shared folder first, so that they are worked out once. The merged days go to a load of
    their own, so what is read is never what is written. Rows without a day are left out.
    """
    spark = df.sparkSession
    staged = stage(df.where(F.col(day_col).isNotNull()), "new-rows", [day_col])
    touched = day_folders(spark, staged, day_col)
    if not touched:
        return drop_stage(spark, staged)
    new = spark.read.schema(df.schema).parquet(staged).select(*df.columns)
    if new.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        raise ValueError(f"rows to merge repeat a key of {list(keys)}")
    state = table_state(spark, target, day_col)
    merged = new
    if any(str(d) in state["days"] for d in touched):
        old = read_table(spark, target, day_col, state).where(F.col(day_col).isin(touched))
        same = [old[k].eqNullSafe(new[k]) for k in keys]
        merged = old.join(new, same, "left_anti").unionByName(new, allowMissingColumns=True).select(*df.columns)
    write_load(merged, target, state, day_col, id_col, notes)
    drop_stage(spark, staged)


def load_days(df, target, dates=None, day_col=DAY, id_col="appid"):
    """New days only, or exactly the listed ones."""
    if dates:
        replace_days(df, target, dates, day_col, id_col)
    else:
        load_new_days(df, target, day_col, id_col)


def drop_unused(spark, target, day_col=DAY):
    """Remove what no reader of the newest commit needs: older commits, days that another load has replaced, loads that were lost.

    For times when no load is on its way and no reader holds an older state.
    """
    state = table_state(spark, target, day_col)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(f"{LOAD}="):
            own = {d for d, load in state["days"].items() if f"{LOAD}={load}" == name}
            unused = [f"{target}/{name}/{day_col}={d}" for d in day_folders(spark, f"{target}/{name}", day_col) if str(d) not in own]
            drop_stage(spark, *(unused if own else [f"{target}/{name}"]))
    replaced = [f"{target}/{day_col}={d}" for d in day_folders(spark, target, day_col) if state["days"].get(str(d), True)]
    drop_stage(spark, *replaced)
    forget_before(spark, f"{target}/{_COMMITS}", state["version"])
