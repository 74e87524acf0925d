"""The trend of the daily fact, kept up to date: a day's changes come from that day and one carried row per title."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..constants import EPOCH_DAY
from ..operators import best_per_key
from ..plans.insights import TREND_METRICS, trend_columns
from ..session import drop_stage, stage
from ..sources.files import DAY
from .incremental import table_state, write_load

CARRIED = "carried"


def read_carried(spark, target, state=None):
    """The last row of every title: what the next load starts from; None before the first one."""
    path = (state or table_state(spark, target))["notes"].get(CARRIED)
    return spark.read.parquet(f"{target}/{path}") if path else None


def update_trend(daily, target, metrics=TREND_METRICS, key="appid", day_col=DAY):
    """Add the days of ``daily`` that are later than the newest one in the trend table at ``target``.

    Only those days are read from ``daily``, and instead of the days before them the carried table, with the last row of each
    title so far. The new carried table is written beside the load, and one commit switches to both. A title that
    misses some days is compared with its last day before them. Older days are ignored, as in the daily fact; a
    metric that is new has no change on its first day.
    """
    spark = daily.sparkSession
    state = table_state(spark, target, day_col)
    mark = dt.date.fromisoformat(max(state["days"], default=EPOCH_DAY))
    columns = [key, day_col, *metrics]
    staged = stage(daily.where(F.col(day_col) > F.lit(mark)).select(*columns), "new-days")
    fresh = spark.read.schema(daily.select(*columns).schema).parquet(staged)
    before = read_carried(spark, target, state)
    rows = fresh.withColumn("__new", F.lit(True))
    if before is not None:
        known = before.select(*[c for c in columns if c in before.columns]).withColumn("__new", F.lit(False))
        rows = rows.unionByName(known, allowMissingColumns=True)
    spec = Window.partitionBy(key).orderBy(day_col)
    changes = rows.select("__new", *trend_columns(spec, metrics, key, day_col)).where("__new").drop("__new")
    folder = lambda load: f"_{CARRIED}/{load}"

    def carry(load):
        last = best_per_key(rows.select(*columns), [key], [F.desc(day_col)])
        last.write.parquet(f"{target}/{folder(load)}")

    write_load(changes, target, state, day_col, key, lambda load: {CARRIED: folder(load)}, carry)
    drop_stage(spark, staged)
