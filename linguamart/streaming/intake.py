"""Landed files into a daily table by Structured Streaming: every file is taken once, in the run after it came."""

from pyspark.sql import functions as F

from ..sources.files import DAY
from .incremental import KEYS, load_new_days, merge_rows, table_state


def intake(spark, landing, target, schema, checkpoint, transform=None, file_format="parquet", merge=False, keys=KEYS, day_col=DAY, id_col="appid", **options):
    """Take the files that have come to ``landing`` since the last run, load them into ``target``, and stop.

    The stream's checkpoint remembers which files were taken. All new files are one batch, so a day that came in
    several files is loaded whole; ``transform`` turns the batch's rows into those of the table. Days later than the table's newest are
    added, or, with ``merge``, rows are updated and added by ``keys``, whatever their day. The number of the batch is
    part of the table's commit: a batch that is run again after a crash, with the table already switched, is left out. Returns the
    number of batches that this run has loaded.
    """
    stream = spark.readStream.schema(schema).format(file_format).options(**options).load(landing)
    loaded = []

    def put(batch, number):
        done = table_state(spark, target, day_col)["notes"].get(f"intake {checkpoint}", -1)
        if number <= done:
            return
        rows = transform(batch) if transform else batch
        notes = lambda load: {f"intake {checkpoint}": number}
        if merge:
            merge_rows(rows, target, keys, day_col, id_col, notes)
        else:
            load_new_days(rows, target, day_col, id_col, notes)
        loaded.append(number)

    run = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return len(loaded)


def add_file_day(df, day_col=DAY):
    """The day of each row from its file's own folder, for files that were landed in day folders."""
    return df.withColumn(day_col, F.regexp_extract(F.col("_metadata.file_path"), rf"/{day_col}=([^/]*)/[^/]*$", 1).try_cast("date"))
