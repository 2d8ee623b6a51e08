"""Calls as they arrive: each micro-batch rebuilds the events of the runs that it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from locuslathe.operators.calls import clean_calls, good_calls
from locuslathe.operators.events import merge_events
from locuslathe.session import temporary_tables


def _folder(spark: SparkSession, store: str, run: str | None) -> str:
    """Where a run's partition lies."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{store}/run_id={escape(run) if run else '__HIVE_DEFAULT_PARTITION__'}"


def start_event_stream(
    spark: SparkSession, calls: DataFrame, store: str, out: str, checkpoint: str, tol: int = 10, once: bool = False
) -> StreamingQuery:
    """Starts a stream over raw calls (run_id, record_id, load_seq, source and the fields of call files).

    Good calls are kept in the Parquet table ``store``, partitioned by run, then batch; ``out`` gets the events of every
    run that a batch touches, replacing what it had of that run. Only the touched runs' folders are listed and read, and
    tables made on the way go with the batch. A batch that is repeated after a failure overwrites its own part of the
    store, so its calls count once.
    """

    def take(batch: DataFrame, number: int) -> None:
        good = good_calls(clean_calls(batch, F.col("source"), keep=("record_id", "run_id", "load_seq")))
        good = good.withColumn("batch", F.lit(number))
        good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch").parquet(store)
        # the runs of one batch; a folder of theirs may be missing if the batch had no good call of it
        touched = [_folder(spark, store, r["run_id"]) for r in good.select("run_id").distinct().collect()]
        if not touched:
            return
        # by its schema, as a run's name may look like a number
        kept = spark.read.schema(good.schema).option("basePath", store).parquet(*touched).drop("batch")
        with temporary_tables():
            events = merge_events(kept, ("run_id",), tol, F.col("load_seq"))
            events.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(out)

    writer = calls.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
