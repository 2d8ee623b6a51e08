"""Run bookkeeping: task traces, reports, timings and the parameters that follow from validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trace_summary(trace: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, completed, failed, cached, aborted, total) task counts by status; aborted are all others, null too."""
    n = lambda s: F.count(F.when(F.col("status") == s, 1))
    d = trace.groupBy(*by).agg(
        n("COMPLETED").alias("completed"), n("FAILED").alias("failed"), n("CACHED").alias("cached"), F.count(F.lit(1)).alias("total"),
    )
    return d.withColumn("aborted", F.col("total") - F.col("completed") - F.col("failed") - F.col("cached"))


def failed_tasks(trace: DataFrame) -> DataFrame:
    """(name, exit) of the failed tasks."""
    return trace.where("status = 'FAILED'").select("name", "exit")


def timing_summary(timings: DataFrame) -> DataFrame:
    """(validator_type, files, total_seconds)."""
    return timings.groupBy("validator_type").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("elapsed_time"), F.lit(0.0)).alias("total_seconds")
    )


def report_summary(files: DataFrame) -> DataFrame:
    """(validator_type, files, plasmids, passed, failed) of validated files; a null ``passed`` counts as failed."""
    ok = F.coalesce(F.col("passed"), F.lit(False))
    return files.groupBy("validator_type").agg(
        F.count(F.lit(1)).alias("files"), F.count(F.when(F.coalesce(F.col("is_plasmid"), F.lit(False)), 1)).alias("plasmids"),
        F.count(F.when(ok, 1)).alias("passed"), F.count(F.when(~ok, 1)).alias("failed"),
    )


def run_flags(runs: DataFrame) -> DataFrame:
    """(platform, runs, contig_files): runs per platform that is switched on; null flags are off."""
    on = F.array_compact(
        F.array(*(F.when(F.coalesce(F.col(f"run_{p}"), F.lit(False)), F.lit(p)) for p in ("illumina", "nanopore", "pacbio")))
    )
    d = runs.select("contig_file_size", F.explode(on).alias("platform"))
    return d.groupBy("platform").agg(F.count(F.lit(1)).alias("runs"), F.coalesce(F.sum("contig_file_size"), F.lit(0)).alias("contig_files"))


def files_per_platform(files: DataFrame) -> DataFrame:
    """(ngs_type, input_format, files): the output files of each platform and format, sorted."""
    return files.groupBy("ngs_type", "input_format").agg(F.array_sort(F.collect_list("output_file")).alias("files"))
