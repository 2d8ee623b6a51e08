"""Merging call tables from the command line: one CSV of events per type.

    python -m locuslathe.cli --asm a.tsv --long_ont o.tsv --long_pacbio p.tsv --short s.tsv --support '*_supporting_reads.tsv' --out DIR
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslathe.functions.intervals import format_percents
from locuslathe.functions.svtypes import std_type
from locuslathe.functions.convert import is_missing, to_int
from locuslathe.operators import calls as C
from locuslathe.operators import events as E
from locuslathe.operators import interval_join as J
from locuslathe.session import build_session, cut_lineage, temporary_tables
from locuslathe.sinks.files import write_audit, write_event_tables
from locuslathe.sources.tables import read_calls, read_support


def load_sources(spark: SparkSession, paths: dict[str, str | None]) -> DataFrame:
    """Every row of the given tables, cleaned, with record_id and seq in the order of sources and rows.

    A source without a table is an empty one.
    """
    out = None
    for rank, source in enumerate(E.SOURCES):
        if not paths.get(source):
            continue
        d = read_calls(spark, paths[source], source)
        d = d.withColumn("seq", F.col("seq") + F.lit(rank << 60)).withColumn("record_id", F.col("seq"))
        d = C.clean_calls(d, F.col("source"), keep=("record_id", "seq"))
        out = d if out is None else out.unionByName(d)
    if out is None:
        raise ValueError("no call table given")
    return out


def support_rows(spark: SparkSession, glob: str) -> DataFrame:
    s = read_support(spark, glob).where(~is_missing(F.col("chrom")))
    std = std_type(F.lit(None).cast("string"), F.col("svtype"), F.lit("long"))
    return s.select(F.trim("chrom").alias("chrom"), std.alias("std_type"), to_int(F.col("start")).alias("start1"), to_int(F.col("supporting_reads")).alias("supporting_reads"))


def merge_tables(spark: SparkSession, paths: dict[str, str | None], out: str, support: str | None = None, tol: int = 10, cross_type_tol: int = 0) -> DataFrame:
    """Writes the event tables and the audit of rejected and modified rows below ``out``; returns the events.

    Tables made on the way are removed, the events are checkpointed.
    """
    cleaned = cut_lineage(load_sources(spark, paths))
    audited = (F.col("reject_reason").isNotNull()) | (F.size("modifications") > 0)
    write_audit(cleaned.where(audited), f"{out}/audit")
    calls = C.good_calls(cleaned)
    if support:
        calls = J.resolve_support(calls, support_rows(spark, support), ("chrom", "std_type"), "record_id", "start1", tol)
    with temporary_tables():
        events = E.linked_lists(E.merge_events(calls, (), tol), (), cross_type_tol)
        events = events.withColumn("percentage_overlap", format_percents(F.col("step_percentages"))).drop("links", "step_percentages")
        events = cut_lineage(events)
    write_event_tables(events, out)
    return events


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    for s in E.SOURCES:
        p.add_argument(f"--{s}")
    p.add_argument("--support")
    p.add_argument("--out", required=True)
    p.add_argument("--tol", type=int, default=10)
    p.add_argument("--cross_type_tol", type=int, default=0)
    a = p.parse_args(args)
    merge_tables(build_session(), {s: getattr(a, s) for s in E.SOURCES}, a.out, a.support, a.tol, a.cross_type_tol)


if __name__ == "__main__":
    main()
