"""Loading structural-variant calls: which rows are valid, and how the valid ones are normalised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuslathe.functions.convert import is_missing, to_float, to_int
from locuslathe.functions.svtypes import type_resolution

#: Types whose length always is the distance of their ends.
SPAN_TYPES = ("DEL", "DUP", "INV", "RPL")
_TEXTS = ("chrom", "start", "end", "svtype", "info_svtype", "svlen", "supporting_reads", "score", "supporting_methods", "RDCN", "chr2", "pos2", "start_mod", "end_mod", "coverage_before_100bp", "coverage_after_100bp")
_MADE = ("reject_reason", "modifications", "start1", "end1", "std_type", "resolution", "raw_svtype", "copy_number")


def clean_calls(df: DataFrame, source: Column, keep: tuple[str, ...] = (), strip_brackets: bool = False) -> DataFrame:
    """Every row with its ``reject_reason`` (null if it is good), ``modifications`` and typed fields.

    ``df`` has the columns of the call files under their names there (start, end, svtype, RDCN, ...), as texts or
    typed; any but chrom, start, end and svtype may be absent and then read as null (``#chrom`` serves where chrom is
    missing). ``keep`` are further columns to carry.

    Rejected: ``missing_required_fields`` (no chrom or svtype), then ``invalid_coordinates`` (start or end no number).
    Modified, in this order: ``coordinates_swapped``, ``svtype_defaulted_to_rpl``, ``svlen_derived``,
    ``svlen_normalized_to_end_minus_start``. Fields that a source doesn't have are null whatever the row holds.
    """
    has = {c.lower(): c for c in df.columns}
    kinds = dict(df.dtypes)
    raw = {c: (F.col(f"`{has[c.lower()]}`") if c.lower() in has else F.lit(None)).cast("string") for c in _TEXTS}

    def whole(name: str) -> Column:
        """Columns that are integers already are spared the way through text."""
        typed = kinds.get(has.get(name.lower(), ""), "") in ("tinyint", "smallint", "int", "bigint")
        return F.col(f"`{has[name.lower()]}`").cast("long") if typed else to_int(raw[name])

    def decimal(name: str) -> Column:
        typed = kinds.get(has.get(name.lower(), ""), "") in ("float", "double")
        d = F.col(f"`{has[name.lower()]}`").cast("double") if typed else to_float(raw[name])
        return F.when(F.abs(d) < F.lit(float("inf")), d) if typed else d

    chrom = raw["chrom"]
    if "#chrom" in has:
        chrom = F.when(is_missing(chrom), F.col("`#chrom`").cast("string")).otherwise(chrom)
    d = df.select(
        *keep,
        source.alias("source"),
        F.when(~is_missing(chrom), F.trim(chrom)).alias("chrom"),
        F.when(~is_missing(raw["svtype"]), F.trim(raw["svtype"])).alias("raw_svtype"),
        F.when(~is_missing(raw["info_svtype"]), raw["info_svtype"]).alias("info_svtype"),
        whole("start").alias("_s"),
        whole("end").alias("_e"),
        F.abs(whole("svlen")).alias("_len"),
        whole("supporting_reads").alias("supporting_reads"),
        decimal("score").alias("score"),
        F.when(source.startswith("long") & ~is_missing(raw["supporting_methods"]), raw["supporting_methods"]).alias("supporting_methods"),
        F.when(source == "short", whole("RDCN")).alias("copy_number"),
        F.when((source == "short") & ~is_missing(raw["chr2"]), raw["chr2"]).alias("chr2"),
        F.when(source == "short", whole("pos2")).alias("pos2"),
        F.when(source == "asm", whole("start_mod")).alias("start_mod"),
        F.when(source == "asm", whole("end_mod")).alias("end_mod"),
        decimal("coverage_before_100bp").alias("coverage_before_100bp"),
        decimal("coverage_after_100bp").alias("coverage_after_100bp"),
    )
    d = d.withColumn(
        "reject_reason",
        F.when(F.col("chrom").isNull() | F.col("raw_svtype").isNull(), "missing_required_fields").when(
            F.col("_s").isNull() | F.col("_e").isNull(), "invalid_coordinates"
        ),
    )
    good = F.col("reject_reason").isNull()
    d = d.withColumns(
        {
            "start1": F.when(good, F.least("_s", "_e")),
            "end1": F.when(good, F.greatest("_s", "_e")),
            "_t": F.when(good, type_resolution(F.col("info_svtype"), F.col("raw_svtype"), F.col("source"), strip_brackets)),
        }
    ).withColumns({"std_type": F.col("_t.std_type"), "resolution": F.col("_t.resolution")})
    span, width = F.col("std_type").isin(*SPAN_TYPES), F.col("end1") - F.col("start1")
    svlen = F.when(span, width).when(F.col("std_type") == "TRA", F.coalesce("_len", F.lit(0))).otherwise(F.col("_len"))
    steps = (
        (F.col("_s") > F.col("_e"), "coordinates_swapped"),
        (F.col("resolution") == "fallback_default", "svtype_defaulted_to_rpl"),
        ((span | (F.col("std_type") == "TRA")) & F.col("_len").isNull(), "svlen_derived"),
        (span & (F.col("_len") != width), "svlen_normalized_to_end_minus_start"),
    )
    changes = F.array_compact(F.array(*(F.when(c, label) for c, label in steps)))
    return d.withColumns(
        {"svlen": F.when(good, svlen), "modifications": F.when(good, changes).otherwise(F.array().cast("array<string>"))}
    ).drop("_s", "_e", "_len", "_t")


def good_calls(cleaned: DataFrame) -> DataFrame:
    """The valid calls."""
    return cleaned.where("reject_reason is null").drop("reject_reason")


def rejected_calls(cleaned: DataFrame) -> DataFrame:
    return cleaned.where("reject_reason is not null")


def audit_counts(cleaned: DataFrame, by: tuple[str, ...] = ("source",)) -> DataFrame:
    """(*by, kind, reason, n): rows skipped and rows modified, by reason."""
    events = F.concat(
        F.array_compact(F.array(F.when(F.col("reject_reason").isNotNull(), F.struct(F.lit("skipped").alias("kind"), F.col("reject_reason").alias("reason"))))),
        F.transform("modifications", lambda m: F.struct(F.lit("modified").alias("kind"), m.alias("reason"))),
    )
    return cleaned.select(*by, F.inline(events)).groupBy(*by, "kind", "reason").agg(F.count(F.lit(1)).alias("n"))


def union_sources(*tables: tuple[str, DataFrame]) -> DataFrame:
    """All tables under one another with a ``source`` column; a column that one lacks is null there."""
    out = None
    for name, df in tables:
        own = df.withColumn("source", F.lit(name))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    if out is None:
        raise ValueError("no tables")
    return out


def route(df: DataFrame, tags: tuple[str, ...], tag: str = "source") -> dict[str, DataFrame]:
    """The rows of each tag by its name, without the tag; rows of other tags, or of none, are in no part."""
    return {t: df.where(F.col(tag) == t).drop(tag) for t in tags}
