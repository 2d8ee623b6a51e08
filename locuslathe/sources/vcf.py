"""Field queries over variant call files: what a caller's record says, as a call table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The INFO key that holds the reads of support, by caller
SUPPORT_KEYS = {"cutesv": "RE", "debreak": "SUPPREAD", "sniffles": "SUPPORT"}


def parse_vcf(lines: DataFrame) -> DataFrame:
    """Records of (value): chrom, pos, id, ref, alt, qual, filter, info (map), sample (map of the first sample)."""
    f = F.split("value", "\t", -1)
    part = lambda i: F.get(f, F.lit(i))
    d = lines.where(~F.col("value").startswith("#") & (F.size(f) >= 8))
    info = F.map_from_entries(
        F.filter(
            F.transform(F.array_distinct(F.split(part(7), ";")), lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.when(x.contains("="), F.regexp_replace(x, "^[^=]*=", "")).otherwise(F.lit("")).alias("v"))),
            lambda x: (x["k"] != "") & (x["k"] != "."),
        )
    )
    formats = F.arrays_zip(F.split(part(8), ":").alias("k"), F.split(part(9), ":").alias("v"))
    return d.select(
        part(0).alias("chrom"), part(1).alias("pos"), part(2).alias("id"), part(3).alias("ref"), part(4).alias("alt"),
        part(5).alias("qual"), part(6).alias("filter"), info.alias("info"),
        F.when(F.size(f) >= 10, F.map_from_entries(F.filter(formats, lambda x: x["k"].isNotNull()))).alias("sample"),
    )


def read_vcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_vcf(spark.read.text(path))


def _info(key: str) -> Column:
    return F.coalesce(F.try_element_at("info", F.lit(key)), F.lit("."))


def assembly_calls(vcf: DataFrame) -> DataFrame:
    """chrom, start, end, svtype (ALT), info_svtype (ID), start_mod, end_mod; what a record lacks is ``.``."""
    return vcf.select(
        "chrom", F.col("pos").alias("start"), _info("END").alias("end"), F.col("alt").alias("svtype"),
        F.col("id").alias("info_svtype"), _info("StartB").alias("start_mod"), _info("EndB").alias("end_mod"),
    )


def short_calls(vcf: DataFrame) -> DataFrame:
    rdcn = F.coalesce(F.try_element_at("sample", F.lit("RDCN")), F.lit("."))
    return vcf.select(
        "chrom", F.col("pos").alias("start"), _info("END").alias("end"), _info("SVTYPE").alias("svtype"),
        _info("CHR2").alias("chr2"), _info("POS2").alias("pos2"), F.col("alt").alias("info_svtype"),
        _info("SVLEN").alias("svlen"), _info("PE").alias("supporting_reads"), F.col("qual").alias("score"), rdcn.alias("RDCN"),
    )


def long_calls(vcf: DataFrame) -> DataFrame:
    """Reads of support aren't in the merged file; they are ``.`` until ``resolve_support``."""
    return vcf.select(
        "chrom", F.col("pos").alias("start"), _info("END").alias("end"), _info("SVTYPE").alias("svtype"),
        F.col("id").alias("info_svtype"), _info("SVLEN").alias("svlen"), F.lit(".").alias("supporting_reads"),
        F.col("qual").alias("score"), _info("SUPP").alias("supporting_methods"),
    )


def support_calls(vcf: DataFrame, caller: str) -> DataFrame:
    key = SUPPORT_KEYS.get(caller.lower(), caller)
    return vcf.select(
        "chrom", F.col("pos").alias("start"), _info("END").alias("end"), _info("SVTYPE").alias("svtype"), _info(key).alias("supporting_reads")
    )


def concat_sorted(*vcfs: DataFrame) -> DataFrame:
    """All records in the order of chromosome and position."""
    out = vcfs[0]
    for v in vcfs[1:]:
        out = out.unionByName(v)
    return out.orderBy("chrom", F.col("pos").try_cast("long"))


def variant_stats(vcf: DataFrame) -> DataFrame:
    """(kind, n): records by kind (snp, indel, other) and transitions and transversions among the snps."""
    snp = (F.length("ref") == 1) & (F.length("alt") == 1) & F.col("alt").rlike("^[ACGTacgt]$")
    pair = F.upper(F.concat("ref", "alt"))
    kinds = F.array_compact(
        F.array(
            F.when(snp, "snp").when(F.col("alt").rlike("^[ACGTNacgtn,]+$"), "indel").otherwise("other"),
            F.when(snp, F.when(pair.isin("AG", "GA", "CT", "TC"), "transition").otherwise("transversion")),
        )
    )
    return vcf.select(F.explode(kinds).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
