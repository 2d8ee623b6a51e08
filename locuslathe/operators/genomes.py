"""Consistency of a reference and a modified genome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare_sequences(ref: DataFrame, mod: DataFrame, id_col: str = "id", length: str = "length") -> DataFrame:
    """(id, status, ref_length, mod_length, difference) for the ids of either side.

    ``status``: ref_only, mod_only, length_missing (on one side), length_mismatch (difference = mod - ref), same.
    Ids must be unique per side; null ids are left out.
    """
    a = ref.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(length).alias("ref_length"), F.lit(True).alias("_r"))
    b = mod.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(length).alias("mod_length"), F.lit(True).alias("_m"))
    d = a.join(b, "id", "full")
    both = F.col("ref_length").isNotNull() & F.col("mod_length").isNotNull()
    status = (
        F.when(F.col("_m").isNull(), "ref_only")
        .when(F.col("_r").isNull(), "mod_only")
        .when(~both, "length_missing")
        .when(F.col("ref_length") != F.col("mod_length"), "length_mismatch")
        .otherwise("same")
    )
    return d.select("id", status.alias("status"), "ref_length", "mod_length", (F.col("mod_length") - F.col("ref_length")).alias("difference"))


def genome_check(compared: DataFrame, same_number: bool = True, same_ids: bool = False, same_lengths: bool = False) -> DataFrame:
    """(passed, n_ref, n_mod, common, ref_only, mod_only, length_mismatches): one row.

    The length check needs the id check. Which differences fail is up to the flags.
    """
    if same_lengths and not same_ids:
        raise ValueError("same_lengths requires same_ids")
    n = lambda *s: F.count(F.when(F.col("status").isin(*s), 1))
    d = compared.agg(
        n("ref_only", "same", "length_mismatch", "length_missing").alias("n_ref"),
        n("mod_only", "same", "length_mismatch", "length_missing").alias("n_mod"),
        n("same", "length_mismatch", "length_missing").alias("common"),
        n("ref_only").alias("ref_only"), n("mod_only").alias("mod_only"),
        n("length_mismatch").alias("length_mismatches"),
    )
    ok = F.lit(True)
    if same_number:
        ok = ok & (F.col("n_ref") == F.col("n_mod"))
    if same_ids:
        ok = ok & (F.col("ref_only") == 0) & (F.col("mod_only") == 0)
    if same_lengths:
        ok = ok & (F.col("length_mismatches") == 0)
    return d.select(ok.alias("passed"), *d.columns)
