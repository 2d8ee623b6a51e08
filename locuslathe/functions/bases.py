"""Column expressions over nucleotide texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Nucleotide codes and their complements (IUPAC)
CODES = "ACGTUMRWSYKVHDBNacgtumrwsykvhdbn"
COMPLEMENTS = "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, CODES, COMPLEMENTS))


def gc_fraction(seq: Column) -> Column:
    """G, C and S among the bases that are not ambiguous; 0 where there are none."""
    u = F.upper(seq)
    known = F.regexp_count(u, F.lit("[ACGTUSW]"))
    return F.when(known > 0, F.regexp_count(u, F.lit("[GCS]")) / known).otherwise(F.lit(0.0))


def invalid_characters(seq: Column) -> Column:
    """struct(n, characters): how many characters are no A, C, G, T or N, and which, sorted."""
    return F.struct(
        F.regexp_count(seq, F.lit("[^ATCGNatcgn]")).alias("n"),
        F.array_sort(F.array_distinct(F.regexp_extract_all(seq, F.lit("([^ATCGNatcgn])"), F.lit(1)))).alias("characters"),
    )


def strip_trailing_digits(name: Column) -> Column:
    return F.regexp_replace(name, "[0-9]+$", "")
