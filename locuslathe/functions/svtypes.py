"""Standard types of structural variants from the callers' spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings and their standard types, in the order in which they are tried.
NAMES = (
    ("INS", "INS"), ("DEL", "DEL"), ("DUP", "DUP"), ("DUP:TANDEM", "DUP"), ("DUP:INT", "DUP"), ("INV", "INV"),
    ("TRA", "TRA"), ("TRANS", "TRA"), ("BND", "TRA"), ("CTX", "TRA"), ("RPL", "RPL"), ("REPL", "RPL"), ("SUB", "RPL"),
    ("SNV", "RPL"),
)
# Prefixes that only assembly comparison writes.
ASSEMBLY_PREFIXES = (("CPG", "INS"), ("CPL", "DEL"), ("SYN", "RPL"))
DEFAULT = "RPL"


def type_resolution(info: Column, raw: Column, source: Column, strip_brackets: bool = False) -> Column:
    """struct(std_type, resolution): which standard type, and by which step of the cascade it was found.

    The info type decides if it is exactly a known name (trimmed, upper case); else the first known name contained in
    the raw type; else, for assembly calls, the raw type's prefix; else RPL (``fallback_default``). A null info or raw
    type decides nothing. ``strip_brackets`` lets ``<CPG>`` count as ``CPG``, which it doesn't otherwise.
    """
    key, u = F.upper(F.trim(info)), F.upper(raw)
    bare = F.regexp_replace(u, "^<|>$", "") if strip_brackets else u

    def found(std: str, how: str) -> Column:
        return F.struct(F.lit(std).alias("std_type"), F.lit(how).alias("resolution"))

    c = F.when(F.lit(False), found(DEFAULT, "fallback_default"))
    for std in dict.fromkeys(s for _, s in NAMES):
        c = c.when(key.isin(*(n for n, s in NAMES if s == std)), found(std, "info_svtype"))
    for name, std in NAMES:
        c = c.when(u.contains(name), found(std, "raw_svtype"))
    for prefix, std in ASSEMBLY_PREFIXES:
        c = c.when((source == "asm") & bare.startswith(prefix), found(std, "asm_prefix"))
    return c.otherwise(found(DEFAULT, "fallback_default"))


def std_type(info: Column, raw: Column, source: Column, strip_brackets: bool = False) -> Column:
    """The standard type alone; see ``type_resolution``."""
    return type_resolution(info, raw, source, strip_brackets)["std_type"]
