"""Sequence records (seq_idx, id, description, seq): statistics, edits, and what alignment hits say about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuslathe.functions.bases import gc_fraction, reverse_complement, strip_trailing_digits
from locuslathe.operators.prefix import prefix_sum, running_rank


def n50(df: DataFrame, by: tuple[str, ...] = (), length: str = "length") -> DataFrame:
    """(*by, n50): the length at which the longest sequences first cover half of all bases.

    Equal lengths are counted together before anything is ordered, so a group's window has a row per distinct length.
    Null lengths are left out; a group of empty sequences has 0.
    """
    c = df.where(F.col(length).isNotNull()).groupBy(*by, length).agg((F.count(F.lit(1)) * F.col(length)).alias("_bases"))
    down = Window.partitionBy(*by).orderBy(F.desc(length)).rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumns({"_cum": F.sum("_bases").over(down), "_all": F.sum("_bases").over(Window.partitionBy(*by))})
    return c.where("_cum * 2 >= _all").groupBy(*by).agg(F.max(length).alias("n50"))


def sequence_stats(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, num_sequences, total_size, longest_id, longest_length, gc_content, n50) of sequence records.

    The longest is the first on ties. Null sequences count as empty. With ``by`` empty an empty table gives one row of
    zeros, as the statistics of nothing.
    """
    d = df.withColumn("length", F.coalesce(F.length("seq"), F.lit(0)).cast("long"))
    gc = F.coalesce(gc_fraction(F.col("seq")), F.lit(0.0)) * F.col("length")
    s = d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_sequences"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_size"),
        F.max(F.struct("length", (-F.col("seq_idx")).alias("i"), "id")).alias("_top"),
        F.coalesce(F.sum(gc) / F.nullif(F.sum("length"), F.lit(0)) * 100, F.lit(0.0)).alias("gc_content"),
    )
    s = s.select(
        *by, "num_sequences", "total_size", F.col("_top.id").alias("longest_id"),
        F.coalesce("_top.length", F.lit(0)).alias("longest_length"), "gc_content",
    )
    half = n50(d, by)
    if by:
        half = half.select(*(F.col(b).alias(f"_b{i}") for i, b in enumerate(by)), "n50")
        on = [F.col(b).eqNullSafe(F.col(f"_b{i}")) for i, b in enumerate(by)]
        return s.join(half, on, "left").drop(*(f"_b{i}" for i in range(len(by)))).fillna(0, ["n50"])
    one = half.agg(F.coalesce(F.max("n50"), F.lit(0)).alias("n50"))
    return s.withColumn("_k", F.lit(1)).join(one.withColumn("_k", F.lit(1)), "_k").drop("_k")


def filter_min_length(df: DataFrame, least: int = 100) -> DataFrame:
    return df.where(F.length("seq") >= least)


def count_short(df: DataFrame, least: int = 100) -> DataFrame:
    """(removed): how many sequences ``filter_min_length`` leaves out."""
    return df.agg(F.count(F.when(F.coalesce(F.length("seq"), F.lit(0)) < least, 1)).alias("removed"))


def replace_id(df: DataFrame, name: str) -> DataFrame:
    """All ids become ``name``; the old ids become the descriptions."""
    return df.withColumns({"description": F.col("id"), "id": F.lit(name)})


def replace_id_incremental(df: DataFrame, prefix: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Ids become ``prefix`` for the first sequence of a group, then ``prefix1``, ``prefix2``, ... in file order."""
    d = running_rank(df, by, "seq_idx", "_rank")
    new = F.when(F.col("_rank") == 0, F.lit(prefix)).otherwise(F.concat(F.lit(prefix), F.col("_rank").cast("string")))
    return d.withColumns({"description": F.col("id"), "id": new}).drop("_rank")


def mark_main(df: DataFrame, by: tuple[str, ...] = (), longest: bool = True) -> DataFrame:
    """``df`` with ``is_main``: the longest sequence of each group (the first on ties), or just the first."""
    rank = F.struct(F.coalesce(F.length("seq"), F.lit(0)).alias("l"), (-F.col("seq_idx")).alias("i"))
    first = F.struct(F.lit(0).alias("l"), (-F.col("seq_idx")).alias("i"))
    top = df.groupBy(*by).agg((-F.max(rank if longest else first)["i"]).alias("_main"))
    top = top.select(*(F.col(b).alias(f"_b{i}") for i, b in enumerate(by)), "_main")
    on: list[Column] = [F.col(b).eqNullSafe(F.col(f"_b{i}")) for i, b in enumerate(by)]
    on.append(F.col("seq_idx") == F.col("_main"))
    d = df.join(top, on, "left")
    return d.withColumn("is_main", F.col("_main").isNotNull()).drop("_main", *(f"_b{i}" for i in range(len(by))))


def check_ids(df: DataFrame, allow_empty_id: bool = False, allow_empty_sequence: bool = False) -> DataFrame:
    """(seq_idx, level, message) for sequences without an id or of length 0."""
    no_id = (F.coalesce(F.col("id"), F.lit("")) == "") & F.lit(not allow_empty_id)
    no_seq = (F.coalesce(F.length("seq"), F.lit(0)) == 0) & F.lit(not allow_empty_sequence)
    issues = F.array_compact(
        F.array(
            F.when(no_id, F.format_string("Sequence at index %d has no ID", F.col("seq_idx"))),
            F.when(no_seq, F.format_string("Sequence '%s' has zero length", F.coalesce("id", F.lit("")))),
        )
    )
    return df.select("seq_idx", F.lit("ERROR").alias("level"), F.explode(issues).alias("message"))


def is_fragmented(df: DataFrame, by: tuple[str, ...] = (), limit: int = 5, organism: str = "prokaryote") -> DataFrame:
    """(*by, num_sequences, fragmented): more sequences than the limit, or a eukaryote."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("num_sequences")).withColumn(
        "fragmented", (F.col("num_sequences") > limit) | F.lit(organism == "eukaryote")
    )


def contig_offsets(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, seq_idx, seq_id, length, start): 1-based start of each sequence when all are written one after another."""
    d = df.select(*by, "seq_idx", F.col("id").alias("seq_id"), F.coalesce(F.length("seq"), F.lit(0)).cast("long").alias("length"))
    return prefix_sum(d, by, "seq_idx", F.col("length"), "start").withColumn("start", F.col("start") + 1)


def merge_contigs(df: DataFrame, by: tuple[str, ...], name: str = "merged") -> DataFrame:
    """One sequence per group, of all its sequences in order. The result is one text and so must fit in one row."""
    parts = F.array_sort(F.collect_list(F.struct("seq_idx", F.coalesce("seq", F.lit("")).alias("seq"))))
    return df.groupBy(*by).agg(parts.alias("_p")).select(
        *by, F.lit(0).cast("long").alias("seq_idx"), F.lit(name).alias("id"),
        F.array_join(F.transform("_p", lambda x: x["seq"]), "").alias("seq"),
    )


def best_hits(hits: DataFrame, query: str = "query", length: str = "block_len", line: str = "line_no", keep: tuple[str, ...] = ("ref", "strand")) -> DataFrame:
    """(query, *keep, length): per query the first line among those with the longest aligned block.

    Lines with a null query or length are left out. A query with a third of all lines is reduced before the shuffle.
    """
    top = F.max(F.struct(F.col(length), (-F.col(line)).alias("_l"), *keep)).alias("_m")
    d = hits.where(F.col(query).isNotNull() & F.col(length).isNotNull()).groupBy(query).agg(top)
    return d.select(query, *(F.col(f"_m.{k}").alias(k) for k in keep), F.col(f"_m.{length}").alias(length))


def split_by_hit(seqs: DataFrame, hits: DataFrame, query: str = "query") -> tuple[DataFrame, DataFrame]:
    """(contigs, plasmids): the sequences that have a hit, and those that have none. Null ids have none."""
    ids = hits.select(F.col(query).alias("id")).where("id is not null").distinct()
    return seqs.join(ids, "id", "left_semi"), seqs.join(ids, "id", "left_anti")


def orient_by_hit(seqs: DataFrame, best: DataFrame, query: str = "query") -> DataFrame:
    """Sequences whose best hit is on the minus strand are reverse-complemented and lose their description.

    ``contig_base`` is the id without trailing digits; sequences without a hit are left out.
    """
    h = best.select(F.col(query).alias("_q"), F.col("strand").alias("_s"), F.col("ref").alias("ref_id"))
    d = seqs.join(h, F.col("id") == F.col("_q"))
    minus = F.col("_s") == "-"
    return d.withColumns(
        {
            "seq": F.when(minus, reverse_complement(F.col("seq"))).otherwise(F.col("seq")),
            "description": F.when(minus, F.lit("")).otherwise(F.col("description")),
            "contig_base": strip_trailing_digits(F.col("id")),
        }
    ).drop("_q", "_s")
