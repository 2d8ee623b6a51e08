"""Queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from locuslathe.plans.event_queries import _cascade_sql
from locuslathe.llm.components import cluster_links, link_groups
from locuslathe.llm.leaks import leaked_items, shared_runs
from locuslathe.llm.sentences import split_sentences
from locuslathe.llm.survivors import call_survivors
from locuslathe.llm.tokens import encode_corpus
from locuslathe.session import spread_scan


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return spread_scan(_table(spark, sf, "documents").select("doc_id", "text"))


def p2_survivors(spark: SparkSession, sf: str) -> DataFrame:
    """The surviving record of each group of repeated calls, with every bundle chosen."""
    return call_survivors(_table(spark, sf, "sv_records"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """The record that survives, per group of repeated calls."""
    return p2_survivors(spark, sf).select("record_id")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """The group of every linked record."""
    return link_groups(cluster_links(_table(spark, sf, "event_clusters")))


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The token ids of every document."""
    return encode_corpus(_texts(spark, sf))


def p6_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """The token ids of every document with each token's first byte."""
    return encode_corpus(_texts(spark, sf), offsets=True)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """The documents and the test items that they share a whole run with."""
    return shared_runs(_texts(spark, sf), _table(spark, sf, "eval_items"))


def p7_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Leaks with their tiles, rearranged passages included."""
    return leaked_items(_texts(spark, sf), _table(spark, sf, "eval_items"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every sentence of every document by its place."""
    return split_sentences(spread_scan(_table(spark, sf, "documents").select("doc_id", "text", "lang")), lang_col="lang")


QUERIES = {
    "p2_found": p2_found,
    "p2_survivors": p2_survivors,
    "p4_found": p4_found,
    "p6_ids": p6_ids,
    "p6_offsets": p6_offsets,
    "p7_found": p7_found,
    "p7_leaks": p7_leaks,
    "p8_found": p8_found,
}

# The trust of a record, then of its length and of its type, as comparable lists: more filled fields, reads, score, ...
_TRUST = """[coalesce(supporting_reads, -1), coalesce(score, -1), -coalesce(abs(svlen), -1), -coalesce(load_seq, 4611686018427387904),
             -coalesce(record_id, 4611686018427387904)]"""
_FREE = {
    "identity": ("record_id", "load_seq", "sample_id"), "evidence": ("supporting_reads", "score", "supporting_methods"),
    "partner": ("chr2", "pos2"), "modified": ("start_mod", "end_mod"),
    "coverage": ("coverage_before_100bp", "coverage_after_100bp", "copy_number"), "times": ("called_at", "loaded_at"),
}


def _filled(*columns: str) -> str:
    return " + ".join(f"CAST({c} IS NOT NULL AS DOUBLE)" for c in columns)


def _survivors_sql() -> str:
    """Every pair of a group's candidates for type and length is tried; the other bundles are each the best of the group."""
    g = "run_id, source, chrom, std_type, lo, hi"
    free = []
    for name, columns in _FREE.items():
        filled = "0" if name == "identity" else _filled(*columns)
        best = f"max_by(struct_pack({', '.join(f'{c} := {c}' for c in columns)}), list_prepend({filled}, {_TRUST}))"
        free.append(f"{best} AS {name}")
    picked = ", ".join(f"f.{name}.{c} AS {c}" for name, columns in _FREE.items() for c in columns)
    raw, info = _cascade_sql("NULL", "raw_svtype", "source"), _cascade_sql("NULL", "info_svtype", "''")
    return f"""WITH r AS (
          SELECT * EXCLUDE (chrom), nullif(trim(chrom), '') AS chrom, least(start_pos, end_pos) AS lo, greatest(start_pos, end_pos) AS hi,
                 coalesce({raw}, 'RPL') AS rs, CASE WHEN regexp_matches(info_svtype, '[A-Za-z]') THEN coalesce({info}, 'RPL') END AS fs,
                 CAST(sign(svlen) AS INTEGER) AS sg
          FROM sv_records WHERE nullif(trim(chrom), '') IS NOT NULL AND start_pos IS NOT NULL AND end_pos IS NOT NULL),
        f AS (SELECT {g}, count(*) AS n_records, {", ".join(free)} FROM r GROUP BY ALL HAVING count(*) > 1),
        c AS (
          SELECT {g}, rs, fs, sg, max({_TRUST}) AS t,
                 max(list_prepend({_filled("svlen")}, {_TRUST})) AS lt, max_by(svlen, list_prepend({_filled("svlen")}, {_TRUST})) AS svlen,
                 max(list_prepend({_filled("raw_svtype", "info_svtype")}, {_TRUST})) AS tt,
                 max_by(struct_pack(raw_svtype := raw_svtype, info_svtype := info_svtype),
                        list_prepend({_filled("raw_svtype", "info_svtype")}, {_TRUST})) AS ty
          FROM r GROUP BY ALL),
        k AS (
          SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY t DESC) AS i, dense_rank() OVER (PARTITION BY {g} ORDER BY lt) AS lr,
                 dense_rank() OVER (PARTITION BY {g} ORDER BY tt) AS tr FROM c),
        dr AS (SELECT {g}, rs, arg_min(sg, i) AS want FROM k WHERE sg IS NOT NULL GROUP BY ALL),
        df AS (SELECT {g}, fs, arg_min(sg, i) AS want FROM k WHERE sg IS NOT NULL AND fs IS NOT NULL GROUP BY ALL),
        pr AS (
          SELECT {", ".join("a." + x for x in g.split(", "))}, a.svlen, b.ty.raw_svtype AS raw_svtype, b.ty.info_svtype AS info_svtype,
                 row_number() OVER (PARTITION BY {", ".join("a." + x for x in g.split(", "))}
                   ORDER BY 3 * a.lr + 2 * b.tr DESC, CASE WHEN a.i = 1 AND b.i = 1 THEN 0 ELSE 1 END, a.lr DESC, a.i, b.tr DESC, b.i) AS best
          FROM k a JOIN k b ON {" AND ".join(f"a.{x} IS NOT DISTINCT FROM b.{x}" for x in g.split(", "))}
          LEFT JOIN dr ON {" AND ".join(f"b.{x} IS NOT DISTINCT FROM dr.{x}" for x in g.split(", "))} AND dr.rs = b.rs
          LEFT JOIN df ON {" AND ".join(f"b.{x} IS NOT DISTINCT FROM df.{x}" for x in g.split(", "))} AND df.fs = b.fs
          WHERE a.sg IS NULL OR ((dr.want IS NULL OR dr.want = a.sg) AND (b.fs IS NULL OR df.want IS NULL OR df.want = a.sg))
             OR (a.i = 1 AND b.i = 1))
        SELECT {", ".join("f." + x for x in g.split(", "))}, f.n_records, {picked}, p.svlen, p.raw_svtype, p.info_svtype
        FROM f JOIN pr p ON p.best = 1 AND {" AND ".join(f"f.{x} IS NOT DISTINCT FROM p.{x}" for x in g.split(", "))}"""


SQL = {
    "p2_survivors": _survivors_sql(),
    "p4_found": """
        WITH RECURSIVE st AS (
          SELECT unnest(members[:-2]) AS a, unnest(members[2:]) AS b, unnest(percentage_overlaps[:len(members) - 1]) AS p FROM event_clusters
          WHERE len(members) >= 2 AND percentage_overlaps IS NOT NULL),
        e AS (SELECT DISTINCT a, b FROM (SELECT a, b FROM st WHERE a <> b AND p IS NOT NULL UNION ALL SELECT b, a FROM st WHERE a <> b AND p IS NOT NULL)),
        r AS (SELECT a AS record_id, b AS o FROM e UNION SELECT r.record_id, e.b FROM r JOIN e ON e.a = r.o)
        SELECT record_id, min(o) AS group_id FROM r GROUP BY 1""",
    "p2_found": """
        WITH r AS (
          SELECT *, nullif(trim(chrom), '') AS c, least(start_pos, end_pos) AS lo, greatest(start_pos, end_pos) AS hi
          FROM sv_records
          WHERE nullif(trim(chrom), '') IS NOT NULL AND start_pos IS NOT NULL AND end_pos IS NOT NULL)
        SELECT record_id FROM (
          SELECT record_id, count(*) OVER (PARTITION BY run_id, source, c, std_type, lo, hi) AS n,
                 row_number() OVER (PARTITION BY run_id, source, c, std_type, lo, hi
                   ORDER BY coalesce(supporting_reads, -1) DESC, coalesce(score, -1) DESC,
                            coalesce(abs(svlen), -1), load_seq) AS k
          FROM r)
        WHERE n > 1 AND k = 1""",
}
