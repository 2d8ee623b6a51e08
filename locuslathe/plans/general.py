"""Queries of the general record-processing operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslathe.functions.clean import bare_chrom
from locuslathe.operators.dense_keys import aggregate_dense
from locuslathe.operators.periods import periods_and_gaps
from locuslathe.operators.raw_lines import judge_lines, rejected_lines, typed_rows


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def p1_key_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Every (chrom, std_type): calls, bases, extent and the best call."""
    r = _table(spark, sf, "sv_records")
    d = aggregate_dense(
        r,
        {"chrom": bare_chrom("chrom"), "std_type": F.col("std_type")},
        amount=F.abs(F.col("end_pos") - F.col("start_pos")) + 1,
        place=F.least("start_pos", "end_pos"),
        rank=(F.col("supporting_reads"), F.col("score")),
        record_id=F.col("record_id"),
    )
    return d.select(
        "chrom", "std_type", F.col("n").alias("n_calls"), F.col("total").alias("bases"),
        F.col("low").alias("first_start"), F.col("high").alias("last_start"), F.col("best_id").alias("best_record_id"),
    )


def p1_found(spark: SparkSession, sf: str, percent: int = 3) -> DataFrame:
    """The pairs that hold at least ``percent`` of all records; records without chromosome count among all."""
    total = _table(spark, sf, "sv_records").agg(F.count(F.lit(1)).alias("total")).scalar()  # from the files' footers
    d = p1_key_stats(spark, sf).where(F.col("n_calls") * 100 >= total * percent)
    return d.where("chrom is not null").select("chrom", "std_type")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Covered periods and the gaps between them, per run, chromosome and type."""
    r = _table(spark, sf, "sv_records").withColumn("bare", bare_chrom("chrom")).where("bare is not null")
    keys = {"run_id": F.col("run_id"), "chrom": F.col("bare"), "std_type": F.col("std_type")}
    return periods_and_gaps(r, keys, F.col("start_pos"), F.col("end_pos"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """The lines that fail to parse, with the first reason."""
    return rejected_lines(judge_lines(_table(spark, sf, "sv_raw_lines")))


def p5_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The lines that parse, typed."""
    return typed_rows(judge_lines(_table(spark, sf, "sv_raw_lines")))


QUERIES = {
    "p1_found": p1_found,
    "p1_key_stats": p1_key_stats,
    "p3_found": p3_found,
    "p5_found": p5_found,
    "p5_rows": p5_rows,
}

# lines taken apart by regular expressions, written without any constant of the operators
_LINES = r"""
  ln AS (SELECT line_id, file_kind AS kind, regexp_replace(coalesce(raw_line, ''), '\r\z', '') AS line FROM sv_raw_lines),
  fl AS (
    SELECT line_id, kind, NOT regexp_full_match(line, '(("([^"]|"")*"|[^"\t][^\t]*|)\t)*("([^"]|"")*"|[^"\t][^\t]*|)') AS bad,
           [CASE WHEN starts_with(x, '"') THEN replace(x[2:-2], '""', '"') ELSE x END
            FOR x IN regexp_extract_all(line || chr(9), '("(?:[^"]|"")*"|[^"\t][^\t]*|)\t', 1)] AS f
    FROM ln),
  nm AS (
    SELECT line_id, kind, bad, f, len(f) AS n, trim(f[2], ' \t') AS s, trim(f[3], ' \t') AS e,
           trim(CASE kind WHEN 'long' THEN f[6] WHEN 'short' THEN f[8] END, ' \t') AS l FROM fl),
  jd AS (
    SELECT line_id, kind, f, n, CASE
      WHEN bad THEN 'bad_quoting'
      WHEN NOT coalesce((kind = 'asm' AND n = 7) OR (kind = 'long' AND n IN (9, 11)) OR (kind = 'short' AND n IN (11, 13))
                        OR (kind = 'support' AND n = 5), false) THEN 'column_count'
      WHEN NOT {num_s} THEN 'invalid_start' WHEN NOT {num_e} THEN 'invalid_end'
      WHEN kind IN ('long', 'short') AND l NOT IN ('', '.', 'NA') AND NOT {num_l} THEN 'invalid_svlen' END AS reason FROM nm)"""


def _is_number_sql(x: str) -> str:
    pattern = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return f"(regexp_full_match({x}, '{pattern}') AND coalesce(isfinite(TRY_CAST({x} AS DOUBLE)), false))"


for _x in "sel":
    _LINES = _LINES.replace("{num_" + _x + "}", _is_number_sql(_x))


def _typed_sql() -> str:
    # column: place of the field per kind, and whether it is an integer (i), a decimal (d) or a text (t)
    columns = (
        ("chrom", "t", dict(asm=1, long=1, short=1, support=1)), ("start_pos", "i", dict(asm=2, long=2, short=2, support=2)),
        ("end_pos", "i", dict(asm=3, long=3, short=3, support=3)), ("svtype", "t", dict(asm=4, long=4, short=4, support=4)),
        ("info_svtype", "t", dict(asm=5, long=5, short=7)), ("start_mod", "i", dict(asm=6)), ("end_mod", "i", dict(asm=7)),
        ("svlen", "i", dict(long=6, short=8)), ("supporting_reads", "i", dict(long=7, short=9, support=5)),
        ("score", "d", dict(long=8, short=10)), ("supporting_methods", "t", dict(long=9)),
        ("coverage_before_100bp", "d", dict(long=10, short=12)), ("coverage_after_100bp", "d", dict(long=11, short=13)),
        ("chr2", "t", dict(short=5)), ("pos2", "i", dict(short=6)), ("rdcn", "i", dict(short=11)),
    )
    texts, values, lost = [], [], []
    for name, kind, places in columns:
        field = "CASE kind " + " ".join(f"WHEN '{k}' THEN f[{p}]" for k, p in places.items()) + " END"
        texts.append(f"{field} AS t_{name}" if kind == "t" else f"trim({field}, ' \t') AS t_{name}")
        number = f"CASE WHEN {_is_number_sql('t_' + name)} THEN CAST(t_{name} AS DOUBLE) END"
        if kind == "i":
            number = f"CAST(CASE WHEN abs({number}) < 9.2e18 THEN trunc({number}) END AS BIGINT)"
        values.append(f"t_{name} AS {name}" if kind == "t" else f"{number} AS {name}")
        if kind != "t":
            lost.append(f"CASE WHEN {name} IS NULL AND t_{name} NOT IN ('', '.', 'NA') THEN '{name}' END")
    return f"""WITH {_LINES}, tx AS (SELECT line_id, kind, {", ".join(texts)} FROM jd WHERE reason IS NULL),
        ty AS (SELECT *, {", ".join(values)} FROM tx)
        SELECT line_id, kind, {", ".join(n for n, *_ in columns)},
               nullif(array_to_string([x FOR x IN [{", ".join(lost)}] IF x IS NOT NULL], ','), '') AS nulled_fields FROM ty"""


SQL = {
    "p5_found": f"WITH {_LINES} SELECT line_id, reason FROM jd WHERE reason IS NOT NULL",
    "p5_rows": _typed_sql(),
    "p1_found": """
        SELECT chrom, std_type FROM (
          SELECT nullif(trim(chrom), '') AS chrom, std_type, count(*) AS n, sum(count(*)) OVER () AS total
          FROM sv_records GROUP BY ALL)
        WHERE chrom IS NOT NULL AND n * 100 >= 3 * total""",
    "p1_key_stats": """
        SELECT nullif(trim(chrom), '') AS chrom, std_type, count(*) AS n_calls,
               CAST(sum(abs(end_pos - start_pos) + 1) AS BIGINT) AS bases,
               min(CASE WHEN start_pos IS NULL THEN end_pos WHEN end_pos IS NULL THEN start_pos
                        ELSE least(start_pos, end_pos) END) AS first_start,
               max(CASE WHEN start_pos IS NULL THEN end_pos WHEN end_pos IS NULL THEN start_pos
                        ELSE least(start_pos, end_pos) END) AS last_start,
               first(record_id ORDER BY coalesce(supporting_reads, -1) DESC, coalesce(score, -1) DESC, record_id)
                 AS best_record_id
        FROM sv_records GROUP BY 1, 2""",
    "p3_found": """
        WITH r AS (
          SELECT run_id, nullif(trim(chrom), '') AS chrom, std_type,
                 least(start_pos, end_pos) AS s, greatest(start_pos, end_pos) AS e
          FROM sv_records WHERE nullif(trim(chrom), '') IS NOT NULL AND start_pos IS NOT NULL AND end_pos IS NOT NULL),
        m AS (
          SELECT *, max(e) OVER (PARTITION BY run_id, chrom, std_type ORDER BY s, e
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS covered FROM r),
        i AS (
          SELECT *, sum(CASE WHEN covered >= s - 1 THEN 0 ELSE 1 END) OVER (
                   PARTITION BY run_id, chrom, std_type ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m),
        p AS (SELECT run_id, chrom, std_type, min(s) AS s, max(e) AS e FROM i GROUP BY run_id, chrom, std_type, island),
        n AS (SELECT *, lead(s) OVER (PARTITION BY run_id, chrom, std_type ORDER BY s) AS nxt FROM p)
        SELECT run_id, chrom, std_type, 'period' AS span_kind, s AS span_start, e AS span_end FROM n
        UNION ALL SELECT run_id, chrom, std_type, 'gap', e + 1, nxt - 1 FROM n WHERE nxt IS NOT NULL""",
}
