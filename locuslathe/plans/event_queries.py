"""Queries of the call, event and interval operators over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslathe.functions.intervals import format_percents
from locuslathe.functions.svtypes import type_resolution
from locuslathe.operators import calls as C
from locuslathe.operators import events as E
from locuslathe.operators import interval_join as J

RUN = ("run_id",)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    r = _table(spark, sf, "sv_records").withColumnsRenamed(
        {"start_pos": "start", "end_pos": "end", "raw_svtype": "svtype", "copy_number": "RDCN"}
    )
    return C.clean_calls(r.drop("std_type"), F.col("source"), keep=("record_id", "run_id", "load_seq"))


def _support(spark: SparkSession, sf: str) -> DataFrame:
    s = _table(spark, sf, "caller_support")
    std = type_resolution(F.lit(None).cast("string"), F.col("svtype"), F.lit("long"))["std_type"]
    return s.select(
        "run_id", F.trim("chrom").alias("chrom"), std.alias("std_type"), F.col("start_pos").alias("start1"), "supporting_reads"
    ).where("chrom is not null and chrom <> ''")


def _resolved(spark: SparkSession, sf: str, tol: int = 10) -> DataFrame:
    return J.resolve_support(
        C.good_calls(_cleaned(spark, sf)), _support(spark, sf), ("run_id", "chrom", "std_type"), "record_id", "start1", tol
    )


def sv_clean(spark: SparkSession, sf: str) -> DataFrame:
    return C.good_calls(_cleaned(spark, sf)).drop("modifications", "load_seq")


def sv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return C.rejected_calls(_cleaned(spark, sf)).select("record_id", "reject_reason")


def sv_audit_counts(spark: SparkSession, sf: str) -> DataFrame:
    return C.audit_counts(_cleaned(spark, sf))


def sv_support_totals(spark: SparkSession, sf: str) -> DataFrame:
    return J.support_totals(_support(spark, sf), ("run_id", "chrom", "std_type"), "start1", "supporting_reads")


def sv_resolved_support(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf).select("record_id", "source", "supporting_reads")


def sv_clusters(spark: SparkSession, sf: str) -> DataFrame:
    c = E.clusters(C.good_calls(_cleaned(spark, sf)), RUN, 10, F.col("load_seq"), steps=False)
    return c.select(
        "run_id", "chrom", "std_type", "cluster_start", "cluster_end", "n_members",
        (F.col("n_members") - 1).alias("n_steps"), F.round("percent_total", 4).alias("percent_total"),
    )


def sv_best_records(spark: SparkSession, sf: str) -> DataFrame:
    c = E.clusters(C.good_calls(_cleaned(spark, sf)), RUN, 10, F.col("load_seq"), steps=False)
    return c.select("run_id", "chrom", "std_type", "cluster_start", "cluster_end", *(F.col(f"{s}.rec.record_id").alias(f"{s}_record") for s in E.SOURCES))


def _events(spark: SparkSession, sf: str, steps: bool) -> DataFrame:
    return E.merge_events(_resolved(spark, sf), RUN, 10, F.col("load_seq"), steps, _cleaned(spark, sf))


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    return E.event_spans(E.clusters(_resolved(spark, sf), RUN, 10, F.col("load_seq"), steps=False), RUN)


def sv_events(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf, False)


def sv_links(spark: SparkSession, sf: str) -> DataFrame:
    return E.link_events(_spans(spark, sf), RUN, 0)


def sv_links_within_5(spark: SparkSession, sf: str) -> DataFrame:
    return E.link_events(_spans(spark, sf), RUN, 5).groupBy("run_id", "relation").agg(F.count(F.lit(1)).alias("n"))


def sv_event_report(spark: SparkSession, sf: str) -> DataFrame:
    """The result tables' rows with links and percentages as text."""
    d = E.linked_lists(_events(spark, sf, True), RUN, 0)
    return d.withColumn("percentage_overlap", format_percents(F.col("step_percentages"))).drop("links", "step_percentages")


def sv_flanks(spark: SparkSession, sf: str) -> DataFrame:
    return J.flanks(_table(spark, sf, "sv_records"), "record_id", "chrom", "start_pos", "end_pos")


def _depths(spark: SparkSession, sf: str) -> DataFrame:
    calls = C.good_calls(_cleaned(spark, sf))
    regions = J.flanks(calls, "record_id", "chrom", "start1", "end1", keep=RUN)
    a = _table(spark, sf, "caller_support").where("end_pos >= start_pos")
    a = a.select("run_id", F.trim("chrom").alias("chrom"), (F.col("start_pos") - 1).alias("a_beg0"), F.col("end_pos").alias("a_end0"), F.coalesce("supporting_reads", F.lit(0)).alias("flag"))
    return J.region_depth(regions, a, (*RUN, "chrom"), ("row_id", "side"))


def sv_flank_depth(spark: SparkSession, sf: str) -> DataFrame:
    return _depths(spark, sf).select("row_id", "side", F.round("depth", 4).alias("depth"))


def sv_flank_coverage(spark: SparkSession, sf: str) -> DataFrame:
    calls = C.good_calls(_cleaned(spark, sf)).select("record_id", "run_id")
    d = J.with_flank_coverage(calls, "record_id", _depths(spark, sf))
    return d.select("record_id", *(F.round(c, 4).alias(c) for c in ("coverage_before_100bp", "coverage_after_100bp")))


def sv_caller_merge(spark: SparkSession, sf: str) -> DataFrame:
    s = _table(spark, sf, "caller_support").where("end_pos is not null")
    std = type_resolution(F.lit(None).cast("string"), F.col("svtype"), F.lit("long"))["std_type"]
    d = s.select(
        "run_id", F.trim("chrom").alias("chrom"), std.alias("std_type"), F.least("start_pos", "end_pos").alias("start1"),
        F.greatest("start_pos", "end_pos").alias("end1"), "caller", F.lit(None).cast("long").alias("svlen"),
    )
    return J.merge_call_sets(d, RUN, "caller").withColumn("n_callers", F.col("n_callers").cast("long"))


QUERIES = {
    f.__name__: f
    for f in (
        sv_clean, sv_rejects, sv_audit_counts, sv_support_totals, sv_resolved_support, sv_clusters, sv_best_records,
        sv_events, sv_links, sv_links_within_5, sv_event_report, sv_flanks, sv_flank_depth, sv_flank_coverage,
        sv_caller_merge,
    )
}


# the cascade written out, without the operators' tables
_EXACT = """CASE WHEN {i} = 'INS' THEN 'INS' WHEN {i} = 'DEL' THEN 'DEL' WHEN {i} IN ('DUP', 'DUP:TANDEM', 'DUP:INT') THEN 'DUP'
    WHEN {i} = 'INV' THEN 'INV' WHEN {i} IN ('TRA', 'TRANS', 'BND', 'CTX') THEN 'TRA' WHEN {i} IN ('RPL', 'REPL', 'SUB', 'SNV') THEN 'RPL' END"""
_WITHIN = """CASE WHEN {r} LIKE '%INS%' THEN 'INS' WHEN {r} LIKE '%DEL%' THEN 'DEL' WHEN {r} LIKE '%DUP%' THEN 'DUP' WHEN {r} LIKE '%INV%' THEN 'INV'
    WHEN {r} LIKE '%TRA%' OR {r} LIKE '%BND%' OR {r} LIKE '%CTX%' THEN 'TRA'
    WHEN {r} LIKE '%RPL%' OR {r} LIKE '%REPL%' OR {r} LIKE '%SUB%' OR {r} LIKE '%SNV%' THEN 'RPL' END"""
_PREFIX = "CASE WHEN {s} = 'asm' THEN CASE WHEN {r} LIKE 'CPG%' THEN 'INS' WHEN {r} LIKE 'CPL%' THEN 'DEL' WHEN {r} LIKE 'SYN%' THEN 'RPL' END END"


def _steps_sql(info: str, raw: str, source: str) -> list[str]:
    i, r = f"upper(trim({info}))", f"upper(trim({raw}))"
    return [_EXACT.replace("{i}", i), _WITHIN.replace("{r}", r), _PREFIX.replace("{s}", source).replace("{r}", r)]


def _cascade_sql(info: str, raw: str, source: str) -> str:
    return f"coalesce({', '.join(_steps_sql(info, raw, source))})"


_STD = _cascade_sql("info_svtype", "raw_svtype", "source")
_HOW = _steps_sql("info_svtype", "raw_svtype", "source")
_NA = "('', 'NA', 'N/A', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null', '<NA>', '#N/A', '#NA')"
_CLEAN = f"""
  raw AS (
    SELECT record_id, run_id, load_seq, source,
           CASE WHEN trim(chrom) NOT IN {_NA} THEN trim(chrom) END AS chrom, trim(raw_svtype) AS raw_svtype,
           info_svtype, start_pos, end_pos, abs(svlen) AS len, supporting_reads, score,
           CASE WHEN starts_with(source, 'long') THEN supporting_methods END AS supporting_methods,
           CASE WHEN source = 'short' THEN copy_number END AS copy_number,
           CASE WHEN source = 'short' THEN chr2 END AS chr2, CASE WHEN source = 'short' THEN pos2 END AS pos2,
           CASE WHEN source = 'asm' THEN start_mod END AS start_mod,
           CASE WHEN source = 'asm' THEN end_mod END AS end_mod,
           coverage_before_100bp, coverage_after_100bp,
           coalesce({_STD}, 'RPL') AS std_type, ({_STD}) IS NULL AS defaulted
    FROM sv_records),
  cl AS (
    SELECT * EXCLUDE (start_pos, end_pos, len, defaulted), least(start_pos, end_pos) AS start1, greatest(start_pos, end_pos) AS end1,
           CASE WHEN std_type IN ('DEL', 'DUP', 'INV', 'RPL') THEN abs(end_pos - start_pos)
                WHEN std_type = 'TRA' THEN coalesce(len, 0) ELSE len END AS svlen
    FROM raw WHERE chrom IS NOT NULL AND start_pos IS NOT NULL AND end_pos IS NOT NULL)"""
_SUP = f"""
  sup AS (
    SELECT run_id, chrom, std_type, start1, CAST(sum(coalesce(supporting_reads, 0)) AS BIGINT) AS reads FROM (
      SELECT run_id, trim(chrom) AS chrom, coalesce({_cascade_sql("NULL", "svtype", "'long'")}, 'RPL') AS std_type,
             start_pos AS start1, supporting_reads
      FROM caller_support WHERE trim(chrom) <> '')
    WHERE start1 IS NOT NULL GROUP BY 1, 2, 3, 4)"""
_RES = """
  near AS (
    SELECT c.record_id, s.reads,
           row_number() OVER (PARTITION BY c.record_id ORDER BY abs(c.start1 - s.start1), s.start1) AS k
    FROM cl c JOIN sup s ON c.run_id = s.run_id AND c.chrom = s.chrom AND c.std_type = s.std_type
      AND s.start1 BETWEEN c.start1 - 10 AND c.start1 + 10
    WHERE starts_with(c.source, 'long')),
  res AS (
    SELECT cl.* REPLACE (CASE WHEN n.reads > 0 THEN n.reads ELSE cl.supporting_reads END AS supporting_reads)
    FROM cl LEFT JOIN (SELECT * FROM near WHERE k = 1) n USING (record_id))"""


def _chain_sql(table: str) -> str:
    w = "PARTITION BY run_id, chrom, std_type ORDER BY start1, end1, load_seq, record_id"
    return f"""
  lagged AS (SELECT *, lag(start1) OVER ({w}) AS ps, lag(end1) OVER ({w}) AS pe FROM {table}),
  flagged AS (
    SELECT *, coalesce(start1 <= pe + 10 AND end1 >= ps - 10 AND (abs(start1 - ps) <= 10 OR abs(end1 - pe) <= 10), false) AS joined,
           greatest(0, least(end1, pe) - greatest(start1, ps) + 1) / greatest(end1 - start1 + 1, pe - ps + 1) * 100 AS pct
    FROM lagged),
  chained AS (SELECT *, sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER ({w} ROWS UNBOUNDED PRECEDING) AS cid FROM flagged),
  bounds AS (
    SELECT run_id, chrom, std_type, cid, min(start1) AS cluster_start, max(end1) AS cluster_end, count(*) AS n_members,
           count(*) FILTER (joined) AS n_steps, coalesce(sum(pct) FILTER (joined), 0) AS pct
    FROM chained GROUP BY 1, 2, 3, 4),
  best AS (
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY run_id, chrom, std_type, cid, source
                 ORDER BY coalesce(supporting_reads, -1) DESC, coalesce(score, -1) DESC, -coalesce(abs(svlen), -1) DESC,
                          start1, end1, load_seq, record_id) AS k FROM chained) WHERE k = 1)"""


_B = "b.run_id, b.chrom, b.std_type, b.cid"


def _side(s: str) -> str:
    return f"""LEFT JOIN (SELECT * FROM best WHERE source = '{s}') {s} ON {s}.run_id = b.run_id AND {s}.chrom = b.chrom
      AND {s}.std_type = b.std_type AND {s}.cid = b.cid"""


def _shared(a: str) -> str:
    others = [o for o in ("asm", "long_ont", "long_pacbio", "short") if o != a]
    one = "CASE WHEN {o}.svlen IS NULL THEN 0 ELSE greatest(0, least({a}.end1, {o}.end1) - greatest({a}.start1, {o}.start1) + 1) END"
    return " + ".join(one.format(a=a, o=o) for o in others)


_ORDERED = ("asm", "long_ont", "long_pacbio", "short")
_CANDS = " UNION ALL ".join(
    f"SELECT run_id, chrom, std_type, cid, {i} AS ord, len_{s} AS len, s_{s} AS s, e_{s} AS e, sh_{s} AS shared FROM wide WHERE len_{s} IS NOT NULL"
    for i, s in enumerate(_ORDERED)
)
_LONG_COLS = "start1 start, end1 end, svlen length, info_svtype info_svtype, score score, supporting_reads supporting_reads, supporting_methods supporting_methods, coverage_before_100bp coverage_before_100bp, coverage_after_100bp coverage_after_100bp"  # noqa: E501
_COLS = {
    "asm": "start1 start, end1 end, start_mod start_mod, end_mod end_mod, svlen length, raw_svtype svtype_raw",
    "long_ont": _LONG_COLS,
    "long_pacbio": _LONG_COLS,
    "short": "start1 start, end1 end, svlen length, raw_svtype svtype_raw, info_svtype info_svtype, chr2 chr2, pos2 pos2, score score, supporting_reads supporting_reads, copy_number reads_copy_number_estimate, coverage_before_100bp coverage_before_100bp, coverage_after_100bp coverage_after_100bp",  # noqa: E501
}


def _source_sql(s: str) -> str:
    out = []
    for pair in _COLS[s].split(", "):
        field, name = pair.split()
        value = f"{s}.{field}"
        if name == "score" and s.startswith("long"):
            value = f"CASE WHEN {value} IS NULL AND {s}.info_svtype <> '' THEN 0 ELSE {value} END"
        out.append(f"{value} AS {s}_{name}")
    return ", ".join(out + (["CAST(1 AS INTEGER) AS asm_score"] if s == "asm" else []))


_EVENTS = f"""WITH {_CLEAN}, {_SUP}, {_RES}, {_chain_sql("res")},
  wide AS (
    SELECT {_B}, b.cluster_start, b.cluster_end,
           {", ".join(f"abs({s}.svlen) AS len_{s}, {s}.start1 AS s_{s}, {s}.end1 AS e_{s}, {_shared(s)} AS sh_{s}" for s in _ORDERED)},
           {", ".join(_source_sql(s) for s in _ORDERED)},
           {" + ".join(f"CAST({s}.record_id IS NOT NULL AS INTEGER)" for s in _ORDERED)} AS support_score
    FROM bounds b {" ".join(_side(s) for s in _ORDERED)}),
  cand AS ({_CANDS}),
  anc AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, chrom, std_type, cid ORDER BY len, shared DESC, ord) AS k FROM cand)
    WHERE k = 1),
  ev AS (
    SELECT w.run_id, w.std_type || '_' || row_number() OVER (PARTITION BY w.run_id, w.std_type ORDER BY w.chrom, w.cluster_start, w.cid) AS event_id,
           w.chrom, w.std_type AS std_svtype, coalesce(a.s, w.cluster_start) AS event_start,
           coalesce(a.e, w.cluster_end) AS event_end, a.len AS event_length_bp,
           w.* EXCLUDE (run_id, chrom, std_type, cid, cluster_start, cluster_end, {", ".join(f"len_{s}, s_{s}, e_{s}, sh_{s}" for s in _ORDERED)})
    FROM wide w LEFT JOIN anc a ON a.run_id = w.run_id AND a.chrom = w.chrom AND a.std_type = w.std_type AND a.cid = w.cid)"""


def _links_sql(tol: int) -> str:
    near = f"WHEN abs(r.event_start - o.event_start) <= {tol} AND abs(r.event_end - o.event_end) <= {tol} THEN 'same_coordinates_within_{tol}bp'" if tol else ""  # noqa: E501
    return f"""{_EVENTS}, lk AS (
    SELECT r.run_id, r.event_id, o.event_id AS other_id, o.std_svtype AS other_type, r.chrom, o.event_start AS other_start,
           o.event_end AS other_end,
           CASE WHEN r.event_start <= o.event_end AND o.event_start <= r.event_end THEN
                CASE WHEN r.event_start = o.event_start AND r.event_end = o.event_end THEN 'exact_coordinates'
                     WHEN r.event_start >= o.event_start AND r.event_end <= o.event_end THEN 'nested_in'
                     WHEN r.event_start <= o.event_start AND r.event_end >= o.event_end THEN 'contains'
                     ELSE 'overlap' END
                {near} END AS relation
    FROM ev r JOIN ev o ON r.run_id = o.run_id AND r.chrom = o.chrom AND r.event_id <> o.event_id
      AND o.event_start <= r.event_end + {tol} AND r.event_start <= o.event_end + {tol})"""


_FLANK = """
  fl AS (
    SELECT row_id, chrom, 'before' AS side, greatest(0, s - 101) AS beg0, s - 1 AS end0 FROM fs WHERE s - 1 > greatest(0, s - 101)
    UNION ALL
    SELECT row_id, chrom, 'after', greatest(0, e), e + 100 FROM fs WHERE e + 100 > greatest(0, e))"""
_DEPTH = f"""WITH {_CLEAN},
  fs AS (SELECT record_id AS row_id, run_id || '|' || chrom AS chrom, start1 AS s, end1 AS e FROM cl), {_FLANK},
  al AS (SELECT run_id || '|' || trim(chrom) AS chrom, start_pos - 1 AS b, end_pos AS e FROM caller_support
         WHERE end_pos >= start_pos AND coalesce(supporting_reads, 0) & 1796 = 0),
  dp AS (
    SELECT row_id, side, sum(CASE WHEN a.b IS NULL THEN 0 ELSE least(a.e, f.end0) - greatest(a.b, f.beg0) END) / any_value(f.end0 - f.beg0) AS depth
    FROM fl f LEFT JOIN al a ON a.chrom = f.chrom AND a.b < f.end0 AND f.beg0 < a.e GROUP BY 1, 2)"""

SQL = {
    "sv_clean": f"""WITH {_CLEAN} SELECT * EXCLUDE (load_seq), CASE WHEN {_HOW[0]} IS NOT NULL THEN 'info_svtype' WHEN {_HOW[1]} IS NOT NULL THEN 'raw_svtype'
        WHEN {_HOW[2]} IS NOT NULL THEN 'asm_prefix' ELSE 'fallback_default' END AS resolution FROM cl""",
    "sv_rejects": """
        SELECT record_id, CASE WHEN nullif(trim(chrom), '') IS NULL THEN 'missing_required_fields' ELSE 'invalid_coordinates' END AS reject_reason
        FROM sv_records WHERE nullif(trim(chrom), '') IS NULL OR start_pos IS NULL OR end_pos IS NULL""",
    "sv_audit_counts": f"""WITH {_CLEAN},
        ok AS (SELECT * FROM raw WHERE chrom IS NOT NULL AND start_pos IS NOT NULL AND end_pos IS NOT NULL),
        ev AS (
          SELECT source, 'skipped' AS kind, CASE WHEN chrom IS NULL THEN 'missing_required_fields' ELSE 'invalid_coordinates' END AS reason
          FROM raw WHERE chrom IS NULL OR start_pos IS NULL OR end_pos IS NULL
          UNION ALL SELECT source, 'modified', 'coordinates_swapped' FROM ok WHERE start_pos > end_pos
          UNION ALL SELECT source, 'modified', 'svtype_defaulted_to_rpl' FROM ok WHERE defaulted
          UNION ALL SELECT source, 'modified', 'svlen_derived' FROM ok WHERE std_type <> 'INS' AND len IS NULL
          UNION ALL SELECT source, 'modified', 'svlen_normalized_to_end_minus_start' FROM ok
            WHERE std_type NOT IN ('INS', 'TRA') AND len <> abs(end_pos - start_pos))
        SELECT source, kind, reason, count(*) AS n FROM ev GROUP BY 1, 2, 3""",
    "sv_support_totals": f"WITH {_SUP} SELECT run_id, chrom, std_type, start1, reads AS supporting_reads FROM sup",
    "sv_resolved_support": f"WITH {_CLEAN}, {_SUP}, {_RES} SELECT record_id, source, supporting_reads FROM res",
    "sv_clusters": f"WITH {_CLEAN}, {_chain_sql('cl')} SELECT run_id, chrom, std_type, cluster_start, cluster_end, n_members, n_steps, round(pct, 4) AS percent_total FROM bounds",  # noqa: E501
    "sv_best_records": f"""WITH {_CLEAN}, {_chain_sql("cl")}
        SELECT b.run_id, b.chrom, b.std_type, b.cluster_start, b.cluster_end, {", ".join(f"{s}.record_id AS {s}_record" for s in _ORDERED)}
        FROM bounds b {" ".join(_side(s) for s in _ORDERED)}""",
    "sv_events": f"{_EVENTS} SELECT * FROM ev",
    "sv_links": f"{_links_sql(0)} SELECT * FROM lk WHERE relation IS NOT NULL",
    "sv_links_within_5": f"{_links_sql(5)} SELECT run_id, relation, count(*) AS n FROM lk WHERE relation IS NOT NULL GROUP BY 1, 2",
    "sv_event_report": f"""{_links_sql(0)},
        tx AS (
          SELECT run_id, event_id, string_agg(t, '; ' ORDER BY other_start, other_end, other_type, other_id) AS linked_event FROM (
            SELECT *, other_id || ' (' || other_type || ', ' || chrom || ':' || other_start || '-' || other_end || ', ' || relation || ')' AS t
            FROM lk WHERE relation IS NOT NULL) GROUP BY 1, 2),
        pc AS (
          SELECT run_id, chrom, std_type, cid,
                 coalesce(string_agg(CASE WHEN pct = floor(pct) THEN CAST(CAST(pct AS BIGINT) AS VARCHAR) ELSE printf('%.2f', pct) END || '%', ', '
                            ORDER BY start1, end1, load_seq, record_id) FILTER (joined), '') AS percentage_overlap
          FROM chained GROUP BY 1, 2, 3, 4),
        id AS (
          SELECT run_id, chrom, std_type, cid,
                 std_type || '_' || row_number() OVER (PARTITION BY run_id, std_type ORDER BY chrom, cluster_start, cid) AS event_id FROM wide)
        SELECT ev.*, coalesce(tx.linked_event, '') AS linked_event, pc.percentage_overlap
        FROM ev JOIN id USING (run_id, event_id) JOIN pc ON pc.run_id = id.run_id AND pc.chrom = id.chrom AND pc.std_type = id.std_type AND pc.cid = id.cid
        LEFT JOIN tx ON tx.run_id = ev.run_id AND tx.event_id = ev.event_id""",
    "sv_flanks": f"""WITH fs AS (
          SELECT record_id AS row_id, chrom, least(coalesce(start_pos, 0), coalesce(end_pos, 0)) AS s,
                 greatest(coalesce(start_pos, 0), coalesce(end_pos, 0)) AS e FROM sv_records), {_FLANK}
        SELECT * FROM fl""",
    "sv_flank_depth": f"{_DEPTH} SELECT row_id, side, round(depth, 4) AS depth FROM dp",
    "sv_flank_coverage": f"""{_DEPTH} SELECT record_id,
          (SELECT round(depth, 4) FROM dp WHERE dp.row_id = c.record_id AND side = 'before') AS coverage_before_100bp,
          (SELECT round(depth, 4) FROM dp WHERE dp.row_id = c.record_id AND side = 'after') AS coverage_after_100bp
        FROM cl c""",
    "sv_caller_merge": f"""WITH cl AS (
          SELECT run_id, trim(chrom) AS chrom, coalesce({_cascade_sql("NULL", "svtype", "'long'")}, 'RPL') AS std_type,
                 least(start_pos, end_pos) AS start1, greatest(start_pos, end_pos) AS end1, caller, support_id AS record_id, 0 AS load_seq,
                 'x' AS source, 0 AS supporting_reads, 0 AS score, 0 AS svlen
          FROM caller_support WHERE end_pos IS NOT NULL AND abs(end_pos - start_pos) >= 30),
        {_chain_sql("cl").replace("+ 10", "+ 1000").replace("- 10 ", "- 1000 ").replace("<= 10", "<= 1000")}
        SELECT run_id, chrom, std_type, min(start1) AS start1, max(end1) AS end1, count(*) AS n_calls, count(DISTINCT caller) AS n_callers
        FROM chained GROUP BY run_id, chrom, std_type, cid""",
}
