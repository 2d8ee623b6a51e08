"""Queries of the sequence, read, feature, genome and run operators over the test tables, and their SQL.

Sequences are the nucleotide lines inside the documents, grouped by the documents' source as if that were a genome.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslathe.functions import bases, names
from locuslathe.functions.intervals import linked_relation, overlap_percent
from locuslathe.operators import alignments as A
from locuslathe.operators import features as FT
from locuslathe.operators import genomes as G
from locuslathe.operators import reads as R
from locuslathe.operators import runs as RN
from locuslathe.operators import sequences as S

BY = ("source",)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _seqs(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents").select("doc_id", "source", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    d = d.withColumn("seq", F.rtrim(F.col("line"), F.lit("\r"))).where(F.col("seq").rlike("^[ACGTN]{8,}$"))
    return d.select(
        "source", (F.col("doc_id") * 1048576 + F.col("pos")).alias("seq_idx"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit("_"), F.col("pos").cast("string")).alias("id"),
        F.lit("").alias("description"), "seq",
    )


def seq_stats(spark: SparkSession, sf: str) -> DataFrame:
    return S.sequence_stats(_seqs(spark, sf), BY).withColumn("gc_content", F.round("gc_content", 6))


def seq_n50(spark: SparkSession, sf: str) -> DataFrame:
    return S.n50(_seqs(spark, sf).withColumn("length", F.length("seq").cast("long")), BY)


def seq_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return S.filter_min_length(_seqs(spark, sf), 100).select("seq_idx", "id")


def seq_renamed(spark: SparkSession, sf: str) -> DataFrame:
    d = S.replace_id_incremental(S.filter_min_length(_seqs(spark, sf), 100), "chr", BY)
    return d.select("source", "seq_idx", "id", "description")


def seq_main(spark: SparkSession, sf: str) -> DataFrame:
    return S.mark_main(_seqs(spark, sf), BY).where("is_main").select("source", "seq_idx", "id")


def seq_fragmented(spark: SparkSession, sf: str) -> DataFrame:
    return S.is_fragmented(_seqs(spark, sf), BY)


def seq_id_issues(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents").select(F.col("doc_id").alias("seq_idx"), F.col("lang").alias("id"), F.col("text").alias("seq"))
    return S.check_ids(d)


def seq_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return S.contig_offsets(_seqs(spark, sf), BY)


def seq_merged(spark: SparkSession, sf: str) -> DataFrame:
    d = S.merge_contigs(_seqs(spark, sf), BY)
    return d.select("source", F.length("seq").cast("long").alias("length"), F.md5("seq").alias("digest"))


def seq_reverse_complement(spark: SparkSession, sf: str) -> DataFrame:
    return _seqs(spark, sf).select("seq_idx", F.md5(bases.reverse_complement(F.col("seq"))).alias("digest"))


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    """Alignment hits: every parsed assembly line as a hit of its chromosome."""
    d = _table(spark, sf, "lineitem")
    return d.select(
        F.col("l_orderkey").alias("query"), F.col("l_partkey").alias("ref"),
        F.when(F.col("l_returnflag") == "R", "-").otherwise("+").alias("strand"),
        F.col("l_quantity").cast("long").alias("block_len"),
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("line_no"),
    )


def paf_best_hits(spark: SparkSession, sf: str) -> DataFrame:
    return S.best_hits(_hits(spark, sf))


def seq_split_by_hit(spark: SparkSession, sf: str) -> DataFrame:
    """Contigs and plasmids: genome pair contigs of the modified side that the reference side has or lacks by name."""
    c = _table(spark, sf, "contigs").withColumn("id", F.col("chrom"))
    mod, ref = c.where("genome_side = 'mod'"), c.where("genome_side = 'ref' and not is_plasmid")
    hit, no_hit = S.split_by_hit(mod, ref.select(F.col("id").alias("query")))
    kind = lambda d, k: d.select("contig_id", F.lit(k).alias("kind"))
    return kind(hit, "contig").union(kind(no_hit, "plasmid"))


def seq_oriented(spark: SparkSession, sf: str) -> DataFrame:
    seqs = _seqs(spark, sf)
    best = seqs.select(
        F.col("id").alias("query"), F.lit("ref").alias("ref"), F.when(F.col("seq_idx") % 2 == 0, "-").otherwise("+").alias("strand")
    )
    d = S.orient_by_hit(seqs, best)
    return d.select("seq_idx", F.md5("seq").alias("digest"), "contig_base", "ref_id")


def read_stats(spark: SparkSession, sf: str) -> DataFrame:
    return R.read_stats(_seqs(spark, sf), BY).withColumn("mean_read_length", F.round("mean_read_length", 6))


def read_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents").select(F.md5("text").alias("id"))
    return R.duplicate_ids(d)


def read_invalid(spark: SparkSession, sf: str) -> DataFrame:
    """The sequences as reads, in every third document with some characters that no base has."""
    odd = F.expr("seq_idx div 1048576 % 3 = 0")
    d = _seqs(spark, sf).select("id", F.when(odd, F.translate("seq", "AG", "R-")).otherwise(F.col("seq")).alias("seq"))
    return R.invalid_reads(d)


def _files(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "caller_support").select("support_id", F.concat("run_id", F.lit("_"), F.trim("chrom")).alias("b"), (F.col("support_id") % 11).alias("k"))
    shapes = ["_R1_001", "_001_1", "_1_001", "_R2_combined", "_2_final", "R1_x", "_R2", "_1", ".R1", ".2", "R2"]
    tail = F.lit("")
    for i, x in enumerate(shapes):
        tail = F.when(F.col("k") == i, F.lit(x)).otherwise(tail)
    name = F.concat(F.coalesce("b", F.lit("none")), tail, F.when(F.col("support_id") % 2 == 0, ".fastq.gz").when(F.col("support_id") % 3 == 0, ".fq.GZIP").otherwise(".fastq"))
    return d.select("support_id", name.alias("file_name"))


def file_names(spark: SparkSession, sf: str) -> DataFrame:
    d = _files(spark, sf).withColumn("base", names.base_name(F.col("file_name")))
    d = d.withColumn("p", names.read_pair(F.col("base")))
    return d.select(
        "support_id", names.coding(F.col("file_name")).alias("coding"), names.file_format(F.col("file_name")).alias("fmt"),
        "base", "p.base_name", F.col("p.read_number").cast("long").alias("read_number"),
    )


def read_pairs(spark: SparkSession, sf: str) -> DataFrame:
    d = file_names(spark, sf)
    return R.pair_completeness(d).drop("multiple_r1", "multiple_r2")


def read_pair_summary(spark: SparkSession, sf: str) -> DataFrame:
    return R.pair_summary(R.pair_completeness(file_names(spark, sf)))


def read_samples(spark: SparkSession, sf: str) -> DataFrame:
    d = R.group_samples(_files(spark, sf))
    return d.select("sample", F.size("files").cast("long").alias("n_files"), F.array_join("files", ",").alias("files"))


def _id_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    r = _table(spark, sf, "sv_records").select("source", "run_id", F.concat_ws(":", F.trim("chrom"), "start_pos").alias("id"))
    return (r.where(F.col("source") == s).select("run_id", "id") for s in ("long_ont", "long_pacbio"))


def read_multisets(spark: SparkSession, sf: str) -> DataFrame:
    ref, mod = _id_sides(spark, sf)
    return R.compare_multisets(ref, mod, by=("run_id",))


def read_intersect_all(spark: SparkSession, sf: str) -> DataFrame:
    return R.multiset_intersect(*_id_sides(spark, sf))


def read_except_all(spark: SparkSession, sf: str) -> DataFrame:
    return R.multiset_except(*_id_sides(spark, sf))


def _alignments(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("chrom"), F.col("l_linenumber").cast("int").alias("flag"))


def unmapped_share(spark: SparkSession, sf: str) -> DataFrame:
    return R.unmapped_share(_alignments(spark, sf), ("chrom",))


def unmapped_lines(spark: SparkSession, sf: str) -> DataFrame:
    d = R.unmapped_share(_alignments(spark, sf), ("chrom",))
    return d.select("chrom", R.unmapped_line("mapping").alias("line"))


def fastq_counts(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents").select("source", F.explode(F.split("text", "\n", -1)))
    return R.fastq_read_count(d, BY)


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "sv_records").select(
        F.trim("chrom").alias("seqname"), F.col("source"), F.col("std_type").alias("feature_type"),
        (F.col("start_pos") - 500).alias("start"), (F.col("end_pos") - 500).alias("end"), "record_id",
    )


def feature_issues(spark: SparkSession, sf: str) -> DataFrame:
    return FT.coordinate_issues(_features(spark, sf))


def feature_summary(spark: SparkSession, sf: str) -> DataFrame:
    d = FT.feature_summary(_features(spark, sf))
    return d.select("num_features", F.array_join("feature_types", ",").alias("feature_types"), F.array_join("sequence_ids", ",").alias("sequence_ids"))


def feature_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return FT.sort_features(FT.with_length(FT.rename_features(_features(spark, sf), "chr"))).select("seqname", "start", "end", "length", "record_id")


def _genomes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = _table(spark, sf, "contigs").select("genome_side", F.col("chrom").alias("id"), F.col("seq_len").alias("length"))
    return c.where("genome_side = 'ref'").drop("genome_side"), c.where("genome_side = 'mod'").drop("genome_side")


def genome_differences(spark: SparkSession, sf: str) -> DataFrame:
    return G.compare_sequences(*_genomes(spark, sf))


def genome_check(spark: SparkSession, sf: str) -> DataFrame:
    return G.genome_check(G.compare_sequences(*_genomes(spark, sf)), True, True, True)


def _trace(spark: SparkSession, sf: str) -> DataFrame:
    e = _table(spark, sf, "events")
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "view", "CACHED").when(F.col("event_type") == "click", "COMPLETED").otherwise("ABORTED")
    return e.select("event_id", (F.col("user_id") % 16).alias("worker"), status.alias("status"), F.col("event_type").alias("name"), F.col("user_id").alias("exit"), "value")


def trace_counts(spark: SparkSession, sf: str) -> DataFrame:
    return RN.trace_summary(_trace(spark, sf), ("worker",))


def trace_failed(spark: SparkSession, sf: str) -> DataFrame:
    return RN.failed_tasks(_trace(spark, sf))


def timing_totals(spark: SparkSession, sf: str) -> DataFrame:
    d = _trace(spark, sf).select(F.col("status").alias("validator_type"), F.col("value").alias("elapsed_time"))
    return RN.timing_summary(d).withColumn("total_seconds", F.round("total_seconds", 2))


def report_counts(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "contigs").select(F.col("genome_side").alias("validator_type"), "is_plasmid", (F.col("gc_content") > 42).alias("passed"))
    return RN.report_summary(d)


def run_flags(spark: SparkSession, sf: str) -> DataFrame:
    return RN.run_flags(_table(spark, sf, "sv_runs"))


def files_per_platform(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "sv_raw_lines").select(F.col("file_kind").alias("ngs_type"), F.lit("tsv").alias("input_format"), F.col("file_label").alias("output_file")).distinct()
    return RN.files_per_platform(d).select("ngs_type", "input_format", F.array_join("files", ",").alias("files"))


def interval_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Every record against its own modified-side interval: label and percentage."""
    r = _table(spark, sf, "sv_records").where("start_mod is not null and end_mod is not null and start_pos is not null and end_pos is not null")
    a = (F.least("start_pos", "end_pos"), F.greatest("start_pos", "end_pos"), F.least("start_mod", "end_mod"), F.greatest("start_mod", "end_mod"))
    return r.select("record_id", linked_relation(*a, 100).alias("relation"), F.round(overlap_percent(*a), 4).alias("percent"))


def alignment_filtered(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.lit(100.0) - F.col("l_discount") * 200).alias("identity"), (F.col("l_quantity") * 5).cast("long").alias("length"))
    return A.filter_alignments(d).select("l_orderkey", "l_linenumber", "length")


def alignment_counts(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("chrom"), (F.col("l_partkey") % 4096).cast("int").alias("flag"))
    return A.alignment_stats(d, ("chrom",))


def alignment_sorted(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "sv_records").select("record_id", F.trim("chrom").alias("chrom"), F.col("start_pos").alias("pos"))
    return A.sort_by_coordinate(d)


def read_length_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return A.length_histogram(_seqs(spark, sf), BY)


QUERIES = {
    f.__name__: f
    for f in (
        seq_stats, seq_n50, seq_filtered, seq_renamed, seq_main, seq_fragmented, seq_id_issues, seq_offsets, seq_merged,
        seq_reverse_complement, paf_best_hits, seq_split_by_hit, seq_oriented, read_stats, read_duplicates, read_invalid,
        file_names, read_pairs, read_pair_summary, read_samples, read_multisets, read_intersect_all, read_except_all,
        unmapped_share, unmapped_lines, fastq_counts, feature_issues, feature_summary, feature_sorted,
        genome_differences, genome_check, trace_counts, trace_failed, timing_totals, report_counts, run_flags,
        files_per_platform, interval_labels, alignment_filtered, alignment_counts, alignment_sorted, read_length_histogram,
    )
}

_SEQS = """
  ln AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
  sq AS (SELECT source, doc_id * 1048576 + pos AS seq_idx, 'd' || doc_id || '_' || pos AS id, rtrim(line, chr(13)) AS seq,
                length(rtrim(line, chr(13))) AS length
         FROM ln WHERE regexp_full_match(rtrim(line, chr(13)), '[ACGTN]{8,}'))"""
_N50 = """
  c AS (SELECT source, length, count(*) * length AS bases FROM sq GROUP BY 1, 2),
  w AS (SELECT *, sum(bases) OVER (PARTITION BY source ORDER BY length DESC) AS cum, sum(bases) OVER (PARTITION BY source) AS tot FROM c),
  h AS (SELECT source, CAST(max(length) AS BIGINT) AS n50 FROM w WHERE cum * 2 >= tot GROUP BY 1)"""
_FILES = """
  fb AS (SELECT support_id, coalesce(run_id || '_' || trim(chrom), 'none') ||
           ['_R1_001', '_001_1', '_1_001', '_R2_combined', '_2_final', 'R1_x', '_R2', '_1', '.R1', '.2', 'R2'][support_id % 11 + 1] AS base0,
         CASE WHEN support_id % 2 = 0 THEN '.fastq.gz' WHEN support_id % 3 = 0 THEN '.fq.GZIP' ELSE '.fastq' END AS ext FROM caller_support),
  fn AS (SELECT support_id, base0 || ext AS file_name, base0 AS base FROM fb)"""


_SAMPLE = r"^(.+?)([_.](S[0-9]+_L[0-9]+_)?(R[12]|[12]))?[.]f(ast)?q[.]gz$"
# the patterns of pairs written out, without the operators' table
_PAIRS = (
    r"^(.+)_(R[12])_[0-9]+$", r"^(.+)_[0-9]+_([12])$", r"^(.+)_([12])_[0-9]+$", r"^(.+)_(R[12])_[A-Za-z0-9_]+$", r"^(.+)_([12])_[A-Za-z0-9_]+$",
    r"^(.+)(R[12])_[A-Za-z0-9_]+$", r"^(.+)_(R[12])$", r"^(.+)_([12])$", r"^(.+)[.](R[12])$", r"^(.+)[.]([12])$", r"^(.+)(R[12])$",
)


def _pair_sql() -> str:
    base = " ".join(f"WHEN regexp_matches(base, '{p}') THEN regexp_extract(base, '{p}', 1)" for p in _PAIRS)
    mate = " ".join(f"WHEN regexp_matches(base, '{p}') THEN right(regexp_extract(base, '{p}', 2), 1)" for p in _PAIRS)
    return f"""{_FILES}, pr AS (
      SELECT support_id, CASE WHEN lower(file_name) LIKE '%.gz' OR lower(file_name) LIKE '%.gzip' THEN 'GZIP' ELSE 'NONE' END AS coding,
             'FASTQ' AS fmt, base, CASE {base} ELSE base END AS base_name, CAST(CASE {mate} ELSE '1' END AS BIGINT) AS read_number FROM fn),
    pc AS (
      SELECT base_name, count(*) FILTER (read_number = 1) AS n_r1, count(*) FILTER (read_number = 2) AS n_r2 FROM pr GROUP BY 1),
    ps AS (
      SELECT *, CASE WHEN n_r1 > 0 AND n_r2 > 0 THEN 'complete' WHEN n_r2 > 0 THEN 'missing_r1' ELSE 'single' END AS status FROM pc),
    pl AS (
      SELECT *, CASE WHEN status = 'missing_r1' THEN 'error' WHEN n_r1 > 1 OR n_r2 > 1 THEN 'warning' ELSE 'ok' END AS level FROM ps)"""


_SIDES = """
  sd AS (SELECT source, run_id, concat_ws(':', trim(chrom), CAST(start_pos AS VARCHAR)) AS id FROM sv_records),
  rf AS (SELECT run_id, id FROM sd WHERE source = 'long_ont'), md AS (SELECT run_id, id FROM sd WHERE source = 'long_pacbio')"""
_CMP = """
  r AS (SELECT chrom AS id, seq_len AS ref_length FROM contigs WHERE genome_side = 'ref'),
  m AS (SELECT chrom AS id, seq_len AS mod_length FROM contigs WHERE genome_side = 'mod'),
  cp AS (SELECT coalesce(r.id, m.id) AS id,
           CASE WHEN m.id IS NULL THEN 'ref_only' WHEN r.id IS NULL THEN 'mod_only' WHEN ref_length <> mod_length THEN 'length_mismatch'
                WHEN ref_length IS NULL OR mod_length IS NULL THEN 'length_missing' ELSE 'same' END AS status,
           ref_length, mod_length, mod_length - ref_length AS difference FROM r FULL JOIN m ON r.id = m.id)"""
_TRACE = """
  tr AS (SELECT user_id % 16 AS worker, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'CACHED' WHEN 'click' THEN 'COMPLETED'
           ELSE 'ABORTED' END AS status, event_type AS name, user_id AS exit, value FROM events)"""
_REV = "reverse(translate(seq, 'ACGTN', 'TGCAN'))"

SQL = {
    "seq_stats": f"""WITH {_SEQS}, {_N50},
        b AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY length DESC, seq_idx) AS k,
                     length(regexp_replace(seq, '[^GC]', '', 'g')) AS gc, length(regexp_replace(seq, '[^ACGT]', '', 'g')) AS known FROM sq)
        SELECT source, count(*) AS num_sequences, CAST(sum(length) AS BIGINT) AS total_size, max(id) FILTER (k = 1) AS longest_id,
               CAST(max(length) AS BIGINT) AS longest_length,
               round(sum(CASE WHEN known > 0 THEN gc / known ELSE 0 END * length) / sum(length) * 100, 6) AS gc_content, any_value(n50) AS n50
        FROM b JOIN h USING (source) GROUP BY source""",
    "seq_n50": f"WITH {_SEQS}, {_N50} SELECT * FROM h",
    "seq_filtered": f"WITH {_SEQS} SELECT seq_idx, id FROM sq WHERE length >= 100",
    "seq_renamed": f"""WITH {_SEQS}, k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seq_idx) - 1 AS n FROM sq WHERE length >= 100)
        SELECT source, seq_idx, 'chr' || CASE WHEN n = 0 THEN '' ELSE CAST(n AS VARCHAR) END AS id, id AS description FROM k""",
    "seq_main": f"WITH {_SEQS} SELECT source, seq_idx, id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY length DESC, seq_idx) AS k FROM sq) WHERE k = 1",  # noqa: E501
    "seq_fragmented": f"WITH {_SEQS} SELECT source, count(*) AS num_sequences, count(*) > 5 AS fragmented FROM sq GROUP BY 1",
    "seq_id_issues": """
        SELECT doc_id AS seq_idx, 'ERROR' AS level, 'Sequence at index ' || doc_id || ' has no ID' AS message FROM documents WHERE coalesce(lang, '') = ''
        UNION ALL SELECT doc_id, 'ERROR', 'Sequence ''' || coalesce(lang, '') || ''' has zero length' FROM documents WHERE coalesce(text, '') = ''""",
    "seq_offsets": f"""WITH {_SEQS} SELECT source, seq_idx, id AS seq_id, CAST(length AS BIGINT) AS length,
        CAST(1 + coalesce(sum(length) OVER (PARTITION BY source ORDER BY seq_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM sq""",
    "seq_merged": f"WITH {_SEQS} SELECT source, CAST(sum(length) AS BIGINT) AS length, md5(string_agg(seq, '' ORDER BY seq_idx)) AS digest FROM sq GROUP BY 1",
    "seq_reverse_complement": f"WITH {_SEQS} SELECT seq_idx, md5({_REV}) AS digest FROM sq",
    "paf_best_hits": """
        SELECT l_orderkey AS query, l_partkey AS ref, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand, CAST(l_quantity AS BIGINT) AS block_len
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_quantity AS BIGINT) DESC,
                l_partkey * 1000000 + l_suppkey * 10 + l_linenumber) AS k FROM lineitem) WHERE k = 1""",
    "seq_split_by_hit": """
        SELECT contig_id, CASE WHEN chrom IN (SELECT chrom FROM contigs WHERE genome_side = 'ref' AND NOT is_plasmid) THEN 'contig' ELSE 'plasmid' END AS kind
        FROM contigs WHERE genome_side = 'mod'""",
    "seq_oriented": f"""WITH {_SEQS} SELECT seq_idx, md5(CASE WHEN seq_idx % 2 = 0 THEN {_REV} ELSE seq END) AS digest,
        regexp_replace(id, '[0-9]+$', '') AS contig_base, 'ref' AS ref_id FROM sq""",
    "read_stats": f"""WITH {_SEQS}, {_N50}
        SELECT source, count(*) AS num_reads, CAST(sum(length) AS BIGINT) AS total_bases, round(avg(length), 6) AS mean_read_length,
               CAST(max(length) AS BIGINT) AS longest_read_length, CAST(min(length) AS BIGINT) AS shortest_read_length, any_value(n50) AS n50
        FROM sq JOIN h USING (source) GROUP BY source""",
    "read_duplicates": "SELECT md5(text) AS id, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "read_invalid": f"""WITH {_SEQS}
        SELECT id, length(x) AS n_invalid, array_to_string(list_sort(list_distinct(string_split(x, ''))), ', ') AS characters
        FROM (SELECT id, regexp_replace(translate(seq, 'AG', 'R-'), '[ATCGNatcgn]', '', 'g') AS x FROM sq WHERE seq_idx // 1048576 % 3 = 0) WHERE x <> ''""",
    "file_names": f"WITH {_pair_sql()} SELECT support_id, coding, fmt, base, base_name, read_number FROM pr",
    "read_pairs": f"WITH {_pair_sql()} SELECT base_name, n_r1, n_r2, status, level FROM pl",
    "read_pair_summary": f"""WITH {_pair_sql()}
        SELECT count(*) FILTER (level = 'error') = 0 AS passed, count(*) AS pairs_checked, count(*) FILTER (status = 'complete') AS complete_pairs,
               count(*) FILTER (status = 'missing_r1') AS missing_r1, count(*) FILTER (level = 'warning') AS warnings FROM pl""",
    "read_samples": f"""WITH {_FILES}, k AS (
          SELECT file_name, regexp_extract(file_name, '{_SAMPLE}', 1) AS sample FROM fn WHERE regexp_matches(file_name, '{_SAMPLE}'))
        SELECT sample, count(*) AS n_files, string_agg(file_name, ',' ORDER BY file_name) AS files FROM k GROUP BY 1""",
    "read_multisets": f"""WITH {_SIDES},
        a AS (SELECT run_id, id, count(*) AS a FROM rf GROUP BY 1, 2), b AS (SELECT run_id, id, count(*) AS b FROM md GROUP BY 1, 2),
        j AS (SELECT coalesce(a.run_id, b.run_id) AS run_id, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM a FULL JOIN b ON a.run_id = b.run_id AND a.id = b.id)
        SELECT run_id, CAST(sum(least(a, b)) AS BIGINT) AS shared, CAST(sum(greatest(a - b, 0)) AS BIGINT) AS ref_only,
               CAST(sum(greatest(b - a, 0)) AS BIGINT) AS mod_only FROM j GROUP BY 1""",
    "read_intersect_all": f"WITH {_SIDES} SELECT * FROM rf INTERSECT ALL SELECT * FROM md",
    "read_except_all": f"WITH {_SIDES} SELECT * FROM rf EXCEPT ALL SELECT * FROM md",
    "unmapped_share": """
        SELECT l_returnflag AS chrom, count(*) AS total, count(*) FILTER ((l_linenumber & 4) = 4) AS unmapped,
               round(count(*) FILTER ((l_linenumber & 4) = 4) * 100.0 / count(*), 2) AS percent FROM lineitem GROUP BY 1""",
    "unmapped_lines": """
        SELECT chrom, 'mapping: unmapped ' || format('{:,}', u) || ' (' || printf('%.2f', round(u * 100.0 / t, 2)) || '%)' AS line
        FROM (SELECT l_returnflag AS chrom, count(*) AS t, count(*) FILTER ((l_linenumber & 4) = 4) AS u FROM lineitem GROUP BY 1)""",
    "fastq_counts": """
        SELECT source, count(*) AS num_lines, count(*) // 4 AS num_reads, count(*) % 4 = 0 AS valid
        FROM (SELECT source, unnest(string_split(text, chr(10))) FROM documents) GROUP BY 1""",
    "feature_issues": """
        SELECT trim(chrom) AS seqname, start_pos - 500 AS start, end_pos - 500 AS "end", 'WARNING' AS level,
               CASE WHEN start_pos - 500 < 1 THEN 'Invalid start coordinate (' || (start_pos - 500) || ' < 1)'
                    ELSE 'start > end (' || (start_pos - 500) || ' > ' || (end_pos - 500) || ')' END AS message
        FROM sv_records WHERE start_pos - 500 < 1 OR start_pos > end_pos""",
    "feature_summary": """
        SELECT count(*) AS num_features, string_agg(DISTINCT std_type, ',' ORDER BY std_type) AS feature_types,
               string_agg(DISTINCT trim(chrom), ',' ORDER BY trim(chrom)) AS sequence_ids FROM sv_records""",
    "feature_sorted": """SELECT 'chr' AS seqname, start_pos - 500 AS start, end_pos - 500 AS "end", end_pos - start_pos AS length, record_id FROM sv_records""",
    "genome_differences": f"WITH {_CMP} SELECT * FROM cp",
    "genome_check": f"""WITH {_CMP}, n AS (
          SELECT count(*) FILTER (status <> 'mod_only') AS n_ref, count(*) FILTER (status <> 'ref_only') AS n_mod,
                 count(*) FILTER (status NOT IN ('ref_only', 'mod_only')) AS common, count(*) FILTER (status = 'ref_only') AS ref_only,
                 count(*) FILTER (status = 'mod_only') AS mod_only, count(*) FILTER (status = 'length_mismatch') AS length_mismatches FROM cp)
        SELECT n_ref = n_mod AND ref_only = 0 AND mod_only = 0 AND length_mismatches = 0 AS passed, * FROM n""",
    "trace_counts": f"""WITH {_TRACE} SELECT worker, count(*) FILTER (status = 'COMPLETED') AS completed, count(*) FILTER (status = 'FAILED') AS failed,
        count(*) FILTER (status = 'CACHED') AS cached, count(*) FILTER (status = 'ABORTED') AS aborted, count(*) AS total FROM tr GROUP BY 1""",
    "trace_failed": f"WITH {_TRACE} SELECT name, exit FROM tr WHERE status = 'FAILED'",
    "timing_totals": f"WITH {_TRACE} SELECT status AS validator_type, count(*) AS files, round(sum(value), 2) AS total_seconds FROM tr GROUP BY 1",
    "report_counts": """
        SELECT genome_side AS validator_type, count(*) AS files, count(*) FILTER (is_plasmid) AS plasmids,
               count(*) FILTER (gc_content > 42) AS passed, count(*) FILTER (NOT coalesce(gc_content > 42, false)) AS failed FROM contigs GROUP BY 1""",
    "run_flags": """
        SELECT platform, count(*) AS runs, CAST(coalesce(sum(contig_file_size), 0) AS BIGINT) AS contig_files FROM (
          SELECT 'illumina' AS platform, contig_file_size FROM sv_runs WHERE run_illumina
          UNION ALL SELECT 'nanopore', contig_file_size FROM sv_runs WHERE run_nanopore
          UNION ALL SELECT 'pacbio', contig_file_size FROM sv_runs WHERE run_pacbio) GROUP BY 1""",
    "files_per_platform": """
        SELECT file_kind AS ngs_type, 'tsv' AS input_format, string_agg(DISTINCT file_label, ',' ORDER BY file_label) AS files FROM sv_raw_lines GROUP BY 1""",
    "alignment_filtered": """
        SELECT l_orderkey, l_linenumber, CAST(l_quantity * 5 AS BIGINT) AS length FROM lineitem
        WHERE 100.0 - l_discount * 200 >= 90 AND CAST(l_quantity * 5 AS BIGINT) >= 100""",
    "alignment_counts": """
        WITH a AS (SELECT l_returnflag AS chrom, CAST(l_partkey % 4096 AS INTEGER) AS f FROM lineitem)
        SELECT chrom, count(*) AS records, count(*) FILTER ((f & 2304) = 0) AS "primary", count(*) FILTER ((f & 256) <> 0) AS secondary,
               count(*) FILTER ((f & 2048) <> 0) AS supplementary, count(*) FILTER ((f & 1024) <> 0) AS duplicates,
               count(*) FILTER ((f & 4) = 0) AS mapped, count(*) FILTER ((f & 16) <> 0) AS reverse FROM a GROUP BY 1""",
    "alignment_sorted": "SELECT record_id, trim(chrom) AS chrom, start_pos AS pos FROM sv_records",
    "read_length_histogram": f"WITH {_SEQS} SELECT source, length - length % 100 AS bin_start, count(*) AS n FROM sq GROUP BY 1, 2",
    "interval_labels": """
        WITH a AS (SELECT record_id, least(start_pos, end_pos) AS s1, greatest(start_pos, end_pos) AS e1, least(start_mod, end_mod) AS s2,
                          greatest(start_mod, end_mod) AS e2 FROM sv_records
                   WHERE start_mod IS NOT NULL AND end_mod IS NOT NULL AND start_pos IS NOT NULL AND end_pos IS NOT NULL)
        SELECT record_id, CASE WHEN s1 <= e2 AND s2 <= e1 THEN
                 CASE WHEN s1 = s2 AND e1 = e2 THEN 'exact_coordinates' WHEN s1 >= s2 AND e1 <= e2 THEN 'nested_in'
                      WHEN s1 <= s2 AND e1 >= e2 THEN 'contains' ELSE 'overlap' END
               WHEN abs(s1 - s2) <= 100 AND abs(e1 - e2) <= 100 THEN 'same_coordinates_within_100bp' END AS relation,
               round(greatest(0, least(e1, e2) - greatest(s1, s2) + 1) / greatest(e1 - s1 + 1, e2 - s2 + 1) * 100, 4) AS percent FROM a""",
}
