"""Queries of the sources and sinks: rows of the test tables written in a file format, read again, and what that must give.

Each query builds the lines of a format from whole tables, or lets a sink write them, and reads them by the source. The
files lie in the checkpoint folder and go when the process ends. The SQL takes the same rows from the tables directly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslathe.functions.names import output_name
from locuslathe.operators import alignments as A
from locuslathe.operators import features as FT
from locuslathe.operators import reads as R
from locuslathe.operators import runs as RN
from locuslathe.operators import sequences as S
from locuslathe.operators.channels import join_channels, with_each
from locuslathe.operators.trimming import trim_reads
from locuslathe.plans import event_queries as EQ
from locuslathe.plans import record_queries as Q
from locuslathe.session import scratch_folder
from locuslathe.sinks import files as K
from locuslathe.sources import sequences as SRC
from locuslathe.sources import tables as T
from locuslathe.sources import vcf as V


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _written(spark: SparkSession, write: Callable[[str], None]) -> str:
    folder = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    write(folder)
    return folder


def _as_text(lines: DataFrame, line: Column) -> str:
    return _written(lines.sparkSession, lambda f: lines.select(line.alias("value")).write.text(f))


def _tabs(*columns: Column) -> Column:
    return F.concat_ws("\t", *(F.coalesce(c.cast("string"), F.lit(".")) for c in columns))


def _tsv(df: DataFrame) -> str:
    """A folder of tab-separated files, each with its header; texts as they stand."""
    options = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return _written(df.sparkSession, lambda f: df.write.options(**options).csv(f))


# --- tables


def src_calls(spark: SparkSession, sf: str) -> DataFrame:
    """Assembly calls through a tab-separated file: texts by the header's names, with the source."""
    r = _table(spark, sf, "sv_records").where("source = 'asm'")
    names = {"record_id": "record_id", "chrom": "chrom", "start": "start_pos", "end": "end_pos", "svtype": "raw_svtype", "start_mod": "start_mod"}
    d = T.read_calls(spark, _tsv(r.select(*(F.col(c).cast("string").alias(n) for n, c in names.items()))), "asm")
    # a reader can't tell an empty field from a missing one
    return d.select(*(F.coalesce(F.col(n), F.lit("")).alias(f"{n}_text") for n in names), "source")


def src_support(spark: SparkSession, sf: str) -> DataFrame:
    """The callers' tables under one glob, each caller's columns in another order."""
    s = _table(spark, sf, "caller_support")
    names = {"chrom": "chrom", "start": "start_pos", "end": "end_pos", "svtype": "svtype", "supporting_reads": "supporting_reads"}
    root, order = f"{scratch_folder(spark)}/{uuid.uuid4().hex}", list(names)
    for i, caller in enumerate(("callerA", "callerB", "callerC")):
        own = order[i:] + order[:i]
        rows = s.where(F.col("caller") == caller) if i < 2 else s.where("caller not in ('callerA', 'callerB')")
        rows = rows.select(*(F.col(names[c]).cast("string").alias(c) for c in own), F.lit("x").alias("more"))
        rows.write.option("sep", "\t").option("header", True).csv(f"{root}/{caller}")
    d = T.read_support(spark, f"{root}/*")
    return d.select(*(F.coalesce(F.col(c), F.lit("")).alias(f"{c}_text") for c in SUPPORT_TEXTS))


SUPPORT_TEXTS = ("chrom", "start", "end", "svtype", "supporting_reads")


def src_trace(spark: SparkSession, sf: str) -> DataFrame:
    """A workflow's trace: the events as tasks, read from a file and counted by status."""
    d = Q._trace(spark, sf).select(F.col("event_id").alias("task_id"), "name", "status", "exit", "worker")
    return RN.trace_summary(T.read_trace(spark, _tsv(d)), ("worker",)).withColumn("worker", F.col("worker").cast("long"))


# --- sequences and reads


def src_fasta(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences through a FASTA file with lines of 60 characters."""
    seqs = Q._seqs(spark, sf).withColumn("description", F.concat_ws(" ", "id", "source"))
    d = SRC.read_fasta(spark, _written(spark, lambda f: K.write_fasta(seqs, f)))
    return d.select("id", "description", F.md5("seq").alias("digest"), F.length("seq").cast("long").alias("length"))


def src_fasta_gzip(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences written as one gzip file, put together from its parts, then copied to bzip2 and to plain text."""
    folder = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    packed = K.as_file(lambda f: K.write_fasta(Q._seqs(spark, sf), f, "gzip"), f"{folder}/a.fasta.gz")
    K.copy_files(spark, [(packed, f"{folder}/a.fasta.bz2", "GZIP", "BZIP2")])
    K.copy_files(spark, [(f"{folder}/a.fasta.bz2", f"{folder}/a.fasta", "BZIP2", "NONE")])
    d = SRC.read_fasta(spark, f"{folder}/a.fasta")
    return d.select("id", F.md5("seq").alias("digest"))


def src_genbank(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences as GenBank records, whose bases stand in numbered blocks of ten."""
    seqs = Q._seqs(spark, sf)
    blocks = F.regexp_replace(F.lower("seq"), "(.{10})", "$1 ")
    record = F.concat(
        F.lit("LOCUS       "), F.col("id"), F.lit("\nDEFINITION  of\n            "), F.col("source"), F.lit("\nVERSION     "), F.col("id"),
        F.lit(".1\nFEATURES\nORIGIN\n        1 "), blocks, F.lit("\n//"),
    )
    d = SRC.read_genbank(spark, _as_text(seqs, record))
    return d.select("id", "description", F.md5("seq").alias("digest"))


def _reads(spark: SparkSession, sf: str) -> DataFrame:
    """The sequences as reads of one file; of every third document an A was read as R."""
    d = Q._seqs(spark, sf).withColumn("seq", F.when(F.expr("seq_idx div 1048576 % 3 = 0"), F.translate("seq", "A", "R")).otherwise(F.col("seq")))
    return d.select(F.lit("f").alias("file"), F.col("seq_idx").alias("read_idx"), "id", F.col("id").alias("description"), "seq", F.regexp_replace("seq", ".", "I").alias("qual"))


def src_fastq(spark: SparkSession, sf: str) -> DataFrame:
    """Reads through a FASTQ file: the characters that no base has, per read."""
    d = SRC.read_fastq(spark, _written(spark, lambda f: K.write_fastq(_reads(spark, sf), f)))
    return d.join(R.invalid_reads(d), "id", "left").select("id", F.md5("seq").alias("digest"), F.length("qual").cast("long").alias("n_qualities"), F.coalesce("n_invalid", F.lit(0)).cast("long").alias("n_invalid"), F.coalesce("characters", F.lit("")).alias("characters"))


def src_fastq_trust(spark: SparkSession, sf: str) -> DataFrame:
    """The first ten reads of the file, which the trust level looks at."""
    file = K.as_file(lambda f: K.write_fastq(_reads(spark, sf), f), f"{scratch_folder(spark)}/{uuid.uuid4().hex}/r.fastq")
    return SRC.read_fastq(spark, file, trust=True).select("read_idx", "id", "seq")


def snk_contigs(spark: SparkSession, sf: str) -> DataFrame:
    """Contigs of the genome pair by their hits: a file each, in order, and their places when merged."""
    c = _table(spark, sf, "contigs").where("genome_side = 'mod'")
    seqs = c.select(F.col("contig_id").alias("seq_idx"), F.col("chrom").alias("id"), F.lit("").alias("description"), F.repeat(F.lit("ACGT"), 5).alias("seq"))
    folder = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    K.write_contig_files(seqs, folder, "mod")
    K.write_offsets(S.contig_offsets(seqs), f"{folder}/order")
    d = SRC.read_fasta(spark, f"{folder}/*.fasta").select(F.regexp_extract("file", r"([^/]+)$", 1).alias("file_name"), "id")
    places = T.read_tsv(spark, f"{folder}/order").select(F.col("seq_id").alias("id"), F.col("start").cast("long").alias("start"))
    return d.join(places, "id")


# --- annotation


def _feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    r = _table(spark, sf, "sv_records").where("chrom is not null and start_pos is not null and end_pos is not null")
    own = F.concat(F.lit("ID=r"), F.col("record_id").cast("string"))
    # every call reported with a record before it is its part
    parent = F.when(F.col("record_id") % 4 != 0, F.concat(F.lit(";Parent=r"), (F.col("record_id") - F.col("record_id") % 4).cast("string")))
    return r.select(
        "record_id", F.col("run_id").alias("seqname"), "source", F.col("std_type").alias("feature_type"), F.col("start_pos").alias("start"),
        F.col("end_pos").alias("end"), F.lit(".").alias("score"), F.lit("+").alias("strand"), F.lit(".").alias("frame"),
        F.concat(own, F.coalesce(parent, F.lit(""))).alias("attributes"),
    )


def src_gff(spark: SparkSession, sf: str) -> DataFrame:
    """Features through a GFF3 file."""
    d = SRC.read_gff(spark, _written(spark, lambda f: K.write_gff3(_feature_rows(spark, sf), f)))
    return d.select("seqname", "source", "feature_type", "start", "end", "attributes")


def src_gff_parents(spark: SparkSession, sf: str) -> DataFrame:
    """Features whose extent is that of the parts that name them."""
    return FT.fit_parents(_feature_rows(spark, sf), 1).select("record_id", "start", "end")


def src_gtf(spark: SparkSession, sf: str) -> DataFrame:
    """Features of a GTF file with their attributes as GFF3 has them."""
    f = _feature_rows(spark, sf)
    attributes = F.concat(F.lit('gene_id "g'), F.col("record_id").cast("string"), F.lit('"; transcript_id "t'), F.col("record_id").cast("string"), F.lit('";'))
    line = _tabs(*(F.col(c) for c in ("seqname", "source", "feature_type", "start", "end", "score", "strand", "frame")), attributes)
    return SRC.gtf_to_gff3(SRC.read_gff(spark, _as_text(f, line))).select("seqname", "start", "end", "attributes")


def src_bed(spark: SparkSession, sf: str) -> DataFrame:
    """Regions of a BED file as features with inclusive coordinates."""
    f = _feature_rows(spark, sf)
    line = _tabs(F.col("seqname"), F.col("start") - 1, F.col("end"), F.col("record_id"), F.lit(0), F.col("strand"))
    return SRC.parse_bed(spark.read.text(_as_text(f, line))).select("seqname", "start", "end", "strand", "attributes")


# --- alignments


def _line_item(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "lineitem").withColumn("line_no", F.col("l_partkey") * 1000000 + F.col("l_suppkey") * 10 + F.col("l_linenumber"))


def src_paf(spark: SparkSession, sf: str) -> DataFrame:
    """Alignment hits of a PAF file, some cut short or without a length: per query the longest block's reference."""
    d = _line_item(spark, sf)
    block = F.when(F.col("l_linenumber") == 7, F.lit("x")).otherwise(F.col("l_quantity").cast("long").cast("string"))
    fields = [F.col("l_orderkey"), *[F.lit(9)] * 3, F.when(F.col("l_returnflag") == "R", "-").otherwise("+"), F.col("l_partkey"), *[F.lit(9)] * 4, block]
    line = F.when(F.col("l_linenumber") == 6, _tabs(*fields)).otherwise(_tabs(*fields, F.lit(60), F.concat(F.lit("ln:i:"), F.col("line_no"))))
    hits = T.read_paf(spark, _as_text(d, line)).drop("line_no")
    # lines of a folder have no order of their own; the hits' places decide among equal ones
    return S.best_hits(hits.withColumn("line_no", F.col("ref").cast("long")), keep=("ref",))


def src_sam(spark: SparkSession, sf: str) -> DataFrame:
    """Alignments as text: the bases of the reference that each covers, unmapped records apart."""
    r = _table(spark, sf, "sv_records")
    flag = F.when(F.col("start_pos").isNull(), 4).otherwise(F.when(F.col("std_type") == "INV", 16).otherwise(0))
    cigar = F.when(F.col("start_pos").isNull(), "*").otherwise(F.concat(F.lit("5S"), (F.col("record_id") % 90 + 1).cast("string"), F.lit("M3I2D7=1X4N6H")))
    line = _tabs(F.col("record_id"), flag, F.when(F.col("start_pos").isNull(), "*").otherwise(F.coalesce(F.nullif(F.trim("chrom"), F.lit("")), F.lit("*"))), F.coalesce("start_pos", F.lit(0)), F.lit(60), cigar, F.lit("*"), F.lit(0), F.lit(0), F.lit("ACGT"), F.lit("*"))
    d = T.read_sam(spark, _as_text(r, line))
    return d.select(F.col("read_id").cast("long").alias("record_id"), "flag", "chrom", "a_beg0", "a_end0")


def src_sam_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What the filters and counts of alignments make of the records of such a file."""
    r = _table(spark, sf, "sv_records")
    flag = F.when(F.col("start_pos").isNull(), 4).when(F.col("std_type") == "INV", 16).when(F.col("std_type") == "DUP", 1024).when(F.col("std_type") == "TRA", 2048).otherwise(0)
    line = _tabs(F.col("record_id"), flag, F.col("run_id"), F.coalesce("start_pos", F.lit(0)), F.lit(60), F.lit("9M"), F.lit("*"), F.lit(0), F.lit(0), F.lit("ACGT"), F.lit("*"))
    return A.alignment_stats(T.read_sam(spark, _as_text(r, line)), ("chrom",))


# --- variant call files


def _vcf_line(spark: SparkSession, sf: str, source: str) -> DataFrame:
    """The calls of one source as variant records; fields that a call lacks aren't in its INFO."""
    r = _table(spark, sf, "sv_records").where(F.col("source").startswith(source) & F.col("chrom").isNotNull() & F.col("start_pos").isNotNull())
    part = lambda key, c: F.when(c.isNotNull(), F.concat(F.lit(f"{key}="), c.cast("string")))
    info = F.concat_ws(
        ";", F.lit("PRECISE"), part("END", F.col("end_pos")), part("SVTYPE", F.col("std_type")), part("SVLEN", F.col("svlen")),
        part("PE", F.col("supporting_reads")), part("RE", F.col("supporting_reads")), part("CHR2", F.col("chr2")), part("POS2", F.col("pos2")),
        part("SUPP", F.translate("supporting_methods", ";", ",")), part("StartB", F.col("start_mod")), part("EndB", F.col("end_mod")),
    )
    sample = F.concat(F.lit("0/1:"), F.coalesce(F.col("copy_number").cast("string"), F.lit(".")))
    alt = F.concat(F.lit("<"), F.col("std_type"), F.lit(">"))
    line = _tabs(F.trim("chrom"), F.col("start_pos"), F.concat(F.lit("v"), F.col("record_id")), F.lit("N"), alt, F.lit(60), F.lit("PASS"), info, F.lit("GT:RDCN"), sample)
    return V.read_vcf(spark, _as_text(r, line))


def src_vcf_assembly(spark: SparkSession, sf: str) -> DataFrame:
    return V.assembly_calls(_vcf_line(spark, sf, "asm"))


def src_vcf_short(spark: SparkSession, sf: str) -> DataFrame:
    return V.short_calls(_vcf_line(spark, sf, "short")).withColumnRenamed("RDCN", "rdcn")


def src_vcf_long(spark: SparkSession, sf: str) -> DataFrame:
    return V.long_calls(_vcf_line(spark, sf, "long"))


def src_vcf_support(spark: SparkSession, sf: str) -> DataFrame:
    return V.support_calls(_vcf_line(spark, sf, "long"), "cuteSV")


def src_vcf_concat(spark: SparkSession, sf: str) -> DataFrame:
    """The records of both long platforms under one another, counted per place."""
    both = V.concat_sorted(_vcf_line(spark, sf, "long_ont"), _vcf_line(spark, sf, "long_pacbio"))
    return both.groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("n"))


def src_variant_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Kinds of variants among the calls, their bases made from their numbers."""
    base = lambda n: F.substring(F.lit("ACGT"), (n % 4 + 1).cast("int"), F.lit(1))
    r = _table(spark, sf, "sv_records").where("start_pos is not null")
    ref, alt = base(F.col("record_id")), base(F.expr("record_id div 4"))
    alt = F.when(F.col("std_type") == "INS", F.concat(alt, F.lit("ACG"))).when(F.col("std_type") == "TRA", F.lit("<TRA>")).otherwise(alt)
    line = _tabs(F.col("run_id"), F.col("start_pos"), F.lit("."), ref, alt, F.lit("."), F.lit("."), F.lit("."))
    return V.variant_stats(V.read_vcf(spark, _as_text(r, line)))


# --- sinks of results


def snk_event_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The result tables of the calls, one CSV per type, read again: rows and the sum of their starts."""
    r = _table(spark, sf, "sv_records").where("chrom is not null and start_pos is not null and end_pos is not null")
    e = r.select(
        F.concat("run_id", F.lit("_"), F.col("record_id").cast("string")).alias("event_id"), F.trim("chrom").alias("chrom"), F.col("std_type").alias("std_svtype"),
        F.col("start_pos").alias("event_start"), F.col("end_pos").alias("event_end"), F.col("start_mod").alias("asm_start_mod"),
    )
    folder = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    written = K.write_event_tables(e, folder)
    out = spark.createDataFrame([], "table_name string, n long, starts long, n_columns long")
    for path in written:
        d = spark.read.csv(path, header=True)
        row = d.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("event_start").cast("long")).alias("starts"))
        out = out.unionByName(row.withColumns({"table_name": F.lit(path.rsplit("/", 1)[1]), "n_columns": F.lit(len(d.columns)).cast("long")}))
    return out


def snk_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    r = _table(spark, sf, "sv_records").select("record_id", F.col("std_type").alias("std_svtype"), "start_pos")
    return spark.read.parquet(_written(spark, lambda f: K.write_partitioned(r, f))).groupBy("std_svtype").agg(F.count(F.lit(1)).alias("n"), F.sum("record_id").alias("ids"))


def snk_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The audit of rejected and modified rows as JSON lines, read again."""
    c = EQ._cleaned(spark, sf).where("reject_reason is not null or size(modifications) > 0").select("record_id", "reject_reason", "modifications")
    d = spark.read.schema(c.schema).json(_written(spark, lambda f: K.write_audit(c, f)))
    return d.select("record_id", F.coalesce("reject_reason", F.lit("")).alias("reject_reason"), F.array_join("modifications", ",").alias("modifications"))


def file_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """The names of the validated read files, by sample, mate and coding, for every setting."""
    d = Q.file_names(spark, sf).select("support_id", "base_name", "read_number")
    named = with_each(d, [{"coding": ""}, {"coding": ".gz"}])
    plain, packed = (output_name(F.col("base_name"), "v", "fastq", x, F.col("read_number")) for x in ("", ".gz"))
    return named.select("support_id", F.when(F.col("coding") == "", plain).otherwise(packed).alias("file_name"))


def channel_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The runs' support tables side by side with the runs' own rows, by run."""
    runs = _table(spark, sf, "sv_runs").select("run_id", "run_stamp")
    own = _table(spark, sf, "caller_support").select("run_id", "support_id")
    return join_channels(own, runs, "run_id")


def read_quality_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Mean qualities of reads, one quality per read from its number."""
    d = _reads(spark, sf).withColumn("qual", F.expr("repeat(chr(cast(read_idx % 40 + 33 as int)), length(seq))"))
    return A.quality_histogram(d).withColumn("quality", F.col("quality").cast("long"))


def read_trimmed(spark: SparkSession, sf: str) -> DataFrame:
    """Reads whose last bases, none to six of them, are bad, without these; short ones are left out."""
    bad = F.expr("cast(read_idx % 7 as int)")
    d = _reads(spark, sf).withColumn("qual", F.concat(F.expr("repeat('I', length(seq) - cast(read_idx % 7 as int))"), F.repeat(F.lit("#"), bad)))
    return trim_reads(d, adapter="").select("id", F.md5("seq").alias("digest"), F.length("qual").cast("long").alias("length"))


def callable_sites(spark: SparkSession, sf: str) -> DataFrame:
    """Places at which calls may be made: line items as pileup rows."""
    d = _table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("coverage"), (F.col("l_partkey") % 41).alias("base_quality"),
        (F.col("l_suppkey") % 61).alias("mapping_quality"), F.col("l_linenumber").alias("alternate_count"),
    )
    return A.callable_sites(d).select("l_orderkey", "l_linenumber")


def sample_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of one sample side by side: those with and without short reads."""
    r = _table(spark, sf, "sv_runs").select(F.col("sample_id").alias("sample"), "run_id", "run_illumina")
    side = lambda x: r.where(x).drop("run_illumina")
    return A.pair_by_sample(side(F.col("run_illumina")), side(~F.col("run_illumina")))


QUERIES = {
    f.__name__: f
    for f in (
        src_calls, src_support, src_trace, src_fasta, src_fasta_gzip, src_genbank, src_fastq, src_fastq_trust, snk_contigs, src_gff,
        src_gff_parents, src_gtf, src_bed, src_paf, src_sam, src_sam_counts, src_vcf_assembly, src_vcf_short, src_vcf_long,
        src_vcf_support, src_vcf_concat, src_variant_stats, snk_event_tables, snk_partitioned, snk_audit, file_outputs, channel_pairs,
        read_quality_histogram, read_trimmed, callable_sites, sample_pairs,
    )
}

_F = """
  ft AS (SELECT record_id, run_id AS seqname, source, std_type AS feature_type, start_pos AS start, end_pos AS "end",
           'ID=r' || record_id || CASE WHEN record_id % 4 <> 0 THEN ';Parent=r' || (record_id - record_id % 4) ELSE '' END AS attributes
         FROM sv_records WHERE chrom IS NOT NULL AND start_pos IS NOT NULL AND end_pos IS NOT NULL)"""
_READS = f"""{Q._SEQS},
  rd AS (SELECT seq_idx AS read_idx, id, CASE WHEN seq_idx // 1048576 % 3 = 0 THEN replace(seq, 'A', 'R') ELSE seq END AS seq FROM sq)"""
_VCF = """
  vc AS (SELECT *, trim(chrom) AS c, CAST(start_pos AS VARCHAR) AS p, coalesce(CAST(end_pos AS VARCHAR), '.') AS e, 'v' || record_id AS v,
           '<' || std_type || '>' AS alt, coalesce(CAST(svlen AS VARCHAR), '.') AS l, coalesce(CAST(supporting_reads AS VARCHAR), '.') AS n
         FROM sv_records WHERE chrom IS NOT NULL AND start_pos IS NOT NULL)"""


def _texts(**columns: str) -> str:
    return ", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {n}_text" for n, c in columns.items())


SQL = {
    "src_calls": f"""SELECT {_texts(record_id="record_id", chrom="chrom", start="start_pos", end="end_pos", svtype="raw_svtype", start_mod="start_mod")},
        source FROM sv_records WHERE source = 'asm'""",
    "src_support": f"""SELECT {_texts(chrom="chrom", start="start_pos", end="end_pos", svtype="svtype", supporting_reads="supporting_reads")} FROM caller_support""",
    "src_trace": Q.SQL["trace_counts"],
    "src_fasta": f"WITH {Q._SEQS} SELECT id, id || ' ' || source AS description, md5(seq) AS digest, CAST(length AS BIGINT) AS length FROM sq",
    "src_fasta_gzip": f"WITH {Q._SEQS} SELECT id, md5(seq) AS digest FROM sq",
    "src_genbank": f"WITH {Q._SEQS} SELECT id || '.1' AS id, 'of ' || source AS description, md5(seq) AS digest FROM sq",
    "src_fastq": f"""WITH {_READS}, k AS (SELECT *, regexp_replace(seq, '[ACGTNacgtn]', '', 'g') AS x FROM rd)
        SELECT id, md5(seq) AS digest, CAST(length(seq) AS BIGINT) AS n_qualities, CAST(length(x) AS BIGINT) AS n_invalid,
               CASE WHEN x <> '' THEN 'R' ELSE '' END AS characters FROM k""",
    "src_fastq_trust": f"""WITH {_READS}, k AS (SELECT *, row_number() OVER (ORDER BY read_idx) - 1 AS i FROM rd)
        SELECT i AS read_idx, id, seq FROM k WHERE i < 10""",
    "snk_contigs": """
        WITH k AS (SELECT chrom AS id, row_number() OVER (ORDER BY contig_id) - 1 AS i FROM contigs WHERE genome_side = 'mod')
        SELECT 'mod_contig_' || i || '.fasta' AS file_name, id, CAST(1 + 20 * i AS BIGINT) AS start FROM k""",
    "src_gff": f'WITH {_F} SELECT seqname, source, feature_type, start, "end", attributes FROM ft',
    "src_gff_parents": f"""WITH {_F},
        k AS (SELECT seqname, record_id - record_id % 4 AS p, min(start) AS s, max("end") AS e FROM ft WHERE record_id % 4 <> 0 GROUP BY 1, 2)
        SELECT record_id, coalesce(k.s, start) AS start, coalesce(k.e, "end") AS "end" FROM ft LEFT JOIN k ON k.p = record_id AND k.seqname = ft.seqname""",
    "src_gtf": f"""WITH {_F} SELECT seqname, start, "end", 'ID=t' || record_id || ';gene_id=g' || record_id || ';transcript_id=t' || record_id AS attributes FROM ft""",
    "src_bed": f"""WITH {_F} SELECT seqname, start, "end", '+' AS strand, 'ID=' || record_id AS attributes FROM ft""",
    "src_paf": """
        SELECT CAST(l_orderkey AS VARCHAR) AS query, CAST(l_partkey AS VARCHAR) AS ref, CAST(l_quantity AS BIGINT) AS block_len
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_quantity AS BIGINT) DESC, l_partkey) AS k
              FROM lineitem WHERE l_linenumber < 6) WHERE k = 1""",
    "src_sam": """
        SELECT record_id, CAST(CASE WHEN start_pos IS NULL THEN 4 WHEN std_type = 'INV' THEN 16 ELSE 0 END AS INTEGER) AS flag,
               CASE WHEN start_pos IS NOT NULL THEN nullif(trim(chrom), '') END AS chrom, coalesce(start_pos, 0) - 1 AS a_beg0,
               coalesce(start_pos + record_id % 90 + 15, 0) - 1 AS a_end0 FROM sv_records""",
    "src_sam_counts": """
        SELECT run_id AS chrom, count(*) AS records, count(*) FILTER (start_pos IS NULL OR std_type <> 'TRA') AS "primary", 0::BIGINT AS secondary,
               count(*) FILTER (start_pos IS NOT NULL AND std_type = 'TRA') AS supplementary,
               count(*) FILTER (start_pos IS NOT NULL AND std_type = 'DUP') AS duplicates, count(*) FILTER (start_pos IS NOT NULL) AS mapped,
               count(*) FILTER (start_pos IS NOT NULL AND std_type = 'INV') AS reverse FROM sv_records GROUP BY 1""",
    "src_vcf_assembly": f"""WITH {_VCF} SELECT c AS chrom, p AS start, e AS "end", alt AS svtype, v AS info_svtype,
        coalesce(CAST(start_mod AS VARCHAR), '.') AS start_mod, coalesce(CAST(end_mod AS VARCHAR), '.') AS end_mod FROM vc WHERE source = 'asm'""",
    "src_vcf_short": f"""WITH {_VCF} SELECT c AS chrom, p AS start, e AS "end", std_type AS svtype, coalesce(chr2, '.') AS chr2,
        coalesce(CAST(pos2 AS VARCHAR), '.') AS pos2, alt AS info_svtype, l AS svlen, n AS supporting_reads, '60' AS score,
        coalesce(CAST(copy_number AS VARCHAR), '.') AS rdcn FROM vc WHERE source = 'short'""",
    "src_vcf_long": f"""WITH {_VCF} SELECT c AS chrom, p AS start, e AS "end", std_type AS svtype, v AS info_svtype, l AS svlen,
        '.' AS supporting_reads, '60' AS score, coalesce(replace(supporting_methods, ';', ','), '.') AS supporting_methods
        FROM vc WHERE starts_with(source, 'long')""",
    "src_vcf_support": f"""WITH {_VCF} SELECT c AS chrom, p AS start, e AS "end", std_type AS svtype, n AS supporting_reads
        FROM vc WHERE starts_with(source, 'long')""",
    "src_vcf_concat": f"WITH {_VCF} SELECT c AS chrom, p AS pos, count(*) AS n FROM vc WHERE starts_with(source, 'long') GROUP BY 1, 2",
    "src_variant_stats": """
        WITH b AS (SELECT 'ACGT'[record_id % 4 + 1] AS r, 'ACGT'[record_id // 4 % 4 + 1] AS a, std_type FROM sv_records WHERE start_pos IS NOT NULL)
        SELECT CASE std_type WHEN 'INS' THEN 'indel' WHEN 'TRA' THEN 'other' ELSE 'snp' END AS kind, count(*) AS n FROM b GROUP BY 1
        UNION ALL SELECT CASE WHEN r || a IN ('AG', 'GA', 'CT', 'TC') THEN 'transition' ELSE 'transversion' END, count(*) FROM b
        WHERE std_type NOT IN ('INS', 'TRA') GROUP BY 1""",
    "snk_event_tables": """
        SELECT CASE std_type WHEN 'INS' THEN 'Insertions' WHEN 'DEL' THEN 'Deletions' WHEN 'DUP' THEN 'Duplications' WHEN 'RPL' THEN 'Replacements'
                 WHEN 'INV' THEN 'Inversions' ELSE 'Translocations' END || '.csv' AS table_name,
               count(*) AS n, CAST(sum(start_pos) AS BIGINT) AS starts, CAST(any_value(CASE WHEN std_type = 'TRA' THEN 5 ELSE 4 END) AS BIGINT) AS n_columns
        FROM sv_records WHERE chrom IS NOT NULL AND start_pos IS NOT NULL AND end_pos IS NOT NULL GROUP BY std_type""",
    "snk_partitioned": "SELECT std_type AS std_svtype, count(*) AS n, CAST(sum(record_id) AS BIGINT) AS ids FROM sv_records GROUP BY 1",
    "snk_audit": f"""WITH {EQ._CLEAN},
        au AS (
          SELECT record_id,
                 CASE WHEN chrom IS NULL THEN 'missing_required_fields' WHEN start_pos IS NULL OR end_pos IS NULL THEN 'invalid_coordinates' ELSE '' END AS reject_reason,
                 [CASE WHEN start_pos > end_pos THEN 'coordinates_swapped' END, CASE WHEN defaulted THEN 'svtype_defaulted_to_rpl' END,
                  CASE WHEN std_type <> 'INS' AND len IS NULL THEN 'svlen_derived' END,
                  CASE WHEN std_type NOT IN ('INS', 'TRA') AND len <> abs(end_pos - start_pos) THEN 'svlen_normalized_to_end_minus_start' END] AS m FROM raw),
        ms AS (SELECT record_id, reject_reason, CASE WHEN reject_reason = '' THEN array_to_string([x FOR x IN m IF x IS NOT NULL], ',') ELSE '' END AS modifications FROM au)
        SELECT * FROM ms WHERE reject_reason <> '' OR modifications <> ''""",
    "file_outputs": f"""WITH {Q._pair_sql()}
        SELECT support_id, base_name || '_R' || read_number || '_v.fastq' || x AS file_name FROM pr, (VALUES (''), ('.gz')) t(x)""",
    "channel_pairs": "SELECT run_id, support_id, run_stamp FROM caller_support JOIN sv_runs USING (run_id)",
    "read_quality_histogram": f"WITH {_READS} SELECT read_idx % 40 AS quality, CAST(sum(length(seq)) AS BIGINT) AS n FROM rd GROUP BY 1",
    "read_trimmed": f"""WITH {_READS}, k AS (SELECT id, seq[1:length(seq) - read_idx % 7] AS s FROM rd)
        SELECT id, md5(s) AS digest, CAST(length(s) AS BIGINT) AS length FROM k WHERE length(s) >= 20""",
    "callable_sites": """
        SELECT l_orderkey, l_linenumber FROM lineitem WHERE CAST(l_quantity AS BIGINT) >= 10 AND l_partkey % 41 >= 20 AND l_suppkey % 61 >= 30 AND l_linenumber >= 3""",
    "sample_pairs": """
        SELECT a.sample_id AS sample, a.run_id, b.run_id AS run_id_mod FROM sv_runs a JOIN sv_runs b ON a.sample_id = b.sample_id
        WHERE a.run_illumina AND NOT b.run_illumina""",
}
