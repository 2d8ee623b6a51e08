"""Sources, sinks, configuration, validation and the stream: round trips over temporary files."""

import bz2
import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from locuslathe import errors as X
from locuslathe import validation as V
from locuslathe.operators import runs as RN
from locuslathe.sinks import files as K
from locuslathe.sinks import reports
from locuslathe.sources import sequences as SRC
from locuslathe.sources import tables as T
from locuslathe.sources import vcf
from locuslathe.sources.config import InputFile, Options, describe, load_config
from locuslathe.streaming.events import start_event_stream


def text(folder) -> str:
    return "".join(p.read_text() for p in sorted(Path(folder).glob("part-*")))


def test_fasta_round_trip(spark, tmp_path):
    recs = [(f"s{i}", "ACGT" * (i * 20)) for i in range(1, 30)]
    f = tmp_path / "a.fa"
    f.write_text("".join(f">{n} some text\n" + "\n".join(s[k : k + 50] for k in range(0, len(s), 50)) + "\n" for n, s in recs))
    d = SRC.read_fasta(spark, str(f))
    rows = d.orderBy("seq_idx").collect()
    assert [(r.id, r.seq) for r in rows] == recs and rows[0].description == "s1 some text"
    K.write_fasta(d, str(tmp_path / "out"))
    again = SRC.read_fasta(spark, str(tmp_path / "out"))
    assert sorted((r.id, r.seq) for r in again.collect()) == sorted(recs)
    assert max(map(len, text(tmp_path / "out").splitlines())) == 60
    with gzip.open(tmp_path / "b.fa.gz", "wt") as g:
        g.write(">x\nAC\nGT\n>y\n")
    assert [(r.id, r.seq) for r in SRC.read_fasta(spark, str(tmp_path / "b.fa.gz")).orderBy("seq_idx").collect()] == [("x", "ACGT"), ("y", "")]


def test_genbank(spark, tmp_path):
    f = tmp_path / "a.gb"
    f.write_text("LOCUS       L1 12 bp\nDEFINITION  two\n            lines\nVERSION     V1.1\nFEATURES\nORIGIN\n        1 acgtac gtac\n       11 gt\n//\nLOCUS       L2 3 bp\nORIGIN\n        1 aaa\n//\n")
    assert [(r.id, r.description, r.seq) for r in SRC.read_genbank(spark, str(f)).orderBy("seq_idx").collect()] == [("V1.1", "two lines", "ACGTACGTACGT"), ("L2", "", "AAA")]


def test_fastq(spark, tmp_path):
    f = tmp_path / "r.fastq"
    f.write_text("".join(f"@r{i} x\nACG\n+\n@@@\n" for i in range(500)))
    d = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        rows = SRC.read_fastq(spark, str(f)).orderBy("read_idx").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", d)
    assert [(r.id, r.seq, r.qual) for r in rows] == [(f"r{i}", "ACG", "@@@") for i in range(500)]
    assert SRC.read_fastq(spark, str(f), trust=True).count() == 10
    K.write_fastq(SRC.read_fastq(spark, str(f)), str(tmp_path / "o"))
    assert text(tmp_path / "o") == f.read_text()


def test_features(spark, tmp_path):
    f = tmp_path / "a.gff"
    f.write_text("##gff-version 3\n\nc\ts\tgene\t100\t200\t.\t+\t.\tID=g\nc\ts\tCDS\t120\t180\t.\t+\t0\tID=c\nshort\tline\nc\ts\tx\tone\t2\t.\t+\t.\ta\n")
    d = SRC.read_gff(spark, str(f))
    assert [(r.feature_type, r.start, r.end) for r in d.orderBy("start").collect()] == [("gene", 100, 200), ("CDS", 120, 180)]
    K.write_gff3(d, str(tmp_path / "o"))
    assert SRC.read_gff(spark, str(tmp_path / "o")).count() == 2 and "##gff-version 3" in text(tmp_path / "o")
    bed = SRC.parse_bed(spark.createDataFrame([("track x",), ("c\t9\t20\tn\t5\t-",), ("c\tq\t1",)], "value string")).collect()
    assert [(r.seqname, r.start, r.end, r.strand, r.attributes) for r in bed] == [("c", 10, 20, "-", "ID=n")]
    gtf = SRC.gtf_to_gff3(spark.createDataFrame([('gene_id "g1"; transcript_id "t1";',)], "attributes string")).head()
    assert gtf.attributes == "ID=t1;gene_id=g1;transcript_id=t1"


def test_tables(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("#chrom\tstart\tend\tsvtype\n# note\nchr1\t1\t2\tDEL\n")
    d = T.read_calls(spark, str(tmp_path / "a.tsv"), "asm")
    assert [(r.chrom, r.start, r.source) for r in d.collect()] == [("chr1", "1", "asm")]
    (tmp_path / "x_supporting_reads.tsv").write_text("chrom\tstart\tend\tsvtype\tsupporting_reads\nc\t1\t2\tDEL\t5\n")
    (tmp_path / "y_supporting_reads.tsv").write_text("")
    assert [(r.chrom, r.supporting_reads) for r in T.read_support(spark, str(tmp_path / "*_supporting_reads.tsv")).collect()] == [("c", "5")]
    assert T.empty_table(spark).count() == 0
    (tmp_path / "t.tsv").write_text("task_id\tname\tstatus\texit\n1\ta\tFAILED\t137\n")
    assert RN.failed_tasks(T.read_trace(spark, str(tmp_path / "t.tsv"))).head()["exit"] == "137"
    (tmp_path / "h.paf").write_text("q\t9\t0\t9\t+\tr\t9\t0\t9\t9\t7\t60\nq\t9\t0\t9\t+\tr\nq\t9\t0\t9\t-\tr\t9\t0\t9\t9\tx\t60\n\n")
    assert [(r.query, r.block_len, r.strand) for r in T.read_paf(spark, str(tmp_path / "h.paf")).collect()] == [("q", 7, "+")]
    sam = T.parse_sam(spark.createDataFrame([("@HD\tx",), ("r\t16\tc\t5\t60\t3S4M2I1D6M\t*\t0\t0\tACGT\t*",), ("u\t4\t*\t0\t0\t*\t*\t0\t0\tA\t*",)], "value string")).collect()
    assert [(r.read_id, r.chrom, r.a_beg0, r.a_end0) for r in sam] == [("r", "c", 4, 15), ("u", None, -1, -1)]


def test_tables_by_name_and_quoted(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('chrom\tstart\tend\tsvtype\tx\n"chr 1"\t1\t2\tDEL\t"a\tb ""c"""\nc2\t3\t4\tINS\t5" y\n')
    (tmp_path / "b.tsv").write_text("svtype\t#chrom\tend\nDUP\tc3\t9\n")
    (tmp_path / "c.tsv").write_text("")
    with gzip.open(tmp_path / "d.tsv.gz", "wt") as g:
        g.write("end\tchrom\n7\tc4\n")
    d = T.read_tsv(spark, str(tmp_path / "*.tsv*"))
    got = {r.chrom: (r.start, r.end, r.svtype, r.x) for r in d.collect()}
    assert got == {"chr 1": ("1", "2", "DEL", 'a\tb "c"'), "c2": ("3", "4", "INS", '5" y'), "c3": (None, "9", "DUP", None), "c4": (None, "7", None, None)}
    assert T.read_tsv(spark, str(tmp_path / "c.tsv")).count() == 0
    (tmp_path / "p_supporting_reads.tsv").write_text("supporting_reads\tsvtype\tend\tstart\tchrom\tmore\n5\tDEL\t2\t1\tc\tz\n")
    (tmp_path / "q_supporting_reads.tsv").write_text("#chrom\tstart\tend\tsvtype\n# note\nd\t1\t2\tINS\n")
    rows = T.read_support(spark, str(tmp_path / "*_supporting_reads.tsv")).collect()
    assert sorted(tuple(r) for r in rows) == [("c", "1", "2", "DEL", "5", "p_supporting_reads.tsv"), ("d", "1", "2", "INS", None, "q_supporting_reads.tsv")]
    assert T.read_support(spark, str(tmp_path / "none*")).count() == 0


def test_vcf(spark):
    lines = ["#CHROM\tx", "c\t5\tid1\tA\t<DEL>\t50\tPASS\tEND=9;SVTYPE=DEL;SVLEN=-4;PE=7;CHR2=d;RE=3;SUPP=2;StartB=1;EndB=2;FLAG\tGT:RDCN\t0/1:2", "c\t6\tid2\tA\tG\t.\tPASS\t.", "bad"]
    v = vcf.parse_vcf(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert tuple(vcf.assembly_calls(v).collect()[0]) == ("c", "5", "9", "<DEL>", "id1", "1", "2")
    s = vcf.short_calls(v).collect()
    assert tuple(s[0]) == ("c", "5", "9", "DEL", "d", ".", "<DEL>", "-4", "7", "50", "2")
    assert tuple(s[1]) == ("c", "6", ".", ".", ".", ".", "G", ".", ".", ".", ".")
    assert tuple(vcf.long_calls(v).collect()[0]) == ("c", "5", "9", "DEL", "id1", "-4", ".", "50", "2")
    assert vcf.support_calls(v, "cuteSV").collect()[0].supporting_reads == "3"
    assert {r.kind: r.n for r in vcf.variant_stats(v).collect()} == {"other": 1, "snp": 1, "transition": 1}
    assert vcf.concat_sorted(v, v).count() == 4


def test_event_tables(spark, tmp_path):
    rows = [("e2", "c", "DEL", 9, 12, 1), ("e1", "c", "DEL", 3, 12, 1), ("t1", "c", "TRA", 3, 3, 7)]
    d = spark.createDataFrame(rows, "event_id string, chrom string, std_svtype string, event_start long, event_end long, asm_start_mod long")
    (tmp_path / "Insertions.csv").write_text("old")
    K.write_event_tables(d, str(tmp_path))
    assert sorted(p.name for p in tmp_path.glob("*.csv")) == ["Deletions.csv", "Translocations.csv"]
    assert (tmp_path / "Deletions.csv").read_text() == "event_id,chrom,event_start,event_end\ne1,c,3,12\ne2,c,9,12\n"
    assert (tmp_path / "Translocations.csv").read_text().splitlines()[0] == "event_id,chrom,event_start,event_end,asm_start_mod"
    K.write_partitioned(d, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).where("std_svtype = 'DEL'").count() == 2


def test_small_sinks(spark, tmp_path):
    seqs = spark.createDataFrame([("a", "AC"), ("b", "GT")], "id string, seq string")
    K.write_contigs(seqs, str(tmp_path / "c"))
    assert sorted(p.name for p in (tmp_path / "c").glob("contig=*")) == ["contig=a", "contig=b"]
    K.append_plasmids(seqs, str(tmp_path / "p"))
    K.append_plasmids(seqs, str(tmp_path / "p"))
    assert SRC.read_fasta(spark, str(tmp_path / "p")).count() == 4
    K.write_offsets(spark.createDataFrame([("b", 2, 3), ("a", 2, 1)], "seq_id string, length long, start long").coalesce(1), str(tmp_path / "o"))
    assert "seq_id\tlength\tstart\na\t2\t1\n" in text(tmp_path / "o")
    K.write_audit(spark.createDataFrame([(1, ["x"])], "id int, modifications array<string>"), str(tmp_path / "j"))
    assert json.loads(text(tmp_path / "j")) == {"id": 1, "modifications": ["x"]}
    with bz2.open(tmp_path / "x.txt.bz2", "wt") as f:
        f.write("one\ntwo\n")
    for coding, ext in (("GZIP", ".gz"), ("BZIP2", ".bz2"), ("NONE", "")):
        K.recompress(spark, str(tmp_path / "x.txt.bz2"), str(tmp_path / f"r{coding}"), coding)
        assert spark.read.text(str(tmp_path / f"r{coding}")).count() == 2 and list((tmp_path / f"r{coding}").glob(f"part-*{ext}"))
    assert K.next_path(tmp_path / "n.fa.gz").name == "n.fa.gz"
    (tmp_path / "n.fa.gz").touch()
    assert K.next_path(tmp_path / "n.fa.gz").name == "n_001.fa.gz"
    assert json.loads(K.params_json({"a": None, "b": [], "c": 1})) == {"b": [], "c": 1}


def test_reports(spark):
    assert reports.shorten([1, 2, 3]) == "1, 2, 3" and reports.shorten([1, 2, 3, 4]) == "1, 2 (+2 more)"
    assert (reports.number(1.239), reports.number(1000), reports.number(999), reports.number(True)) == ("1.24", "1,000", "999", "True")
    t = spark.createDataFrame([("c", "FAILED", "1")], "name string, status string, exit string")
    assert "failed: 1\naborted: 0\n  c (exit 1)\n" in reports.manifest_text(RN.trace_summary(t), RN.failed_tasks(t))
    r = reports.validation_report([{"validator_type": "genome", "input_file": "a", "metadata": {"n50": 1000}, "issues": [("WARNING", "w")]}], [{"name": "x", "passed": False, "errors": ["e"]}])
    assert r.startswith("status: FAILED") and "n50: 1,000" in r and "  error: e" in r


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "ref.fa").write_text(">a one\n" + "ACGT" * 100 + "\n>b\n" + "GG" * 60 + "\n>short\nAC\n")
    (tmp_path / "g.gff").write_text("c\ts\tgene\t200\t100\t.\t+\t.\tx\nc\ts\tgene\t1\t100\t.\t+\t.\tx\n")
    (tmp_path / "reads").mkdir()
    (tmp_path / "reads" / "s_R1.fastq").write_text("@r\nACGX\n+\nIIII\n@r\nAC\n+\nII\n")
    (tmp_path / "reads" / "s_R2.fastq").write_text("@r\nACG\n+\nIII\n")
    return tmp_path


def config(folder, **more):
    (folder / "c.json").write_text(json.dumps({"ref_genome_filename": "ref.fa", "reads": [{"directory": "reads"}], "ref_feature_filename": {"filename": "g.gff", "validation_level": "strict"}} | more))
    return load_config(folder / "c.json")


def test_config(folder):
    c = config(folder, options={"threads": 4, "validation_level": "strict", "logging_level": "debug"})
    assert [f.path.name for f in c.reads] == ["s_R1.fastq", "s_R2.fastq"] and c.files["ref_genome"].n_sequence_limit == 5
    assert c.options.logging_level == "DEBUG" and c.files["ref_feature"].options.validation_level == "strict"
    for bad in ({"options": {"x": 1}}, {"options": {"threads": 0}}, {"options": {"type": "x"}}, {"reads": []}, {"reads": [{"filename": "a", "directory": "b"}]},
                {"ref_genome_filename": "../x.fa"}, {"ref_genome_filename": "/etc/passwd"}, {"reads": [{"directory": "reads", "ngs_type": "x"}]},
                {"ref_genome_filename": {"filename": "ref.fa", "n_sequence_limit": 0}}):
        with pytest.raises(X.ConfigurationError):
            config(folder, **bad)
    with pytest.raises(X.InputFileNotFoundError):
        config(folder, mod_genome_filename="none.fa")
    (folder / "c.json").write_text("{")
    with pytest.raises(X.ConfigurationError):
        load_config(folder / "c.json")
    assert describe(Path("x.fastq.BZ2")) == ("FASTQ", "BZIP2")


def test_validators(spark, folder):
    c = config(folder, options={"validation_level": "strict"})
    r = V.validate_genome(spark, c.files["ref_genome"], V.GenomeSettings(replace_id_with_incremental="chr", plasmids_to_one=True))
    assert (r.metadata["num_sequences"], r.metadata["longest_id"], r.metadata["fragmented"]) == (1, "chr", False)
    assert [x.id for x in r.outputs["plasmids"].collect()] == ["chr1"]
    reads = V.validate_all(spark, list(c.reads), V.ReadSettings())
    assert [x.metadata["num_reads"] for x in reads] == [2, 1] and reads[0].metadata["n50"] == 4
    assert V.check_reads(spark, reads)["passed"] and not V.check_reads(spark, reads[1:])["passed"]
    assert V.check_reads(spark, reads[1:], True)["warnings"]
    with pytest.raises(X.ReadValidationError, match="invalid character"):
        V.validate_reads(spark, c.reads[0], V.ReadSettings(check_invalid_chars=True))
    with pytest.raises(X.ReadValidationError, match="Duplicate"):
        V.validate_reads(spark, c.reads[0], V.ReadSettings(allow_duplicate_ids=False))
    f = V.validate_features(spark, c.files["ref_feature"])
    assert f.metadata["num_features"] == 2 and f.issues.head().message == "start > end (200 > 100)"
    (folder / "empty.gff").write_text("#\n")
    with pytest.raises(X.GffFormatError):
        V.validate_features(spark, InputFile(folder / "empty.gff", "f", Options(), "GFF", "NONE"))
    with pytest.raises(X.FileFormatError):
        V.validate_genome(spark, c.reads[0])
    minimal = Options(validation_level="minimal")
    assert V.validate_reads(spark, InputFile(c.reads[0].path, "r", minimal, "FASTQ", "NONE")).data is None
    with pytest.raises(X.CompressionError):
        V.validate_reads(spark, InputFile(c.reads[0].path, "r", minimal, "FASTQ", "NONE"), V.ReadSettings(coding_type="gz"))
    g = V.check_genomes(r.data, r.data, True, True, True)
    assert g["passed"] and not V.check_genomes(r.data, r.outputs["plasmids"], True, True)["passed"]


def test_trusted_reads_are_all_kept(spark, tmp_path):
    f = tmp_path / "t.fastq"
    f.write_text("".join(f"@r{i}\nAC{'G' if i < 10 else '#'}\n+\n@@@\n" for i in range(25)))
    got = V.validate_reads(spark, InputFile(f, "r", Options(), "FASTQ", "NONE"), V.ReadSettings(check_invalid_chars=True))
    assert [r.id for r in got.data.orderBy("read_idx").collect()] == [f"r{i}" for i in range(25)]
    assert got.metadata["num_reads"] == 10 and got.issues.isEmpty()  # the checks look at ten


def test_genomes_with_many_length_mismatches(spark):
    ref, mod = (spark.range(103).select(F.format_string("c%03d", "id").alias("id"), F.lit(s).alias("seq")) for s in ("ACG", "AC"))
    errors = V.check_genomes(ref, mod, True, True, True)["errors"]
    assert errors == [f"Sequence length mismatch for 'c{i:03d}': difference=-1" for i in range(103)]  # each of them


def test_settings_and_parameters():
    s = V.GenomeSettings()
    assert s.update(min_sequence_length=5).min_sequence_length == 5 and s.min_sequence_length == 100
    assert V.GenomeSettings.from_dict(s.to_dict()) == s and V.ReadSettings(coding_type="gz").coding_type == "GZIP"
    with pytest.raises(ValueError):
        s.update(nothing=1)
    with pytest.raises(ValueError):
        V.GenomeSettings(plasmid_split=True, plasmids_to_one=True)
    reads = [{"output_file": "b", "ngs_type": "ont", "input_format": "BAM"}, {"output_file": "a", "ngs_type": "illumina", "input_format": "FASTQ"}]
    p = V.run_parameters({"ref": "r", "mod": "m", "mod_split": ["ms"], "characterised_plasmid": "cp", "contigs": ["x", "y"]}, reads, True)
    assert (p["run_ref_x_mod"], p["run_illumina"], p["run_nanopore"], p["run_pacbio"], p["contig_file_size"]) == (True, True, True, False, 2)
    assert (p["ref_plasmid_fasta"], p["mod_plasmid_fasta"], p["illumina_fastq_files"], p["ont_bam_files"]) == (None, "ms", ["a"], ["b"])
    assert not V.run_parameters({"ref": "r", "mod": "m"}, [], False)["run_ref_x_mod"]
    assert V.run_parameters({"characterised_plasmid": "cp"}, [], True)["mod_plasmid_fasta"] == "cp"


def test_stream(spark, tmp_path):
    schema = "record_id long, run_id string, load_seq long, source string, chrom string, start string, end string, svtype string"
    (tmp_path / "in").mkdir()
    calls = spark.readStream.schema(schema).json(str(tmp_path / "in"))

    def add(name, rows):
        keys = [x.split()[0] for x in schema.split(", ")]
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(dict(zip(keys, r))) for r in rows) + "\n")
        q = start_event_stream(spark, calls, str(tmp_path / "store"), str(tmp_path / "out"), str(tmp_path / "ck"), once=True)
        q.awaitTermination(120)
        assert q.exception() is None
        return sorted(((r.run_id, r.event_start, r.event_end, r.support_score) for r in spark.read.parquet(str(tmp_path / "out")).withColumn("run_id", F.col("run_id").cast("string")).collect()), key=repr)

    one = add("a.json", [(1, "r", 1, "asm", "c", "100", "200", "DEL"), (2, "q", 1, "asm", "c", "1", "5", "DEL"), (3, "q", 2, "asm", None, "1", "5", "DEL")])
    assert one == [("q", 1, 5, 1), ("r", 100, 200, 1)]
    assert add("b.json", [(4, "r", 2, "short", "c", "100", "190", "DEL")]) == [("q", 1, 5, 1), ("r", 100, 190, 2)]
    assert add("c.json", [(5, "q", 3, "asm", None, "1", "5", "DEL")]) == [("q", 1, 5, 1), ("r", 100, 190, 2)]  # nothing good
    odd = add("d.json", [(6, "7:x=%", 1, "asm", "c", "1", "5", "DEL"), (7, None, 1, "asm", "c", "1", "9", "DEL")])
    assert ("7:x=%", 1, 5, 1) in odd and (None, 1, 9, 1) in odd


def test_command_line(spark, tmp_path):
    from locuslathe import cli

    (tmp_path / "asm.tsv").write_text("chrom\tstart\tend\tsvtype\tinfo_svtype\tstart_mod\tend_mod\nc\t100\t200\tDEL\tx\t1\t2\n.\tq\t1\tDEL\tx\t1\t2\n")
    (tmp_path / "ont.tsv").write_text("chrom\tstart\tend\tsvtype\tinfo_svtype\tsvlen\tsupporting_reads\tscore\tsupporting_methods\nc\t190\t100\tDEL\tx.DEL\t-90\t.\t.\t3\nc\t150\t150\tINS\tx.INS\t7\t.\t5\t1\n")
    (tmp_path / "s_supporting_reads.tsv").write_text("chrom\tstart\tend\tsvtype\tsupporting_reads\nc\t103\t190\tDEL\t4\nc\t103\t190\tDEL\t2\n")
    paths = {"asm": str(tmp_path / "asm.tsv"), "long_ont": str(tmp_path / "ont.tsv")}
    cli.merge_tables(spark, paths, str(tmp_path / "out"), str(tmp_path / "*_supporting_reads.tsv"))
    rows = (tmp_path / "out" / "Deletions.csv").read_text().splitlines()
    r = dict(zip(rows[0].split(","), __import__("csv").reader(rows[1:]).__next__()))
    assert (r["event_id"], r["event_start"], r["event_end"], r["event_length_bp"], r["support_score"]) == ("DEL_1", "100", "190", "90", "2")
    assert (r["long_ont_supporting_reads"], r["long_ont_score"], r["percentage_overlap"]) == ("6", "0.0", "90.10%")
    assert r["linked_event"] == "INS_1 (INS, c:150-150, contains)" and "asm_start_mod" not in r
    audit = [json.loads(x) for x in text(tmp_path / "out" / "audit").splitlines()]
    assert sorted(a.get("reject_reason") or a["modifications"][0] for a in audit) == ["coordinates_swapped", "invalid_coordinates", "svlen_derived"]
    with pytest.raises(ValueError):
        cli.load_sources(spark, {})


def test_params(tmp_path):
    from locuslathe.sources.config import branches, load_params

    (tmp_path / "p.json").write_text(K.params_json(V.run_parameters({"ref": "r", "mod": "m", "contigs": ["c"]}, [], True)))
    assert branches(load_params(tmp_path / "p.json")) == ("assembly", "merge")
    assert branches({"run_pacbio": True, "run_ref_x_mod": True}) == ("pacbio", "merge")
