"""A whole validation run, and the sinks it uses: outputs, plasmids, characterisation, copies, reports."""

import bz2
import gzip
import json
import random

import pytest

from locuslathe import validation as V
from locuslathe.operators import channels
from locuslathe.operators.calls import route, union_sources
from locuslathe.operators.features import fit_parents
from locuslathe.run import RunOptions, characterise, main, validate_run
from locuslathe.sinks import files as K
from locuslathe.sources import sequences as SRC
from locuslathe.sources import tables as T
from locuslathe.sources.config import InputFile, Options

RNG = random.Random(1)
MAIN, PLASMID, OTHER = ("".join(RNG.choice("ACGT") for _ in range(n)) for n in (900, 300, 200))


def reverse_complement(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def fasta(path):
    out = {}
    for rec in path.read_text().split(">")[1:]:
        head, *lines = rec.split("\n")
        out[head] = "".join(lines)
    return out


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "ref.fa").write_text(f">a one\n{MAIN}\n>b\n{PLASMID}\n>short\nAC\n")
    (tmp_path / "mod.fa").write_text(f">m1\n{MAIN}\n>m2\n{OTHER}\n>m3\n{reverse_complement(PLASMID)}\n")
    (tmp_path / "g.gff").write_text("##gff-version 3\nc\ts\tgene\t100\t200\t.\t+\t.\tID=g1\nc\ts\tmRNA\t1\t2\t.\t+\t.\tID=t1;Parent=g1\nc\ts\tCDS\t120\t180\t.\t+\t0\tParent=t1\n")
    (tmp_path / "reads").mkdir()
    (tmp_path / "reads" / "s_R1_001.fastq").write_bytes(b"@r\r\nACG\r\n+\r\nIII\r\n@q\nAC\n+x\nII\n")
    with gzip.open(tmp_path / "reads" / "s_R2_001.fastq.gz", "wb") as f:
        f.write(b"@r\nACG\n+\nIII\n")
    (tmp_path / "long.bam").write_bytes(b"BAM\1\0\xff")
    (tmp_path / "h.paf").write_text("chr\t900\t0\t900\t+\tchr\t900\t0\t900\t900\t900\t60\nchr2\t300\t0\t300\t-\tp\t300\t0\t300\t290\t300\t60\n")
    (tmp_path / "c.json").write_text(json.dumps({
        "ref_genome_filename": "ref.fa", "mod_genome_filename": "mod.fa", "ref_feature_filename": "g.gff",
        "reads": [{"directory": "reads"}, {"filename": "long.bam", "ngs_type": "ont"}], "options": {"validation_level": "strict"},
    }))
    return tmp_path


def test_run(spark, folder):
    out = folder / "out"
    p = validate_run(spark, RunOptions(str(folder / "c.json"), str(out), hits=str(folder / "h.paf")))
    assert p["fatal_errors"] == [] and (p["run_ref_x_mod"], p["run_illumina"], p["run_nanopore"], p["run_pacbio"]) == (True, True, True, False)
    assert fasta(out / "ref_ref.fasta") == {"chr a": MAIN} and fasta(out / "ref_ref_plasmid.fasta") == {"chr1 b": PLASMID}
    assert fasta(out / "mod_mod.fasta") == {"chr m1": MAIN, "chr1 m2": OTHER, "chr2 m3": reverse_complement(PLASMID)}
    # contigs by their hits, the minus strand turned; what has no hit is a plasmid
    assert fasta(out / "mod_mod_contig_0.fasta") == {"chr": MAIN} and fasta(out / "mod_mod_contig_1.fasta") == {"chr": PLASMID}
    assert fasta(out / "mod_mod_plasmid.fasta") == {"chr1 m2": OTHER} and p["contig_file_size"] == 2
    assert p["ref_plasmid_fasta"] == str(out / "ref_ref_plasmid.fasta") and p["mod_plasmid_fasta"] == str(out / "mod_mod_plasmid.fasta")
    assert gzip.open(out / "illumina" / "s_R1.fastq.gz").read() == (folder / "reads" / "s_R1_001.fastq").read_bytes()
    assert (out / "illumina" / "s_R2.fastq.gz").read_bytes() == (folder / "reads" / "s_R2_001.fastq.gz").read_bytes()
    assert (out / "ont" / "long.bam").read_bytes() == (folder / "long.bam").read_bytes()
    lines = (out / "g_ref.gff").read_text().splitlines()
    assert lines[0] == "##gff-version 3" and [x.split("\t")[:5] for x in lines[1:]] == [["chr", "s", k, "120", "180"] for k in ("gene", "mRNA", "CDS")]
    assert json.loads((out / "validated_params.json").read_text())["ont_bam_files"] == [str(out / "ont" / "long.bam")]
    report = json.loads((out / "report.json").read_text())
    assert report["summary"]["overall_status"] == "PASSED" and report["summary"]["total_files"] == 6 and report["summary"]["read_files"] == 3
    kinds = {v["validation_type"]: v for v in report["inter_file_validations"]}
    assert kinds["genomexgenome"]["metadata"]["contig_orientations"] == {"chr": "+", "chr2": "-"} and kinds["readxread"]["passed"]
    assert report["file_validations"][0]["output_data"]["output_file"] == str(out / "ref_ref.fasta")
    assert (out / "report.txt").read_text().startswith("status: PASSED\n")
    again = validate_run(spark, RunOptions(str(folder / "c.json"), str(out), hits=str(folder / "h.paf")))
    assert fasta(out / "mod_mod_plasmid.fasta") and again["contig_files"] == p["contig_files"] and (out / "report_001.txt").exists()


def test_failing_runs(spark, folder):
    (folder / "reads" / "s_R1_001.fastq").unlink()
    (folder / "mod.fa").write_text("")
    (folder / "ref.fa").write_text(">\n" + MAIN + "\n")
    p = validate_run(spark, RunOptions(str(folder / "c.json"), str(folder / "o")))
    assert len(p["fatal_errors"]) == 1 and "ref_genome" in p["fatal_errors"][0] and not p["run_ref_x_mod"]
    report = json.loads((folder / "o" / "report.json").read_text())
    assert report["summary"]["overall_status"] == "FAILED" and report["summary"]["interfile_failed"] == 1
    assert "R2 file(s) without matching R1" in (folder / "o" / "report.txt").read_text()
    (folder / "c.json").write_text("{")
    assert main(["--config_json", str(folder / "c.json"), "--out_dir", str(folder / "o")]) == 1


def test_minimal_run(spark, folder):
    c = json.loads((folder / "c.json").read_text())
    c["options"]["validation_level"] = "minimal"
    (folder / "reads" / "s_R1_001.fastq").unlink()
    with gzip.open(folder / "reads" / "s_R1_001.fastq.gz", "wb") as f:
        f.write(b"@r\nACG\n+\nIII\n")
    (folder / "c.json").write_text(json.dumps(c))
    c["reads"][1]["validation_level"] = "trust"
    (folder / "c.json").write_text(json.dumps(c))
    p = validate_run(spark, RunOptions(str(folder / "c.json"), str(folder / "o")))
    assert p["fatal_errors"] == [] and p["run_illumina"] and p["run_nanopore"] and not p["run_ref_x_mod"]
    assert [x.rsplit("/", 1)[1] for x in p["illumina_fastq_files"]] == ["s_R1.fastq.gz", "s_R2.fastq.gz"]
    assert (folder / "o" / "mod_mod.fasta").read_bytes() == (folder / "mod.fa").read_bytes()


def test_defragmented_reference(spark, folder):
    c = json.loads((folder / "c.json").read_text())
    c["options"]["force_defragment_ref"] = True
    (folder / "c.json").write_text(json.dumps(c))
    p = validate_run(spark, RunOptions(str(folder / "c.json"), str(folder / "o")))
    assert list(fasta(folder / "o" / "ref_merged_ref.fasta").values()) == [MAIN + PLASMID + "AC"] and p["ref_plasmid_fasta"] is None
    assert not (folder / "o" / "g_ref.gff").exists()


def test_plasmids_go_behind_an_existing_file(spark, tmp_path):
    seqs = spark.createDataFrame([(0, "c1", "", MAIN), (1, "p1", "x", OTHER)], "seq_idx long, id string, description string, seq string")
    hits = T.parse_paf(spark.createDataFrame([("c1\t9\t0\t9\t+\tr\t9\t0\t9\t9\t7\t60", 0)], "value string, line_no long"))
    for name in ("explicit", "split"):
        (tmp_path / f"{name}.fasta").write_text(">old\nACGT\n")
    m = characterise(seqs, hits, str(tmp_path), "b", str(tmp_path / "explicit.fasta"), str(tmp_path / "split.fasta"))
    assert fasta(tmp_path / "explicit.fasta") == {"old": "ACGT", "p1 x": OTHER} and fasta(tmp_path / "split.fasta") == {"old": "ACGT"}
    assert m["plasmid_file"] == str(tmp_path / "explicit.fasta") and m["plasmids_found"] == 1 and m["contig_ref_names"] == {"c1": "r"}
    m = characterise(seqs, hits.where("false"), str(tmp_path), "n")
    assert m["contigs_found"] == 0 and m["contig_files"] == [] and len(fasta(tmp_path / "n_plasmid.fasta")) == 2
    m = characterise(seqs.where("id = 'c1'"), hits, str(tmp_path), "n2")
    assert m["plasmid_file"] is None and not (tmp_path / "n2_plasmid.fasta").exists()


def test_split_plasmids_and_minimal(spark, folder):
    file = InputFile(folder / "ref.fa", "ref_genome", Options(validation_level="strict"), "FASTA", "NONE", 5)
    r = V.validate_genome(spark, file, V.GenomeSettings(plasmid_split=True, min_sequence_length=1, coding_type="bz2"), out=folder / "o")
    assert r.metadata["plasmid_filenames"] == ["ref_plasmid0.fasta.bz2", "ref_plasmid1.fasta.bz2"]
    assert bz2.open(folder / "o" / "ref_plasmid1.fasta.bz2", "rt").read() == ">short\nAC\n"
    minimal = InputFile(folder / "ref.fa", "ref_genome", Options(validation_level="minimal"), "FASTA", "NONE", 5)
    V.validate_genome(spark, minimal, V.GenomeSettings(output_filename_suffix="m", output_subdir_name="sub"), out=folder / "o")
    assert (folder / "o" / "sub" / "ref_m.fasta").read_bytes() == (folder / "ref.fa").read_bytes()
    bam = InputFile(folder / "long.bam", "reads", Options(validation_level="minimal"), "BAM", "NONE", None, "ont")
    r = V.validate_reads(spark, bam, V.ReadSettings(output_filename_suffix="v"), out=folder / "o")
    assert (folder / "o" / "long_v.bam").read_bytes() == (folder / "long.bam").read_bytes() and r.data is None


@pytest.mark.parametrize("have", ["NONE", "GZIP", "BZIP2"])
def test_copies_are_lossless(spark, tmp_path, have):
    data = b"one\r\ntwo\rthree\n\x00\xff" * 1000 + b"no end"
    packed = {"NONE": data, "GZIP": gzip.compress(data), "BZIP2": bz2.compress(data)}
    source = tmp_path / f"x{K.SUFFIXES[have]}"
    source.write_bytes(packed[have])
    K.copy_files(spark, [(str(source), str(tmp_path / "o" / w), have, w) for w in packed])
    for want, unpack in (("NONE", bytes), ("GZIP", gzip.decompress), ("BZIP2", bz2.decompress)):
        got = (tmp_path / "o" / want).read_bytes()
        assert unpack(got) == data and (want != have or got == packed[have])
    assert K.copy_files(spark, []) == 0
    there = K.publish(spark, {"mapping": [str(source)], "calls": []}, str(tmp_path / "p"))
    assert there == [str(tmp_path / "p" / "mapping" / source.name)] and (tmp_path / "p" / "mapping" / source.name).read_bytes() == packed[have]


def test_parents_fit_their_children(spark):
    rows = [("c", 1, 900, "ID=g"), ("c", 5, 6, "Parent=g;ID=t1"), ("c", 1, 2, "ID=t2;Parent=g"), ("c", 20, 30, "Parent=t1,t2"), ("c", 40, 50, "Parent=t2"),
            ("d", 7, 8, "ID=t1"), ("c", 3, 4, "x"), ("c", 1, 1, "ID=lone")]
    d = fit_parents(spark.createDataFrame(rows, "seqname string, start long, end long, attributes string"))
    got = sorted((r.seqname, r.attributes, r.start, r.end) for r in d.collect())
    assert got == sorted([("c", "ID=g", 20, 50), ("c", "Parent=g;ID=t1", 20, 30), ("c", "ID=t2;Parent=g", 20, 50), ("c", "Parent=t1,t2", 20, 30),
                          ("c", "Parent=t2", 40, 50), ("d", "ID=t1", 7, 8), ("c", "x", 3, 4), ("c", "ID=lone", 1, 1)])


def test_features_that_are_none_of_their_format(spark, folder):
    f = InputFile(folder / "g.gff", "ref_feature", Options(validation_level="strict"), "BED", "NONE")
    assert V.validate_features(spark, f).metadata["num_features"] == 3


def test_trusted_features_are_the_first(spark, tmp_path):
    (tmp_path / "g.gff").write_text("".join(f"c\ts\tx\t{9 if i < 10 else 0}\t9\t.\t+\t.\tID={i}\n" for i in range(4000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        r = V.validate_features(spark, InputFile(tmp_path / "g.gff", "f", Options(), "GFF", "NONE"))
        assert r.issues.count() == 0
        (tmp_path / "r.fastq").write_text("".join(f"@r{i}\nA\n+\nI\n" for i in range(2000)))
        assert sorted(x.id for x in SRC.read_fastq(spark, str(tmp_path / "r.fastq"), trust=True).collect()) == sorted(f"r{i}" for i in range(10))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_channels(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, v int")
    b = spark.createDataFrame([("x", 7), ("x", 8), (None, 9)], "k string, v int")
    assert sorted(map(tuple, channels.join_channels(a, b, "k").collect())) == [("x", 1, 7), ("x", 1, 8)]
    assert channels.with_each(a, [{"f": "p"}, {"f": "q"}]).count() == 6 and channels.with_each(a, []).count() == 0
    assert {r.ref for r in channels.with_value(a, ref="r.fa").collect()} == {"r.fa"}
    with pytest.raises(ValueError):
        channels.with_value(a, V=1)
    parts = route(union_sources(("asm", a), ("short", b)), ("asm", "short", "long"))
    assert [parts[t].count() for t in ("asm", "short", "long")] == [3, 3, 0] and parts["asm"].columns == ["k", "v"]


def test_repeated_batches_of_plasmids(spark, tmp_path):
    seqs = spark.createDataFrame([("a", "AC")], "id string, seq string")
    for batch in ("1", "1", "2"):
        K.append_plasmids(seqs, str(tmp_path / "p"), batch)
    assert spark.read.option("recursiveFileLookup", True).text(str(tmp_path / "p")).where("value like '>%'").count() == 2
