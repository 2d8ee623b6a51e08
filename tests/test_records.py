"""Sequences, reads, features, genomes, names and runs: the fixtures' cases and edge inputs."""

import random

import pytest
from pyspark.sql import functions as F

from locuslathe.functions import bases, names
from locuslathe.operators import alignments as A
from locuslathe.operators import features as FT
from locuslathe.operators import genomes as G
from locuslathe.operators import reads as R
from locuslathe.operators import runs as RN
from locuslathe.operators import sequences as S
from locuslathe.operators.prefix import prefix_sum

SEQ = "seq_idx long, id string, description string, seq string, length string, is_main int"


def seqs(spark, *pairs):
    return spark.createDataFrame([(i, n, "", s, "x", 5) for i, (n, s) in enumerate(pairs)], SEQ)


def test_statistics(spark):
    d = seqs(spark, *((f"s{n}", "A" * n) for n in (1000, 800, 500, 200)))
    r = S.sequence_stats(d).head()
    assert (r.num_sequences, r.total_size, r.longest_id, r.longest_length, r.n50, r.gc_content) == (4, 2500, "s1000", 1000, 800, 0.0)
    assert S.sequence_stats(seqs(spark, ("a", "ATGC" * 250), ("n", "NNNN"), ("e", None))).head().gc_content == pytest.approx(50 * 1000 / 1004)
    r = S.sequence_stats(d.where("false")).head()
    assert (r.num_sequences, r.total_size, r.n50, r.gc_content, r.longest_id) == (0, 0, 0, 0.0, None)
    r = R.read_stats(seqs(spark, *((str(n), "A" * n) for n in (1000, 800, 600, 400, 200)))).head()
    assert tuple(r) == (5, 3000, 600.0, 1000, 200, 800)
    r = R.read_stats(seqs(spark, *((str(n), "A" * n) for n in (100, 200, 300, 400)))).head()
    assert (r.n50, r.total_bases, r.mean_read_length) == (300, 1000, 250.0)
    assert tuple(R.read_stats(d.where("false")).head()) == (0, 0, 0.0, 0, 0, 0)


def test_edits(spark):
    d = seqs(spark, ("c", "A" * 5000), ("p1", "A" * 500), ("p2", "A" * 1000), ("x", "A" * 5))
    kept = S.filter_min_length(d)
    assert S.count_short(d).head().removed == 1
    assert [(r.id, r.description) for r in S.replace_id_incremental(kept, "chr").orderBy("seq_idx").collect()] == [("chr", "c"), ("chr1", "p1"), ("chr2", "p2")]
    assert {(r.id, r.description) for r in S.replace_id(kept, "z").collect()} == {("z", "c"), ("z", "p1"), ("z", "p2")}
    m = {r.id: r.is_main for r in S.mark_main(kept.drop("is_main")).collect()}
    assert m == {"c": True, "p1": False, "p2": False}
    assert S.mark_main(seqs(spark, ("a", "AC"), ("b", "GT")).drop("is_main")).where("is_main").head().id == "a"
    assert S.mark_main(seqs(spark, ("a", "A"), ("b", "GT")).drop("is_main"), (), False).where("is_main").head().id == "a"
    assert [r.fragmented for r in (S.is_fragmented(d, (), 3).head(), S.is_fragmented(d, (), 5).head(), S.is_fragmented(d, (), 5, "eukaryote").head())] == [True, False, True]
    issues = S.check_ids(seqs(spark, ("", "A"), (None, None), ("q", "")))
    assert sorted(r.message for r in issues.collect()) == ["Sequence '' has zero length", "Sequence 'q' has zero length", "Sequence at index 0 has no ID", "Sequence at index 1 has no ID"]


def test_merging(spark):
    d = seqs(spark, ("a", "ATCGATCGATCG"), ("b", "GGGGCCCCTTTT"), ("c", "AAAATTTTCCCC"))
    assert [r.start for r in S.contig_offsets(d).orderBy("seq_idx").collect()] == [1, 13, 25]
    assert S.merge_contigs(d, ()).head().seq == "ATCGATCGATCGGGGGCCCCTTTTAAAATTTTCCCC"
    assert S.contig_offsets(d.where("false")).count() == 0


def test_prefix_sums(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), i * 7 % 5000, rng.choice([None, 1, 5])) for i in range(1, 600)]
    for bits in (3, 16):
        d = prefix_sum(spark.createDataFrame(rows, "g string, o long, v long"), ("g",), "o", F.col("v"), "p", bits)
        got = {(r.g, r.o): r.p for r in d.collect()}
        assert got == {(g, o): sum(v or 0 for g2, o2, v in rows if g2 == g and o2 < o) for g, o, _ in rows}


def test_hits(spark):
    rows = [("chr1", "small", 200, "+", 1), ("chr1", "large", 5000, "-", 2), ("chr1", "mid", 1000, "+", 3), ("t", "r1", 9, "+", 4), ("t", "r2", 9, "+", 5), (None, "x", 1, "+", 6), ("n", "x", None, "+", 7)]
    rows += [("rrna", f"copy_{k}", 5900 + k, "+", 10 + k) for k in range(5)]
    h = spark.createDataFrame(rows, "query string, ref string, block_len long, strand string, line_no long")
    best = S.best_hits(h)
    assert {(r.query, r.ref, r.strand, r.block_len) for r in best.collect()} == {("chr1", "large", "-", 5000), ("t", "r1", "+", 9), ("rrna", "copy_4", "+", 5904)}
    mod = seqs(spark, ("chr1", "AAACCCGGG"), ("t", "AC"), ("plasmid1", "GG"))
    contigs, plasmids = S.split_by_hit(mod, h)
    assert ({r.id for r in contigs.collect()}, {r.id for r in plasmids.collect()}) == ({"chr1", "t"}, {"plasmid1"})
    o = {r.id: (r.seq, r.contig_base) for r in S.orient_by_hit(mod, best).collect()}
    assert o == {"chr1": ("CCCGGGTTT", "chr"), "t": ("AC", "t")}
    assert S.best_hits(h.where("false")).count() == 0


def test_bases(spark):
    d = spark.createDataFrame([("ATCGXYZATCG",), ("acgtn",), (None,)], "seq string").withColumn("id", F.lit("i"))
    (r,) = R.invalid_reads(d).collect()
    assert (r.n_invalid, r.characters) == (3, "X, Y, Z")
    assert d.select(bases.reverse_complement(F.col("seq")).alias("x")).collect()[1].x == "nacgt"


@pytest.mark.parametrize(
    ("name", "base", "mate"),
    [
        ("Bacillus_toyonensis_LE1_S1_L001_R1.fastq.gz", "Bacillus_toyonensis_LE1_S1_L001", 1),
        ("Bacillus-toyonensis-LE1-sequence_2.fastq.gz", "Bacillus-toyonensis-LE1-sequence", 2),
        ("Bacillus_toyonensis_LE1_sequence.R1.fastq.gz", "Bacillus_toyonensis_LE1_sequence", 1),
        ("SRR834393.fq.gz", "SRR834393", 1), ("SRR834394_1.fq.gz", "SRR834394", 1), ("SRR837394_2_001.fastq.gz", "SRR837394", 2),
        ("SRR834393R1_combined.fq.gz", "SRR834393", 1), ("sampleR2.fastq.gz", "sample", 2),
    ],
)
def test_file_names(spark, name, base, mate):
    d = spark.createDataFrame([(name,)], "n string").select(names.read_pair(names.base_name(F.col("n"))).alias("p"), names.file_format(F.col("n")).alias("f"), names.coding(F.col("n")).alias("c"))
    r = d.head()
    assert (r.p.base_name, r.p.read_number, r.f, r.c) == (base, mate, "FASTQ", "GZIP")


def test_formats_and_outputs(spark):
    d = spark.createDataFrame([("a.FA",), ("a.gbk.bz2",), ("a.txt",), ("a",), ("x.gff2.GZIP",)], "n string")
    got = [tuple(r) for r in d.select(names.file_format(F.col("n")), names.coding(F.col("n")), names.base_name(F.col("n"))).collect()]
    assert got == [("FASTA", "NONE", "a"), ("GENBANK", "BZIP2", "a"), (None, "NONE", "a"), (None, "NONE", "a"), ("GTF", "GZIP", "x")]
    assert d.select(names.output_name(F.lit("b"), "s", "fastq", ".gz", F.lit(2)).alias("o")).head().o == "b_R2_s.fastq.gz"
    f = spark.createDataFrame([("s1_S1_L001_R1.fastq.gz",), ("s1_S1_L001_R2.fastq.gz",), ("t.R1.fq.gz",), ("u.bam",)], "file_name string")
    assert {r["sample"]: r.files for r in R.group_samples(f).collect()} == {"s1": ["s1_S1_L001_R1.fastq.gz", "s1_S1_L001_R2.fastq.gz"], "t": ["t.R1.fq.gz"]}


def test_pairs(spark):
    schema = "base_name string, read_number int"

    def check(rows, **kw):
        p = R.pair_completeness(spark.createDataFrame(rows, schema), **kw)
        return R.pair_summary(p).head()

    assert tuple(check([("s", 1), ("s", 2)])) == (True, 1, 1, 0, 0)
    assert tuple(check([("s", 2), (None, 2), ("q", None)])) == (False, 1, 0, 1, 0)
    assert tuple(check([("s", 2)], allow_missing_r1=True)) == (True, 1, 0, 1, 1)
    assert tuple(check([("s", 1), ("s", 1)])) == (True, 1, 0, 0, 1)
    assert tuple(check([])) == (True, 0, 0, 0, 0)


def test_multisets(spark):
    a, b = (spark.createDataFrame([(x,) for x in s], "id string") for s in ("aabc", "accd"))
    assert tuple(R.compare_multisets(a, b).head()) == (2, 2, 2)
    assert (R.multiset_intersect(a, b).count(), R.multiset_except(a, b).count(), R.multiset_except(b, a).count()) == (2, 2, 2)
    assert tuple(R.compare_multisets(a.where("false"), b.where("false")).head()) == (0, 0, 0)
    assert [(r.id, r.n) for r in R.duplicate_ids(a).collect()] == [("a", 2)]


def test_unmapped(spark):
    d = spark.createDataFrame([(4,), (5,), (0,), (16,), (1028,), (None,)], "flag int")
    assert R.unmapped(d).count() == 3
    r = R.unmapped_share(d).withColumn("line", R.unmapped_line("x")).head()
    assert (r.total, r.unmapped, r.percent, r.line) == (6, 3, 50.0, "x: unmapped 3 (50.00%)")
    assert R.fastq_read_count(spark.range(10)).head()[1:] == (2, False)


def test_features(spark):
    d = spark.createDataFrame([("s", 200, 100), ("s", -10, 5), ("s", 100, 100), ("s", None, 4)], "seqname string, start long, end long").withColumn("feature_type", F.lit("gene"))
    assert sorted(r.message for r in FT.coordinate_issues(d).collect()) == ["Invalid start coordinate (-10 < 1)", "start > end (200 > 100)"]
    assert FT.feature_summary(d).head().feature_types == ["gene"]
    assert [r.start for r in FT.sort_features(d).collect()] == [None, -10, 100, 200]


def test_genomes(spark):
    a = spark.createDataFrame([("chr1", 5_000_000), ("chr2", 3_000_000)], "id string, length long")
    b = spark.createDataFrame([("chr1", 5_001_000), ("chr2", 3_000_000), ("p", None)], "id string, length long")
    assert G.genome_check(G.compare_sequences(a, a), True, True, True).head().passed
    c = G.compare_sequences(a, b)
    assert {(r.id, r.status, r.difference) for r in c.collect()} == {("chr1", "length_mismatch", 1000), ("chr2", "same", 0), ("p", "mod_only", None)}
    assert not G.genome_check(c).head().passed and G.genome_check(c, False).head().passed
    with pytest.raises(ValueError):
        G.genome_check(c, True, False, True)


def test_runs(spark):
    t = spark.createDataFrame([("a", "COMPLETED", "0"), ("b", "COMPLETED", "0"), ("c", "FAILED", "137"), ("d", "CACHED", "0"), ("e", "ABORTED", "-")], "name string, status string, exit string")
    assert RN.trace_summary(t).head().asDict() == {"completed": 2, "failed": 1, "cached": 1, "aborted": 1, "total": 5}
    assert [tuple(r) for r in RN.failed_tasks(t).collect()] == [("c", "137")]
    assert RN.trace_summary(t.where("false")).head().total == 0
    f = spark.createDataFrame([("g", True, True), ("g", None, False)], "validator_type string, passed boolean, is_plasmid boolean")
    assert tuple(RN.report_summary(f).head()) == ("g", 2, 1, 1, 1)


def test_alignments(spark):
    d = spark.createDataFrame([("b", 5, 0), (None, None, 4), ("a", 9, 16), ("a", 2, 2048 + 256), ("a", 2, None)], "chrom string, pos long, flag int")
    assert [(r.chrom, r.pos) for r in A.sort_by_coordinate(d).collect()] == [("a", 2), ("a", 2), ("a", 9), ("b", 5), (None, None)]
    assert tuple(A.alignment_stats(d).head()) == (5, 4, 1, 1, 0, 4, 1)
    f = spark.createDataFrame([(95.0, 100), (95.0, 99), (89.9, 500), (None, 500)], "identity double, length long")
    assert A.filter_alignments(f).count() == 1
    p = spark.createDataFrame([(10, 20, 30, 3), (9, 20, 30, 3)], "coverage int, base_quality int, mapping_quality int, alternate_count int")
    assert A.callable_sites(p).count() == 1 and A.callable_sites(p, min_coverage=9).count() == 2
    q = spark.createDataFrame([("AC", "I!"), (None, None)], "seq string, qual string")
    assert {(r.quality, r.n) for r in A.quality_histogram(q).collect()} == {(40, 1), (0, 1)}
    assert [tuple(r) for r in A.length_histogram(q).collect()] == [(0, 1)]
    s = spark.createDataFrame([("s", 1)], "sample string, n int")
    assert A.pair_by_sample(s, s).columns == ["sample", "n", "n_mod"]
