import gzip
import struct

import pytest

from mixspark.sources import readers, writers


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text("junk\n>s1 first\nACgt  \nAC\n\n>s2\n")
    with gzip.open(tmp_path / "b.fa.gz", "wt") as f:
        f.write(">s3\nTT\nTT\n")
    got = readers.read_fasta(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.header, r.seq) for r in got] == [("s1 first", "ACgtAC"), ("s2", ""), ("s3", "TTTT")]


def test_fastq_and_discovery(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "s.1.fastq").write_text("@r1 x\nACGT\n+\n@@@@\n@r2\nA\n+\n!\n")
    with gzip.open(tmp_path / "t.fq.gz", "wt") as f:
        f.write("@r3\nCC\n+\nII\n")
    (tmp_path / "other.txt").write_text("no")
    got = readers.read_fastq(spark, str(tmp_path)).orderBy("ord").collect()
    assert {(r.sample, r.read, r.seq, r.qual) for r in got} == {("s.1", "r1", "ACGT", "@@@@"), ("s.1", "r2", "A", "!"), ("t", "r3", "CC", "II")}
    assert [r.sample for r in readers.discover(spark, str(tmp_path)).collect()] == ["s.1", "t"]
    (tmp_path / "in" / "t.fastq").write_text("")
    with pytest.raises(ValueError, match="more than one file"):
        readers.discover(spark, str(tmp_path))


def test_sam(spark, tmp_path):
    (tmp_path / "x.sam").write_text("@HD\tVN:1\n@SQ\tSN:1:d:1\tLN:9\nr1\t0\t1:d:1\t1\t0\t4M\t*\t0\t0\tACGT\t*\tAS:i:9\tNM:i:2\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tA\t*\n")
    (tmp_path / "y.sam").write_text("@HD\tVN:1\n")
    got = [tuple(r) for r in readers.read_sam(spark, str(tmp_path)).select("sample", "read", "flag", "ref", "cigar", "nm").orderBy("read").collect()]
    assert got == [("x", "r1", 0, "1:d:1", "4M", 2), ("x", "r2", 4, None, None, None)]


def bam_record(name, flag, ref, ops, nm):
    body = struct.pack("<iiBBHHHiiii", ref, 0, len(name) + 1, 0, 0, len(ops), flag, 3, -1, -1, 0) + name.encode() + b"\0"
    body += b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for n, o in ops) + b"\x12\x30" + b"\xff" * 3
    body += b"XZZhello\0" + b"XBBs" + struct.pack("<ihh", 2, 1, 2) + b"NMC" + bytes([nm])
    return struct.pack("<i", len(body)) + body


def test_bam(spark, tmp_path):
    header = b"@HD\tVN:1\n"
    raw = b"BAM\1" + struct.pack("<i", len(header)) + header + struct.pack("<i", 1) + struct.pack("<i", 6) + b"1:d:1\0" + struct.pack("<i", 100)
    raw += bam_record("r1", 256, 0, [(4, "S"), (10, "M"), (2, "I")], 7) + bam_record("r2", 4, -1, [], 0)
    (tmp_path / "z.bam").write_bytes(gzip.compress(raw[:40]) + gzip.compress(raw[40:]))
    got = [tuple(r) for r in readers.read_bam(spark, str(tmp_path)).select("sample", "read", "flag", "ref", "cigar", "nm").orderBy("ord").collect()]
    assert got == [("z", "r1", 256, "1:d:1", "4S10M2I", 7), ("z", "r2", 4, None, None, 0)]


def test_tables(spark, tmp_path):
    (tmp_path / "nodes.dmp").write_text("1\t|\t1\t|\tno rank\t|\n2\t|\t1\t|\tspecies\t|\n")
    (tmp_path / "names.dmp").write_text("1\t|\troot\t|\t\t|\tscientific name\t|\n1\t|\tall\t|\t\t|\tsynonym\t|\n")
    assert [tuple(r) for r in readers.read_nodes(spark, str(tmp_path / "nodes.dmp")).collect()] == [("1", "1", "no rank"), ("2", "1", "species")]
    assert [tuple(r) for r in readers.read_names(spark, str(tmp_path / "names.dmp")).collect()] == [("1", "root")]
    (tmp_path / "map.tsv").write_text("a\t1\nb\t2\n")
    assert [(r.seq_id, r.tax_id) for r in readers.read_seq2tax(spark, str(tmp_path / "map.tsv")).collect()] == [("a", "1"), ("b", "2")]
    (tmp_path / "bad.tsv").write_text("a\t1\t9\n")
    with pytest.raises(Exception, match="not two fields"):
        readers.read_seq2tax(spark, str(tmp_path / "bad.tsv")).collect()
    (tmp_path / "i.tsv").write_text("tax_id\tother\n1\tx\n")
    assert readers.read_identical(spark, None) is None
    assert readers.read_identical(spark, "").count() == readers.read_identical(spark, str(tmp_path / "i.tsv")).count() == 0
    (tmp_path / "s1_counts.json").write_text('{"assigned_count": 3, "unassigned_count": 1}')
    assert tuple(readers.read_counts(spark, str(tmp_path / "s1_counts.json")).first()) == ("s1", 3, 1)


def test_samplesheet(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text("sample,fastq\na,/x/a.fq\nb!,/x/b.fastq.gz\nc,/x/c.txt\na,/y/a.fq\n")
    got = {(r.sample, r.fault) for r in readers.samplesheet_faults(readers.read_samplesheet(spark, str(tmp_path / "sheet.csv"))).collect()}
    assert got == {("b!", "bad sample id"), ("c", "not a FASTQ name"), ("a", "sample more than once")}


def test_empty_samplesheet_is_an_error(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text("sample,fastq\n")
    with pytest.raises(ValueError, match="no rows"):
        readers.read_samplesheet(spark, str(tmp_path / "sheet.csv"))


def test_split_files_keep_their_order(spark, tmp_path):
    """Files read in many small ranges come back whole and in order."""
    (tmp_path / "b.fa").write_text("".join(f">s{i} x\n{'ACGT' * (i % 9)}\n{'GG' * (i % 5)}\n" for i in range(900)))
    (tmp_path / "a.fa").write_text(">first\nAC\n")
    (tmp_path / "r.fastq").write_text("".join(f"@r{i} x\n{'A' * (i % 40)}\n+\n{'@' * (i % 40)}\n" for i in range(700)))
    (tmp_path / "t.tsv").write_text("tax_id\tname\n" + "".join(f"{i}\tname {i}\n" for i in range(800)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        fasta = readers.read_fasta(spark, str(tmp_path / "*.fa")).orderBy("ord").collect()
        assert [(r.header, r.seq) for r in fasta] == [("first", "AC")] + [(f"s{i} x", "ACGT" * (i % 9) + "GG" * (i % 5)) for i in range(900)]
        fastq = readers.read_fastq(spark, str(tmp_path)).orderBy("ord").collect()
        assert [(r.read, r.seq, r.qual) for r in fastq] == [(f"r{i}", "A" * (i % 40), "@" * (i % 40)) for i in range(700)]
        assert [r.tax_id for r in readers.read_tsv(spark, str(tmp_path / "t.tsv")).orderBy("ord").collect()] == [str(i) for i in range(800)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_estimates(spark, tmp_path):
    (tmp_path / "s1_abundance.json").write_text('{"abundance": {"12": 0.75, "3": 0.25}, "below_detection_count": 4, "read_summary": {"12": {"expected_reads": 7.5, "shared_reads": 1, "alpha": 8}, "3": {"expected_reads": 2, "shared_reads": 0}}}')
    (tmp_path / "s2_abundance.json").write_text('{"abundance": {}, "below_detection_count": 0}')
    got = sorted((tuple(r) for r in readers.read_estimates(spark, str(tmp_path)).collect()), key=str)
    assert got == [("s1", 12, 0.75, 7.5, 1.0, 8.0, 4), ("s1", 3, 0.25, 2.0, 0.0, None, 4), ("s2", None, None, None, None, None, 0)]


def test_sample_tables_round_trip(spark, tmp_path):
    (tmp_path / "A_rel-abundance.tsv").write_text("species\tabundance\tgenus\testimated_counts\nx\t0.5\tG\t7\n")
    (tmp_path / "B_rel-abundance.tsv").write_text("species\tgenus\tabundance\nx\t\t0.5\n")
    (tmp_path / "A_rel-abundance-genus.tsv").write_text("genus\tabundance\nG\t1\n")
    got = readers.read_sample_tables(spark, str(tmp_path)).collect()
    assert sorted((r.sample, r.species, r.abundance, r.genus or "", r.estimated_counts) for r in got) == [("A", "x", "0.5", "G", "7"), ("B", "x", "0.5", "", None)]
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no .*rel-abundance"):
        readers.read_sample_tables(spark, str(tmp_path / "none"))


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b:d:2", "ACGTAC"), (1, "a:d:1", "AC")], "n long, seq_id string, seq string")
    writers.write_fasta(rows, str(tmp_path / "f"), wrap=4)
    assert [(r.header, r.seq) for r in readers.read_fasta(spark, str(tmp_path / "f")).orderBy("ord").collect()] == [("a:d:1", "AC"), ("b:d:2", "ACGTAC")]
    writers.write_tsv(rows.limit(0), str(tmp_path / "t"))
    assert (tmp_path / "t").read_text() == "n\tseq_id\tseq\n"
    assert writers.combined_name("genus", True) == "vi-combined-genus-counts.tsv" and writers.combined_name("genus", True, "taxonomy") == "vi-combined-taxonomy-genus.tsv"
