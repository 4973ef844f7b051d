"""Commands from files to files."""

import gzip
import json

import pytest

from mixspark.plans import commands
from mixspark.schema import RANKS


def tsv(path):
    return [line.split("\t") for line in path.read_text().splitlines()]


@pytest.fixture
def inputs(tmp_path):
    (tmp_path / "in").mkdir()
    records = [f"r{i}\t0\t{1 + i % 2}:db:{i}\t1\t60\t50M2I1D3S\t*\t0\t0\t*\t*\tNM:i:{4 + i % 3}" for i in range(30)] + ["u1\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*"]
    (tmp_path / "in" / "A.sam").write_text("@HD\tVN:1\n" + "\n".join(records) + "\n")
    (tmp_path / "in" / "blank.sam").write_text("@HD\tVN:1\n")
    (tmp_path / "taxonomy.tsv").write_text("\t".join(["tax_id", *RANKS]) + "\n" + "".join(f"{i}\tGenus sp{i} x\tGenus\tF\tO\tC\tP\tK\n" for i in (1, 2)))
    return tmp_path


def test_abundance(spark, inputs):
    with pytest.warns(UserWarning, match="sample blank"):
        commands.abundance(spark, str(inputs / "in"), str(inputs / "taxonomy.tsv"), str(inputs / "out"), binomial_names=True, identical="")
    rows = tsv(inputs / "out" / "samples" / "A_rel-abundance.tsv")
    assert rows[0] == ["species", "abundance", "genus", "family", "order", "class", "phylum", "superkingdom", "estimated_counts", "identical_16s_species", "shared_read_fraction"]
    assert [r[0] for r in rows[1:]] == ["Genus sp1", "Genus sp2", "Below detection", "Unassigned"] and [r[8] for r in rows[1:]] == ["15", "15", "0", "1"]
    assert [r[0] for r in tsv(inputs / "out" / "samples" / "blank_rel-abundance.tsv")[1:]] == ["Below detection", "Unassigned"]
    counts = tsv(inputs / "out" / "otu_table_counts.tsv")
    assert counts == [["species", "A", "blank"], ["Genus sp1", "15", "0"], ["Genus sp2", "15", "0"], ["Below detection", "0", "0"], ["Unassigned", "1", "0"]]
    assert [r[0] for r in tsv(inputs / "out" / "sample_metadata.tsv")] == ["sample", "A", "blank"]
    # and on from the written tables
    folder = str(inputs / "out" / "samples")
    commands.consolidated(spark, folder, str(inputs / "again"))
    assert tsv(inputs / "again" / "otu_table_counts.tsv") == counts
    (path,) = commands.combined(spark, folder, "genus", str(inputs / "wide"), counts=True)
    assert path.endswith("/vi-combined-genus-counts.tsv") and ["Genus", "F", "O", "C", "P", "K", "30", "0"] in tsv(inputs / "wide" / "vi-combined-genus-counts.tsv")
    paths = commands.combined(spark, folder, "genus", str(inputs / "split"), split=True)
    assert [p.rsplit("/", 1)[1] for p in paths] == ["vi-combined-taxonomy-genus.tsv", "vi-combined-abundance-genus.tsv"]
    assert commands.collapsed(spark, f"{folder}/A_rel-abundance.tsv", "phylum", str(inputs / "flat")).endswith("/A_rel-abundance-phylum.tsv")
    assert tsv(inputs / "flat" / "A_rel-abundance-phylum.tsv")[0] == ["phylum", "superkingdom", "abundance", "estimated_counts"]


def test_samples_of_a_sheet_all_get_tables(spark, inputs):
    (inputs / "sheet.csv").write_text("sample,fastq\nA,/x/A.fastq\nlost,/x/lost.fq.gz\n")
    with pytest.warns(UserWarning, match="sample lost"):
        got = commands.abundance(spark, str(inputs / "in"), str(inputs / "taxonomy.tsv"), str(inputs / "out"), samples=str(inputs / "sheet.csv"), estimator="em")
    assert {r.sample for r in got.select("sample").collect()} == {"A", "lost"}
    (inputs / "sheet.csv").write_text("sample,fastq\nA!,/x/A.fastq\n")
    with pytest.raises(ValueError, match="bad sample id"):
        commands.listed_samples(spark, str(inputs / "sheet.csv"))


def test_tables_of_estimates(spark, inputs):
    (inputs / "e").mkdir()
    (inputs / "c").mkdir()
    summary = {"1": {"expected_reads": 6.0, "shared_reads": 3.0, "alpha": 6.5}, "2": {"expected_reads": 3.0, "shared_reads": 0.0, "alpha": 3.5}}
    (inputs / "e" / "S_abundance.json").write_text(json.dumps({"abundance": {"1": 0.6, "2": 0.4}, "below_detection_count": 1, "read_summary": summary}))
    (inputs / "c" / "S_counts.json").write_text(json.dumps({"assigned_count": 11, "unassigned_count": 2}))
    commands.tables_of_estimates(spark, str(inputs / "e"), str(inputs / "c"), str(inputs / "taxonomy.tsv"), str(inputs / "out"), credible_intervals=True)
    rows = tsv(inputs / "out" / "samples" / "S_rel-abundance.tsv")
    at = {c: k for k, c in enumerate(rows[0])}
    assert [(r[0], r[at["estimated_counts"]], r[at["shared_read_fraction"]]) for r in rows[1:]] == [("Genus sp1 x", "6", "0.5"), ("Genus sp2 x", "4", "0.0"), ("Below detection", "1", ""), ("Unassigned", "2", "")]


def test_missing_counts_warn(spark, tmp_path):
    (tmp_path / "A_rel-abundance.tsv").write_text("species\tabundance\testimated_counts\tgenus\tfamily\torder\tclass\tphylum\tsuperkingdom\nx\t1\t5\tG\tF\tO\tC\tP\tK\n")
    (tmp_path / "B_rel-abundance.tsv").write_text("species\tabundance\tgenus\tfamily\torder\tclass\tphylum\tsuperkingdom\nx\t1\tG\tF\tO\tC\tP\tK\n")
    with pytest.warns(UserWarning, match="sample B has no counts"):
        commands.consolidated(spark, str(tmp_path), str(tmp_path / "out"))
    assert tsv(tmp_path / "out" / "otu_table_counts.tsv") == [["species", "A", "B"], ["x", "5", "0"], ["Unassigned", "0", "0"]]
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "B_rel-abundance.tsv").write_text((tmp_path / "B_rel-abundance.tsv").read_text())
    with pytest.warns(UserWarning, match="no sample has counts"):
        commands.consolidated(spark, str(tmp_path / "only"), str(tmp_path / "bare"))
    assert not (tmp_path / "bare" / "otu_table_counts.tsv").exists()


def test_build_database(spark, tmp_path):
    with gzip.open(tmp_path / "in.fa.gz", "wt") as f:
        f.write(">s1 first\nAACCGGA\n>s2 turned\nTCCGGTT\n>s3\nACGTT\n>s4 unmapped\nTTTT\n")
    (tmp_path / "map.tsv").write_text("s1\t10\ns2\t20\ns3\t10\nghost\t30\n")
    (tmp_path / "list.tsv").write_text("id\t" + "\t".join(RANKS) + "\n" + "".join(f"{i}\tA sp{i}\tA\tF\tO\tC\tP\tK\n" for i in (30, 20, 10, 99)))
    got = commands.build_database(spark, str(tmp_path / "in.fa.gz"), str(tmp_path / "map.tsv"), "db", str(tmp_path / "out"), taxonomy_list=str(tmp_path / "list.tsv"))
    assert [(r.seq_id, r.seq) for r in got["sequences"].orderBy("n").collect()] == [("10:db:1", "AACCGGA"), ("20:db:2", "AACCGGA"), ("10:db:3", "ACGTT")]
    assert [r[0] for r in tsv(tmp_path / "out" / "taxonomy.tsv")] == ["tax_id", "30", "20", "10"]  # file order; an id of the map without a sequence stays
    assert [r[0] for r in tsv(tmp_path / "out" / "identical_16s.tsv")[1:]] == ["10", "20"]
    assert len(tsv(tmp_path / "out" / "cross_genus_identical.tsv")) == 1


def test_build_lineage_database(spark, tmp_path):
    line = "d__K;p__P;c__C;o__O;f__F;g__{g};s__{s}"
    rows = [("a", line.format(g="Z_A", s="Z_A one"), "ACGTACGT"), ("b", line.format(g="Z", s="Z one"), "TTTTCCCC"), ("c", line.format(g="Z", s="Z two"), "acgtacgt"), ("d", line.format(g="Y", s="Y ten"), "TTTTCCCC"), ("e", line.format(g="Y", s="Y ten"), "AC")]
    with gzip.open(tmp_path / "in.fna.gz", "wt") as f:
        f.writelines(f">{i}~c {lin} [n=1]\n{seq}\n" for i, lin, seq in rows)
    out = tmp_path / "merged"
    commands.build_lineage_database(spark, str(tmp_path / "in.fna.gz"), "db", str(out), min_length=4, merge_suffixes=True)
    assert (out / "species_taxid.fasta").read_text() == ">2:db:1\nACGTACGT\n>2:db:2\nTTTTCCCC\n>3:db:3\nacgtacgt\n>1:db:4\nTTTTCCCC\n"
    assert [r[:3] for r in tsv(out / "taxonomy.tsv")] == [["tax_id", "species", "genus"], ["1", "Y ten", "Y"], ["2", "Z one", "Z"], ["3", "Z two", "Z"]]
    assert tsv(out / "merged_species.tsv") == [["tax_id", "species", "gtdb_species_merged", "gtdb_species", "gtdb_genera", "ranks_in_conflict", "lineage_from"], ["2", "Z one", "2", "Z one;Z_A one", "Z;Z_A", "", "Z_A one"]]
    assert [r[0] for r in tsv(out / "identical_16s.tsv")[1:]] == ["2", "3"]
    assert [r[2] for r in tsv(out / "cross_genus_identical.tsv")[1:]] == ["2:db:2;1:db:4"]
    assert sorted(p.name for p in out.iterdir() if not p.name.startswith(".")) == ["cross_genus_identical.tsv", "identical_16s.tsv", "merged_species.tsv", "species_taxid.fasta", "taxonomy.tsv"]


def test_reports_are_in_order(spark, tmp_path):
    """Equal names by the number of the id; sequences across genera as first seen."""
    (tmp_path / "db.fasta").write_text("".join(f">{t}:db:{i}\n{s}\n" for i, (t, s) in enumerate([("10", "GG"), ("9", "GG"), ("x", "GG"), ("3", "TT"), ("4", "TT"), ("3", "AA"), ("4", "AA")], 1)))
    genera = {"10": "A", "9": "A", "x": "A", "3": "B", "4": "C"}
    (tmp_path / "taxonomy.tsv").write_text("\t".join(["tax_id", *RANKS]) + "\n" + "".join(f"{t}\tsame\t{g}\t\t\t\t\t\n" for t, g in genera.items()))
    commands.identical_reports(spark, str(tmp_path / "db.fasta"), str(tmp_path / "taxonomy.tsv"), str(tmp_path / "i.tsv"), str(tmp_path / "c.tsv"))
    assert [r[0] for r in tsv(tmp_path / "i.tsv")] == ["tax_id", "x", "9", "10"]
    assert [r[2] for r in tsv(tmp_path / "c.tsv")[1:]] == ["3:db:4;4:db:5", "3:db:6;4:db:7"]
