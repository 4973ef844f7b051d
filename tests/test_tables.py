import math

import pytest
from pyspark.sql import functions as F

from mixspark.operators import assemble, consolidate
from mixspark.schema import RANKS
from mixspark.sources import joining, writers

COLUMNS = "tax_id string, " + ", ".join(f"`{r}` string" for r in RANKS)
ESTIMATES = "sample string, tax_id long, abundance double, expected_reads double, shared_reads double, alpha double, below_detection long"


def lineage(species, genus="G"):
    return (species, genus, "F", "O", "C", "P", "K")


def taxonomy(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def counts(spark, *rows):
    return spark.createDataFrame(list(rows), "sample string, assigned long, unassigned long")


@pytest.mark.parametrize(
    "weights, total, want",
    [((0.5, 0.5), 10, [5, 5]), ((0.245, 0.155, 0.6), 597, [146, 93, 358]), ((1, 1, 1, 1), 2, [1, 1, 0, 0]), ((0.25, 0.25), 100, [50, 50]), ((0, 0), 10, [0, 0])],
)
def test_largest_remainder(spark, weights, total, want):
    rows = spark.createDataFrame([("s", i, float(w), total) for i, w in enumerate(weights)], "sample string, i long, w double, t long")
    got = assemble.largest_remainder(rows, "w", "t", ["sample"], ["i"], "n").orderBy("i").collect()
    assert [r.n for r in got] == want


def test_sample_table(spark):
    tax = taxonomy(spark, [("1", *lineage("Esch coli A")), ("2", *lineage("Esch coli B")), ("3", *lineage("Bac sub", "B")), ("1", *lineage("late twin")), ("4", *lineage(""))])
    est = spark.createDataFrame([("s", 1, 0.3, 60.0, 6.0, 60.2, 5), ("s", 2, 0.2, 30.0, 0.0, 30.2, 5), ("s", 3, 0.4, 10.0, 5.0, 10.2, 5), ("s", 9, 0.1, 1.0, 0.0, 1.2, 5)], ESTIMATES)
    ident = spark.createDataFrame([("1", "Esch coli B; Esch fer"), ("2", "Esch coli A; Esch fer")], "tax_id string, identical_16s_species string")
    ordered = tax.withColumn("ord", F.monotonically_increasing_id())
    got = assemble.sample_tables(est, counts(spark, ("s", 105, 30), ("blank", 0, 4)), ordered, ident, intervals=True, binomial=True)
    rows = [r.asDict() for r in got.where("sample = 's'").orderBy("row_ord").collect()]
    assert [r["species"] for r in rows] == ["Bac sub", "Esch coli", "Unknown taxid 9", "Below detection", "Unassigned"]
    assert [r["estimated_counts"] for r in rows] == [40, 50, 10, 5, 30]
    coli = rows[1]
    assert coli["abundance"] == pytest.approx(0.5) and coli["identical_16s_species"] == "Esch fer" and coli["shared_read_fraction"] == pytest.approx(6 / 90)
    assert 0 < coli["ci_lower"] < 90.4 / 101.8 < coli["ci_upper"] < 1
    assert rows[2]["genus"] == "Unknown taxid 9" and rows[4]["genus"] == "Unassigned"
    assert rows[3]["shared_read_fraction"] is None and rows[4]["ci_lower"] is None
    blank = got.where("sample = 'blank'").orderBy("row_ord").collect()
    assert [(r.species, r.estimated_counts) for r in blank] == [("Below detection", 0), ("Unassigned", 4)]


def test_single_species_interval(spark):
    est = spark.createDataFrame([("s", 1, 1.0, 9.0, 0.0, 9.0, 0)], ESTIMATES)
    row = assemble.sample_tables(est, counts(spark, ("s", 9, 0)), taxonomy(spark, [("1", *lineage("A b"))]), intervals=True).orderBy("row_ord").first()
    assert (row.ci_lower, row.ci_upper) == (1.0, 1.0)


def test_same_name_other_genus_stays_apart(spark):
    est = spark.createDataFrame([("s", 1, 0.5, 1.0, 0.0, 1.0, 0), ("s", 2, 0.5, 1.0, 0.0, 1.0, 0)], ESTIMATES)
    tax = taxonomy(spark, [("1", *lineage("A b", "A")), ("2", *lineage("A b", "Z"))])
    assert assemble.sample_tables(est, counts(spark, ("s", 2, 0)), tax).where("abundance > 0").count() == 2


def test_missing_ranks_are_unknown(spark):
    tax = spark.createDataFrame([("1", "A b")], "tax_id string, species string")
    got = assemble.with_lineage(spark.createDataFrame([("1",)], "tax_id string"), tax).first()
    assert got.genus == "Unknown" and got.superkingdom == "Unknown"
    with pytest.raises(ValueError):
        assemble.first_lineages(tax.drop("species"))


def tables(spark):
    rows = [
        ("A", 1, "x", "0.6", "6", *lineage("x")[1:]),
        ("A", 2, "x", "0.1", "1.9", *lineage("x", "other")[1:]),
        ("A", 3, "y", "-", "bad", *lineage("y")[1:]),
        ("A", 4, "unassigned", "0", "3", "", "", "", "", "", ""),
        ("B", 1, "x", "0.9", "9", *lineage("x")[1:]),
        ("B", 2, "Below detection", "0", "2", "", "", "", "", "", ""),
    ]
    return spark.createDataFrame(rows, "sample string, row_ord int, species string, abundance string, estimated_counts string, " + ", ".join(f"`{r}` string" for r in RANKS[1:]))


def test_consolidated(spark):
    t = tables(spark)
    a = {r.species: (r.A, r.B) for r in consolidate.otu_abundance(t, ["A", "B"]).collect()}
    assert a["x"] == pytest.approx((0.7, 0.9)) and a["y"] == (0, 0) and a["Unassigned"] == (0, 0)
    assert [r.species for r in consolidate.otu_abundance(t, ["A", "B"]).orderBy(*consolidate.species_order()).collect()] == ["x", "y", "Below detection", "Unassigned"]
    c = {r.species: (r.A, r.B) for r in consolidate.otu_counts(t, ["A", "B"]).collect()}
    assert c == {"x": (7, 9), "y": (0, 0), "Below detection": (0, 2), "Unassigned": (3, 0)}
    assert consolidate.otu_counts(t.drop("estimated_counts"), ["A"]) is None
    lines = {r.species: r.genus for r in consolidate.modal_lineages(t).collect()}
    assert lines == {"x": "G", "y": "G", "Below detection": "", "Unassigned": ""}
    meta = {r.sample: r for r in consolidate.sample_metadata(t).collect()}
    assert (meta["A"].n_taxa_detected, meta["A"].assigned_counts, meta["A"].unassigned_counts) == (1, 7, 3)
    assert math.isclose(meta["B"].total_abundance, 0.9) and meta["B"].assigned_counts == 11


def test_ties_in_lineage_go_to_the_first(spark):
    t = tables(spark).where("sample = 'A'")
    assert {r.species: r.genus for r in consolidate.modal_lineages(t).collect()}["x"] == "G"


def test_collapse_and_combine(spark):
    t = tables(spark).where("abundance <> 'bad' AND estimated_counts <> 'bad'")
    got = {(r.sample, r.genus): (r.abundance, r.estimated_counts) for r in consolidate.collapse(t, "genus").collect()}
    assert got["A", "G"] == pytest.approx((0.6, 6.0)) and got["B", "G"] == (0.9, 9.0)
    wide = {r.genus: (r.A, r.B) for r in consolidate.combine(tables(spark), "genus", ["A", "B"]).collect()}
    assert wide["G"] == pytest.approx((0.6, 0.9)) and wide["other"] == (0.1, 0.0)
    n = {r.genus: (r.A, r.B) for r in consolidate.combine(tables(spark), "genus", ["A", "B"], counts=True).collect()}
    assert n["other"] == (2, 0)
    tax, ab = consolidate.combine(tables(spark), "genus", ["A", "B"], split=True)
    assert tax.columns == RANKS[1:] and ab.columns == ["genus", "A", "B"]
    for wrong in (lambda: consolidate.collapse(t, "kingdom"), lambda: consolidate.combine(t.drop("estimated_counts"), "genus", ["A"], counts=True), lambda: consolidate.combine(t, "genus", [])):
        with pytest.raises(ValueError):
            wrong()


def test_matrices_as_arrays(spark, tmp_path):
    """Arrays hold what the pivot's columns hold, and are written as the same file."""
    t = tables(spark)
    for metric, wide in (("abundance", consolidate.otu_abundance(t, ["A", "B"])), ("estimated_counts", consolidate.otu_counts(t, ["A", "B"]))):
        got = {r.species: r["values"] for r in consolidate.otu_arrays(t, ["A", "B"], metric).collect()}
        assert got == {r.species: [r.A, r.B] for r in wide.collect()}
        writers.write_tsv(wide, str(tmp_path / "wide.tsv"), consolidate.species_order())
        writers.write_matrix(consolidate.otu_arrays(t, ["A", "B"], metric), ["A", "B"], str(tmp_path / "arrays.tsv"), consolidate.species_order())
        assert (tmp_path / "wide.tsv").read_text() == (tmp_path / "arrays.tsv").read_text()
    assert consolidate.otu_arrays(t.drop("estimated_counts"), ["A"], "estimated_counts") is None
    for counts in (False, True):
        wide = {tuple(r)[:-2]: list(r)[-2:] for r in consolidate.combine(t, "genus", ["A", "B"], counts).collect()}
        assert {tuple(r)[:-1]: r["values"] for r in consolidate.combined_arrays(t, "genus", ["A", "B"], counts).collect()} == wide


def test_many_samples(spark, tmp_path):
    """20,000 samples are no 20,000 aggregates."""
    names = [f"s{i:05}" for i in range(20_000)]
    ranks = ", ".join(f"'{r}' AS `{r}`" for r in RANKS[1:])
    rows = spark.range(20_000).selectExpr("concat('s', lpad(id, 5, '0')) AS sample", "1 AS row_ord", "concat('x', id % 3) AS species", "CAST(id AS string) AS abundance", "CAST(id AS string) AS estimated_counts", *ranks.split(", "))
    writers.write_matrix(consolidate.otu_arrays(rows, names, "estimated_counts"), names, str(tmp_path / "m.tsv"), consolidate.species_order())
    lines = [x.split("\t") for x in (tmp_path / "m.tsv").read_text().splitlines()]
    assert [x[0] for x in lines] == ["species", "x0", "x1", "x2", "Unassigned"] and lines[0][1:] == names
    assert all(int(lines[1 + k][1 + i]) == (i if i % 3 == k else 0) for k in range(3) for i in range(0, 20_000, 371)) and set(lines[4][1:]) == {"0"}


def test_joined_files_are_whole_or_absent(spark, tmp_path, monkeypatch):
    table = spark.range(5000).selectExpr("id", "concat('v', id) AS v").repartition(6)
    writers.write_tsv(table, str(tmp_path / "t.tsv"), [table["id"]])
    assert (tmp_path / "t.tsv").read_text().splitlines() == ["id\tv", *(f"{i}\tv{i}" for i in range(5000))]
    monkeypatch.setattr(joining, "parts_of", lambda *_: [(None, 5)])
    with pytest.raises(Exception):
        writers.write_tsv(table, str(tmp_path / "u.tsv"))
    assert not (tmp_path / "u.tsv").exists() and not (tmp_path / "u.tsv.joining").exists()
