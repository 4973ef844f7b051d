import pytest

from mixspark.operators import refdb
from mixspark.operators.graph import linked_groups
from mixspark.plans import api

LINE = "d__B;p__P;c__C;o__O;f__F;g__{g};s__{s}"


def sequences(spark, rows):
    return spark.createDataFrame([(i, h, s) for i, (h, s) in enumerate(rows)], "ord long, header string, seq string")


def test_build_from_lineages(spark):
    h = lambda g, s: f">gen~c {LINE.format(g=g, s=s)} [x=1]"
    rows = [(h("Z", "Z a"), "ACGT" * 3), (h("A", "A b"), "AC" * 6), (h("Z", "Z a"), "acgt" * 3), (h("Z", "Z a"), "AC"), (">bad header", "ACGT" * 4), (h("C", "C c"), "A")]
    fasta, tax = refdb.build_from_lineages(sequences(spark, rows), "db", 10)
    assert [(r.tax_id, r.species) for r in tax.orderBy("tax_id").collect()] == [("1", "A b"), ("2", "C c"), ("3", "Z a")]
    assert [r.seq_id for r in fasta.orderBy("n").collect()] == ["3:db:1", "1:db:2"]


def test_merged_species(spark):
    h = lambda g, s: f">gen~c {LINE.format(g=g, s=s)} [x=1]"
    rows = [(h("D_E", "D_E x"), "A" * 5), (h("D", "D_A x"), "A" * 20), (h("D", "D x"), "C" * 20), (h("E", "E y_A"), "A" * 20)]
    parsed = refdb.parsed_headers(sequences(spark, rows), True)
    got = refdb.merged_species(parsed, 10).collect()
    assert [(r.species, r.source_species, r.conflict_ranks, r.lineage_from) for r in got] == [("D x", "D x;D_A x", "", "D_E x")]


def test_reverse_complements_are_one(spark):
    rows = spark.createDataFrame([(0, "t2", "d0", "AACC"), (1, "t1", "d1", "GGTT"), (2, "t2", "d2", "AACC"), (3, "t1", "d3", "aacc")], "ord long, tax_id string, description string, seq string")
    got = refdb.reduced_fasta(refdb.unique_sequences(rows), "db").orderBy("n").collect()
    assert [(r.seq_id, r.seq, r.description) for r in got] == [("t2:db:1", "AACC", "d0; d2"), ("t1:db:2", "AACC", "d1"), ("t1:db:3", "aacc", "d3")]


def tree(spark):
    nodes = [("1", "1", "no rank"), ("2", "1", "superkingdom"), ("20", "2", "phylum"), ("200", "20", "genus"), ("287", "200", "species"), ("9", "287", "strain"), ("7", "1", "no rank")]
    names = [(i, "root" if i == "1" else f"n{i}") for i, _, _ in nodes]
    return spark.createDataFrame(nodes, "tax_id string, parent string, rank string"), spark.createDataFrame(names, "tax_id string, name string")


def test_tree(spark):
    nodes, names = tree(spark)
    ids = spark.createDataFrame([("9",), ("200",)], "tax_id string")
    got = {r.tax_id: r for r in refdb.lineages(ids, nodes, names).collect()}
    assert (got["9"].species, got["9"].genus, got["9"].family, got["9"].superkingdom) == ("n287", "n200", "", "n2")
    assert {r.tax_id: r.ranked_id for r in refdb.ranked_ancestor(ids, nodes).collect()} == {"9": "287", "200": "200"}
    for bad in ("7", "404"):
        with pytest.raises(Exception, match="no ranked ancestor"):
            refdb.ranked_ancestor(spark.createDataFrame([(bad,)], "tax_id string"), nodes).collect()
    with pytest.raises(Exception, match="not in the tree"):
        refdb.lineages(spark.createDataFrame([("404",)], "tax_id string"), nodes, names).collect()


def test_deep_walks(spark):
    """A chain of 200 nodes, the topmost of a rank counts, the root's own rank does not."""
    rank = lambda i: {3: "superkingdom", 5: "phylum", 9: "phylum", 150: "genus"}.get(i, "no rank")
    nodes = spark.createDataFrame([("1", "1", "species"), *((str(i), str(i - 1), rank(i)) for i in range(2, 201))], "tax_id string, parent string, rank string")
    names = nodes.selectExpr("tax_id", "concat('n', tax_id) AS name")
    ids = spark.createDataFrame([("200",), ("149",), ("2",), ("1",)], "tax_id string")
    got = {r.tax_id: (r.species, r.genus, r.phylum, r.superkingdom) for r in refdb.lineages(ids, nodes, names).collect()}
    assert got == {"200": ("", "n150", "n5", "n3"), "149": ("", "", "n5", "n3"), "2": ("", "", "", ""), "1": ("", "", "", "")}
    assert {r.tax_id: r.ranked_id for r in refdb.ranked_ancestor(ids, nodes).collect()} == {"200": "150", "149": "9", "2": "1", "1": "1"}


def test_loops_and_lost_parents_are_errors(spark):
    nodes = spark.createDataFrame([("1", "1", "no rank"), ("2", "1", "genus"), ("5", "6", "x"), ("6", "7", "x"), ("7", "5", "x"), ("8", "404", "species"), ("9", "8", "x")], "tax_id string, parent string, rank string")
    one = lambda i: spark.createDataFrame([(i,)], "tax_id string")
    assert refdb.ranked_ancestor(one("2"), nodes).first().ranked_id == "2"  # others' faults do not matter
    with pytest.raises(ValueError, match="up from 6 .*loop"):
        refdb.ranked_ancestor(one("6"), nodes)
    with pytest.raises(ValueError, match="up from 9 leaves the tree at 404"):
        refdb.ranked_ancestor(one("9"), nodes)


def test_linked_groups(spark):
    links = [(f"n{i:03}", f"n{i + 1:03}") for i in range(40)] + [("x", "y"), ("z", "y"), ("q", None)]
    got = {r.node: r.group for r in linked_groups(spark.createDataFrame(links, "a string, b string")).collect()}
    assert {got[f"n{i:03}"] for i in range(41)} == {"n000"} and got["x"] == got["y"] == got["z"] == "x" and "q" not in got


def carried(spark):
    seqs = [("1", "AA"), ("2", "aa"), ("2", "CC"), ("3", "CC"), ("4", "GG"), ("5", "GG"), ("6", "AA"), ("7", "AA"), ("8", "TT")]
    rows = spark.createDataFrame([(i, f"{t}:db:{i}", s) for i, (t, s) in enumerate(seqs)], "ord long, seq_id string, seq string")
    tax = [("1", "Al a", "Al"), ("2", "Al b", "Al"), ("3", "Al c", "Al"), ("4", "De d", "De_E"), ("5", "De e", "De"), ("6", "Om o", "Om"), ("7", "Blank", ""), ("8", "Al t", "Al")]
    taxa = spark.createDataFrame([(t, s, g, f"F{g}", "P") for t, s, g in tax], "tax_id string, species string, genus string, family string, phylum string")
    return refdb.carriers(rows, taxa)


def test_identical_groups(spark):
    got = {r.species: r for r in refdb.identical_groups(carried(spark)).collect()}
    assert {s: (r.group, r.group_size) for s, r in got.items()} == {"Al a": ("G1", 3), "Al b": ("G1", 3), "Al c": ("G1", 3), "De d": ("G2", 2), "De e": ("G2", 2)}
    assert got["Al b"].identical_16s_species == "Al a; Al c" and got["Al a"].identical_16s_species == "Al b"


def test_cross_genus(spark):
    (r,) = refdb.cross_genus(carried(spark)).collect()
    assert (r.species_count, r.tax_ids, r.genera, r.sequence_ids) == (3, "1;2;6", "Al;Om", "1:db:0;2:db:1;6:db:6")


def test_build_database(spark):
    seqs = sequences(spark, [("a one", "AACC"), ("b two", "GGTT"), ("c", "TTTT"), ("unmapped", "CCCC")])
    listed = spark.createDataFrame([(0, "5", "Sp y", "Ge", "n"), (1, "4", "Sp x", "Ge", "m"), (2, "6", "Sp z", "Ge", "k")], "ord long, id string, species string, genus string, note string").selectExpr("ord", "id", "species", "genus", "'F' AS family", "'P' AS phylum", "note")
    seq2tax = spark.createDataFrame([("a", "9", 0), ("b", "5", 1), ("c", "5", 2), ("a", "4", 3)], "seq_id string, tax_id string, ord long")
    got = api.build_database(seqs, seq2tax, "db", taxonomy_list=listed)
    assert [r.seq_id for r in got["sequences"].orderBy("n").collect()] == ["4:db:1", "5:db:2", "5:db:3"]
    assert [(r.tax_id, r.note) for r in got["taxonomy"].collect()] == [("5", "n"), ("4", "m")]
    assert {r.species for r in got["identical"].collect()} == {"Sp x", "Sp y"}
    with pytest.raises(ValueError):
        api.build_database(seqs, seq2tax, "db")


def test_outputs_of_a_database_come_from_written_sequences(spark):
    sequences = spark.createDataFrame([(1, "a", "ACGT"), (2, "b", "ACGT"), (3, "c", "GGGG")], "ord long, header string, seq string")
    mapped = spark.createDataFrame([("a", "1", 1), ("b", "2", 2), ("c", "2", 3)], "seq_id string, tax_id string, ord long")
    taxa = spark.createDataFrame([(1, "1", "s1", "g1", "f", "", "", "p", "k"), (2, "2", "s2", "g2", "f", "", "", "p", "k")], ["ord", "tax_id", "species", "genus", "family", "order", "class", "phylum", "superkingdom"])
    got = api.build_database(sequences, mapped, "db", taxonomy_list=taxa)
    plans = {k: v._jdf.queryExecution().executedPlan().toString() for k, v in got.items()}
    assert sorted((r.n, r.tax_id, r.seq) for r in got["sequences"].collect()) == [(1, "1", "ACGT"), (2, "2", "ACGT"), (3, "2", "GGGG")]
    assert [(r.species_count, r.genera) for r in got["cross_genus"].collect()] == [(2, "g1;g2")]
    assert "Exchange" not in plans["sequences"] and plans["cross_genus"].count("FileScan") == 1
