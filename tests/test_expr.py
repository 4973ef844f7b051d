import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixspark.functions import expr, special


def values(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_names(spark):
    got = values(spark, expr.binomial_name(F.col("x")), [("Escherichia coli O157",), ("Candidatus Pelagibacter ubique HTCC",), ("Candidatusx a b",), ("One",)])
    assert got == ["Escherichia coli", "Candidatus Pelagibacter ubique", "Candidatusx a", "One"]
    got = values(spark, expr.strip_suffix(F.col("x")), [("Delta_E",), ("Bacillus_AB subtilis_C",), ("X_ABC y",), ("a_b",), ("T_A1",)])
    assert got == ["Delta", "Bacillus subtilis", "X_ABC y", "a_b", "T_A1"]


def test_lineage_strings(spark):
    line = "d__Bacteria;p__P;c__;o__O;f__F;g__G;s__G s"
    got = {r: values(spark, expr.lineage_rank(F.col("x"), r), [(line,), ("d__A;d__B",)]) for r in expr.LINEAGE_PREFIXES}
    assert got["superkingdom"] == ["Bacteria", "B"] and got["class"] == ["", ""] and got["species"] == ["G s", ""] and got["family"] == ["F", ""]
    parts = expr.lineage_of_header(F.col("x"))
    headers = [(f">gen~contig {line} [len=5] [x=1]",), (">nolineage",), (">a b__x",), (f"gen2 {line}",)]
    assert values(spark, parts["genome"], headers) == ["gen", None, None, "gen2"]
    assert values(spark, parts["lineage"], headers) == [line, None, None, line]


def test_cigar(spark):
    c = expr.cigar_counts(expr.cigar_totals(F.col("cigar")), F.col("nm"))
    rows = spark.createDataFrame([("4S100M2I", 5), ("100M1D", 2), (None, None), ("10M2=3X4N5H6P", None)], "cigar string, nm long").select(*[v.alias(k) for k, v in c.items()]).collect()
    assert [tuple(r) for r in rows] == [(2, 0, 4, 3, 106), (0, 1, 0, 1, 101), (0, 0, 0, 0, 0), (0, 0, 0, 0, 10)]


def test_sequences(spark):
    assert values(spark, expr.reverse_complement(F.col("x")), [("ACGTN",), ("RYKM",), ("acgt",)]) == ["NACGT", "KMRY", "acgt"]
    a, b = values(spark, expr.sequence_md5(F.col("x")), [("acgt",), ("ACGT",)])
    assert a == b
    assert values(spark, expr.sequence_id(F.col("x")), [(">s1 rest",), ("s2\tx",)]) == ["s1", "s2"]
    assert values(spark, expr.mean_quality(F.col("x")), [("!!",), ("+5",), ("",)]) == [0.0, 15.0, None]


def test_labels_and_numbers(spark):
    assert values(spark, expr.normal_species(F.col("x")), [(" a ",), ("",), (None,), ("nan",), ("uNassigned",)]) == ["a", *["Unassigned"] * 4]
    assert values(spark, expr.truncated_count(F.col("x")), [("2.9",), ("-1.9",), ("-",), (None,), ("x",)]) == [2, -1, 0, 0, 0]
    rows = spark.createDataFrame([("x10",), ("9",), ("10",), ("2",)], "t string").orderBy(*expr.tax_id_order(F.col("t"))).collect()
    assert [r.t for r in rows] == ["2", "9", "10", "x10"]


def test_special_functions(spark):
    assert abs(special.digamma(np.array([1.0]))[0] + 0.5772156649015329) < 1e-13
    assert abs(special.digamma(np.array([0.5]))[0] + 1.9635100260214235) < 1e-13
    got = values(spark, special.digamma_column(F.col("x")), [(1e-4,), (0.3,), (7.0,), (1e5,)], "x double")
    assert np.allclose(got, special.digamma(np.array([1e-4, 0.3, 7.0, 1e5])), rtol=1e-12)
    assert special.beta_quantile(0.025, 60.2, 40.4) == pytest.approx(0.50145, abs=1e-5)
    assert special.beta_quantile(0.975, 60.2, 40.4) == pytest.approx(0.69166, abs=1e-5)
    assert special.beta_quantile(0.5, 3, 0) == 1.0
    assert special.dirichlet_entropy(np.ones(2)) == pytest.approx(0.0, abs=1e-12)
    assert special.dirichlet_divergence(np.array([2.0, 3.0]), np.array([2.0, 3.0])) == pytest.approx(0, abs=1e-12)
    shares = spark.createDataFrame([(0.25,)] * 4 + [(0.0,)], "p double").select(special.effective_number(F.col("p"))).first()[0]
    assert shares == pytest.approx(4)
    assert math.isclose(special.beta_cdf(0.5, 2, 2), 0.5)
