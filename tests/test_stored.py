"""Scores in buckets of reads: the same numbers, and no shuffle by read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixspark.operators import estimate, graph
from mixspark.operators.graph import written
from mixspark.sources import stored


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(2)
    rows = [(s, f"r{i}", int(t), float(-rng.random() * 5)) for s in ("a", "b") for i in range(200) for t in rng.choice(9, 3, replace=False)]
    return spark.createDataFrame(rows, "sample string, read string, tax_id long, log_score double")


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["em", "vb"])
def test_steps_need_no_shuffle_by_read(spark, scores, tmp_path, name):
    start, step = (estimate.em_start, estimate.em_step) if name == "em" else (estimate.start_state, estimate.vb_step)
    path = str(tmp_path / "scores")
    stored.store_scores(scores, path, 8)
    spark.sql(f"DROP TABLE {stored._name(path)}")  # as in a later session
    table = stored.stored_scores(spark, path)
    state = written(start(table), "state")
    by_read = "hashpartitioning(sample#"
    out = step(table, state)
    exchanges = [x for x in plan_of(out).split("\n") if "Exchange hashpartitioning" in x]
    assert exchanges and not any("read#" in x for x in exchanges)
    plain = step(scores, state)
    assert any("read#" in x and by_read in x for x in plan_of(plain).split("\n"))
    value = "freq" if name == "em" else "alpha"
    got = {(r.sample, r.tax_id): r[value] for r in out.collect()}
    assert got == pytest.approx({(r.sample, r.tax_id): r[value] for r in plain.collect()})


def test_written_again(spark, scores, tmp_path):
    path = str(tmp_path / "scores")
    stored.store_scores(scores, path, 4)
    again = stored.store_scores(scores.where("sample = 'a'"), path, 2)
    assert again.count() == stored.stored_scores(spark, path).count() == scores.where("sample = 'a'").count()


@pytest.mark.parametrize("known", [{}, {"rows": 5000}])
def test_buckets_grow_with_the_scores(spark, scores, tmp_path, monkeypatch, known):
    """No task sorts more than some part of them, counted or named."""
    monkeypatch.setattr(graph, "ROWS", 100)
    path = str(tmp_path / "scores")
    stored.store_scores(scores, path, 2, **known)
    spark.sql(f"DROP TABLE {stored._name(path)}")  # as in a later session
    table = stored.stored_scores(spark, path)
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {stored._name(path)}").collect()}
    assert int(described["Num Buckets"]) == known.get("rows", scores.count()) // 100
    assert sorted(table.collect()) == sorted(scores.collect())
    assert max(r["count"] for r in table.groupBy(F.input_file_name()).count().collect()) < scores.count() / 4
