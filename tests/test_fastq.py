"""FASTQ records across the ends of ranges."""

import gzip
import random

import pytest

from mixspark.sources import fastq, readers


@pytest.fixture
def ranges(spark):
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def records(n, seed, tricky):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.randint(1, 200)
        letters = "@+" if tricky else "ACGT"
        out.append((f"r{i}", "".join(rng.choice(letters) for _ in range(size)), "".join(rng.choice("@+!I") for _ in range(size))))
    return out


@pytest.mark.parametrize("tricky", [False, True])
def test_ranges_of_any_size(spark, tmp_path, ranges, tricky):
    made = {"one": records(90, 1, tricky), "two b": records(40, 2, tricky), "three": records(20, 3, tricky)}
    text = {k: "".join(f"@{r} more\n{s}\n+\n{q}\n" for r, s, q in v) for k, v in made.items()}
    (tmp_path / "one.fastq").write_text(text["one"] + "@cut\nACGT\n+\n")
    (tmp_path / "two b.fq").write_text(text["two b"].rstrip("\n"))
    (tmp_path / "three.fastq.gz").write_bytes(gzip.compress(text["three"].encode()))
    for size in ("100m", "4k", "700"):
        ranges(size)
        got = {}
        for r in readers.read_fastq(spark, str(tmp_path)).orderBy("ord").collect():
            got.setdefault(r.sample, []).append((r.read, r.seq, r.qual))
        assert got == made, size


def test_sequences_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.fq").write_text("@r\nAC\n+\nII\n")
    plan = readers.read_fastq(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "path" in plan.split("Exchange hashpartitioning")[1][:30]  # of the ends


def test_where_a_record_begins():
    lines = ["GATT", "+", "IIII", "@r2", "AC", "+", "@+", "@r3", "A", "+x", "I"]
    assert fastq.first_record(lines) == 3
    assert fastq.first_record(["@", "+", "+", "@"] * 9) is None and fastq.first_record([]) is None


def test_wrong_borders_are_an_error():
    end = fastq.LineRange("f", 0, True)
    out = list(end.feed(fastq.pa.array(["@r", "A", "+", "I", "@r2"]))) + list(end.finish())
    late = fastq.LineRange("f", 100, True)
    out += [late.end(fastq.HEAD, ["A"])]
    with pytest.raises(ValueError, match="four lines"):
        list(fastq._joined(iter(out)))
