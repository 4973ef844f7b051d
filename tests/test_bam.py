"""BAM files written, split and read again; ends of ranges at every kind of place."""

import random
import struct
import zlib

import pyarrow as pa
import pytest

from mixspark.sources import bam, readers, writers


def made(n, seed=0, samples=("a b", "z")):
    rng = random.Random(seed)
    return [
        (rng.choice(samples), i, f"read/{i}:{'x' * rng.randint(0, 60)}", rng.choice([0, 4, 16, 256, 2048]), rng.choice([None, "1:d:1", "22:d:9", "3:d:3"]), rng.choice([None, "4S10M2I", f"{rng.randint(1, 1 << 20)}M3D"]), rng.choice([None, 0, 7, 70_000]))
        for i in range(n)
    ]


SCHEMA = "sample string, ord long, read string, flag int, ref string, cigar string, nm long"
FIELDS = ["sample", "read", "flag", "ref", "cigar", "nm"]


@pytest.fixture
def ranges(spark):
    """Ranges of a few kilobytes, so that a file has many."""

    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("block", [300, 65_280])
def test_written_files_are_read_by_ranges(spark, tmp_path, monkeypatch, ranges, block):
    rows = made(1200, block)
    monkeypatch.setattr(bam, "BLOCK", block)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    writers.write_sample_bams(frame, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith((".", "_"))) == ["a b.bam", "z.bam"]
    for size in ("100m", "3k"):
        ranges(size)
        got = [tuple(r) for r in readers.read_bam(spark, str(tmp_path / "out")).orderBy("ord").select(*FIELDS).collect()]
        want = [(s, *rest) for s, _, *rest in sorted(rows)]
        assert got == want, size
    writers.write_sample_lines(writers.sam_lines(frame), str(tmp_path / "sam"), ".sam")
    assert [tuple(r) for r in readers.read_sam(spark, str(tmp_path / "sam")).orderBy("ord").select(*FIELDS).collect()] == got


def test_long_records_span_ranges_and_headers_do(spark, tmp_path, ranges):
    """Records of many blocks (long tags), a header of many blocks, an empty file and one without records."""
    rng = random.Random(3)
    names = [f"{i}:db:{i}" for i in range(4000)]
    head = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", len(names)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", 9) for n in names)

    def record(i):
        raw = bam.encoded_record(f"r{i}", 0, rng.randrange(4000), "5M", i)[4:] + b"XZZ" + bytes(rng.randrange(33, 127) for _ in range(rng.choice([10, 20_000]))) + b"\0"
        return struct.pack("<i", len(raw)) + raw

    def blocks(data, size=1500):
        return b"".join(bam.MARK + bam.packed(data[i : i + size]) for i in range(0, len(data), size)) + bam.END

    data = head + b"".join(record(i) for i in range(60))
    (tmp_path / "long.bam").write_bytes(blocks(data))
    (tmp_path / "none.bam").write_bytes(blocks(head))
    for size in ("100m", "20k"):
        ranges(size)
        got = readers.read_bam(spark, str(tmp_path)).orderBy("ord").collect()
        assert [(r.sample, r.read, r.nm) for r in got] == [("long", f"r{i}", i) for i in range(60)] and all(r.ref in set(names) for r in got)
    (tmp_path / "cut.bam").write_bytes(blocks(data[:-20]))
    with pytest.raises(Exception, match="no whole records"):
        readers.read_bam(spark, str(tmp_path)).collect()


def test_separator_inside_a_block_belongs_to_it():
    """Stored (not deflated) data can hold the bytes that begin a block."""
    data = b"BAM\1" + struct.pack("<ii", 0, 0) + bam.encoded_record("r", 4, -1, None, 5)[:-7] + b"NMi" + struct.pack("<i", 5)
    data = data.replace(b"r\0", b"r\0")
    inner = data + b""
    store = zlib.compressobj(0, zlib.DEFLATED, -15)
    tagged = bam.encoded_record("q", 4, -1, None, None)[4:] + b"XZZ" + b"ab" + bam.MARK.replace(b"\0", b"\1") + b"\0"
    inner += struct.pack("<i", len(tagged)) + tagged
    raw = bam.encoded_record("s", 4, -1, None, None)[4:] + b"XBBC" + struct.pack("<i", len(bam.MARK)) + bam.MARK
    inner += struct.pack("<i", len(raw)) + raw
    body = store.compress(inner) + store.flush()
    block = struct.pack("<H", 18 + len(body) + 8 - 1) + body + struct.pack("<II", zlib.crc32(inner), len(inner))
    parts = block.split(bam.MARK)
    assert len(parts) == 2
    parser = bam.BlockRange("f", 0)
    out = list(parser.feed(pa.array([b"", *parts], pa.binary()))) + list(parser.finish())
    reads = [r["read"] for b in out for r in b.to_pylist() if r["kind"] == bam.RECORD]
    assert reads == ["r", "q", "s"]


def test_many_records_at_once_are_as_one_by_one():
    """Columns of a batch, sliced or not, and of records with other tags, against the plain functions."""
    rows = [(read, flag, -1 if ref is None else int(ref[0]), cigar, nm) for _, _, read, flag, ref, cigar, nm in made(500)]
    rows += [("", 4, -1, "", -5), ("é", 65_535, 7, f"{(1 << 28) - 1}=1X", 2**31 - 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64()))], names=["read", "flag", "ref_id", "cigar", "nm"])
    plain = [bam.encoded_record(*r) for r in rows]
    assert bam.encoded_records(batch) == b"".join(plain)
    assert bam.encoded_records(batch.slice(3, 40)) == b"".join(plain[3:43])
    other = [b"XAAz", b"NMC\7", b"NMs\xff\xff", b"XZZNMC\7\0NMc\xfb", b"XBBC\3\0\0\0NMC", b""]
    for i, tags in enumerate(other):
        raw = bam.encoded_record(f"t{i}", 0, 1, "5M1I", None)[4:] + tags
        plain.append(struct.pack("<i", len(raw)) + raw)
    data, at = b"".join(plain), [sum(map(len, plain[:i])) for i in range(len(plain))]
    got = bam.records_at(data, at)
    want = [bam.record_fields(p[4:]) for p in plain]
    assert list(zip(*[got[c].to_pylist() for c in ("read", "flag", "ref_id", "cigar", "nm")])) == want
    for bad in ("M", "3Q", f"{1 << 28}M"):
        with pytest.raises(ValueError):
            bam.encoded_records(pa.RecordBatch.from_pylist([{"read": "r", "flag": 0, "ref_id": 0, "cigar": bad, "nm": 1}]))
