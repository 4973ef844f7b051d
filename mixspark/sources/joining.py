"""Single files made of parts that tasks have written side by side."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Files that are joined side by side.
AT_ONCE = 8


def file_system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def parts_of(fs, folder) -> list:
    """The part files of a folder with their sizes, in the order of their tasks."""
    found = [(f.getPath(), f.getLen()) for f in fs.listStatus(folder)]
    numbered = [(re.match(r"part-(\d+)-.*?(?:\.c(\d+))?(?:\.|$)", p.getName()), p, n) for p, n in found]
    return [(p, n) for m, p, n in sorted(((m, p, n) for m, p, n in numbered if m), key=lambda x: (int(x[0][1]), int(x[0][2] or 0)))]


def join_parts(spark: SparkSession, folder: str, path: str, head: bytes = b"", tail: bytes = b"", trim: int = 0) -> None:
    """The parts in ``folder``, without their last ``trim`` bytes, as one file; the folder goes.

    Bytes stream from file to file; no task and no Python process holds them. The file
    gets its name when it is whole, so a failure leaves no half of it.
    """
    fs, at = file_system(spark, path)
    jvm, waiting = spark._jvm, at(f"{path}.joining")
    out = fs.create(waiting, True)
    try:
        if head:
            out.write(bytearray(head))
        for part, size in parts_of(fs, at(folder)):
            if size > trim:
                stream = fs.open(part)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, size - trim, False)
                finally:
                    stream.close()
        if tail:
            out.write(bytearray(tail))
    except BaseException:
        out.close()
        fs.delete(waiting, False)
        raise
    out.close()
    fs.delete(at(path), True)
    if not fs.rename(waiting, at(path)):
        raise OSError(f"can't give {path} its name")
    fs.delete(at(folder), True)


def join_by_sample(spark: SparkSession, folder: str, ending: str, **options) -> None:
    """The parts of each ``sample=...`` folder as a file with the sample's name."""
    fs, at = file_system(spark, folder)
    names = [f.getPath().getName() for f in fs.listStatus(at(folder))]
    samples = [n.removeprefix("sample=") for n in names if n.startswith("sample=")]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(lambda s: join_parts(spark, f"{folder}/sample={s}", f"{folder}/{s}{ending}", **options), samples))
