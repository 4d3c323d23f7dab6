"""Paths through the filesystem that Spark itself uses.

The same calls serve local folders, a cluster's default filesystem and remote
stores, so a path means here what it means to a reader.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# A first line of this many bytes without an end is one document on one line.
LONGEST_FIRST_LINE = 64 << 20


def filesystem(spark: SparkSession, path: str):
    """The filesystem that holds ``path``, and the path in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = filesystem(spark, path)
    return fs.exists(at)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, at = filesystem(spark, path)
    return fs.exists(at) and fs.getFileStatus(at).isDirectory()


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The non-empty data files that a reader of ``path`` reads, in order (hidden and underscore names left out)."""
    fs, at = filesystem(spark, path)
    if not fs.exists(at):
        raise ValueError(f"nothing found at {path}")
    out = []
    for s in sorted(fs.listStatus(at), key=lambda s: s.getPath().toString()):
        name = s.getPath().getName()
        if s.isDirectory():
            if "=" in name:  # a partition folder
                out += data_files(spark, s.getPath().toString())
        elif s.getLen() > 0 and not name.startswith((".", "_")):
            out.append(s.getPath().toString())
    return out


def first_line(spark: SparkSession, path: str) -> bytes:
    """The first non-blank line of a (possibly compressed) file, or its first LONGEST_FIRST_LINE bytes."""
    fs, at = filesystem(spark, path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(at)
    stream, got = fs.open(at), b""
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        size = 4096
        while len(got) < LONGEST_FIRST_LINE and (part := bytes(stream.readNBytes(size))):
            got = (got + part).lstrip()
            if b"\n" in got:
                return got.split(b"\n", 1)[0].strip()
            size = min(2 * size, 4 << 20)
        return got.strip()
    finally:
        stream.close()
