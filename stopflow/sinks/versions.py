"""Tables that are never without a readable version.

A table is a folder of versions.  A writer fills a new one, which no reader
sees, and only then lists it under ``_versions`` by creating one empty file
whose name holds a number and the version's folder; the highest number is
current.  A job that ends in mid-write leaves the version before as it was,
and creating a file needs no rename, so object stores do as well as
filesystems.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stopflow.sinks.publish import write_table
from stopflow.sources.paths import filesystem

LIST = "_versions"


@dataclass(frozen=True, order=True)
class Version:
    number: int
    folder: str


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The complete versions of a table, oldest first; two writers that took one number go by the names of their folders."""
    fs, at = filesystem(spark, f"{path.rstrip('/')}/{LIST}")
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(Version(int(n), folder) for n, _, folder in (x.partition(".") for x in names) if n.isdigit() and folder)


def publish_version(df: DataFrame, path: str, keep: int = 2, **options) -> Version:
    """Write ``df`` as the table's next version and make it current.

    ``options`` go to :func:`write_table`.  The ``keep`` newest versions stay,
    so that readers of the one before aren't cut off; older ones are taken
    from the list first and then deleted.  What an ended job has left unlisted
    stays until :func:`remove_unlisted`.
    """
    if keep < 1:
        raise ValueError("at least the current version must be kept")
    spark, root = df.sparkSession, path.rstrip("/")
    folder = f"v-{uuid.uuid4().hex}"
    write_table(df, f"{root}/{folder}", mode="errorifexists", **options)
    known = versions(spark, root)
    new = Version(known[-1].number + 1 if known else 1, folder)
    fs, at = filesystem(spark, f"{root}/{LIST}/{new.number:012d}.{folder}")
    fs.mkdirs(at.getParent())
    fs.create(at, False).close()
    for old in versions(spark, root)[:-keep]:
        fs.delete(filesystem(spark, f"{root}/{LIST}/{old.number:012d}.{old.folder}")[1], False)
        fs.delete(filesystem(spark, f"{root}/{old.folder}")[1], True)
    return new


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The current version of a table, or the one of a number that is still kept."""
    found = [v for v in versions(spark, path) if number is None or v.number == number]
    if not found:
        raise ValueError(f"no version {'' if number is None else f'{number} '}of a table at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{found[-1].folder}")


def remove_unlisted(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders of versions that were never listed and return their names; run it while nothing writes the table."""
    listed = {v.folder for v in versions(spark, path)}
    fs, at = filesystem(spark, path)
    lost = sorted(s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().startswith("v-"))
    lost = [n for n in lost if n not in listed]
    for name in lost:
        fs.delete(filesystem(spark, f"{path.rstrip('/')}/{name}")[1], True)
    return lost
