"""Secret scans over an incremental ledger of content-addressed blobs.

The ledger has one row per blob and rule version that was ever scanned.  A
scan takes any set of (path, version) texts, addresses them by SHA-256, scans
only the pairs of blob and rule version that the ledger lacks, appends those,
and joins the findings back to every path that holds the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The base rules, in the order in which equal starts are listed.
# (kind, pattern, flags, group, least length of that group)
RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     re.IGNORECASE | re.ASCII, 2, 8),
    # A run that is too short can't hold a longer match, so the least lengths
    # of the next two stand in their patterns.
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 0, 32),
    # Further spans; the base kinds above are never changed by them.
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, 1),
    ("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0, 40),
)
BASE_KINDS = ("assign", "access", "hex")
RULE_VERSION = "2"

_FOUND = "blob binary, kinds array<int>, starts array<int>, ends array<int>"
_LEDGER = "blob binary, kinds array<int>, starts array<int>, ends array<int>, rule_version string"


def find_spans(text: str, rules=RULES) -> list[tuple[int, int, int]]:
    """(start, rule number, end) of every finding in code points, by start and rule."""
    out = []
    for k, (_, pattern, flags, group, least) in enumerate(rules):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return sorted(out)


def _scan(rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [find_spans(t.as_py(), rules) for t in b.column(1)]
            cols = [pa.array([[s[i] for s in f] for f in found], pa.list_(pa.int32())) for i in (1, 0, 2)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["blob", "kinds", "starts", "ends"])
    return run


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger at ``path``, or None before the first scan."""
    try:
        return spark.read.schema(_LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan_versions(versions: DataFrame, ledger_path: str, rules=RULES, rule_version: str = RULE_VERSION) -> DataFrame:
    """Findings of every row of ``versions``: its columns but ``text``, then blob, kinds, starts, ends.

    ``versions`` has ``text`` and any columns that name the path and version.
    A null text counts as empty.  ``kinds`` holds rule numbers; the arrays are
    empty for a row without findings, and no row is left out.  Repeated rows
    stay repeated.  Columns named like the four result columns are replaced.

    Copies are merged by hash aggregation on (address, bytes) before and after
    the one shuffle of texts, so a blob that a third of all rows share crosses
    the network once per map task and is scanned once.  Blobs are re-read from
    the written ledger for the join back, where AQE may broadcast them or
    split hot addresses.
    """
    spark = versions.sparkSession
    names = [c for c in versions.columns if c not in ("text", "blob", "kinds", "starts", "ends")]
    rows = versions.select(*names, F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2("text", 256)))
    blobs = rows.select("blob", "text")
    seen = read_ledger(spark, ledger_path)
    if seen is not None:
        blobs = blobs.join(seen.filter(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
    fresh = blobs.distinct().mapInArrow(_scan(rules), _FOUND).withColumn("rule_version", F.lit(rule_version))
    fresh.write.mode("append").parquet(ledger_path)
    found = (read_ledger(spark, ledger_path)
             .filter((F.col("rule_version") == rule_version) & (F.size("kinds") > 0)).drop("rule_version"))
    none = F.array().cast("array<int>")
    return (rows.drop("text").join(found, "blob", "left")
            .select(*names, "blob", *(F.coalesce(c, none).alias(c) for c in ("kinds", "starts", "ends"))))


def span_digests(found: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans from ``scan_versions``' arrays."""
    names = F.array(*(F.lit(r[0]) for r in rules))
    at = F.arrays_zip("kinds", "starts", "ends")
    text = lambda x: F.concat_ws(":", F.get(names, x["kinds"]), x["starts"].cast("string"), x["ends"].cast("string"))
    base = [k for k, r in enumerate(rules) if r[0] in BASE_KINDS]
    count = lambda kind: F.size(F.filter("kinds", lambda k: k == [r[0] for r in rules].index(kind))).cast("long")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(F.concat_ws(",", F.transform(F.filter(at, lambda x: x["kinds"].isin(base)), text)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform(at, text)).alias("spans"))
