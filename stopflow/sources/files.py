"""File sources: JSON (array or line-delimited), CSV, Parquet, manifests.

Pass an explicit schema wherever one is known: it skips the inference pass
(a full extra read) and keeps text columns as text (CSV inference would turn
``04601`` into 4601 and ``23:45:00`` into a timestamp).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopflow.sources.paths import data_files, exists, first_line, is_folder
from stopflow.sources.ranges import array_records, csv_records, parsed_csv, parsed_json
from stopflow.sources.sniff import found_files, header_names

FORMATS = {".json": "json", ".geojson": "json", ".ndjson": "json", ".csv": "csv", ".parquet": "parquet", ".pq": "parquet"}


def is_json_array(spark: SparkSession, path: str) -> bool:
    """True when the first data file of ``path`` holds a JSON array."""
    files = data_files(spark, path)
    return bool(files) and first_line(spark, files[0]).startswith(b"[")


def _split_bytes(spark: SparkSession, given: int | None) -> int:
    return given or spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def _together(parts: list[DataFrame]) -> DataFrame:
    """The union by name; a column that the parts type differently is text."""
    kinds: dict[str, set[str]] = {}
    for df in parts:
        for c, kind in df.dtypes:
            kinds.setdefault(c, set()).add(kind)
    text = {c for c, of in kinds.items() if len(of) > 1}
    out = None
    for df in parts:
        df = df.withColumns({c: F.col(f"`{c}`").cast("string") for c in df.columns if c in text})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None,
              multi_line: bool | None = None, split_bytes: int | None = None) -> DataFrame:
    """Read JSON arrays, single documents or line-delimited JSON, also mixed in one folder.

    With ``multi_line=None`` each file's layout is found from its beginning
    by a task of its own, local or remote, and all records of all files come
    back.  Line-delimited files are split over tasks.  So are array files of
    more than ``split_bytes`` (default: the session's scan split size), cut
    into records by ``ranges.array_records`` and written once to the shared
    folder; smaller ones and single documents are read by a task each.  A
    record that can't be parsed fails the read; none becomes a row of nulls.
    Without a schema, a column that the layouts type differently is text.
    """
    def reader(lines_span: bool):
        r = spark.read.option("multiLine", lines_span).option("mode", "FAILFAST")
        return r.schema(schema) if schema is not None else r

    if multi_line is not None:
        return reader(multi_line).json(path)
    if not exists(spark, path):
        raise ValueError(f"nothing found at {path}")
    limit = _split_bytes(spark, split_bytes)
    by_kind: dict[str, list[str]] = {}
    large_bytes = 0
    for f in found_files(spark, path, "json"):
        kind = f.kind if f.kind == "lines" else "large" if f.kind == "array" and f.size > limit else "document"
        by_kind.setdefault(kind, []).append(f.path)
        large_bytes += f.size if kind == "large" else 0
    alone = len(by_kind) < 2
    parts = [reader(kind == "document").json(path if alone else by_kind[kind]) for kind in ("lines", "document") if kind in by_kind]
    if "large" in by_kind:
        parts.append(parsed_json(array_records(spark, by_kind["large"], limit, large_bytes), schema))
    return _together(parts) if parts else reader(False).json(path)


def read_feature_collection(spark: SparkSession, path: str, schema: T.StructType | None = None,
                            multi_line: bool | None = None) -> DataFrame:
    """Read GeoJSON FeatureCollection documents (one row per document), each file by its own layout."""
    return read_json(spark, path, schema, multi_line)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             columns: list[str] | None = None, multi_line: bool | None = None, split_bytes: int | None = None) -> DataFrame:
    """Read header CSV as text (all columns string unless ``schema`` says otherwise).

    Quotes inside quoted fields are doubled, and quoted fields may hold line
    breaks.  With ``multi_line=None`` files of more than ``split_bytes``
    (default: the session's scan split size) are cut into records by
    ``ranges.csv_records`` in many tasks, and smaller ones are read by a task
    each; ``multi_line=False`` says that no field holds a line break, so that
    Spark's reader may split all, and ``True`` that none shall be split.
    Every file is read by its own header, found by a task: files of one
    folder may order their columns differently.  Without a schema only the
    headers are read for the column names (no type inference pass).
    """
    def reader():
        return (spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"').option("multiLine", multi_line is not False)
                .option("enforceSchema", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))

    if not exists(spark, path):
        raise ValueError(f"nothing found at {path}")
    if schema is not None or columns is not None:
        schema = schema or T.StructType([T.StructField(c, T.StringType()) for c in columns])
    limit = _split_bytes(spark, split_bytes) if multi_line is None else None
    by_header: dict[tuple[tuple[str, ...], str], list[str]] = {}
    sizes: dict[tuple[tuple[str, ...], str], int] = {}
    for f in found_files(spark, path, "csv"):
        large = limit is not None and f.size > limit
        layout = (header_names(f.kind), "small" if not large else "returns" if f.kind.endswith("\r") else "feeds")
        by_header.setdefault(layout, []).append(f.path)
        sizes[layout] = sizes.get(layout, 0) + f.size
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    out = None
    for (header, size), files in sorted(by_header.items()):
        own = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
        if size != "small":
            part = parsed_csv(csv_records(spark, files, limit, size == "returns", sizes[header, size]), own)
        else:
            part = reader().schema(own).csv(files if len(by_header) > 1 else path)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if schema is None:
        return out if out is not None else spark.createDataFrame([], "value string").limit(0)
    if out is None:
        return spark.createDataFrame([], schema)
    return out.select(*(F.col(f"`{f.name}`") if f.name in out.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Read Parquet; with ``columns`` only those are read (column pruning)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Dispatch on the file extension: json / geojson / ndjson / csv / parquet / pq (a folder without one is JSON)."""
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    fmt = FORMATS.get(ext) or ("json" if not ext and is_folder(spark, path) else None)
    if fmt is None:
        raise ValueError(f"unsupported input format {ext!r} for {path}; expected one of {sorted(FORMATS)}")
    if not exists(spark, path):
        raise ValueError(f"nothing found at {path}")
    if fmt == "json":
        return read_json(spark, path, schema)
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return read_parquet(spark, path)


def file_manifest(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Every file under ``path`` with its size and modification time,
    largest first.  Only metadata columns are selected, so no file
    content is read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path).select("path", "length", "modificationTime")
    return (df.withColumn("name", F.element_at(F.split("path", "/"), -1))
            .select("name", "path", "length", "modificationTime")
            .orderBy(F.col("length").desc(), F.col("path")))


def largest_file(spark: SparkSession, folder: str, extensions: tuple[str, ...] = (".json", ".csv"),
                 exclude: tuple[str, ...] = ()) -> str:
    """Path of the largest file under ``folder`` with one of ``extensions``
    (ties by path), skipping names in ``exclude``; ``ValueError`` when none.

    Only file metadata is listed (no content read); one row comes back.
    """
    m = file_manifest(spark, folder)
    ok = F.lower(F.col("name")).rlike("(" + "|".join(e.replace(".", "\\.") + "$" for e in extensions) + ")")
    if exclude:
        ok = ok & ~F.col("name").isin(*exclude)
    row = m.filter(ok).select("path").first()
    if row is None:
        raise ValueError(f"no {'/'.join(extensions)} file under {folder}")
    return row.path


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Read a small metrics document (one JSON object per line)."""
    return spark.read.json(path)
