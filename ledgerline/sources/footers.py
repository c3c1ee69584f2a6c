"""Storage figures from parquet footers, as a data source: ``spark.read.format("parquet_footers").load(folder)``.

One row per file, row group and column: rows, values, nulls, compressed and raw bytes, codec, least and greatest value as text. Footers
are read in tasks, a group of files each; no data page is. The paths are those of ``pyarrow.fs`` (plain, ``file``, ``hdfs``, ``s3``,
``gs``); hidden files and those of other kinds are left out. Predicates on ``file`` and ``column_name`` with constants are tested
before rows are made, one on ``file`` before a footer is read.

A file without row groups gives one row with nulls for the row group and column, so that files without rows count too. A column
without statistics has null for nulls, least and greatest.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from ledgerline.functions.text import size_text

FORMAT = "parquet_footers"
SCHEMA = pa.schema(
    [
        ("file", pa.string()),
        ("file_bytes", pa.int64()),
        ("row_group", pa.int32()),
        ("n_rows", pa.int64()),
        ("column_name", pa.string()),
        ("n_values", pa.int64()),
        ("n_nulls", pa.int64()),
        ("compressed_bytes", pa.int64()),
        ("raw_bytes", pa.int64()),
        ("codec", pa.string()),
        ("least", pa.string()),
        ("greatest", pa.string()),
    ]
)
_KINDS = {pa.string(): "string", pa.int64(): "bigint", pa.int32(): "int"}

_TESTS = {EqualTo: lambda v, f: v == f.value, In: lambda v, f: v in f.value, StringStartsWith: lambda v, f: v is not None and v.startswith(f.value)}


def _file_system(path: str):
    from pyarrow import fs

    if urlsplit(path).scheme:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _text(value) -> str | None:
    if value is None:
        return None
    return value.decode("utf-8", "replace") if isinstance(value, bytes) else str(value)


def footer_rows(name: str, size: int, opened, wanted=lambda column: True) -> Iterator[dict]:
    """The rows of one file."""
    import pyarrow.parquet as pq

    found = pq.ParquetFile(opened).metadata
    if not found.num_row_groups:
        yield {"file": name, "file_bytes": size, "n_rows": 0}
    for g in range(found.num_row_groups):
        group = found.row_group(g)
        for c in range(group.num_columns):
            column = group.column(c)
            if not wanted(column.path_in_schema):
                continue
            known = column.statistics
            bounds = known is not None and known.has_min_max
            yield {
                "file": name,
                "file_bytes": size,
                "row_group": g,
                "n_rows": group.num_rows,
                "column_name": column.path_in_schema,
                "n_values": column.num_values,
                "n_nulls": known.null_count if known is not None and known.has_null_count else None,
                "compressed_bytes": column.total_compressed_size,
                "raw_bytes": column.total_uncompressed_size,
                "codec": column.compression,
                "least": _text(known.min) if bounds else None,
                "greatest": _text(known.max) if bounds else None,
            }


@dataclass
class Files(InputPartition):
    files: list[tuple[str, int]]


class FooterReader(DataSourceReader):
    """Options: ``path``, a file or folder; ``filesPerTask`` (default 64)."""

    def __init__(self, options):
        if "path" not in options:
            raise ValueError("parquet_footers needs a path")
        self.path = options["path"]
        self.per_task = int(options.get("filesPerTask", 64))
        self.file_tests: list[Filter] = []
        self.column_tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if type(f) in _TESTS and f.attribute == ("file",):
                self.file_tests.append(f)
            elif type(f) in _TESTS and f.attribute == ("column_name",):
                self.column_tests.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        store, path = _file_system(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        listed = [info] if info.is_file else store.get_file_info(fs.FileSelector(path, recursive=True))
        root = info.path if not info.is_file else posixpath.dirname(info.path)
        files = []
        for f in listed:
            below = f.path[len(root) :].strip("/").split("/")
            if f.is_file and f.path.endswith(".parquet") and not any(p.startswith(("_", ".")) for p in below):
                if all(_TESTS[type(t)](f.path, t) for t in self.file_tests):
                    files.append((f.path, f.size))
        files.sort()
        return [Files(files[i : i + self.per_task]) for i in range(0, len(files), self.per_task)] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _file_system(self.path)
        tests = self.column_tests

        def wanted(column: str) -> bool:
            return all(_TESTS[type(t)](column, t) for t in tests)

        for name, size in partition.files:
            with store.open_input_file(name) as opened:
                rows = [r for r in footer_rows(name, size, opened, wanted) if "column_name" in r or not tests]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)


class ParquetFooters(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ", ".join(f"{f.name} {_KINDS[f.type]}" for f in SCHEMA)

    def reader(self, schema) -> FooterReader:
        return FooterReader(self.options)


def footers(spark: SparkSession, path: str, files_per_task: int = 64) -> DataFrame:
    """The footers below a path, one row per file, row group and column."""
    spark.dataSource.register(ParquetFooters)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(FORMAT).option("filesPerTask", str(files_per_task)).load(path)


def table_figures(read: DataFrame) -> DataFrame:
    """One row for all: files, row groups, rows, bytes on disk, of column data, and raw, and the first as text."""
    per_group = read.groupBy("file", "row_group").agg(
        F.max("file_bytes").alias("file_bytes"), F.max("n_rows").alias("n_rows"), F.sum("compressed_bytes").alias("c"), F.sum("raw_bytes").alias("r")
    )
    per_file = per_group.groupBy("file").agg(
        F.max("file_bytes").alias("b"), F.count("row_group").alias("g"), F.sum("n_rows").alias("n"), F.sum("c").alias("c"), F.sum("r").alias("r")
    )
    sums = {"n_row_groups": "g", "n_rows": "n", "file_bytes": "b", "column_bytes": "c", "raw_bytes": "r"}
    zero = F.lit(0).cast("bigint")
    out = per_file.agg(F.count(F.lit(1)).alias("n_files"), *[F.coalesce(F.sum(c), zero).alias(name) for name, c in sums.items()])
    return out.withColumn("total", size_text(F.col("file_bytes")))


def column_figures(read: DataFrame, kind: str = "string") -> DataFrame:
    """Per column: values, nulls, bytes on disk and raw, and bounds over all row groups, compared as ``kind``.

    Nulls and bounds are null where a row group has none stated, for then the footers don't tell.
    """
    rows = read.filter(F.col("column_name").isNotNull())
    # A row group without rows, or of nothing but nulls, has no bounds, and none are missed.
    nulls = F.when(F.col("n_values") == 0, F.lit(0)).otherwise(F.col("n_nulls"))
    stated = F.bool_and(F.col("least").isNotNull() | F.coalesce(nulls == F.col("n_values"), F.lit(False)))
    return rows.groupBy("column_name").agg(
        F.sum("n_values").alias("n_values"),
        F.when(F.bool_and(nulls.isNotNull()), F.sum(nulls)).alias("n_nulls"),
        F.sum("compressed_bytes").alias("column_bytes"),
        F.sum("raw_bytes").alias("raw_bytes"),
        F.when(stated, F.min(F.col("least").try_cast(kind))).alias("least"),
        F.when(stated, F.max(F.col("greatest").try_cast(kind))).alias("greatest"),
    )
