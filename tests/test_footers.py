"""Storage figures from footers against the library that wrote the files, and DuckDB's reading of them."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import row_set
from pyspark.sql import functions as F

from ledgerline.sources import footers as f


@pytest.fixture
def folder(tmp_path):
    table = pa.table({"id": pa.array(range(1000), pa.int64()), "name": [None if i % 7 == 0 else f"n{i}" for i in range(1000)], "none": pa.nulls(1000, pa.int32())})
    (tmp_path / "t" / "p=1").mkdir(parents=True)
    pq.write_table(table, tmp_path / "t" / "a.parquet", row_group_size=300)
    pq.write_table(table.slice(0, 10), tmp_path / "t" / "p=1" / "b.parquet", compression="zstd")
    pq.write_table(table.slice(0, 0), tmp_path / "t" / "empty.parquet")
    pq.write_table(table, tmp_path / "t" / "_hidden.parquet")
    (tmp_path / "t" / "_SUCCESS").write_text("")
    (tmp_path / "t" / "notes.txt").write_text("no table")
    return str(tmp_path / "t")


FILES = ("a.parquet", "p=1/b.parquet", "empty.parquet")


def test_rows_equal_duckdb(spark, folder):
    got = f.footers(spark, folder, files_per_task=1).filter("row_group is not null")
    names = ", ".join(f"'{folder}/{x}'" for x in FILES)
    want = duckdb.sql(
        "SELECT file_name, row_group_id, row_group_num_rows, path_in_schema, num_values, stats_null_count, total_compressed_size, "
        f"total_uncompressed_size, compression, stats_min_value, stats_max_value FROM parquet_metadata([{names}]) WHERE row_group_num_rows > 0"
    ).fetchall()
    columns = ["file", "row_group", "n_rows", "column_name", "n_values", "n_nulls", "compressed_bytes", "raw_bytes", "codec", "least", "greatest"]
    got = got.filter("n_rows > 0")
    assert row_set(got, *columns) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert got.rdd.getNumPartitions() == 3


def test_figures_of_the_table(spark, folder):
    import os

    figures = f.table_figures(f.footers(spark, folder)).first()
    assert (figures.n_files, figures.n_rows) == (3, 1010)
    assert figures.file_bytes == sum(os.path.getsize(f"{folder}/{x}") for x in FILES)
    meta = [pq.ParquetFile(f"{folder}/{x}").metadata for x in FILES]
    groups = [m.row_group(g) for m in meta for g in range(m.num_row_groups)]
    assert figures.n_row_groups == len(groups)
    assert figures.column_bytes == sum(g.column(c).total_compressed_size for g in groups for c in range(3))
    assert figures.raw_bytes == sum(g.total_byte_size for g in groups)


def test_figures_of_columns(spark, folder):
    read = f.footers(spark, folder)
    got = {r.column_name: r for r in f.column_figures(read).collect()}
    assert (got["name"].n_values, got["name"].n_nulls, got["name"].greatest) == (1010, 145, "n999")
    assert (got["none"].n_nulls, got["none"].least) == (1010, None)
    by_number = f.column_figures(read.filter("column_name = 'id'"), "bigint").first()
    assert (by_number.least, by_number.greatest) == (0, 999)


def test_predicates_reach_the_reader(spark, folder):
    read = f.footers(spark, folder)
    one = read.filter((F.col("file") == f"{folder}/a.parquet") & F.col("column_name").isin("id", "name"))
    assert {(r.file, r.column_name) for r in one.collect()} == {(f"{folder}/a.parquet", c) for c in ("id", "name")}
    reader = f.FooterReader({"path": folder})
    left = list(reader.pushFilters([f.EqualTo(("file",), f"{folder}/a.parquet"), f.EqualTo(("column_name",), "id"), f.EqualTo(("n_rows",), 1)]))
    assert len(left) == 1 and [p.files[0][0] for p in reader.partitions()] == [f"{folder}/a.parquet"]
    assert {r.column("column_name")[0].as_py() for p in reader.partitions() for r in reader.read(p)} == {"id"}


def test_single_file_empty_folder_and_missing_path(spark, folder, tmp_path):
    assert f.table_figures(f.footers(spark, f"{folder}/a.parquet")).first().n_rows == 1000
    (tmp_path / "nothing").mkdir()
    assert f.table_figures(f.footers(spark, str(tmp_path / "nothing"))).first().n_files == 0
    with pytest.raises(Exception, match="nowhere"):
        f.footers(spark, str(tmp_path / "nowhere")).collect()
