"""Folders whose files disagree about column types."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from trafficlens.sources import dataset as DS

SCHEMA = T.StructType([T.StructField("CLASS", T.IntegerType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.LongType())])


def rows(spark, root):
    return sorted((tuple(r) for r in DS.normalise_foreign(spark, str(root), SCHEMA).collect()), key=str)


def test_drifting_types_missing_and_extra_columns(spark, tmp_path):
    (tmp_path / "x").mkdir()
    pq.write_table(pa.table({"CLASS": pa.array([1, 2, 3], pa.int64()), "a": pa.array([5, None, 7], pa.int64()), "b": pa.array([2**40, 1, None])}),
                   tmp_path / "one.parquet", row_group_size=1)
    pq.write_table(pa.table({"b": pa.array([1.0, None]), "a": pa.array([float("nan"), 9.75]), "CLASS": pa.array([4.0, 5.0]), "z": ["p", "q"]}),
                   tmp_path / "x" / "two.parquet")
    pq.write_table(pa.table({"CLASS": pa.array([6], pa.int8()), "a": pa.array(["17"])}), tmp_path / "x" / "three.parquet")
    assert pq.ParquetFile(tmp_path / "one.parquet").metadata.num_row_groups == 3
    assert rows(spark, tmp_path) == sorted([(1, 5, 2**40), (2, None, 1), (3, 7, None), (4, None, 1), (5, 9, None), (6, 17, None)], key=str)


def test_a_folder_without_files_or_rows(spark, tmp_path):
    assert rows(spark, tmp_path) == []
    pq.write_table(pa.table({"CLASS": pa.array([], pa.int64())}), tmp_path / "none.parquet")
    assert rows(spark, tmp_path) == [] and DS.normalise_foreign(spark, str(tmp_path)).columns[0] == "CLASS"


def test_a_value_that_does_not_fit_is_an_error(spark, tmp_path):
    pq.write_table(pa.table({"a": pa.array([2.0**40])}), tmp_path / "big.parquet")
    with pytest.raises(Exception, match="not in range|out of bounds|truncated|Integer value"):
        rows(spark, tmp_path)
