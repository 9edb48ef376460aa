import pytest
from pyspark.sql import functions as F

from veilset import samples
from veilset.session import stage_path
from veilset.sinks.files import write_files
from veilset.sources import files


def test_unknown_file_kind_fails(spark, tables):
    base = stage_path(spark, "t-mixed")
    write_files(tables["nation"], f"{base}/a", "csv")
    write_files(tables["nation"], f"{base}/b", "json")
    assert files.folder_formats(spark, base) == ["csv", "json"]
    with pytest.raises(ValueError):
        files.read_folder(spark, base, tables["nation"].schema)


def test_stage_copies_are_left_out(spark, tables):
    base = stage_path(spark, "t-mixed2")
    write_files(tables["nation"], f"{base}/a", "parquet")
    write_files(tables["nation"], f"{base}/nation_stg", "parquet")
    df = files.read_folder(spark, base, tables["nation"].schema)
    assert df.count() == tables["nation"].count()


def test_key_list_composite_padded_deduplicated(spark):
    path = stage_path(spark, "t-keys")
    spark.createDataFrame([("1,7   ",), ("1,7",), ("2, 9",), ("   ",)], "value string") \
        .write.text(path)
    keys = files.read_key_list(spark, path, ["a", "b"], ["bigint", "int"])
    assert sorted(tuple(r) for r in keys.collect()) == [(1, 7), (2, 9)]


def test_declared_schema_reads_csv_types(spark, tables):
    path = write_files(tables["orders"], stage_path(spark, "t-orders"), "csv")
    df = files.read_declared(spark, path, samples.META["orders"], "csv")
    assert df.schema == samples.META["orders"].struct_type() or \
        [f.dataType for f in df.schema] == [f.dataType for f in samples.META["orders"].struct_type()]
    assert df.where(F.col("o_orderdate").isNull()).count() == 0


def test_key_table_header_names(spark):
    path = stage_path(spark, "t-kt")
    spark.createDataFrame([(1, 2)], "`ORDERS.O_ORDERKEY` long, `CUSTOMER.C_CUSTKEY` long") \
        .write.option("header", True).csv(path)
    kt = files.read_key_table(spark, path)
    assert kt.columns == ["orders_o_orderkey", "customer_c_custkey"]


def test_source_dispatch(spark, tables):
    from veilset.sources import dispatch
    assert dispatch.reader_kind("ORACLE") == "jdbc"
    assert dispatch.reader_kind("sqlserver") == "jdbc"
    assert dispatch.reader_kind("parquet") == "file"
    assert dispatch.reader_kind("cassandra") == "connector"
    with pytest.raises(ValueError):
        dispatch.reader_kind("mainframe")
    df = dispatch.read_source(spark, "parquet", path="/root/testdata/sf0.001/nation.parquet")
    assert df.count() == tables["nation"].count()
