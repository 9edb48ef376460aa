import pytest
from pyspark.sql import types as T

from veilset import samples
from veilset.catalog import TableMeta, normalise_name, normalise_rule, spark_type


def test_rule_spellings_fold_together():
    assert normalise_rule("<primary_pan_acct_nbr_15>") == "primary_pan_acct_nbr15"
    assert normalise_rule("<secondary_pii_indv_name: full_name_other>") == \
        "secondary_pii_indv_name:full_name_other"
    assert normalise_rule("secondary-pii_address:state") == "secondary_pii_address:state"
    assert normalise_rule(None) is None


def test_flag_spellings():
    doc = samples.request("t", [
        {"column_name": "a", "data_type": "NUMBER", "is_primaryKey": "YES", "is_pii": "NO"},
        {"column_name": "b", "data_type": "NUMBER", "is_primarykey": "YES"},
        {"column_name": "c", "data_type": "NUMBER", "is_primary_key": "NO"},
    ])
    m = TableMeta.from_document(doc)
    assert m.primary_key == ["a", "b"]


def test_type_mapping():
    assert spark_type("VARCHAR2", 20) == T.StringType()
    assert spark_type("NUMBER", 22, 10) == T.LongType()
    assert spark_type("NUMBER", 22, 12, 2) == T.DecimalType(12, 2)
    assert spark_type("NUMBER") == T.DoubleType()
    assert spark_type("DATE") == T.TimestampNTZType()
    assert spark_type("TIMESTAMP(6) WITH TIME ZONE") == T.TimestampType()
    assert spark_type("bytea") == T.BinaryType()
    assert spark_type("jsonb") == T.StringType()
    with pytest.raises(ValueError):
        spark_type("geometry")


def test_length_zero_is_absent():
    m = TableMeta.from_document(samples.request("t", [samples.col("x", "varchar", 0)]))
    assert m.column("x").length is None


def test_highest_priority_rule_and_duplicates():
    assert samples.META["orders_p3"].highest_priority_rule() == "cust_id"
    doc = samples.request("t", [
        samples.col("a", "VARCHAR2", 15, pii=True, rule="primary_pan_acct_nbr15"),
        samples.col("b", "VARCHAR2", 15, pii=True, rule="primary_pan_acct_nbr_15"),
    ])
    with pytest.raises(ValueError):
        TableMeta.from_document(doc).highest_priority_rule()


def test_normalise_name():
    assert normalise_name("ORDERS.O_ORDERKEY") == "orders_o_orderkey"


def test_nested_paths_deduplicated():
    attrs = samples.META["doc_request"].column("request_f1").nested
    assert [a.path for a in attrs] == ["caseId", "entities.name", "entities.status"]
