"""Metadata documents for the bundled test tables.

Each document has the shape of a table request (valid JSON; field names as
in the request format).  Roles: ``customer`` is the driver table
(``c_custkey``), ``orders`` is one hop away (``o_custkey``), ``lineitem`` two
hops (``l_orderkey``).  ``member`` and ``doc_request`` are tables derived
from ``customer`` / ``orders`` that carry one column per masking rule and a
nested JSON column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import TableMeta

TEST_SEED = "veilset-identity-1"      # of the samples' identities; a real one is a secret

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def col(name, data_type, length=None, *, pk=False, pii=False, rule=None, nullable=True,
        precision=None, scale=None, **extra):
    doc = {
        "column_name": name, "column_length": length, "data_type": data_type,
        "precision": precision, "scale": scale,
        "is_primary_key": "YES" if pk else "NO", "is_foreign_key": "NO",
        "is_pii": "YES" if pii else "NO", "rule": f"<{rule}>" if rule else None,
        "is_nullable": "YES" if nullable and not pk else "NO",
        "is_encrypted": None, "algorithm": None, "key_name": None,
        "use_iv": None,
    }
    doc.update(extra)
    return doc


def request(table, columns, *, driver=("customer", "c_custkey"), edges=(), filters=(),
            operator="AND", limit=None, order=None, driver_rule=None):
    return {
        "table_extract_request_id": f"servicerequest:0000:PARQUET:20240101000000:{table.upper()}",
        "schema_name": "tpch", "db_type": "PARQUET", "table_name": table,
        "relational_extract": "Yes" if edges else "No",
        "extract_type": "R" if edges else "F",
        "table_relationship": [
            {"parent_table": p, "child_table": c, "parent_column": pc, "child_column": cc,
             "index": i} for (p, pc, c, cc, i) in edges] or None,
        "driver_table": driver[0] if driver else None,
        "driver_column": driver[1] if driver else None,
        "driver_column_rule": driver_rule,
        "driver_column_encrypted": "NO", "keys_encrypted": "NO",
        "filter_criteria": [{"column_name": c, "condition": op, "value": list(v)}
                            for c, op, v in filters],
        "operator": operator, "limit": limit, "order": order,
        "column_list": list(columns),
    }


CUSTOMER_COLUMNS = [
    col("c_custkey", "NUMBER", 22, precision=18, pk=True),
    col("c_name", "VARCHAR2", 25, pii=True, rule="secondary_pii_indv_name:full_name_other"),
    col("c_nationkey", "INTEGER", nullable=False),
    col("c_acctbal", "DOUBLE", pii=True, rule="affiliated_pia_income"),
    col("c_mktsegment", "VARCHAR2", 10),
]
ORDERS_COLUMNS = [
    col("o_orderkey", "NUMBER", 22, precision=18, pk=True),
    col("o_custkey", "NUMBER", 22, precision=18, nullable=False),
    col("o_orderstatus", "CHAR", 1),
    col("o_totalprice", "DOUBLE", pii=True, rule="affiliated_pia_income"),
    col("o_orderdate", "DATE", 7),
    col("o_orderpriority", "VARCHAR2", 15),
]
LINEITEM_COLUMNS = [
    col("l_orderkey", "NUMBER", 22, precision=18, pk=True),
    col("l_partkey", "NUMBER", 22, precision=18),
    col("l_suppkey", "NUMBER", 22, precision=18),
    col("l_linenumber", "INTEGER", pk=True),
    col("l_quantity", "DOUBLE"),
    col("l_extendedprice", "DOUBLE", pii=True, rule="affiliated_pia_income"),
    col("l_discount", "DOUBLE"),
    col("l_tax", "DOUBLE"),
    col("l_returnflag", "CHAR", 1),
    col("l_linestatus", "CHAR", 1),
    col("l_shipdate", "DATE", 7),
]
EVENTS_COLUMNS = [
    col("event_id", "NUMBER", 22, precision=18, pk=True),
    col("ts", "DATE", 7),
    col("user_id", "NUMBER", 22, precision=18),
    col("event_type", "VARCHAR2", 10),
    col("value", "DOUBLE"),
    col("props", "VARCHAR2", 4000),
]

CUSTOMER = request("customer", CUSTOMER_COLUMNS)
ORDERS = request("orders", ORDERS_COLUMNS,
                 edges=[("customer", "c_custkey", "orders", "o_custkey", 0)])
LINEITEM = request("lineitem", LINEITEM_COLUMNS,
                   edges=[("customer", "c_custkey", "orders", "o_custkey", 0),
                          ("orders", "o_orderkey", "lineitem", "l_orderkey", 1)])
EVENTS = request("events", EVENTS_COLUMNS, driver=None)

# primary keys per table, as a key-table builder needs them
PRIMARY_KEYS = {
    "customer": ["c_custkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "returned_lines": ["r_orderkey", "r_linenumber"],
}

# declared keys that hold in the bundled data (validate.unique_key_tables):
# the line-item key (l_orderkey, l_linenumber) is declared but repeats
UNIQUE_KEYS = {
    "customer": ["c_custkey"],
    "orders": ["o_orderkey"],
}

# composite hop: returned lines reference a line item by (order, line number)
RETURNED_LINES_COLUMNS = [
    col("r_orderkey", "NUMBER", 22, precision=18, pk=True),
    col("r_linenumber", "INTEGER", pk=True),
    col("r_quantity", "DOUBLE"),
]
RETURNED_LINES = request(
    "returned_lines", RETURNED_LINES_COLUMNS, driver=("orders", "o_orderkey"),
    edges=[("orders", "o_orderkey", "lineitem", "l_orderkey", 0),
           ("lineitem", "l_orderkey", "returned_lines", "r_orderkey", 1),
           ("lineitem", "l_linenumber", "returned_lines", "r_linenumber", 1)])

META = {
    "customer": TableMeta.from_document(CUSTOMER),
    "orders": TableMeta.from_document(ORDERS),
    "lineitem": TableMeta.from_document(LINEITEM),
    "events": TableMeta.from_document(EVENTS),
    "returned_lines": TableMeta.from_document(RETURNED_LINES),
}


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    """The test tables as lazy Parquet scans (nothing is read here)."""
    base = sf_dir.rstrip("/")
    return {n: spark.read.parquet(f"{base}/{n}.parquet") for n in names}


def returned_lines(lineitem: DataFrame) -> DataFrame:
    """Derived child with a composite foreign key into ``lineitem``."""
    return lineitem.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("r_orderkey"),
        F.col("l_linenumber").alias("r_linenumber"),
        F.col("l_quantity").alias("r_quantity"))


# ---------------------------------------------------------------------------
# member: one column per masking rule, derived from customer (1 row per customer)

MEMBER_COLUMNS = [
    col("c_custkey", "NUMBER", 22, precision=18, pk=True),
    col("c_name", "VARCHAR2", 25, pii=True, rule="secondary_pii_indv_name:full_name_other"),
    col("name_first", "VARCHAR2", 20, pii=True, rule="secondary_pii_indv_name:first_name"),
    col("name_mid", "VARCHAR2", 1, pii=True, rule="secondary_pii_indv_name:full_name_other"),
    col("name_last", "VARCHAR2", 20, pii=True, rule="secondary_pii_indv_name:last_name"),
    col("name_title", "VARCHAR2", 5, pii=True, rule="secondary_pii_indv_name:full_name_other"),
    col("emplr_name", "VARCHAR2", 40, pii=True, rule="secondary_pii_indv_name:full_name_other"),
    col("birth_dt", "DATE", 7, pii=True, rule="secondary_pia_dob"),
    col("birth_mo", "INTEGER", 2, pii=True, rule="secondary_pia_dob"),
    col("birth_yr", "INTEGER", 4, pii=True, rule="secondary_pia_dob"),
    col("birth_dd", "INTEGER", 2, pii=True, rule="secondary_pia_dob"),
    col("card_nbr", "VARCHAR2", 15, pii=True, rule="primary_pan_acct_nbr_15"),
    col("card13_nbr", "VARCHAR2", 13, pii=True, rule="primary_pan_acct_nbr13"),
    col("card11_nbr", "VARCHAR2", 11, pii=True, rule="primary_pan_acct_nbr11"),
    col("bank_acct_no", "VARCHAR2", 10, pii=True, rule="primary_ban_acct_nbr"),
    col("ban_ref", "VARCHAR2", 15, pii=True, rule="primary_ban_acct_nbr"),
    col("addr_line1", "VARCHAR2", 40, pii=True, rule="secondary_pii_address:line1"),
    col("addr_line2", "VARCHAR2", 40, pii=True, rule="secondary_pii_address:line2"),
    col("addr_city", "VARCHAR2", 30, pii=True, rule="secondary_pii_address:city"),
    col("addr_state", "VARCHAR2", 2, pii=True, rule="secondary-pii_address:state"),
    col("addr_zip", "VARCHAR2", 5, pii=True, rule="secondary-pii_address:zip_code"),
    col("addr_country", "VARCHAR2", 2, pii=True, rule="secondary_pii_address:country"),
    col("home_address", "VARCHAR2", 120, pii=True, rule="secondary_pii_address:full_address_other"),
    col("residence_txt", "VARCHAR2", None, pii=True, rule="secondary_pii_address:full_address_other"),
    col("email_id", "VARCHAR2", 60, pii=True, rule="secondary_pii_email"),
    col("cell_phone", "VARCHAR2", 12, pii=True, rule="secondary_pii_telephone_cell_fax"),
    col("ssn", "VARCHAR2", 9, pii=True, rule="primary_nid_ssn"),
    col("tax_id", "VARCHAR2", 12, pii=True, rule="secondary_cse_tax_id"),
    col("marital_status", "VARCHAR2", 10, pii=True, rule="secondary_pia_marital_status"),
    col("salary_amt", "DOUBLE", pii=True, rule="affiliated_pia_income"),
    col("c_acctbal", "DOUBLE", pii=True, rule="affiliated_pia_income"),
    col("mr_nbr", "VARCHAR2", 2, pii=True, rule="secondary_pii_mr_nbr"),
    col("note_code", "NUMBER", 2, pii=True, rule="secondary_pii_other", precision=2),
    col("flag_cd", "CHAR", 1, pii=True, rule="secondary_pii_other"),
    col("doc_date", "DATE", 7, pii=True, rule="secondary_pii_other"),
    col("c_nationkey", "INTEGER", nullable=False),
    col("c_mktsegment", "VARCHAR2", 10),
]
MEMBER = request("member", MEMBER_COLUMNS, driver=("member", "c_custkey"))
META["member"] = TableMeta.from_document(MEMBER)
MEMBER_NO_DRIVER = request("member", MEMBER_COLUMNS, driver=None)
META["member_no_driver"] = TableMeta.from_document(MEMBER_NO_DRIVER)


def member_table(customer: DataFrame) -> DataFrame:
    """Wide PII table derived from ``customer`` (values are stand-ins that
    the scrub must replace)."""
    k = F.col("c_custkey").cast("string")
    n = F.col("c_nationkey")
    day0 = F.lit("1970-01-01").cast("date")
    return customer.select(
        "c_custkey", "c_name",
        F.concat(F.lit("First"), k).alias("name_first"),
        F.substring("c_name", 1, 1).alias("name_mid"),
        F.concat(F.lit("Last"), k).alias("name_last"),
        F.substring("c_mktsegment", 1, 2).alias("name_title"),
        F.concat(F.col("c_mktsegment"), F.lit(" Co")).alias("emplr_name"),
        F.date_add(day0, n * 100).cast("timestamp_ntz").alias("birth_dt"),
        (n + 1).alias("birth_mo"), (n + 1950).alias("birth_yr"), (n + 2).alias("birth_dd"),
        F.lpad(k, 15, "0").alias("card_nbr"), F.lpad(k, 13, "0").alias("card13_nbr"),
        F.lpad(k, 11, "0").alias("card11_nbr"), F.lpad(k, 10, "1").alias("bank_acct_no"),
        F.concat(F.lit("BAN"), k).alias("ban_ref"),
        F.concat(k, F.lit(" Main St")).alias("addr_line1"),
        F.concat(F.lit("Unit "), n.cast("string")).alias("addr_line2"),
        F.concat(F.lit("City"), n.cast("string")).alias("addr_city"),
        F.lit("ST").alias("addr_state"), F.lpad(n.cast("string"), 5, "0").alias("addr_zip"),
        F.lit("XX").alias("addr_country"),
        F.concat(k, F.lit(" Main St, City"), n.cast("string")).alias("home_address"),
        F.concat(F.lit("Residence "), k).alias("residence_txt"),
        F.concat(F.lit("c"), k, F.lit("@mail.test")).alias("email_id"),
        F.concat(F.lit("+1"), F.lpad(k, 10, "0")).alias("cell_phone"),
        F.lpad(k, 9, "0").alias("ssn"), F.concat(F.lit("T"), k).alias("tax_id"),
        F.substring("c_mktsegment", 1, 1).alias("marital_status"),
        (F.col("c_acctbal") * 10).alias("salary_amt"), "c_acctbal",
        F.substring("c_name", 1, 2).alias("mr_nbr"),
        (n + 10).alias("note_code"), F.substring("c_mktsegment", 1, 1).alias("flag_cd"),
        F.date_add(day0, n).cast("timestamp_ntz").alias("doc_date"),
        "c_nationkey", "c_mktsegment")


# ---------------------------------------------------------------------------
# doc_request: a JSON column with a nested PII attribute (entities.name)

DOC_REQUEST_COLUMNS = [
    col("document_request_id", "NUMBER", 22, precision=18, pk=True),
    col("cust_key", "NUMBER", 22, precision=18),
    col("journey_nm", "VARCHAR2", 20),
    col("request_f1", "jsonb", 0, complex_column_attributes=[
        {"path": "caseId", "name": "caseId", "rule": None, "isPII": False,
         "data_type": "string"},
        {"path": "entities.name", "name": "name",
         "rule": "<secondary_pii_indv_name: full_name_other>", "isPII": True,
         "data_type": "string"},
        {"path": "entities.name", "name": "name",
         "rule": "<secondary_pii_indv_name: full_name_other>", "isPII": True,
         "data_type": "string"},
        {"path": "entities.status", "name": "status", "rule": None, "isPII": False,
         "data_type": "string"},
    ]),
]
DOC_REQUEST = request("doc_request", DOC_REQUEST_COLUMNS,
                      edges=[("customer", "c_custkey", "doc_request", "cust_key", 0)])
META["doc_request"] = TableMeta.from_document(DOC_REQUEST)
PRIMARY_KEYS["doc_request"] = ["document_request_id"]


def doc_request_table(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One request per order; the JSON names the customer inside ``entities``."""
    j = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "inner")
    doc = F.struct(
        F.col("o_orderkey").cast("string").alias("caseId"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("journey"),
        F.array(F.struct(
            F.col("c_name").alias("name"),
            F.lit("ACTIVE").alias("status"),
            F.lit("CUST").alias("identifierType"),
            F.col("c_custkey").cast("string").alias("identifierValue"),
            F.array(F.struct(F.lit("INVOICE").alias("type"),
                             F.col("o_orderstatus").alias("status"))).alias("requestedDocuments"),
        )).alias("entities"))
    return j.select(F.col("o_orderkey").alias("document_request_id"),
                    F.col("o_custkey").alias("cust_key"),
                    F.col("o_orderpriority").alias("journey_nm"),
                    F.to_json(doc).alias("request_f1"))


# ---------------------------------------------------------------------------
# test-only keys for the bundled queries (real runs pass keys from a secret store)
TEST_ENV_KEY = b"veilset-test-environment-key-32b"
TEST_COLUMN_KEYS = {"custkey_db_key": b"veilset-test-column-key-0000016b"[:16],
                    "name_db_key": b"veilset-test-column-key-24bytes!"[:24]}
TEST_HASH_SECRET = "veilset-test-hash-secret"

# P3 variant of orders: several PII columns, one rule with priority, a driver column
ORDERS_P3 = request("orders", [
    col("o_orderkey", "NUMBER", 22, precision=18, pk=True, pii=True),
    col("o_custkey", "NUMBER", 22, precision=18, pii=True, rule="cust_id"),
    col("o_orderstatus", "CHAR", 1),
    col("o_totalprice", "DOUBLE", pii=True, rule="affiliated_pia_income"),
    col("o_orderdate", "DATE", 7, pii=True),
    col("o_orderpriority", "VARCHAR2", 15, pii=True),
], driver=("orders", "o_orderpriority"))
META["orders_p3"] = TableMeta.from_document(ORDERS_P3)

# customer as a source that stores its key encrypted with a column key
CUSTOMER_DB_ENCRYPTED = request("customer", [
    col("c_custkey", "NUMBER", 22, precision=18, pk=True, pii=True, is_encrypted="YES",
        algorithm="deterministic", key_name="custkey_db_key",
        use_iv="NO"),
    col("c_name", "VARCHAR2", 25, pii=True, is_encrypted="YES",
        rule="primary_pan_acct_nbr_15", algorithm="keyed_hash",
        key_name="name_db_key"),
    col("c_nationkey", "INTEGER"),
    col("c_acctbal", "DOUBLE"),
    col("c_mktsegment", "VARCHAR2", 10),
])
CUSTOMER_DB_ENCRYPTED.update({"driver_column_encrypted": "YES", "keys_encrypted": "YES"})
META["customer_db_encrypted"] = TableMeta.from_document(CUSTOMER_DB_ENCRYPTED)
CUSTOMER_ENCRYPTED_KEYS = dict(CUSTOMER, keys_encrypted="YES", driver_column_encrypted="NO")
META["customer_encrypted_keys"] = TableMeta.from_document(CUSTOMER_ENCRYPTED_KEYS)

PAGES = request("pages", [
    col("page_id", "NUMBER", 22, precision=18, pk=True),
    col("url", "VARCHAR2", 2000),
    col("html", "bytea"),
], driver=None)
META["pages"] = TableMeta.from_document(PAGES)


# events with a JSON column whose attribute ``k`` is PII; no driver: typed constant
EVENTS_NESTED = request("events", [
    col("event_id", "NUMBER", 22, precision=18, pk=True),
    col("ts", "DATE", 7),
    col("user_id", "NUMBER", 22, precision=18),
    col("event_type", "VARCHAR2", 10),
    col("value", "DOUBLE"),
    col("props", "jsonb", 0, complex_column_attributes=[
        {"path": "k", "name": "k", "rule": "<secondary_pii_mr_nbr>", "isPII": True,
         "data_type": "NUMBER"}]),
], driver=None)
META["events_nested"] = TableMeta.from_document(EVENTS_NESTED)

# a JSON column whose ``entities`` take any shape; no driver: typed constants
SHAPED = request("shaped", [
    col("conv_id", "NUMBER", 22, precision=18, pk=True),
    col("turn", "NUMBER", 22, precision=18),
    col("doc", "jsonb", 0, complex_column_attributes=[
        {"path": "entities.name", "name": "name",
         "rule": "<secondary_pii_indv_name: full_name_other>", "isPII": True,
         "data_type": "string"}]),
], driver=None)
META["shaped"] = TableMeta.from_document(SHAPED)

# line items again, reaching the customer by the orders' other column
PAYMENT = request("payment", LINEITEM_COLUMNS,
                  edges=[("customer", "c_custkey", "orders", "o_payer", 0),
                         ("orders", "o_orderkey", "payment", "l_orderkey", 1)])
META["payment"] = TableMeta.from_document(PAYMENT)
