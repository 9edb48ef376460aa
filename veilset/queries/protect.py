"""Extract projection and crypto queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import samples
from ..functions import crypto
from ..operators import protect, subset
from ..registry import query
from ..sources.files import normalise_columns

def driver():
    return F.col("c_mktsegment") == "BUILDING"


DRIVER_SQL = "c_mktsegment = 'BUILDING'"


def _t(spark, sf, names=("customer", "orders", "lineitem", "pages")):
    return samples.load_tables(spark, sf, names)


@query("project_list", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders""")
def project_list(spark, sf):
    return protect.project_columns(_t(spark, sf)["orders"], samples.META["orders"])


@query("project_null_pii", """
SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal,
       c_mktsegment FROM customer""")
def project_null_pii(spark, sf):
    return protect.extract_projection(_t(spark, sf)["customer"], samples.META["customer"])


@query("project_keep_keys", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice,
       CAST(NULL AS TIMESTAMP) AS o_orderdate, o_orderpriority FROM orders""")
def project_keep_keys(spark, sf):
    """Primary key, driver column and the top-priority rule keep their values."""
    return protect.extract_projection(_t(spark, sf)["orders"], samples.META["orders_p3"])


@query("project_binary_text", "SELECT page_id, url, html FROM pages")
def project_binary_text(spark, sf):
    """A bytea column (raw page bytes) extracted as text, whole."""
    pages = _t(spark, sf)["pages"].withColumn("html", F.encode("html", "UTF-8"))
    return protect.extract_projection(pages, samples.META["pages"])


@query("project_normalise", """
SELECT o_orderkey AS orders_o_orderkey, o_custkey AS orders_o_custkey,
       o_orderstatus AS orders_o_orderstatus, o_totalprice AS orders_o_totalprice,
       o_orderdate AS orders_o_orderdate, o_orderpriority AS orders_o_orderpriority FROM orders""")
def project_normalise(spark, sf):
    """Headers like ``ORDERS.O_ORDERKEY`` -> ``orders_o_orderkey``."""
    o = _t(spark, sf)["orders"]
    return normalise_columns(o.toDF(*[f"ORDERS.{c.upper()}" for c in o.columns]))


@query("project_default", """
SELECT c_custkey, 'NA' AS c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment
FROM customer""")
def project_default(spark, sf):
    """String columns left empty by the projection get 'NA'."""
    c = protect.extract_projection(_t(spark, sf)["customer"], samples.META["customer"])
    return protect.null_default(c)


@query("encrypt_roundtrip", "SELECT *, true AS differs FROM orders")
def encrypt_roundtrip(spark, sf):
    """E1 then E2 on every row: decrypt(encrypt(x)) = x, types restored."""
    o = _t(spark, sf)["orders"]
    cols = ["o_orderkey", "o_custkey"]
    enc = protect.encrypt_columns(o.withColumn("plain", F.col("o_orderkey").cast("string")), cols,
                                  samples.TEST_ENV_KEY).withColumn("cipher", F.col("o_orderkey"))
    dec = protect.decrypt_columns(enc, cols, samples.TEST_ENV_KEY,
                                  types={c: o.schema[c].dataType for c in cols})
    return dec.withColumn("differs", F.col("cipher") != F.col("plain")).drop("plain", "cipher")


def _db_encrypted_customer(t):
    """customer as a source storing c_custkey encrypted with its column key."""
    meta = samples.META["customer_db_encrypted"]
    return protect.encrypt_with_column_keys(t["customer"], meta, samples.TEST_COLUMN_KEYS,
                                            ["c_custkey"])


@query("decrypt_column_keys", "SELECT *, true AS differs FROM customer")
def decrypt_column_keys(spark, sf):
    """Decrypt with the column's own key and mode; the one-way hashed
    column passes through."""
    t = _t(spark, sf)
    meta = samples.META["customer_db_encrypted"]
    enc = _db_encrypted_customer(t).withColumn("cipher", F.col("c_custkey"))
    dec = protect.decrypt_with_column_keys(enc, meta, samples.TEST_COLUMN_KEYS,
                                           types={"c_custkey": "bigint"})
    return dec.withColumn("differs", F.col("cipher") != F.col("c_custkey").cast("string")) \
        .drop("cipher")


@query("encrypt_column_keys", f"""
SELECT c_custkey AS plain, true AS differs, true AS restored, 1 AS ciphers
FROM customer WHERE {DRIVER_SQL}""")
def encrypt_column_keys(spark, sf):
    """The driver column encrypted with its own key: the cipher differs
    from the value, decrypts to it, and is the same each time (so that it can
    be matched); every value has a cipher of its own."""
    t = _t(spark, sf)
    meta = samples.META["customer_db_encrypted"]
    own = t["customer"].where(driver())
    both = own.unionAll(own).withColumn("plain", F.col("c_custkey"))
    enc = protect.encrypt_with_column_keys(both, meta, samples.TEST_COLUMN_KEYS, ["c_custkey"]) \
        .withColumn("cipher", F.col("c_custkey"))
    dec = protect.decrypt_with_column_keys(enc, meta, samples.TEST_COLUMN_KEYS,
                                           types={"c_custkey": "bigint"})
    return dec.groupBy("plain").agg(
        F.bool_and(F.col("cipher") != F.col("plain").cast("string")).alias("differs"),
        F.bool_and(F.col("c_custkey") == F.col("plain")).alias("restored"),
        F.count_distinct("cipher").cast("int").alias("ciphers"))


@query("keys_prepare", f"SELECT c_custkey AS key FROM customer WHERE {DRIVER_SQL}")
def keys_prepare(spark, sf):
    """E5 with encrypted keys, source column plain: keys are decrypted."""
    t = _t(spark, sf)
    keys = t["customer"].where(driver()).select(F.col("c_custkey").alias("key"))
    cipher = protect.encrypt_columns(keys, ["key"], samples.TEST_ENV_KEY)
    out = protect.prepare_keys(cipher, samples.META["customer_encrypted_keys"], ["key"],
                               env_key=samples.TEST_ENV_KEY)
    return out.select(F.col("key").cast("bigint"))


@query("keys_prepare_reencrypt", f"SELECT * FROM customer WHERE {DRIVER_SQL}")
def keys_prepare_reencrypt(spark, sf):
    """E5 with encrypted keys and an encrypted source column: keys are decrypted
    and re-encrypted with the column key, then matched against the stored
    ciphertext (deterministic column mode), then the extract is decrypted."""
    t = _t(spark, sf)
    meta = samples.META["customer_db_encrypted"]
    keys = t["customer"].where(driver()).select(F.col("c_custkey").alias("key"))
    cipher = protect.encrypt_columns(keys, ["key"], samples.TEST_ENV_KEY)
    ready = protect.prepare_keys(cipher, meta, ["key"], env_key=samples.TEST_ENV_KEY,
                                 column_keys=samples.TEST_COLUMN_KEYS)
    source = _db_encrypted_customer(t)
    rows = subset.semi_join(source, ready, [("c_custkey", "key")])
    return protect.decrypt_with_column_keys(rows, meta, samples.TEST_COLUMN_KEYS,
                                            types={"c_custkey": "bigint"})


@query("hash_passthrough", "SELECT * FROM customer")
def hash_passthrough(spark, sf):
    """A one-way hashed column is neither decrypted nor re-encrypted."""
    t = _t(spark, sf)
    meta = samples.META["customer_db_encrypted"]
    out = protect.decrypt_with_column_keys(t["customer"], meta, samples.TEST_COLUMN_KEYS,
                                           columns=["c_name"])
    return protect.encrypt_with_column_keys(out, meta, samples.TEST_COLUMN_KEYS, ["c_name"])


def _hmac_sql(column):
    """HMAC-SHA-256 in DuckDB's own functions."""
    inner, outer = (f"unhex('{p.hex()}')" for p in crypto.hmac_pads(samples.TEST_HASH_SECRET))
    return (f"sha256({outer} || unhex(sha256({inner} || "
            f"encode(CAST({column} AS VARCHAR)))))")


@query("hash_key", f"""
SELECT c_custkey, {_hmac_sql("c_custkey")} AS cust_token
FROM customer""")
def hash_key(spark, sf):
    c = _t(spark, sf)["customer"]
    return c.select("c_custkey",
                    crypto.keyed_hash(F.col("c_custkey"), samples.TEST_HASH_SECRET).alias("cust_token"))


@query("encrypt_joinable", f"""
SELECT o.o_orderkey, {_hmac_sql("o.o_custkey")} AS cust_token,
       c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def encrypt_joinable(spark, sf):
    """Both sides carry a keyed-hash token beside the GCM ciphertext and
    join on the token; the plain key is dropped before the join."""
    t = _t(spark, sf)
    sec, key = samples.TEST_HASH_SECRET, samples.TEST_ENV_KEY
    o = t["orders"].select("o_orderkey",
                           crypto.keyed_hash(F.col("o_custkey"), sec).alias("cust_token"),
                           crypto.encrypt(F.col("o_custkey"), key).alias("o_custkey_enc"))
    c = t["customer"].select(crypto.keyed_hash(F.col("c_custkey"), sec).alias("c_token"),
                             "c_mktsegment")
    return o.join(c, o["cust_token"] == c["c_token"], "inner").select(
        "o_orderkey", "cust_token", "c_mktsegment")
