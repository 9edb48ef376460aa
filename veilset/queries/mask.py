"""Scrub queries (P8, M1-M19, J6, J7, J10, S12) and their DuckDB oracles.

The oracle side derives the same synthetic identities with DuckDB's own
functions (``sha256``, hex casts, list indexing) and an unrolled Luhn sum,
independently of the Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import samples
from ..catalog import TableMeta
from ..functions import fpe
from ..functions import identity as idfn
from ..functions.crypto import hmac_pads
from ..operators import mask, subset
from ..plans.scrub import scrub_related
from ..registry import query
from ..session import stage_path

def driver():
    return F.col("c_mktsegment") == "BUILDING"


DRIVER_SQL = "c_mktsegment = 'BUILDING'"
def covered():
    return F.col("c_acctbal") >= 0
        # identities exist for accounts in good standing
COVERED_SQL = "c_acctbal >= 0"

# ---------------------------------------------------------------------------
# identity generator in DuckDB SQL

_S = samples.TEST_SEED


def _u(tag, n, k="k"):
    return (f"((('0x' || substr(sha256(concat_ws(':', '{_S}', '{tag}', CAST({k} AS VARCHAR))), "
            f"1, 8))::BIGINT) % {n})")


def _pick(tag, values):
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{_u(tag, len(values))} + 1]"


def _digits(tag, n):
    parts, i = [], 0
    while n > 0:
        size = min(8, n)
        parts.append(f"lpad(CAST({_u(f'{tag}{i}', 10 ** size)} AS VARCHAR), {size}, '0')")
        n -= size
        i += 1
    return " || ".join(parts)


def fpe_sql(source, key, out, size, secret, tweak):
    """``source`` with a column ``out``: ``key`` under format-preserving encryption
    over ``size`` numbers (a power of ten), one nested SELECT per round."""
    a, b = fpe.halves(size)
    inner, outer = (f"from_hex('{x.hex()}')" for x in hmac_pads(secret))
    sql = (f"(SELECT *, CAST({key} AS BIGINT) // {b} AS _l, CAST({key} AS BIGINT) % {b} AS _r "
           f"FROM {source})")
    for i in range(fpe.ROUNDS):
        now, half, m = ("_l", "_r", a) if i % 2 == 0 else ("_r", "_l", b)
        mac = (f"CAST('0x' || substr(sha256({outer} || unhex(sha256({inner} || encode("
               f"'{tweak}:{i}:' || CAST({half} AS VARCHAR))))), 1, 15) AS BIGINT)")
        sql = f"(SELECT * REPLACE (({now} + {mac} % {m}) % {m} AS {now}) FROM {sql})"
    return f"(SELECT * EXCLUDE (_l, _r), _l * {b} + _r AS {out} FROM {sql})"


_UNIQUE = {"cm15_": 12, "cm13_": 11, "cm11_": 9, "nid_": 8, "bank_": 10}


def _numbers(source):
    """``source`` (a column ``k``) with the unique digits of every tag."""
    for tag, n in _UNIQUE.items():
        source = fpe_sql(source, "k", f"u_{tag}", 10 ** n, _S, tag)
    return source


def _unique(tag, n):
    assert _UNIQUE[tag] == n
    return f"lpad(CAST(u_{tag} AS VARCHAR), {n}, '0')"


def _luhn(col, length):
    terms = []
    for j in range(1, length + 1):
        d = f"CAST(substr({col}, {j}, 1) AS INTEGER)"
        if (length - j + 1) % 2 == 1:
            terms.append(f"(CASE WHEN {d} * 2 > 9 THEN {d} * 2 - 9 ELSE {d} * 2 END)")
        else:
            terms.append(d)
    return f"{col} || CAST((10 - ({' + '.join(terms)}) % 10) % 10 AS VARCHAR)"


def identity_cte(source_sql: str) -> str:
    """``ids`` CTE: one identity per key ``k`` of ``source_sql``."""
    return f"""
n AS MATERIALIZED (SELECT * FROM {_numbers(f"({source_sql})")}),
p AS (SELECT *, '37' || {_unique('cm15_', 12)} AS p15, '4' || {_unique('cm13_', 11)} AS p13,
             '6' || {_unique('cm11_', 9)} AS p11 FROM n),
ids AS (SELECT
  ('0x' || substr(sha256(concat_ws(':', '{_S}', 'id', CAST(k AS VARCHAR))), 1, 15))::BIGINT AS id,
  {_luhn('p15', 14)} AS cm15, {_luhn('p13', 12)} AS cm13, {_luhn('p11', 10)} AS cm11,
  k AS cust_id,
  {_pick('first', idfn.FIRST_NAMES)} AS first_nm,
  {_pick('mid', idfn.MIDDLE_INITIALS)} AS mid_nm,
  {_pick('last', idfn.LAST_NAMES)} AS lst_nm,
  DATE '1940-01-01' + CAST({_u('dob', 22000)} AS INTEGER) AS cm_dob,
  '9' || {_unique('nid_', 8)} AS nat_id,
  CAST({_u('income', 180000)} + 20000 AS DOUBLE) AS incom_self,
  CAST({_u('asset', 5000000)} AS DOUBLE) AS asset_am,
  {_unique('bank_', 10)} AS bank_acct_no,
  {_pick('employer', idfn.EMPLOYERS)} AS emplr_nm,
  concat_ws(' ', CAST({_u('house', 9900)} + 100 AS VARCHAR), {_pick('street', idfn.STREETS)}) AS addr_line1,
  'Apt ' || CAST({_u('apt', 900)} + 1 AS VARCHAR) AS addr_line2,
  'Bldg ' || CAST({_u('bldg', 50)} + 1 AS VARCHAR) AS addr_line3,
  'Floor ' || CAST({_u('floor', 40)} + 1 AS VARCHAR) AS addr_line4,
  'PO Box ' || CAST({_u('box', 9000)} + 1000 AS VARCHAR) AS addr_line5,
  {_pick('city', idfn.CITIES)} AS city,
  {_pick('state', idfn.STATES)} AS state,
  {_digits('zip_', 5)} AS zip_code,
  '{idfn.COUNTRY}' AS country,
  lower({_pick('first', idfn.FIRST_NAMES)} || '.' || {_pick('last', idfn.LAST_NAMES)} || '.' || {_digits('mail_', 4)} || '@example.test') AS email,
  '555' || {_digits('phone_', 7)} AS phone
FROM p)"""


IDS_ALL = identity_cte("SELECT c_custkey AS k FROM customer")
IDS_COVERED = identity_cte(f"SELECT c_custkey AS k FROM customer WHERE {COVERED_SQL}")


def _identity(t, covered_only=False):
    """Stored-style identity table (joined on the driver key)."""
    cust = t["customer"].where(covered()) if covered_only else t["customer"]
    return mask.identity_table(cust, "c_custkey", seed=_S, unique=True)


GENERATOR = mask.identity_generator(_S)      # identities as expressions of the key
UKS = samples.UNIQUE_KEYS          # keys verified unique in the data


def _t(spark, sf):
    return samples.load_tables(spark, sf, ("customer", "orders", "lineitem"))


@query("src_identity", f"WITH {IDS_ALL} SELECT * FROM ids")
def src_identity(spark, sf):
    return _identity(_t(spark, sf))


@query("mask_unique_numbers", """
SELECT count(DISTINCT o_orderkey) AS keys, count(DISTINCT o_orderkey) AS cm15,
       count(DISTINCT o_orderkey) AS cm13, count(DISTINCT o_orderkey) AS cm11,
       count(DISTINCT o_orderkey) AS nat_id, count(DISTINCT o_orderkey) AS bank FROM orders""")
def mask_unique_numbers(spark, sf):
    """As many different numbers as keys."""
    names = {"cm15": "cm15", "cm13": "cm13", "cm11": "cm11", "nat_id": "nat_id",
             "bank_acct_no": "bank"}
    path = stage_path(spark, "numbers")          # made once, counted per column
    GENERATOR.table(_t(spark, sf)["orders"], "o_orderkey", ["cust_id", *names]) \
        .write.parquet(path)
    ids = spark.read.parquet(path)
    return ids.agg(F.count_distinct("cust_id").alias("keys"),
                   *[F.count_distinct(f).alias(n) for f, n in names.items()])


# ---------------------------------------------------------------------------
# member table: one column per rule (own driver, J6)

MEMBER_SQL_COLS = {
    "c_custkey": "c.c_custkey",
    "c_name": "concat_ws(' ', i.first_nm, i.mid_nm, i.lst_nm)",
    "name_first": "i.first_nm", "name_mid": "i.mid_nm", "name_last": "i.lst_nm",
    "name_title": "CAST(NULL AS VARCHAR)", "emplr_name": "i.emplr_nm",
    "birth_dt": "CAST(i.cm_dob AS TIMESTAMP)", "birth_mo": "CAST(month(i.cm_dob) AS INTEGER)",
    "birth_yr": "CAST(year(i.cm_dob) AS INTEGER)", "birth_dd": "CAST(day(i.cm_dob) AS INTEGER)",
    "card_nbr": "i.cm15", "card13_nbr": "i.cm13", "card11_nbr": "i.cm11",
    "bank_acct_no": "i.bank_acct_no", "ban_ref": "i.cm15",
    "addr_line1": "i.addr_line1", "addr_line2": "i.addr_line2", "addr_city": "i.city",
    "addr_state": "i.state", "addr_zip": "i.zip_code", "addr_country": "i.country",
    "home_address": "concat_ws(', ', i.addr_line1, i.addr_line2, i.city, i.state, i.zip_code)",
    "residence_txt": "'abc'", "email_id": "i.email", "cell_phone": "i.phone",
    "ssn": "i.nat_id", "tax_id": "i.nat_id", "marital_status": "'MARRIED'",
    "salary_amt": "i.incom_self", "c_acctbal": "i.asset_am",
    "mr_nbr": "'a'", "note_code": "CAST(4 AS INTEGER)", "flag_cd": "'a'",
    "doc_date": "TIMESTAMP '2003-05-03 00:00:00'",
    "c_nationkey": "c.c_nationkey", "c_mktsegment": "c.c_mktsegment",
}


def _member_sql(cols):
    sel = ", ".join(f"{MEMBER_SQL_COLS[c]} AS {c}" for c in cols)
    return f"WITH {IDS_ALL} SELECT {sel} FROM customer c JOIN ids i ON i.cust_id = c.c_custkey"


def _member_query(name, cols=None):
    cols = cols or [c.name for c in samples.META["member"].columns]

    def fn(spark, sf):
        t = _t(spark, sf)
        member = samples.member_table(t["customer"]).select(*cols)
        return mask.scrub(member, samples.META["member"], GENERATOR)
    query(name, _member_sql(cols))(fn)


_member_query("mask_table")
_member_query("mask_dob_parts", ["c_custkey", "birth_dt", "birth_mo", "birth_yr", "birth_dd"])
_member_query("mask_card_number", ["c_custkey", "card_nbr", "card13_nbr", "card11_nbr", "ban_ref"])
_member_query("mask_name_by_column", ["c_custkey", "c_name", "name_first", "name_mid",
                                      "name_last", "name_title", "emplr_name"])
_member_query("mask_address", ["c_custkey", "addr_line1", "addr_line2", "addr_city",
                               "addr_state", "addr_zip", "addr_country", "home_address",
                               "residence_txt"])
_member_query("mask_contact", ["c_custkey", "email_id", "cell_phone"])
_member_query("mask_national_id", ["c_custkey", "ssn", "tax_id"])
_member_query("mask_marital", ["c_custkey", "marital_status", "c_mktsegment"])
_member_query("mask_income", ["c_custkey", "salary_amt", "c_acctbal"])
_member_query("mask_bank_number", ["c_custkey", "bank_acct_no", "ban_ref"])
_member_query("mask_constants", ["c_custkey", "mr_nbr", "note_code", "flag_cd", "doc_date",
                                 "residence_txt"])

_NO_DRIVER_SQL = {
    "c_custkey": "c_custkey", "c_name": "'abc'", "name_first": "'abc'", "name_mid": "'a'",
    "name_last": "'abc'", "name_title": "'abc'", "emplr_name": "'abc'",
    "birth_dt": "TIMESTAMP '2003-05-03 00:00:00'", "birth_mo": "CAST(4 AS INTEGER)",
    "birth_yr": "CAST(10 AS INTEGER)", "birth_dd": "CAST(4 AS INTEGER)",
    "card_nbr": "'abc'", "card13_nbr": "'abc'", "card11_nbr": "'abc'",
    "bank_acct_no": "'abc'", "ban_ref": "'abc'", "addr_line1": "'abc'", "addr_line2": "'abc'",
    "addr_city": "'abc'", "addr_state": "'a'", "addr_zip": "'abc'", "addr_country": "'a'",
    "home_address": "'abc'", "residence_txt": "'abc'", "email_id": "'abc'",
    "cell_phone": "'abc'", "ssn": "'abc'", "tax_id": "'abc'", "marital_status": "'abc'",
    "salary_amt": "CAST(10 AS DOUBLE)", "c_acctbal": "CAST(10 AS DOUBLE)", "mr_nbr": "'a'",
    "note_code": "CAST(4 AS INTEGER)", "flag_cd": "'a'",
    "doc_date": "TIMESTAMP '2003-05-03 00:00:00'",
    "c_nationkey": "c_nationkey", "c_mktsegment": "c_mktsegment",
}


@query("mask_no_driver", "SELECT " + ", ".join(f"{v} AS {k}" for k, v in _NO_DRIVER_SQL.items())
       + " FROM customer")
def mask_no_driver(spark, sf):
    """PII of a table without driver -> typed constants, no join."""
    t = _t(spark, sf)
    return mask.scrub(samples.member_table(t["customer"]), samples.META["member_no_driver"])


# ---------------------------------------------------------------------------
# tables reached over hops

_CUSTOMER_SQL = f"""WITH {IDS_ALL}
SELECT c.c_custkey, concat_ws(' ', i.first_nm, i.mid_nm, i.lst_nm) AS c_name, c.c_nationkey,
       i.asset_am AS c_acctbal, c.c_mktsegment
FROM customer c JOIN ids i ON i.cust_id = c.c_custkey WHERE c.{DRIVER_SQL}"""


@query("mask_identity", _CUSTOMER_SQL)
def mask_identity(spark, sf):
    """The driver table is its own driver."""
    t = _t(spark, sf)
    meta = samples.META["customer"]
    rows = subset.extract_rows(t["customer"], meta, where=driver())
    return mask.scrub(rows, meta, _identity(t))


@query("mask_identity_generated", _CUSTOMER_SQL)
def mask_identity_generated(spark, sf):
    """J6 with identities computed from the driver key (no identity join)."""
    t = _t(spark, sf)
    meta = samples.META["customer"]
    return mask.scrub(subset.extract_rows(t["customer"], meta, where=driver()), meta, GENERATOR)


_ORDERS_SQL = f"""WITH {IDS_ALL}
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, i.asset_am AS o_totalprice, o.o_orderdate,
       o.o_orderpriority
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN ids i ON i.cust_id = c.c_custkey
WHERE c.{DRIVER_SQL}"""


@query("mask_identity_1hop", _ORDERS_SQL)
def mask_identity_1hop(spark, sf):
    t = _t(spark, sf)
    return scrub_related(t, samples.META["orders"], GENERATOR, driver_filter=driver(),
                         unique_keys=UKS)


@query("mask_identity_1hop_table", _ORDERS_SQL)
def mask_identity_1hop_table(spark, sf):
    """One hop with a stored identity table: keys-only link first, identity
    joined after it (keeps the orders join open to AQE's skew split)."""
    t = _t(spark, sf)
    return scrub_related(t, samples.META["orders"], _identity(t), driver_filter=driver(),
                         unique_keys=UKS)


def _lineitem_sql(ids_cte, how="JOIN", extendedprice="i.asset_am"):
    return f"""WITH {ids_cte}
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
       {extendedprice} AS l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag,
       l.l_linestatus, l.l_shipdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey {how} ids i ON i.cust_id = c.c_custkey
WHERE c.{DRIVER_SQL}"""


def mask_lineitem(t, identity, how="inner"):
    """Extract line items two hops from the driver and mask them."""
    return scrub_related(t, samples.META["lineitem"], identity, driver_filter=driver(),
                         how=how, unique_keys=UKS)


@query("mask_identity_2hop", _lineitem_sql(IDS_ALL))
def mask_identity_2hop(spark, sf):
    """Extract + mask in one join of the line items; identities computed from
    the driver key carried by the link."""
    return mask_lineitem(_t(spark, sf), GENERATOR)


@query("mask_identity_2hop_table", _lineitem_sql(IDS_ALL))
def mask_identity_2hop_table(spark, sf):
    """Same, with a stored identity table joined to the driver rows."""
    t = _t(spark, sf)
    return mask_lineitem(t, _identity(t))


@query("mask_identity_left", _lineitem_sql(
    IDS_COVERED, "LEFT JOIN", "coalesce(i.asset_am, CAST(10 AS DOUBLE))"))
def mask_identity_left(spark, sf):
    """Left identity join: rows without an identity keep typed constants."""
    t = _t(spark, sf)
    return mask_lineitem(t, _identity(t, covered_only=True), how="left")


@query("mask_unmatched", f"""
SELECT l.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.{DRIVER_SQL} AND NOT (c.{COVERED_SQL})""")
def mask_unmatched(spark, sf):
    """Extracted rows the inner identity join would drop."""
    t = _t(spark, sf)
    meta = samples.META["lineitem"]
    rows = subset.extract_related(t, meta, driver_filter=driver())
    link, pairs = mask.driver_link(t, meta, UKS, identity=_identity(t, covered_only=True),
                                   how="left", driver_filter=driver())
    return mask.unmatched(rows, meta, link=link, pairs=pairs)


# ---------------------------------------------------------------------------
# nested JSON

def _doc_json_sql(name_sql):
    # keys in the order the merged JSON schema gives them (sorted)
    return ("'{\"caseId\":\"' || CAST(o.o_orderkey AS VARCHAR) || '\",\"entities\":[{"
            "\"identifierType\":\"CUST\",\"identifierValue\":\"' || CAST(c.c_custkey AS VARCHAR) || "
            f"'\",\"name\":\"' || {name_sql} || '\",\"requestedDocuments\":[{{\"status\":\"' || "
            "o.o_orderstatus || '\",\"type\":\"INVOICE\"}],\"status\":\"ACTIVE\"}],\"journey\":\"' || "
            "o.o_orderpriority || '\",\"status\":\"' || o.o_orderstatus || '\"}'")


_DOC_JSON_SQL = f"""WITH {IDS_ALL}
SELECT o.o_orderkey AS document_request_id, o.o_custkey AS cust_key,
       o.o_orderpriority AS journey_nm,
       {_doc_json_sql("concat_ws(' ', i.first_nm, i.mid_nm, i.lst_nm)")} AS request_f1
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN ids i ON i.cust_id = c.c_custkey
WHERE c.{DRIVER_SQL}"""


@query("mask_nested_json", _DOC_JSON_SQL)
def mask_nested_json(spark, sf):
    t = _t(spark, sf)
    t["doc_request"] = samples.doc_request_table(t["orders"], t["customer"])
    return scrub_related(t, samples.META["doc_request"], GENERATOR, driver_filter=driver(),
                         unique_keys=UKS)


# one row in six shapes: array, object, other case, null, explicit null, plain
# value; beside it what must stay: an integer, a decimal, a null, a text
_SHAPES = """CASE {k} % 6
  WHEN 0 THEN '[{{"name":"{n}","rank":1}},{{"name":"{n}","rank":2.5}}]'
  WHEN 1 THEN '{{"name":"{n}","rank":3}}' WHEN 2 THEN '{{"NAME":"{n}"}}'
  WHEN 3 THEN '[[{{"name":["{n}",null]}}],{{"rank":null}}]' WHEN 4 THEN '{{"name":null}}'
  ELSE {plain} END"""


def _shaped_sql(name, plain):
    return ("'{\"a\":1,\"b\":2.5,\"c\":null,\"entities\":' || "
            + _SHAPES.format(k="conv_id", n=name, plain=plain) + " || ',\"t\":\"x\"}'")


@query("mask_nested_mixed", f"""
SELECT conv_id, turn, CASE WHEN conv_id % 11 = 0 THEN NULL
  ELSE {_shaped_sql("abc", "'null'")} END AS doc, false AS leaks
FROM conversations""")
def mask_nested_mixed(spark, sf):
    """M18 fails closed: the PII path meets an array in one row, an object in
    the next, other spellings, nulls and plain values; ``leaks`` tells whether
    the role's name is left anywhere (the plain value holds it too)."""
    c = samples.load_tables(spark, sf, ("conversations",))["conversations"]
    real = F.concat(F.lit("Real "), F.coalesce("role", F.lit("nobody")))
    doc = F.when(F.col("conv_id") % 11 == 0, F.lit(None)).otherwise(F.replace(
        F.expr(_shaped_sql("@@", "'\"@@\"'")), F.lit("@@"), real))
    rows = c.select("conv_id", "turn", doc.alias("doc"))
    out = mask.scrub(rows, samples.META["shaped"])
    return out.withColumn("leaks", F.coalesce(F.contains("doc", F.lit("Real")), F.lit(False)))


@query("mask_request_two_paths", f"""WITH {IDS_ALL},
shift AS (SELECT o_orderkey, xor(o_custkey, 1) AS o_payer FROM orders)
SELECT 'buyer' AS path, l.l_orderkey, l.l_linenumber, i.asset_am AS l_extendedprice
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN ids i ON i.cust_id = c.c_custkey
WHERE c.{DRIVER_SQL}
UNION ALL
SELECT 'payer', l.l_orderkey, l.l_linenumber, i.asset_am
FROM lineitem l JOIN shift o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_payer = c.c_custkey JOIN ids i ON i.cust_id = c.c_custkey
WHERE c.{DRIVER_SQL}""")
def mask_request_two_paths(spark, sf):
    """Two tables of a request reach the customer over the same table by
    different columns; each gets the identities of its own path."""
    from ..plans.scrub import scrub_request
    t = _t(spark, sf)
    t["orders"] = t["orders"].withColumn("o_payer", F.col("o_custkey").bitwiseXOR(F.lit(1)))
    t["payment"] = t["lineitem"]
    out = scrub_request(t, [samples.META["lineitem"], samples.META["payment"]], GENERATOR,
                        driver_filter=driver(), unique_keys=UKS)
    cols = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    return out["lineitem"].select(F.lit("buyer").alias("path"), *cols).unionAll(
        out["payment"].select(F.lit("payer"), *cols))


# ---------------------------------------------------------------------------
# the scrub over a landing folder (Structured Streaming, availableNow)

@query("mask_stream_2hop", _lineitem_sql(IDS_ALL))
def mask_stream_2hop(spark, sf):
    """Extract files of line items land in a folder (two arrivals); the
    streaming scrub masks each file once and the output is read back."""
    from ..sinks.files import write_files
    from ..streaming.landing import start_scrub
    t = _t(spark, sf)
    meta = samples.META["lineitem"]
    rows = subset.extract_related(t, meta, driver_filter=driver())
    landing = stage_path(spark, "landing-lineitem")
    write_files(rows.where(F.col("l_returnflag") == "R"), f"{landing}/arrival1", "csv")
    write_files(rows.where(F.col("l_returnflag") != "R"), f"{landing}/arrival2", "csv")
    link, pairs = mask.driver_link(t, meta, UKS, identity=GENERATOR, driver_filter=driver())
    out = stage_path(spark, "scrubbed-lineitem")
    q = start_scrub(spark, meta, f"{landing}/*", out, identity=GENERATOR, link=link,
                    pairs=pairs)
    q.awaitTermination()
    return spark.read.parquet(out)


@query("mask_stream_restart", _lineitem_sql(IDS_ALL))
def mask_stream_restart(spark, sf):
    """A second arrival, processed by a second call with the default
    checkpoint: it resumes beside its output, so every row is there once."""
    from ..sinks.files import write_files
    from ..streaming.landing import start_scrub
    t = _t(spark, sf)
    meta = samples.META["lineitem"]
    rows = subset.extract_related(t, meta, driver_filter=driver())
    link, pairs = mask.driver_link(t, meta, UKS, identity=GENERATOR, driver_filter=driver())
    landing, out = stage_path(spark, "landing-twice"), stage_path(spark, "scrubbed-twice")
    first = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    for i, part in enumerate((first, ~first)):
        write_files(rows.where(part), f"{landing}/arrival{i}", "csv")
        start_scrub(spark, meta, f"{landing}/*", out, identity=GENERATOR, link=link,
                    pairs=pairs).awaitTermination()
    return spark.read.parquet(out)


@query("mask_request_shared_link", _ORDERS_SQL)
def mask_request_shared_link(spark, sf):
    """A request over orders and doc_request (both one hop from customer):
    their identity link is built once and checkpointed; the orders result."""
    return _shared_link(spark, sf)["orders"]


@query("mask_request_shared_docs", _DOC_JSON_SQL)
def mask_request_shared_docs(spark, sf):
    """The doc_request result of the same request."""
    return _shared_link(spark, sf)["doc_request"]


def _shared_link(spark, sf):
    from ..plans.scrub import scrub_request
    t = _t(spark, sf)
    t["doc_request"] = samples.doc_request_table(t["orders"], t["customer"])
    return scrub_request(t, [samples.META["orders"], samples.META["doc_request"]], GENERATOR,
                         driver_filter=driver(), unique_keys=UKS)


@query("mask_nested_no_driver", """
SELECT event_id, ts, user_id, event_type, value, '{"k":10}' AS props FROM events""")
def mask_nested_no_driver(spark, sf):
    """M15 inside JSON: a PII attribute of a table without driver gets its
    typed constant; no schema is gathered (values are VARIANT)."""
    ev = samples.load_tables(spark, sf, ("events",))["events"]
    return mask.scrub(ev, samples.META["events_nested"])


# ---------------------------------------------------------------------------
# format-preserving numbers, dense numbers, padded keys

FPE_SIZE = 10 ** 9


@query("mask_fpe_numbers", f"""
SELECT o_orderkey, cipher, o_orderkey AS restored, true AS walked_restored, true AS walked_inside
FROM {fpe_sql("orders", "o_orderkey", "cipher", FPE_SIZE, samples.TEST_SEED, "t")}""")
def mask_fpe_numbers(spark, sf):
    """Order keys under format-preserving encryption over nine digits,
    and back; and over a domain that is no power of ten (cycle walking)."""
    odd = 600_000_007
    k = F.col("o_orderkey")
    walked = fpe.encrypt_number(k, odd, _S, "w")
    return _t(spark, sf)["orders"].select(
        k, fpe.encrypt_number(k, FPE_SIZE, _S, "t").alias("cipher"), walked.alias("w")).select(
        k, "cipher", fpe.decrypt_number(F.col("cipher"), FPE_SIZE, _S, "t").alias("restored"),
        (fpe.decrypt_number(F.col("w"), odd, _S, "w") == k).alias("walked_restored"),
        F.col("w").between(0, odd - 1).alias("walked_inside"))


_TEXT_KEY = "'C' || CAST(c_custkey AS VARCHAR)"


@query("identity_dense", f"""
SELECT {_TEXT_KEY} AS key, row_number() OVER (ORDER BY {_TEXT_KEY}) - 1 AS number,
       count(*) OVER () AS persons, count(*) OVER () AS cm15, count(*) OVER () AS nat_id,
       count(*) OVER () AS bank
FROM customer""")
def identity_dense(spark, sf):
    """Text keys numbered densely in key order, over any number of ranges; as
    many different card, national and bank numbers as persons.  A second run over
    half the keys first, then all, keeps the first half's numbers."""
    from ..operators import dense
    keys = _t(spark, sf)["customer"].select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("key"),
        (F.col("c_custkey") % 2 == 0).alias("even"))
    numbers = dense.dense_numbers(keys.repartition(3), "key")
    again = dense.dense_numbers(keys, "key")
    half = dense.dense_numbers(keys.where("even"), "key")
    grown = dense.dense_numbers(keys, "key", known=half)
    same = numbers.join(again.withColumnRenamed("number", "n2"), "key").where("number = n2")
    kept = half.withColumnRenamed("number", "n3").join(grown, "key").where("number = n3")
    whole = (numbers.count() == same.count() and half.count() == kept.count()
             and grown.select("number").distinct().count() == numbers.count())
    fields = ["cust_id", "cm15", "nat_id", "bank_acct_no"]
    path = stage_path(spark, "numbers")          # made once, counted per column
    mask.identity_table(keys, "key", seed=_S, fields=fields, numbers=numbers).write.parquet(path)
    ids = spark.read.parquet(path)
    n = ids.agg(F.count_distinct("cust_id").alias("persons"), F.count_distinct("cm15").alias("cm15"),
                F.count_distinct("nat_id").alias("nat_id"),
                F.count_distinct("bank_acct_no").alias("bank")).first()
    out = numbers.select("key", "number", *[F.lit(n[c]).cast("bigint").alias(c) for c in n.asDict()])
    return out if whole else out.limit(0)


def _padded(t):
    """customer and orders with text keys, the orders' padded as a CHAR column."""
    text = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    parent = t["customer"].select(text.alias("p_key"), "c_mktsegment")
    child = t["orders"].select(
        "o_orderkey", F.rpad(F.concat(F.lit("C"), F.col("o_custkey").cast("string")), 16, " ")
        .alias("c_key"), F.lit("a name").alias("name_first"))
    return {"p": parent, "c": child}


_PADDED = TableMeta.from_document(samples.request(
    "c", [samples.col("o_orderkey", "NUMBER", 22, precision=18, pk=True),
          samples.col("c_key", "CHAR", 16),
          samples.col("name_first", "VARCHAR2", 20, pii=True,
                      rule="secondary_pii_indv_name:first_name")],
    driver=("p", "p_key"), edges=[("p", "p_key", "c", "c_key", 0)]))


@query("scrub_padded_keys", f"""
SELECT o_orderkey, rpad(k, 16, ' ') AS c_key,
       {_pick('first', idfn.FIRST_NAMES)} AS name_first, true AS extracted, true AS chained
FROM (SELECT o_orderkey, 'C' || CAST(o_custkey AS VARCHAR) AS k FROM orders
      WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE {DRIVER_SQL}))""")
def scrub_padded_keys(spark, sf):
    """J2 + J5 + J7: a child whose CHAR keys are padded at their end; extract, key
    chain and scrub find the same rows, and one person has one identity."""
    t = _padded(_t(spark, sf))
    pks = {"p": ["p_key"], "c": ["o_orderkey"]}
    rows = subset.extract_related(t, _PADDED, driver_filter=driver(), primary_keys=pks)
    chain = subset.key_chain(t, _PADDED, pks, driver_filter=driver())
    masked = scrub_related(t, _PADDED, GENERATOR, driver_filter=driver(), unique_keys=pks)
    rows = rows.select(F.col("o_orderkey").alias("x"), F.lit(True).alias("extracted"))
    chain = chain.select(F.col("c__o_orderkey").alias("y"), F.lit(True).alias("chained"))
    return masked.join(rows, F.col("o_orderkey") == F.col("x"), "full").join(
        chain, F.col("o_orderkey") == F.col("y"), "full").drop("x", "y")
