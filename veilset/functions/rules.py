"""Masking rules: which value replaces a PII column.

Resolution is driver-side over column metadata and yields a small
``Choice``; :mod:`veilset.functions.masks` turns a choice into a Column.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from ..catalog import ColumnMeta

# ---------------------------------------------------------------------------
# fixed values (must equal the request format's rule names and outputs)
#
# rule names, after normalisation (angle brackets stripped, '-' -> '_',
# blanks removed, '_15' -> '15')
RULE_DOB = "secondary_pia_dob"
RULE_CARD = ("primary_ban_acct_nbr", "primary_pan_acct_nbr15", "primary_pan_acct_nbr13",
             "primary_pan_acct_nbr11")
RULE_NAME = ("secondary_pii_indv_name:first_name", "secondary_pii_indv_name:last_name",
             "secondary_pii_indv_name:full_name_other")
RULE_ADDRESS_LINES = ("secondary_pii_address:line1", "secondary_pii_address:line2",
                      "secondary_pii_address:line3", "secondary_pii_address:line4")
RULE_FULL_ADDRESS = "secondary_pii_address:full_address_other"
RULE_ADDRESS_PARTS = ("secondary_pii_address:line5", "secondary_pii_address:city",
                      "secondary_pii_address:state", "secondary_pii_address:zip_code",
                      "secondary_pii_address:country")
RULE_EMAIL = "secondary_pii_email"
RULE_PHONE = "secondary_pii_telephone_cell_fax"
RULE_NATIONAL_ID = ("primary_nid_ssn", "secondary_cse_tax_id")
RULE_MARITAL = "secondary_pia_marital_status"
RULE_INCOME = "affiliated_pia_income"
RULE_BANK = "primary_ban_acct_nbr"
RULE_MR_NUMBER = "secondary_pii_mr_nbr"
MARITAL_VALUE = "MARRIED"
# name fragments, tested in this order (case-insensitive)
NAME_NULL = ("title", "suf", "pfx", "sffx")
NAME_EMPLOYER = ("emplr",)
NAME_FIRST = ("first", "frst", "1st", "fname", "fst", "first_name", "name_first")
NAME_MIDDLE = ("mid", "name_mid")
NAME_LAST = ("last", "lst", "lname", "name_last")
DOB_MONTH = ("nm", "mo")
DOB_YEAR = ("yy", "yr", "year")
DOB_DAY = "dd"                       # as a whole name token only (not in 'address')
INCOME_SELF = ("salary", "inc")
BANK_NAME = ("bank", "bnk")
BANK_NUMBER = ("num", "no", "nbr")
# typed constants by declared type and length
CONST_STRING_KINDS = ("varchar", "varchar2", "string", "blob", "clob")
CONST_NUMBER_KINDS = ("number", "int", "double", "float")
CONST_SHORT_STRING = "a"             # length 1-2
CONST_STRING = "abc"
CONST_CHAR = "a"
CONST_SHORT_NUMBER = 4               # length 1-2
CONST_NUMBER = 10
CONST_DATE = _dt.date(2003, 5, 3)
# identity key by driver rule; a driver column named like a customer id joins cust_id
DRIVER_RULE_KEY = {"primary_pan_acct_nbr15": "cm15", "primary_pan_acct_nbr13": "cm13",
                   "primary_pan_acct_nbr11": "cm11"}
CUSTOMER_ID_NAMES = ("cust", "customer")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Choice:
    kind: str                  # keep | identity | constant | null
    field: str | None = None   # identity field, or 'month' / 'year' / 'day' of cm_dob,
    value: object = None       # 'full_name', 'full_address'


def _has(name: str, fragments) -> bool:
    n = name.lower()
    return any(f.lower() in n for f in fragments)


def _has_token(name: str, token: str) -> bool:
    return re.search(rf"(^|[^a-z]){token}([^a-z]|$)", name.lower()) is not None


_KIND_ALIASES = {"integer": "int", "bigint": "int", "smallint": "int", "numeric": "number",
                 "decimal": "number", "character varying": "varchar", "text": "string",
                 "nvarchar2": "varchar2", "nchar": "char", "real": "float"}


def typed_constant_value(cm: ColumnMeta):
    """The fixed replacement value of a column by declared type and length
    (length 0 counts as absent)."""
    kind = _KIND_ALIASES.get(cm.kind, cm.kind)
    length = cm.length
    if length is not None:
        if length < 3 and kind in CONST_STRING_KINDS:
            return CONST_SHORT_STRING
        if length < 3 and kind in CONST_NUMBER_KINDS:
            return CONST_SHORT_NUMBER
        if kind == "char":
            return CONST_CHAR
        if kind in CONST_NUMBER_KINDS:
            return CONST_NUMBER
        if kind == "date":
            return CONST_DATE
        return CONST_STRING
    if kind in CONST_STRING_KINDS:
        return CONST_STRING
    if kind == "char":
        return CONST_CHAR
    if kind in CONST_NUMBER_KINDS:
        return CONST_NUMBER
    if kind == "date":
        return CONST_DATE
    return CONST_STRING


def name_field(column_name: str) -> str | None:
    """M3: identity name field chosen by the column's name (None -> NULL)."""
    if _has(column_name, NAME_NULL):
        return None
    if _has(column_name, NAME_EMPLOYER):
        return "emplr_nm"
    if _has(column_name, NAME_FIRST):
        return "first_nm"
    if _has(column_name, NAME_MIDDLE):
        return "mid_nm"
    if _has(column_name, NAME_LAST):
        return "lst_nm"
    return "full_name"


def dob_field(column_name: str) -> str:
    """M1: part of the identity's birth date chosen by the column's name."""
    if _has(column_name, DOB_MONTH):
        return "month"
    if _has(column_name, DOB_YEAR):
        return "year"
    if _has_token(column_name, DOB_DAY):
        return "day"
    return "cm_dob"


_ADDRESS_BY_NAME = (
    (("city",), "city"), (("state",), "state"), (("zip", "postal"), "zip_code"),
    (("country", "cntry"), "country"),
    (("line1", "ln1", "line_1"), "addr_line1"), (("line2", "ln2", "line_2"), "addr_line2"),
    (("line3", "ln3", "line_3"), "addr_line3"), (("line4", "ln4", "line_4"), "addr_line4"),
    (("line5", "ln5", "line_5"), "addr_line5"),
    (("addr",), "full_address"),
)


def address_field(column_name: str) -> str | None:
    """Identity address part chosen by the column's name (None: nothing fits)."""
    for fragments, field in _ADDRESS_BY_NAME:
        if _has(column_name, fragments):
            return field
    return None


def _rule_part(rule: str) -> str:
    part = rule.split(":", 1)[1]
    return {"line1": "addr_line1", "line2": "addr_line2", "line3": "addr_line3",
            "line4": "addr_line4", "line5": "addr_line5"}.get(part, part)


def resolve(cm: ColumnMeta, has_driver: bool, name: str | None = None) -> Choice:
    """The choice for one column (or nested attribute named ``name``)."""
    name = name or cm.name
    if not cm.is_pii:
        return Choice("keep")                                   # M16
    if not has_driver:
        return Choice("constant", value=typed_constant_value(cm))   # M15
    if cm.is_pk:
        return Choice("keep")                                   # M17
    rule = cm.rule
    if rule == RULE_DOB:
        return Choice("identity", dob_field(name))             # M1
    if rule == RULE_BANK and _has(name, BANK_NAME) and _has(name, BANK_NUMBER):
        return Choice("identity", "bank_acct_no")               # M12
    if rule in RULE_CARD:                                       # M2
        return Choice("identity", {"primary_pan_acct_nbr13": "cm13",
                                   "primary_pan_acct_nbr11": "cm11"}.get(rule, "cm15"))
    if rule in RULE_NAME:                                       # M3
        f = name_field(name)
        return Choice("null") if f is None else Choice("identity", f)
    if rule in RULE_ADDRESS_LINES or rule in RULE_ADDRESS_PARTS:   # M4, M6
        return Choice("identity", _rule_part(rule))
    if rule == RULE_FULL_ADDRESS:                               # M5
        f = address_field(name)
        return Choice("identity", f) if f else Choice("constant", value=typed_constant_value(cm))
    if rule == RULE_EMAIL:
        return Choice("identity", "email")                      # M7
    if rule == RULE_PHONE:
        return Choice("identity", "phone")                      # M8
    if rule in RULE_NATIONAL_ID:
        return Choice("identity", "nat_id")                     # M9
    if rule == RULE_MARITAL:
        return Choice("constant", value=MARITAL_VALUE)          # M10
    if rule == RULE_INCOME:                                     # M11
        return Choice("identity", "incom_self" if _has(name, INCOME_SELF) else "asset_am")
    return Choice("constant", value=typed_constant_value(cm))   # M13, M14


def identity_key(driver_rule: str | None, driver_column: str | None) -> str:
    """Identity column matched by the driver column."""
    if driver_rule in DRIVER_RULE_KEY:
        return DRIVER_RULE_KEY[driver_rule]
    if driver_rule is None and driver_column and _has(driver_column, CUSTOMER_ID_NAMES):
        return "cust_id"
    raise ValueError(
        f"no identity join for driver column {driver_column!r} with rule {driver_rule!r}")
