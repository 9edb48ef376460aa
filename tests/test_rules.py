import datetime as dt

import pytest

from veilset.catalog import ColumnMeta
from veilset.functions import rules


def c(name, rule=None, kind="VARCHAR2", length=None, pii=True, pk=False):
    return ColumnMeta(name=name, data_type=kind, length=length, is_pii=pii, is_pk=pk,
                      rule=rule)


@pytest.mark.parametrize("name,field", [
    ("cust_title", None), ("name_sfx_suf", None), ("emplr_nm", "emplr_nm"),
    ("FIRST_NAME", "first_nm"), ("fname", "first_nm"), ("Name_MID", "mid_nm"),
    ("lst_nm", "lst_nm"), ("NAME_LAST", "lst_nm"), ("c_name", "full_name")])
def test_name_by_column(name, field):
    assert rules.name_field(name) == field


@pytest.mark.parametrize("name,part", [
    ("dob_mo", "month"), ("birth_year", "year"), ("dob_yy", "year"), ("dob_dd", "day"),
    ("home_address_dob", "cm_dob"), ("birth_dt", "cm_dob")])
def test_dob_parts(name, part):
    assert rules.dob_field(name) == part


def test_bank_name_tested_before_card():
    ch = rules.resolve(c("bank_acct_no", "primary_ban_acct_nbr"), True)
    assert ch == rules.Choice("identity", "bank_acct_no")
    ch = rules.resolve(c("ban_ref", "primary_ban_acct_nbr"), True)
    assert ch == rules.Choice("identity", "cm15")


def test_keep_and_constant_paths():
    assert rules.resolve(c("x", pii=False), True).kind == "keep"
    assert rules.resolve(c("x", "secondary_pii_email", pk=True), True).kind == "keep"
    assert rules.resolve(c("x", "secondary_pii_email"), False).kind == "constant"
    assert rules.resolve(c("x", "secondary_pii_mr_nbr", length=2), True) == \
        rules.Choice("constant", value="a")
    assert rules.resolve(c("x", "something_new", kind="NUMBER", length=22), True) == \
        rules.Choice("constant", value=10)


@pytest.mark.parametrize("kind,length,value", [
    ("varchar2", 2, "a"), ("varchar2", 10, "abc"), ("varchar2", None, "abc"),
    ("char", 5, "a"), ("char", None, "a"), ("number", 1, 4), ("number", 22, 10),
    ("number", None, 10), ("date", 7, dt.date(2003, 5, 3)), ("date", None, dt.date(2003, 5, 3)),
    ("geometry", 5, "abc"), ("integer", 2, 4)])
def test_typed_constants(kind, length, value):
    assert rules.typed_constant_value(ColumnMeta("x", kind, length)) == value


def test_identity_key():
    assert rules.identity_key("primary_pan_acct_nbr15", "acct") == "cm15"
    assert rules.identity_key(None, "c_custkey") == "cust_id"
    with pytest.raises(ValueError):
        rules.identity_key(None, "account_num")
