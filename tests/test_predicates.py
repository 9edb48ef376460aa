import pytest
from pyspark.sql import functions as F

from veilset import samples
from veilset.catalog import FilterSpec
from veilset.functions.predicates import condition, fold


def _count(tables, table, spec):
    df = tables[table]
    meta = samples.META[table]
    return df.where(condition(spec, meta.column(spec.column), df.schema[spec.column].dataType)).count()


def test_date_equality_is_by_day(tables):
    ev = tables["events"]
    n = _count(tables, "events", FilterSpec("ts", "=", ("2024-01-03",)))
    expect = ev.where(F.to_date("ts") == F.lit("2024-01-03")).count()
    assert n == expect and n > 0


def test_date_between_uses_midnight_bounds(tables):
    ev = tables["events"]
    n = _count(tables, "events", FilterSpec("ts", "BETWEEN", ("2024-01-02", "2024-01-03")))
    whole_days = ev.where(F.to_date("ts").between("2024-01-02", "2024-01-03")).count()
    assert n < whole_days


def test_between_needs_two_values(tables):
    with pytest.raises(ValueError):
        _count(tables, "orders", FilterSpec("o_totalprice", "BETWEEN", ("1",)))


def test_unknown_condition(tables):
    with pytest.raises(ValueError):
        _count(tables, "orders", FilterSpec("o_totalprice", "LIKE", ("1",)))


def test_fold_operators():
    assert fold([]) is None
    with pytest.raises(ValueError):
        fold([F.lit(True)], "XOR")
