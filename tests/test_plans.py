"""Plan checks: pushdown, pruning of nulled PII, no Python in any plan."""
import pytest
from pyspark.sql import functions as F

from veilset import registry, samples
from veilset.operators import protect, subset

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nulled_pii_is_not_read(tables):
    df = protect.extract_projection(tables["customer"], samples.META["customer"])
    plan = _plan(df)
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "c_custkey" in schema and "c_name" not in schema and "c_acctbal" not in schema


def test_filters_reach_the_scan(tables):
    df = subset.extract_related(tables, samples.META["lineitem"],
                                driver_filter=F.col("c_mktsegment") == "BUILDING")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan


def test_day_compare_is_pushed_as_range(tables):
    meta = samples.META["events"]
    from veilset.catalog import FilterSpec
    from veilset.functions.predicates import condition
    ev = tables["events"]
    df = ev.where(condition(FilterSpec("ts", "=", ("2024-01-03",)), meta.column("ts"),
                            ev.schema["ts"].dataType))
    plan = _plan(df)
    assert "GreaterThanOrEqual(ts,2024-01-03T00:00)" in plan
    assert "LessThan(ts,2024-01-04T00:00)" in plan


def test_scans_read_only_needed_columns(tables):
    df = subset.extract_related(tables, samples.META["lineitem"],
                                driver_filter=F.col("c_mktsegment") == "BUILDING")
    plan = _plan(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan


def test_small_key_set_becomes_pushed_in_list(tables):
    keys = tables["customer"].where(F.col("c_mktsegment") == "BUILDING") \
        .select(F.col("c_custkey").alias("k"))
    df = subset.semi_join(tables["orders"], keys, [("o_custkey", "k")], strategy="isin",
                          isin_limit=1000)
    assert "In(o_custkey" in _plan(df)
    with pytest.raises(ValueError):
        subset.semi_join(tables["orders"], keys, [("o_custkey", "k")], strategy="isin",
                         isin_limit=5)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_python_in_plans(spark, name):
    registry.load_all()
    plan = _plan(registry.QUERIES[name](spark, SF))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_masked_big_table_is_shuffled_once(spark):
    registry.load_all()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.QUERIES["mask_identity_2hop"](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lineitem_scans = plan.count("lineitem.parquet")
    assert lineitem_scans == 1


def test_keys_are_redacted_in_plans(spark, capsys):
    from veilset.functions import crypto
    from veilset.session import RECOMMENDED_CONF
    key = "spark.sql.redaction.string.regex"
    old = spark.conf.get(key, None)
    spark.conf.set(key, RECOMMENDED_CONF[key])
    try:
        df = spark.range(2).select(crypto.encrypt(F.col("id"), samples.TEST_ENV_KEY).alias("c"))
        df.explain(True)
        out = capsys.readouterr().out
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
    assert "redacted" in out and samples.TEST_ENV_KEY.hex().upper() not in out.upper()


def test_building_plans_runs_no_jobs(spark, tables):
    """Extract, chain, fused mask, link, upsert and validation plans are lazy:
    building them starts no Spark job (actions belong to the caller)."""
    from veilset.operators import load, mask, validate
    from veilset.plans.scrub import scrub_related
    sc = spark.sparkContext
    st = sc.statusTracker()
    sc.setJobGroup("lazy-check", "plan building only")
    try:
        building = F.col("c_mktsegment") == "BUILDING"
        subset.extract_related(tables, samples.META["lineitem"], driver_filter=building,
                               primary_keys=samples.PRIMARY_KEYS)
        subset.key_chain(tables, samples.META["lineitem"], samples.PRIMARY_KEYS,
                         driver_filter=building)
        gen = mask.identity_generator(samples.TEST_SEED)
        scrub_related(tables, samples.META["lineitem"], gen, driver_filter=building,
                      unique_keys=samples.UNIQUE_KEYS)
        ident = mask.identity_table(tables["customer"], "c_custkey", seed=samples.TEST_SEED, unique=True)
        scrub_related(tables, samples.META["orders"], ident, driver_filter=building,
                      unique_keys=samples.UNIQUE_KEYS)
        load.upsert(tables["orders"], tables["orders"], ["o_orderkey"])
        validate.validate_rows(tables["orders"], samples.META["orders"])
        protect.encrypt_columns(tables["orders"], ["o_orderkey"], samples.TEST_ENV_KEY)
        jobs = st.getJobIdsForGroup("lazy-check")
    finally:
        sc.setJobGroup("", "")
    assert list(jobs) == []


def test_large_key_lists_are_pushed_in_chunks(tables):
    keys = tables["lineitem"].select(F.col("l_orderkey").alias("k"))
    df = subset.semi_join(tables["lineitem"], keys, [("l_orderkey", "k")], strategy="isin",
                          isin_limit=5000)
    n_keys = keys.distinct().count()
    assert 1000 < n_keys <= 5000
    plan = _plan(df)
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "Or(In(l_orderkey" in pushed
    assert df.count() == tables["lineitem"].count()
