"""A key holding a third of the rows is split by AQE in the joins that touch
the big table (semi join of an extract, the fused extract+mask join)."""
import pytest
from pyspark.sql import functions as F

from veilset import samples
from veilset.operators import mask, subset
from veilset.plans.scrub import scrub_related

SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot_tables(spark):
    t = samples.load_tables(spark, "/root/testdata/sf0.01", ("customer", "orders", "lineitem"))
    li = t["lineitem"]
    # one order gets every line item with line number <= 2 (about a third of all rows)
    hot_order = t["orders"].agg(F.min("o_orderkey")).first()[0]
    # AQE splits a skewed partition along map outputs: read the table with
    # several map tasks, as a large input always is
    t["lineitem"] = li.repartition(6).withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") <= 2, F.lit(hot_order))
        .otherwise(F.col("l_orderkey")))
    return t


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_extract_splits_hot_key(spark, skew_conf):
    t = _hot_tables(spark)
    df = subset.extract_related(t, samples.META["lineitem"],
                                driver_filter=F.col("c_mktsegment").isNotNull(),
                                primary_keys=samples.PRIMARY_KEYS)
    assert "skew=true" in _final_plan(df)


def test_fused_mask_splits_hot_key(spark, skew_conf):
    t = _hot_tables(spark)
    df = scrub_related(t, samples.META["lineitem"], mask.identity_generator(samples.TEST_SEED),
                       driver_filter=F.col("c_mktsegment").isNotNull(),
                       unique_keys=samples.UNIQUE_KEYS)
    plan = _final_plan(df)
    assert "skew=true" in plan
    assert df.count() == t["lineitem"].count()


def test_stored_identity_one_hop_splits_hot_key(spark, skew_conf):
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    try:
        t = samples.load_tables(spark, "/root/testdata/sf0.01", ("customer", "orders"))
        hot = t["customer"].agg(F.min("c_custkey")).first()[0]
        t["orders"] = t["orders"].repartition(6).withColumn(
            "o_custkey", F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(hot))
            .otherwise(F.col("o_custkey")))
        ident = mask.identity_table(t["customer"], "c_custkey", seed=samples.TEST_SEED, unique=True)
        df = scrub_related(t, samples.META["orders"], ident,
                           driver_filter=F.col("c_mktsegment").isNotNull(),
                           unique_keys=samples.UNIQUE_KEYS)
        assert "skew=true" in _final_plan(df)
        assert df.count() == t["orders"].count()
    finally:
        spark.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")


def test_masked_rows_are_not_sorted_for_the_link(spark, skew_conf):
    """The link is hashed: no task holds its share of the large table to sort it."""
    t = samples.load_tables(spark, "/root/testdata/sf0.001", ("customer", "orders", "lineitem"))
    df = scrub_related(t, samples.META["lineitem"], mask.identity_generator(samples.TEST_SEED),
                       driver_filter=F.col("c_mktsegment").isNotNull(),
                       unique_keys=samples.UNIQUE_KEYS)
    join = _final_plan(df).split("ShuffledHashJoin", 1)
    assert len(join) == 2 and "Sort " not in join[0]
    assert df.count() == t["lineitem"].count()
