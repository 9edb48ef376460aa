"""End-to-end jobs: extract -> files + key tables, scrub, load with stage."""
import pytest
from pyspark.sql import functions as F

from veilset import samples
from veilset.operators import load, mask, subset
from veilset.plans.extract import run_extract
from veilset.plans.load import run_load
from veilset.plans.scrub import run_scrub
from veilset.session import stage_path
from veilset.sinks.files import write_files
from veilset.sources import files, jdbc

def driver():
    return F.col("c_mktsegment") == "BUILDING"



def test_extract_scrub_load_round(spark, tables):
    meta = samples.META["lineitem"]
    out = stage_path(spark, "t-extract")
    keys = stage_path(spark, "t-keys")
    rec = run_extract(spark, tables, meta, out, driver_filter=driver(), key_base=keys,
                      primary_keys=samples.PRIMARY_KEYS)
    n = rec.first().records_processed
    assert n == subset.extract_related(tables, meta, driver_filter=driver()).count()
    back = files.read_declared(spark, out, meta, "csv")
    assert back.where(F.col("l_extendedprice").isNotNull()).count() == 0   # PII nulled
    levels = {t: files.read_key_table(spark, f"{keys}/{t}") for t in ("customer", "orders")}
    assert levels["orders"].columns == ["customer_c_custkey", "orders_o_orderkey"]

    ident = mask.identity_table(tables["customer"], "c_custkey", seed=samples.TEST_SEED, unique=True)
    link, pairs = mask.driver_link(tables, meta, identity=ident, driver_filter=driver())
    scrubbed = stage_path(spark, "t-scrub")
    rec2 = run_scrub(spark, back, meta, scrubbed, link=link, pairs=pairs)
    assert rec2.first().records_processed == n

    target = load.FileTarget(stage_path(spark, "t-target"), "parquet")
    target.write(tables["lineitem"].limit(0), "overwrite")
    rec3 = run_load(spark, out, meta, target, "full_refresh", fail_on_invalid=False)
    assert rec3.first().records_processed == n


def test_empty_relational_extract_writes_no_rows(spark, tables):
    meta = samples.META["lineitem"]
    out = stage_path(spark, "t-empty")
    rec = run_extract(spark, tables, meta, out,
                      driver_filter=F.col("c_mktsegment") == "NONE")
    assert rec.first().records_processed == 0
    assert spark.read.option("header", True).csv(out).count() == 0     # no rows


def test_empty_filter_extract_is_not_written(spark, tables):
    from dataclasses import replace

    from veilset.catalog import FilterSpec
    meta = replace(samples.META["orders"], edges=(), relational=False, extract_type="F",
                   filters=(FilterSpec("o_orderpriority", "=", ("NONE",)),))
    out = stage_path(spark, "t-empty2")
    rec = run_extract(spark, tables, meta, out)
    assert rec.first().records_processed == 0
    import os
    assert not os.path.exists(out.replace("file:", ""))


def test_load_rejects_invalid_rows(spark, tables):
    from dataclasses import replace
    meta = samples.META["orders"]
    strict = replace(meta, columns=tuple(replace(c, length=5) if c.name == "o_orderpriority"
                                         else c for c in meta.columns))
    src = stage_path(spark, "t-orders")
    tables["orders"].write.option("header", True).csv(src)
    target = load.FileTarget(stage_path(spark, "t-target2"), "parquet")
    with pytest.raises(ValueError):
        run_load(spark, src, strict, target, "full_refresh")


def test_relational_extract_needs_edges(tables):
    from dataclasses import replace
    meta = replace(samples.META["orders"], edges=())
    with pytest.raises(ValueError):
        subset.extract_related(tables, meta, driver_filter=driver())


def test_jdbc_options_and_partitions():
    src = jdbc.JdbcSource("oracle", "db.example", 1521, "svc", user="u", password="s3cr3t-value")
    o = src.options()
    assert o["url"] == "jdbc:oracle:thin:@//db.example:1521/svc"
    assert o["fetchsize"] == "10000" and o["driver"] == "oracle.jdbc.OracleDriver"
    assert "s3cr3t-value" not in repr(src)
    p = jdbc.partition_options("ID", 1, 100, 4)
    assert p == {"partitionColumn": "ID", "lowerBound": "1", "upperBound": "100",
                 "numPartitions": "4"}
    with pytest.raises(ValueError):
        jdbc.JdbcSource("cassandra").url()


def test_partitioned_scan_wraps_queries():
    src = jdbc.JdbcSource("postgresql", "db.example", 5432, "dw")
    o = jdbc.partitioned_scan_options(src, "SELECT * FROM t WHERE x > 1", column="id",
                                      lower=0, upper=10, partitions=2)
    assert o["dbtable"] == "(SELECT * FROM t WHERE x > 1) q"
    assert o["url"] == "jdbc:postgresql://db.example:5432/dw" and o["numPartitions"] == "2"
    assert jdbc.partitioned_scan_options(src, "schema.t", column="id", lower=0, upper=10,
                                         partitions=2)["dbtable"] == "schema.t"


def test_link_from_key_tables_matches_source_link(spark, tables):
    """Three tables, composite last hop: the link read from the written key
    tables equals the link computed from the sources."""
    t = dict(tables)
    t["returned_lines"] = samples.returned_lines(t["lineitem"])
    meta = samples.META["returned_lines"]
    urgent = F.col("o_orderpriority") == "1-URGENT"
    chain = subset.key_chain(t, meta, samples.PRIMARY_KEYS, driver_filter=urgent, fold=False)
    base = stage_path(spark, "t-levels")
    paths = subset.write_level_keys(chain, meta, samples.PRIMARY_KEYS, base)
    levels = {}
    for name, path in paths.items():
        df = subset.undotted(spark.read.option("header", True).csv(path))
        levels[name] = df.select(*[F.col(c).cast("bigint") for c in df.columns])
    from_keys, pairs = mask.link_from_key_tables(levels, meta, samples.UNIQUE_KEYS)
    from_src, pairs2 = mask.driver_link(t, meta, samples.UNIQUE_KEYS,
                                        identity=mask.identity_generator(samples.TEST_SEED), driver_filter=urgent)
    cols = [k for _, k in pairs] + [mask.DRIVER_KEY]
    assert pairs == pairs2
    a, b = from_keys.select(*cols), from_src.select(*cols)
    # key tables hold only parent keys that lead to a target row (the chain
    # ends at the target); on those keys both links agree, one row per key
    keys_only = [k for _, k in pairs]
    b_on_a = b.join(a.select(*keys_only), keys_only, "left_semi")
    assert a.count() > 0 and a.exceptAll(b_on_a).count() == 0
    assert b_on_a.exceptAll(a).count() == 0
    assert b.groupBy(*keys_only).count().where("count > 1").count() == 0



def test_unique_key_tables_finds_broken_keys(tables):
    from veilset.operators import validate
    got = validate.unique_key_tables(tables, samples.PRIMARY_KEYS)
    assert got == samples.UNIQUE_KEYS


def test_scrub_request_shares_links(spark, tables):
    """orders and doc_request both hang off customer: one shared link, same
    results as scrubbing each table on its own."""
    from veilset.plans.scrub import scrub_related, scrub_request
    t = dict(tables)
    t["doc_request"] = samples.doc_request_table(t["orders"], t["customer"])
    gen = mask.identity_generator(samples.TEST_SEED)
    metas = [samples.META["orders"], samples.META["doc_request"], samples.META["lineitem"]]
    got = scrub_request(t, metas, gen, driver_filter=driver(), unique_keys=samples.UNIQUE_KEYS)
    assert set(got) == {"orders", "doc_request", "lineitem"}
    for m in metas:
        alone = scrub_related(t, m, gen, driver_filter=driver(), unique_keys=samples.UNIQUE_KEYS)
        a = got[m.table_name]
        assert a.schema == alone.schema
        assert a.exceptAll(alone).count() == 0 and alone.exceptAll(a).count() == 0


def test_request_scan_uses_partition_range():
    from dataclasses import replace
    src = jdbc.JdbcSource("oracle", "db.example", 1521, "svc")
    meta = samples.META["orders"]
    whole = jdbc.request_scan_options(src, meta)
    assert whole["dbtable"] == "tpch.orders" and "partitionColumn" not in whole
    ranged = replace(meta, partition_column="o_orderkey", partition_range=("1", "6000000"))
    o = jdbc.request_scan_options(src, ranged, partitions=16)
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == \
        ("o_orderkey", "1", "6000000", "16")


def test_typed_split_in_one_pass(spark, tables):
    from dataclasses import replace

    from veilset.operators import validate
    meta = samples.META["orders"]
    strict = replace(meta, columns=tuple(replace(c, length=10) if c.name == "o_orderpriority"
                                         else c for c in meta.columns))
    src = write_files(tables["orders"], stage_path(spark, "t-text"), "csv")
    text = spark.read.option("header", True).csv(src)
    sc = spark.sparkContext
    sc.setJobGroup("split", "one pass")
    paths = validate.write_typed_split(text, strict, stage_path(spark, "t-split"))
    jobs = len(sc.statusTracker().getJobIdsForGroup("split"))
    sc.setJobGroup("", "")
    assert jobs == 1
    good, rejected = validate.split_typed(text, strict)
    g = spark.read.parquet(paths["good"]).select(*good.columns)
    r = spark.read.parquet(paths["rejected"])
    assert g.exceptAll(good).count() == 0 and good.exceptAll(g).count() == 0
    assert r.count() == rejected.count() > 0


def test_readme_flow(spark, tables):
    """The README's usage example, on the sample tables."""
    from veilset.operators import validate
    from veilset.plans.scrub import scrub_request
    metas = [samples.META["customer"], samples.META["orders"], samples.META["lineitem"]]
    keyfile = stage_path(spark, "t-keylist")
    tables["customer"].where(driver()).select(F.col("c_custkey").cast("string").alias("value")) \
        .write.text(keyfile)
    keys = files.read_key_list(spark, keyfile, ["c_custkey"], ["bigint"])
    base = stage_path(spark, "t-req")
    counts = {}
    for meta in metas:
        rec = run_extract(spark, tables, meta, f"{base}/{meta.table_name}", driver_keys=keys,
                          env_key=samples.TEST_ENV_KEY, key_base=f"{base}/keys",
                          primary_keys=samples.PRIMARY_KEYS)
        counts[meta.table_name] = rec.first().records_processed
    want = {m.table_name: subset.extract_related(tables, m, driver_keys=keys).count()
            for m in metas}
    assert counts == want and counts["lineitem"] == 1336      # SURVEY: 1,336 at sf0.001
    unique = validate.unique_key_tables(tables, samples.PRIMARY_KEYS)
    masked = scrub_request(tables, metas, mask.identity_generator(samples.TEST_SEED), driver_keys=keys,
                           unique_keys=unique)
    assert {k: v.count() for k, v in masked.items()} == counts


def test_jdbc_write_caps_connections():
    src = jdbc.JdbcSource("postgresql", "db.example", 5432, "dw")
    o = jdbc.write_options(src, "public.orders")
    assert o["numPartitions"] == "32" and o["truncate"] == "true" and o["dbtable"] == "public.orders"
