"""The landing-folder scrub resumes from its checkpoint: each file once."""
from pyspark.sql import functions as F

from veilset import samples
from veilset.operators import mask, subset
from veilset.session import stage_path
from veilset.sinks.files import write_files
from veilset.streaming.landing import start_scrub


def test_second_run_processes_only_new_files(spark, tables):
    meta = samples.META["lineitem"]
    building = F.col("c_mktsegment") == "BUILDING"
    rows = subset.extract_related(tables, meta, driver_filter=building)
    gen = mask.identity_generator(samples.TEST_SEED)
    link, pairs = mask.driver_link(tables, meta, samples.UNIQUE_KEYS, identity=gen,
                                   driver_filter=building)
    landing, out = stage_path(spark, "t-landing"), stage_path(spark, "t-out")
    ckpt = stage_path(spark, "t-ckpt")
    first = rows.where(F.col("l_returnflag") == "R")
    rest = rows.where(F.col("l_returnflag") != "R")

    write_files(first, f"{landing}/a", "csv")
    start_scrub(spark, meta, f"{landing}/*", out, identity=gen, link=link, pairs=pairs,
                checkpoint=ckpt).awaitTermination()
    n1 = spark.read.parquet(out).count()
    assert n1 == first.count()

    write_files(rest, f"{landing}/b", "csv")
    start_scrub(spark, meta, f"{landing}/*", out, identity=gen, link=link, pairs=pairs,
                checkpoint=ckpt).awaitTermination()
    result = spark.read.parquet(out)
    assert result.count() == rows.count()                     # nothing twice, nothing lost
    batch = mask.scrub(rows, meta, gen, link=link, pairs=pairs)
    assert result.exceptAll(batch).count() == 0
