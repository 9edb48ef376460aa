"""Physical-plan summary of the headline queries (final AQE plans).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
For each query: joins (strategy, type), exchanges, and for every scan the
pushed filters and the columns read.  Run with the recommended settings.
"""
import re
import sys

from pyspark.sql import SparkSession

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])
from veilset import registry  # noqa: E402
from veilset.session import apply_recommended_conf  # noqa: E402

HEADLINE = ["extract_2hop", "keys_chain", "mask_identity_2hop", "mask_identity_1hop_table",
            "mask_nested_json", "encrypt_roundtrip", "load_restore_keys", "validate_rows",
            "load_dedup", "validate_pk"]


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect() if df.count() < 200000 else None
    return df._jdf.queryExecution().executedPlan().toString()


def summarize(plan: str) -> list[str]:
    final = plan.split("== Initial Plan ==")[0]
    out = []
    joins = re.findall(r"(SortMergeJoin(?:\(skew=true\))?|BroadcastHashJoin|ShuffledHashJoin)"
                       r"[^\n]*?(Inner|LeftSemi|LeftAnti|LeftOuter|FullOuter)", final)
    out.append("joins: " + (", ".join(f"{a} {b}" for a, b in joins) or "none"))
    ex = re.findall(r"Exchange (hashpartitioning\(([^,]+)[^)]*\)|RoundRobinPartitioning\(\d+\)|"
                    r"SinglePartition|rangepartitioning)", final)
    out.append(f"exchanges: {len(ex)} (" + ", ".join(
        (f"hash({k.strip()})" if k else e.split("(")[0]) for e, k in ex) + ")")
    aggs = len(re.findall(r"HashAggregate|SortAggregate|ObjectHashAggregate", final))
    out.append(f"aggregate operators: {aggs}")
    for m in re.finditer(r"FileScan parquet [^\n]*?Location: [^\[]*\[([^\]]+)\][^\n]*?"
                         r"PushedFilters: \[([^\]]*)\], ReadSchema: (struct<[^\n]*>?)", final):
        table = m.group(1).rsplit("/", 1)[-1]
        out.append(f"scan {table}: pushed [{m.group(2)}] read {m.group(3)[:120]}")
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    apply_recommended_conf(spark)
    registry.load_all()
    print("# Plans of the headline queries\n")
    print(f"Final adaptive plans at `{sf}` under `session.RECOMMENDED_CONF`, produced by "
          "`tools/plan_report.py` (regenerate after changing a plan).  Two passes: as run "
          "(AQE broadcasts a side once its shuffle stage measured under 32 MB, which at this "
          "scale is every key side), and the at-scale shape with runtime broadcast off (what "
          "a 100 TB run gets when no side is small).  Exchanges list the hash key of each "
          "shuffle.\n")
    passes = [("as run", None), ("at-scale shape (no broadcast)", "-1")]
    for title, threshold in passes:
        if threshold:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
        print(f"# {title}\n")
        for name in HEADLINE:
            plan = final_plan(registry.QUERIES[name](spark, sf))
            print(f"## {name}\n")
            for line in summarize(plan):
                print(f"* {line}")
            print()
    spark.stop()


if __name__ == "__main__":
    main()
