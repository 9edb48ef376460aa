"""Benchmark of the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and
prints ONE JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is fully executed (written to the no-op sink, or through its own
writes) after one warm-up pass, and timed as the best of $BENCH_REPEAT (default 3) runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from veilset import registry  # noqa: E402
from veilset.session import apply_recommended_conf  # noqa: E402

HEADLINE = ["extract_2hop", "keys_chain", "mask_identity_2hop", "encrypt_roundtrip",
            "load_upsert"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    scratch = tempfile.mkdtemp(prefix="veilset-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("veilset-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", str(max(8, cpus * 2)))
             .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    apply_recommended_conf(spark)
    registry.load_all()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:          # warm-up: JIT, file listing caches
        run(name)
    times = {name: round(min(run(name) for _ in range(repeat)), 3) for name in HEADLINE}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
