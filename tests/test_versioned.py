"""File-level upsert under a manifest, and loads that fail half-way."""
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from veilset.operators import load, reconcile
from veilset.operators.versioned import VersionedTarget
from veilset.session import path_exists, stage_path


def table(spark, lo, hi, mark):
    return spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(mark).alias("v"))


def contents(path):
    base = path.replace("file:", "")
    out = {}
    for folder, _, names in os.walk(base):
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(folder, n), "rb") as f:
                    out[os.path.relpath(os.path.join(folder, n), base)] = hashlib.sha256(
                        f.read()).hexdigest()
    return out


@pytest.fixture
def target(spark):
    t = VersionedTarget(stage_path(spark, "t-versioned"), ("k",), rows_per_file=100)
    t.write(table(spark, 0, 2000, "old"), "overwrite")
    return t


def test_untouched_files_keep_name_and_bytes(spark, target):
    before, index = contents(target.path), target.index(spark).collect()
    assert len(index) >= 20 and sum(r["rows"] for r in index) == 2000
    inc = table(spark, 150, 160, "new").unionAll(table(spark, 5000, 5020, "more"))
    report = {}
    n = load.load(spark, inc, target, "upsert", key=["k"], report=report)
    assert n == 2020
    got = {r["k"]: r["v"] for r in target.read(spark).collect()}
    assert got == {k: "new" if 150 <= k < 160 else "more" if k >= 5000 else "old"
                   for k in [*range(2000), *range(5000, 5020)]}
    after = {r["file"] for r in target.index(spark).collect()}
    gone = {r["file"] for r in index} - after
    assert gone == set(report["rewritten"]) and 1 <= len(gone) <= 3
    now = contents(target.path)
    assert all(now[f] == h for f, h in before.items())      # nothing rewritten in place
    removed = target.vacuum(spark)
    assert target.read(spark).count() == 2020 and len(target.versions(spark)) == 1
    assert removed == [] or len(contents(target.path)) < len(now)


def test_new_keys_only_touch_no_file(spark, target):
    report = {}
    load.load(spark, table(spark, 9000, 9010, "x"), target, "upsert", key=["k"], report=report)
    assert report["rewritten"] == [] and target.read(spark).count() == 2010


@pytest.mark.parametrize("where", ["_write_files", "_switch"])
def test_a_failure_before_the_switch_changes_nothing(spark, target, monkeypatch, where):
    before, version = contents(target.path), target.versions(spark)

    def fails(*_, **__):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(VersionedTarget, where, fails)
        with pytest.raises(OSError):
            load.load(spark, table(spark, 0, 50, "new"), target, "upsert", key=["k"])
    assert contents(target.path) == before and target.versions(spark) == version
    assert target.read(spark).where("v = 'old'").count() == 2000
    assert load.load(spark, table(spark, 0, 50, "new"), target, "upsert", key=["k"]) == 2000


def test_of_two_writers_one_fails(spark, target):
    after = target._last(spark)
    target.write(table(spark, 0, 10, "a"), "append")
    with pytest.raises(RuntimeError, match="another writer"):
        target._commit(spark, lambda c: target._write_files(table(spark, 0, 5, "b"), c), after)
    assert target.read(spark).count() == 2010


def test_a_version_without_its_commit_is_not_the_table(spark, target):
    fs, path = target._fs(spark)
    fs.create(path(f"{target.path}/versions/{target._last(spark) + 1:012d}"), False).close()
    assert target.read(spark).count() == 2000
    target.write(table(spark, 0, 10, "a"), "append")
    assert target.read(spark).count() == 2010


def test_first_load_composite_and_text_keys(spark):
    t = VersionedTarget(stage_path(spark, "t-versioned2"), ("a", "b"), rows_per_file=50)
    df = spark.range(300).select(F.concat(F.lit("k"), F.col("id") % 7).alias("a"),
                                 F.col("id").alias("b"), F.lit("x").alias("v"))
    assert load.load(spark, df, t, "upsert", key=["a", "b"]) == 300
    change = df.where("a = 'k3'").withColumn("v", F.lit("y"))
    report = {}
    assert load.load(spark, change, t, "upsert", key=["a", "b"], report=report) == 300
    assert t.read(spark).where("v = 'y'").count() == change.count()
    assert 0 < len(report["rewritten"]) < t.index(spark).count()
    with pytest.raises(ValueError):
        load.load(spark, df, t, "upsert", key=["b", "a"])


def stages(spark):
    base = stage_path(spark, "x").rsplit("/", 1)[0].replace("file:", "")
    names = os.listdir(base) if os.path.isdir(base) else []
    return [n for n in names if n.startswith(("load-incoming", "load-split", "load-stage"))]


def test_file_target_survives_a_failed_load(spark, monkeypatch):
    t = load.FileTarget(stage_path(spark, "t-files"), "parquet")
    t.write(table(spark, 0, 100, "old"), "overwrite")
    held = stages(spark)
    bad = table(spark, 0, 10, "new").withColumn("v", F.when(F.col("k") < 5, "new").otherwise(
        F.raise_error(F.lit("no value"))))
    for mode in ("upsert", "full_refresh"):
        with pytest.raises(Exception, match="no value"):
            load.load(spark, bad, t, mode, key=["k"])
        assert t.read(spark).where("v = 'old'").count() == 100
    # files that are not what was written are noticed before the swap
    real = reconcile.fingerprint
    monkeypatch.setattr(reconcile, "fingerprint", lambda df, *a: real(df.where("k <> 3"), *a))
    with pytest.raises(RuntimeError, match="load check failed"):
        load.load(spark, table(spark, 0, 10, "new"), t, "full_refresh")
    assert t.read(spark).where("v = 'old'").count() == 100 and stages(spark) == held
    folder, name = t.path.rsplit("/", 1)
    left = [n for n in os.listdir(folder.replace("file:", "")) if n.startswith(f"_{name}")]
    assert left == []


def test_null_keys_leave_no_stage(spark):
    t = load.FileTarget(stage_path(spark, "t-nulls"), "parquet")
    held = stages(spark)
    with pytest.raises(ValueError, match="no value in their key"):
        load.load(spark, spark.createDataFrame([(None, "x")], "k long, v string"), t, "upsert",
                  key=["k"])
    assert stages(spark) == held and not path_exists(spark, t.path)
