"""The tape written as files and read back: disk that it takes, and heads of files found without a sort."""

import datetime as dt
import gzip
import re
import time

import pytest
from pyspark.sql import functions as F

from mortar.plans import staging
from mortar.plans.frames import Frames
from mortar.session import shuffles_removed, work_folder
from mortar.sources import tape

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.fixture(scope="module")
def orders(spark):
    folder = work_folder(spark, "orders")
    spark.range(1_500).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"), (F.col("id") * 7 + 0.5).alias("o_totalprice"),
        F.lit(dt.datetime(2000, 1, 5)).alias("o_orderdate"),
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(50).select(F.col("id").alias("c_custkey"), (F.col("id") % 4).alias("c_nationkey")).write.parquet(f"{folder}/customer.parquet")
    spark.range(4).select(F.col("id").alias("n_nationkey")).write.parquet(f"{folder}/nation.parquet")
    return folder


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files.mkString(" ")))


def left_after(spark, write):
    """Shuffle files that a write leaves; they are removed in the background, so it may take a moment."""
    before, until = shuffle_files(spark), time.time() + 10
    write()
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return left


def test_tape_files_are_compressed_and_leave_no_shuffle_files(spark, orders, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "work_folder", lambda spark, name: f"{tmp_path}/{name}")
    write, left = tape.write_csv, []

    monkeypatch.setattr(tape, "write_csv", lambda *args: left.append(left_after(spark, lambda: write(*args))))
    frames = Frames(spark, orders)
    read = staging._tape_from_files(frames)
    assert left == [set()] * 3
    files = [f for f in tmp_path.glob("tapes/*/*") if f.is_file() and not f.name.startswith(("_", "."))]
    assert {f.parent.name for f in files} == {"as-made", "reversed", "one-field-less"} and {f.suffix for f in files} == {".gz"}
    assert sum(len(gzip.decompress(f.read_bytes())) for f in files) > 4 * sum(f.stat().st_size for f in files)
    want = tape.stage_tape(frames.raw()).select(read.columns)
    found, wanted = (sorted(map(repr, df.collect())) for df in (read, want))
    assert len(found) == 9_000 and found == wanted


@pytest.mark.parametrize("given", ["false", "true"])
def test_removing_shuffle_files_is_undone(spark, given):
    spark.conf.set(CLEANUP, given)
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
        assert spark.conf.get(CLEANUP) == "true"
        1 / 0
    assert spark.conf.get(CLEANUP) == given
    spark.conf.unset(CLEANUP)


@pytest.mark.parametrize("block", ["300", "128m"])
def test_heads_of_files_are_found_without_a_sort(spark, tmp_path, monkeypatch, block):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, block)
    # a file of one line, of blank lines between, of many blocks, and compressed ones
    (tmp_path / "a.csv").write_text("AR3,AR1\n")
    (tmp_path / "b.csv").write_text("\n \nAR3,AR1\n\n\nzz,1\nAR3,AR1\naa,2\n")
    (tmp_path / "c.csv").write_text("AR1,AR3\n" + "".join(f"{i},c{i:04d}\n" for i in range(999, -1, -1)))
    for k in range(40):
        (tmp_path / f"d{k}.csv.gz").write_bytes(gzip.compress("".join(["AR3,AR1\n", *[f"d{k} {i},{k}\n" for i in range(k)]]).encode()))
    seen, heads = [], tape._heads
    monkeypatch.setattr(tape, "_heads", lambda lines: seen.append(heads(lines)) or seen[0])
    rows = [tuple(r) for r in tape.read_tape(spark, str(tmp_path)).select("AR3", "AR1", tape.FILE, tape.FIRST, tape.MALFORMED).collect()]
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(name, before)
    assert "Sort" not in plan and "Window" not in plan
    want = [("zz", "1", "b.csv", True, None), ("aa", "2", "b.csv", False, None)]
    want += [(f"c{i:04d}", str(i), "c.csv", i == 999, None) for i in range(1000)]
    want += [(f"d{k} {i}", str(k), f"d{k}.csv.gz", i == 0, None) for k in range(40) for i in range(k)]
    assert sorted(rows) == sorted(want)
