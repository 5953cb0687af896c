"""Checkpoints found in folders."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from catalog import runlogs
from catalog.fixtures import remove_checkpoints, write_checkpoints
from tunetables.operators import checkpoints
from tunetables.sources.checkpoints import checkpoint_folders, local_files
from tunetables.session import shared_dir


def test_folders_and_files(spark, tmp_path):
    for place in (
        "run_id=1/checkpoint-9/a.bin",
        "run_id=1/checkpoint-10/deep/er/a.bin",
        "run_id=1/checkpoint-10/b.bin",
        "run_id=1/checkpoint-200",
        "run_id=1/final/a.bin",
        "run_id=1/log.json",
        "run_id=2/checkpoint-3-old/run_id=7/a.bin",
        "run_id=2/checkpoint-x/a.bin",
        "run_id=3/notes.txt",
        "stray.txt",
    ):
        (tmp_path / place).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / place).write_text("x")
    (tmp_path / "run_id=3/checkpoint-1").mkdir()
    found = checkpoint_folders(spark, str(tmp_path))
    got = {(r["run_id"], r["path"].split(tmp_path.name + "/")[1], r["is_dir"]) for r in found.collect()}
    assert got == {
        (1, "run_id=1/checkpoint-9", True),
        (1, "run_id=1/checkpoint-10", True),
        (1, "run_id=1/checkpoint-200", False),
        (1, "run_id=1/final", True),
        (1, "run_id=1/log.json", False),
        (2, "run_id=2/checkpoint-3-old", True),
        (2, "run_id=2/checkpoint-x", True),
        (3, "run_id=3/notes.txt", False),
    }
    newest = {r["run_id"]: r["path"].split("/")[-1] for r in checkpoints.latest_checkpoint(found).collect()}
    assert newest == {1: "checkpoint-10", 2: "checkpoint-3-old"}


def test_files_are_not_opened(spark, tmp_path):
    (tmp_path / "run_id=1/checkpoint-1").mkdir(parents=True)
    (tmp_path / "run_id=1/checkpoint-1/a").write_text("x")
    plan = checkpoint_folders(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_no_files(spark, tmp_path):
    assert checkpoint_folders(spark, str(tmp_path)).collect() == []


def orders(spark, path, n):
    rows = spark.range(n).select(F.col("id").alias("o_orderkey"), (F.col("id") % 60).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"))
    rows.write.parquet(f"{path}/orders.parquet")


def test_folders_stand_in_rounds(spark, tmp_path, monkeypatch):
    orders(spark, tmp_path, 400)
    whole = {(r["run_id"], r["path"].split("/")[-1], r["is_dir"]) for r in runlogs.stored_checkpoints(spark, str(tmp_path)).collect()}
    assert len(whole) == len({(k % 60 % 20, "final" if k % 13 == 0 else k) for k in range(400)})
    standing = []

    def counted(spark, root):
        standing.append(len(list(Path(root.removeprefix("file:")).glob("*/*"))))
        return checkpoint_folders(spark, root)

    monkeypatch.setattr(runlogs, "checkpoint_folders", counted)
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    found = runlogs.stored_checkpoints(spark, str(tmp_path), standing=100)
    assert {(r["run_id"], r["path"].split("/")[-1], r["is_dir"]) for r in found.collect()} == whole
    assert len(standing) == 4 and sum(standing) == len(whole) and max(standing) < 150
    # the folders are gone, what was found of them stays
    roots = {r["path"].split("/run_id=")[0].removeprefix("file:") for r in found.collect()}
    assert len(roots) == 1 and all(r.startswith(shared_dir(spark).removeprefix("file:")) and not Path(r).exists() for r in roots)
    assert spark.conf.get(key) == before


def test_no_checkpoints(spark, tmp_path):
    orders(spark, tmp_path, 0)
    assert runlogs.stored_checkpoints(spark, str(tmp_path)).collect() == []


def test_local_files_are_those_that_spark_lists(spark, tmp_path):
    for place in (
        "run_id=1/checkpoint-1/deep/er/a.bin",
        "run_id=1/checkpoint-2/_hidden",
        "run_id=1/checkpoint-3/.hidden",
        "run_id=1/checkpoint-4/_a=b",
        "run_id=1/checkpoint-5/_metadata",
        "run_id=1/checkpoint-6/_metadata/a",
        "run_id=1/checkpoint-7/_hidden/a",
        "run_id=1/checkpoint-8/_a=b/a",
        "run_id=1/checkpoint-9/a._COPYING_",
        "run_id=1/.hidden/a",
        "run_id=2/a b%20c/é",
        "run_id=2/[x]*{y}/a",
        "run_id=2/file",
        "_run_id=3/checkpoint-1/a",
        "elsewhere/a",
        "stray.txt",
    ):
        (tmp_path / place).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / place).write_text("x")
    (tmp_path / "run_id=1/checkpoint-10").mkdir()
    (tmp_path / "run_id=1/checkpoint-10/empty").touch()
    (tmp_path / "run_id=2/checkpoint-link").symlink_to(tmp_path / "elsewhere")
    (tmp_path / "run_id=2/broken").symlink_to(tmp_path / "nothing")
    by_spark = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)).select("path")
    want = sorted(r["path"] for r in by_spark.collect())
    assert len(want) == 11
    assert sorted(r["path"] for r in local_files(spark, str(tmp_path)).collect()) == want


def test_local_files_do_not_pass_the_driver(spark, tmp_path):
    (tmp_path / "run_id=1/checkpoint-1").mkdir(parents=True)
    (tmp_path / "run_id=1/checkpoint-1/a").write_text("x")
    found = checkpoint_folders(spark, str(tmp_path))
    # the source of Spark's own would hold every file's status in the driver
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    (tmp_path / "run_id=1/checkpoint-2").mkdir()
    (tmp_path / "run_id=1/checkpoint-2/a").write_text("x")
    assert found.count() == 2


def entries(spark, *rows):
    return spark.createDataFrame([*rows], "run_id long, path string, is_dir boolean")


def standing(root):
    return {str(p.relative_to(root)): p.stat().st_ino for p in root.glob("*/*")}


def test_new_entries_take_the_places_of_former_ones(spark, tmp_path):
    first = entries(spark, *[(k % 3, f"runs/checkpoint-{k}", k % 2 == 0) for k in range(60)])
    second = entries(spark, *[(k % 3, f"runs/checkpoint-{k}", k % 2 == 0) for k in range(60, 120)])
    # more of one kind and fewer of the other, in a run that is new
    third = entries(spark, *[(k % 4, f"runs/checkpoint-{k}", k % 5 > 0) for k in range(120, 180)])
    write_checkpoints(first, str(tmp_path))
    before, last = standing(tmp_path), None
    assert len(before) == 60
    for rows in (second, third):
        write_checkpoints(rows, str(tmp_path), first if last is None else last, tasks=1)
        found = {(r["run_id"], "runs/" + r["path"].split("/")[-1], r["is_dir"]) for r in checkpoint_folders(spark, str(tmp_path)).collect()}
        assert found == {tuple(r) for r in rows.collect()}
        now = standing(tmp_path)
        states = [p / "state" if p.is_dir() else p for p in tmp_path.glob("*/*")]
        assert len(now) == 60 and {s.read_bytes() for s in states} == {b"weights"}
        assert len(set(now.values()) & set(before.values())) == (60 if last is None else 42)  # 30 folders and 12 files
        before, last = now, rows
    # a task that is tried again finds its places filled and the former ones gone
    write_checkpoints(third, str(tmp_path), second)
    assert standing(tmp_path) == before
    remove_checkpoints(third, str(tmp_path))
    remove_checkpoints(third, str(tmp_path))
    assert standing(tmp_path) == {}


def test_former_entries_left_over_go(spark, tmp_path):
    first = entries(spark, *[(k % 3, f"runs/checkpoint-{k}", k % 2 == 0) for k in range(40)])
    second = entries(spark, (7, "runs/checkpoint-100", True), (7, "runs/final", False))
    write_checkpoints(first, f"file://{tmp_path}")
    write_checkpoints(second, f"file://{tmp_path}", first)
    assert set(standing(tmp_path)) == {"run_id=7/checkpoint-100", "run_id=7/final"}
