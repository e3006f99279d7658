"""Many writers at a time: no commit is lost, none is made twice."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import commits, incremental as inc, snapshots as snap, versions

from .conftest import rows

OLD, NEW = datetime(2024, 1, 1), datetime(2024, 1, 2)
DATED = "id INT, v STRING, updated_at TIMESTAMP_NTZ, day DATE"


def test_two_writers_lose_and_double_nothing(spark, tmp_path):
    path = str(tmp_path / "t")

    def writer(name):
        return [commits.commit(spark, path, f"{name}{i}", [(f"p={name}{i % 3}", f"{name}{i}")]) for i in range(20)]

    with ThreadPoolExecutor(2) as pool:
        a, b = pool.map(writer, "ab")
    assert sorted(a + b) == list(range(1, 41)) and a == sorted(a) and b == sorted(b)
    log = commits.history(spark, path)
    assert sorted(r.version for r in log.collect()) == sorted(f"{n}{i}" for n in "ab" for i in range(20))
    current, newest = commits.current(spark, path)
    assert newest == 40 and commits.listed(spark, path).checkpoint[0] == 40
    assert {r.partition: r.folder for r in current.collect()} == {f"p={n}{k}": f"{n}{max(i for i in range(20) if i % 3 == k)}" for n in "ab" for k in range(3)}


def test_checkpoint_and_commits_after_it(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(13):
        commits.commit(spark, path, f"v{i}", [(f"p={i}", f"f{i}")])
    assert commits.listed(spark, path).checkpoint[0] == 10
    assert commits.current(spark, path)[0].count() == 13
    commits.commit(spark, path, "all", [(commits.WHOLE, "whole")])  # replaces everything
    assert [r.folder for r in commits.current(spark, path)[0].collect()] == ["whole"]
    assert versions.expired_versions(commits.history(spark, path)).count() == 13


def test_only_overlapping_commits_stop_a_writer(spark, tmp_path):
    path, asked = str(tmp_path / "t"), []
    first = commits.commit(spark, path, "v1", [("d=1", "a"), ("d=2", "b")])
    commits.commit(spark, path, "v2", [("d=2", "c")])
    assert commits.commit(spark, path, "v3", [("d=1", "d")], first, lambda: asked.append(1)) == 3 and asked == [1]
    for delivered in ([("d=2", "e")], [(commits.WHOLE, "e")]):
        with pytest.raises(commits.Overlap):
            commits.commit(spark, path, "v4", delivered, first)
    assert commits.listed(spark, path).newest == 3


def test_merges_at_the_same_time(spark, tmp_path):
    """Eight deltas on the same two dates at once: each change arrives."""
    path = str(tmp_path / "fact")
    days = [date(2024, 1, 1), date(2024, 1, 2)]
    versions.write_version(spark.createDataFrame([(i, "old", OLD, days[i % 2]) for i in range(32)], DATED), path, "day")

    def merge(k):
        delta = [(i, f"by{k}", NEW, days[i % 2]) for i in range(k, 32, 8)] + [(100 + k, "new", NEW, days[k % 2])]
        inc.merge_into_dates(spark, path, spark.createDataFrame(delta, DATED), "day", check_moved=k % 2 == 0)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(merge, range(8)))
    found = dict(rows(versions.read_current(spark, path, DATED).select("id", "v")))
    assert found == {i: f"by{i % 8}" for i in range(32)} | {100 + k: "new" for k in range(8)}
    assert versions.read_current(spark, path, DATED).count() == 40
    assert commits.listed(spark, path).newest == 9


def test_a_key_moved_by_another_writer_is_refused(spark, tmp_path):
    path = str(tmp_path / "fact")
    versions.write_version(spark.createDataFrame([(1, "a", OLD, date(2024, 1, 1))], DATED), path, "day")
    _, number = versions.read_at(spark, path, DATED)
    versions.write_version(spark.createDataFrame([(2, "b", OLD, date(2024, 1, 2))], DATED), path, "day", number)

    def refuse():
        raise ValueError("moved")

    with pytest.raises(ValueError, match="moved"):
        versions.write_version(spark.createDataFrame([(2, "c", OLD, date(2024, 1, 3))], DATED), path, "day", number, refuse)
    current = versions.read_current(spark, path, DATED)
    assert rows(current.select("id", "v")) == [(1, "a"), (2, "b")]
    folders = {p.name for p in (tmp_path / "fact" / "data").iterdir()}
    assert len(folders) == 2  # the refused version left no files


def test_snapshot_runs_at_the_same_time(spark, table, tmp_path):
    root, day = str(tmp_path / "s"), date(2024, 1, 1)
    tables = {"customers": table("customers", {"id": 1})}
    with ThreadPoolExecutor(4) as pool:
        runs = list(pool.map(lambda _: snap.snap_write(tables, root, day), range(8)))
    manifest = snap.snap_manifest(spark, root)
    assert sorted(r.run_id for r in manifest.where(F.col("table_name").isNull()).collect()) == sorted(runs)
    assert snap.snap_latest(spark, root, "customers").count() == 1
