"""Snapshot commits: failures, keys that move, conflicts, clean-up."""

import pytest

from tradelens.snapshots import CommitConflict, SnapshotTable

SCHEMA = "id long, day string, n int, at int"


def rows(df):
    return sorted((tuple(r) for r in df.select("id", "day", "n", "at").collect()), key=str)


def test_upserts_equal_a_dictionary(spark, tmp_path):
    table = SnapshotTable(spark, f"file://{tmp_path}/t", ["day"])
    want = {}
    batches = [[(1, "a b", 1, 1), (1, "a b", 2, 2), (2, "b", 1, 1), (None, "c", 5, 1)], [(2, "c", 7, 3), (3, "d%", 1, 1)], [(None, "a b", 6, 2)], [], [(9, None, 4, 4), (1, "b", 8, 8)], [(9, "b", 5, 5)]]
    for batch in batches:
        last = {}
        for r in sorted(batch, key=lambda r: r[3]):
            last[r[0]] = r
        want |= last
        assert rows(table.upsert(spark.createDataFrame(batch, SCHEMA), ["id"], "at")) == sorted(want.values(), key=str)
    assert rows(table.read(0)) == sorted([(1, "a b", 2, 2), (2, "b", 1, 1), (None, "c", 5, 1)], key=str)


def test_failure_before_the_commit_leaves_the_table(spark, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.upsert(spark.createDataFrame([(1, "a", 1, 1)], SCHEMA), ["id"], "at")

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_publish", fail)
        with pytest.raises(OSError):
            table.upsert(spark.createDataFrame([(1, "a", 2, 2)], SCHEMA), ["id"], "at")
    assert rows(table.read()) == [(1, "a", 1, 1)]
    # a manifest that broke off is no snapshot, and its number is not used again
    (tmp_path / "t/manifests" / f"{1:020d}").write_text("{}\ndata/none")
    assert rows(table.read()) == [(1, "a", 1, 1)] and table.versions() == [0]
    assert rows(table.upsert(spark.createDataFrame([(2, "b", 2, 2)], SCHEMA), ["id"], "at")) == [(1, "a", 1, 1), (2, "b", 2, 2)]
    assert table.versions() == [0, 2]


def test_second_writer_of_a_version_is_refused(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.upsert(spark.createDataFrame([(1, "a", 1, 1)], SCHEMA), ["id"], "at")
    version, schema, folders = table._state()
    table._publish(version + 1, schema, folders)
    with pytest.raises(CommitConflict):
        table._publish(version + 1, schema, folders)


def test_only_touched_partitions_are_written_and_old_files_go(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ["day"])
    table.upsert(spark.createDataFrame([(k, "abcd"[k % 4], k, 1) for k in range(40)], SCHEMA), ["id"], "at")
    before = table._state()[2]
    table.upsert(spark.createDataFrame([(1, "c", 100, 2)], SCHEMA), ["id"], "at")
    after = table._state()[2]
    assert len(set(before) & set(after)) == 2 and len(after) == 4
    assert table.vacuum(keep=1) == [] and table.versions() == [1]
    table.upsert(spark.createDataFrame([(k, "e", k, 9) for k in range(40)], SCHEMA), ["id"], "at")
    assert len(table.vacuum(keep=1, hours=0)) == 2
    assert rows(table.read()) == sorted([(k, "e", k, 9) for k in range(40)], key=str)


def test_new_columns_and_no_table(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.upsert(spark.createDataFrame([(1, 1)], "id long, at int"), ["id"], "at")
    out = table.upsert(spark.createDataFrame([(2, 1, "x")], "id long, at int, extra string"), ["id"], "at")
    assert sorted((r.id, r.extra) for r in out.collect()) == [(1, None), (2, "x")]
