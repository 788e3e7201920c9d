import os
import uuid

import pytest

from pairmine.schemas import TABLES
from pairmine.sources import keys, segments, tables

NAME = "image_context"


def contexts(spark, names):
    rows = spark.createDataFrame([(n, f"http://a/{n}.png") for n in names], "context_id string, image_url string")
    others = [f.name for f in TABLES[NAME].fields if f.name not in rows.columns]
    return rows.selectExpr("*", *[f"null as {c}" for c in others])


def stored(spark, root, without=None):
    read = tables.read_table(spark, root, NAME, without)
    return sorted(r.context_id for r in read.select("context_id").collect())


def folders(root):
    merged = f"{root}/{NAME}_merged"
    segment = os.listdir(merged) if os.path.exists(merged) else []
    return [n for n in os.listdir(f"{root}/{NAME}") + segment if n[0] not in "._"]


@pytest.fixture
def root(spark, tmp_path):
    where = str(tmp_path / "store")
    tables.create_tables(spark, where)
    return where


def test_fifty_batches_leave_few_folders_and_all_rows(spark, root):
    for i in range(50):
        tables.write_batch(contexts(spark, [f"c{i}a", f"c{i}b"]), root, NAME, f"b{i:02d}")
        tables.compact(spark, root, NAME, fan_in=3)
        # The marker, and at most two batches and two segments of each of three levels.
        assert len(folders(root)) <= 1 + 2 + 2 * 3
    assert stored(spark, root) == sorted(f"c{i}{s}" for i in range(50) for s in "ab")
    held = tables.batches(spark, root, NAME)
    assert held.names() == sorted(["created"] + [f"b{i:02d}" for i in range(50)])
    assert max(s.level for s in held.segments()) == 2
    assert [r.context_id for r in held.read_batch("b07").orderBy("context_id").collect()] == ["c7a", "c7b"]
    assert "c7a" not in stored(spark, root, without="b07") and len(stored(spark, root, without="b07")) == 98


def test_a_merged_batch_can_be_written_again(spark, root):
    for i in range(3):
        tables.write_batch(contexts(spark, [f"old{i}"]), root, NAME, f"b{i}")
    tables.compact(spark, root, NAME, fan_in=3)
    assert not os.path.exists(f"{root}/{NAME}/batch=b1")
    tables.write_batch(contexts(spark, ["new1"]), root, NAME, "b1")
    assert stored(spark, root) == ["new1", "old0", "old2"]
    # The later version also counts when it is merged itself, and when the two segments are.
    for i in range(3, 5):
        tables.write_batch(contexts(spark, [f"old{i}"]), root, NAME, f"b{i}")
    tables.compact(spark, root, NAME, fan_in=3)
    assert stored(spark, root) == ["new1", "old0", "old2", "old3", "old4"]
    tables.write_batch(contexts(spark, []), root, NAME, "b0")
    for i in range(5, 7):
        tables.write_batch(contexts(spark, [f"old{i}"]), root, NAME, f"b{i}")
    tables.compact(spark, root, NAME, fan_in=3)
    assert [s.level for s in tables.batches(spark, root, NAME).segments()] == [1]
    assert stored(spark, root) == ["new1", "old2", "old3", "old4", "old5", "old6"]


def test_a_run_that_dies_leaves_nothing_double(spark, root, monkeypatch):
    for i in range(3):
        tables.write_batch(contexts(spark, [f"c{i}"]), root, NAME, f"b{i}")
    held = tables.batches(spark, root, NAME)
    files = held._files

    class Dying:
        def __getattr__(self, name):
            return getattr(files, name)

        def delete(self, path, deep):
            if "batch=b1" in path.toString():
                raise OSError("lost")
            return files.delete(path, deep)

    held._files = Dying()
    with pytest.raises(OSError):
        held.compact({"created"}, fan_in=3)
    assert "batch=b1" in folders(root) and "batch=b0" not in folders(root)
    assert stored(spark, root) == ["c0", "c1", "c2"]
    # Half a segment has a name that readers pass over.
    contexts(spark, ["x"]).write.parquet(f"{root}/{NAME}_merged/_incoming-{uuid.uuid4().hex}/rows")
    assert stored(spark, root) == ["c0", "c1", "c2"]


def test_large_batches_stay(spark, root, monkeypatch):
    for i in range(3):
        tables.write_batch(contexts(spark, [f"c{i}"]), root, NAME, f"b{i}")
    monkeypatch.setattr(segments, "LARGE_BYTES", 1)
    tables.compact(spark, root, NAME, fan_in=2)
    assert sorted(folders(root)) == ["batch=b0", "batch=b1", "batch=b2", "batch=created"]


def test_keys_of_merged_batches_count(spark, root):
    known = keys.context_keys(spark, root)
    for i in range(4):
        keys.add_context_batch(contexts(spark, [f"c{i}"]), root, f"b{i}")
    # A batch whose keys were never written.
    tables.write_batch(contexts(spark, ["c9"]), root, NAME, "b9")
    tables.compact(spark, root, NAME, fan_in=5)
    assert folders(root) and "batch=b9" not in folders(root)
    known.repair()
    rows = contexts(spark, ["c1", "c9", "c10"])
    assert [r.context_id for r in known.missing(rows, "next", 3).collect()] == ["c10"]
    # A batch that runs again does not see its own earlier keys.
    assert sorted(r.context_id for r in known.missing(rows, "b1", 3).collect()) == ["c1", "c10"]
    known.compact()
    assert [r.context_id for r in known.missing(rows, "next").collect()] == ["c10"]


def test_tables_that_streams_follow_are_refused(spark, root):
    with pytest.raises(ValueError):
        tables.compact(spark, root, "predicted_descriptions")
